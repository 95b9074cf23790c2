"""Damaged payloads and timestamps against Python's own parsers."""

import json
import random
from datetime import datetime, timezone

from conftest import GOOD, event
from pyspark.sql import functions as F

from tripmill.functions.text import rfc3339_timestamp

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def damaged(draw: random.Random, text: str, alphabet: str) -> str:
    """``text`` after one to three random replacements, insertions or deletions."""
    chars = list(text)
    for _ in range(draw.choice([1, 1, 1, 2, 3])):
        at, kind = draw.randrange(len(chars)), draw.random()
        if kind < 0.4:
            chars[at] = draw.choice(alphabet)
        elif kind < 0.7:
            chars.insert(at, draw.choice(alphabet))
        else:
            del chars[at]
    return "".join(chars)


def shape(payload: str) -> str | None:
    """Structural code Python's JSON reader leads to; None if the rules get to see fields."""
    def refuse(token):
        raise ValueError(token)

    try:
        document = json.loads(payload, parse_constant=refuse)
    except ValueError:
        return "INVALID_JSON"
    if not isinstance(document, dict):
        return "NOT_AN_OBJECT"
    return "MISSING_FIELDS" if set(GOOD) - set(document) else None


def test_damaged_json(judge):
    draw = random.Random(11)
    alphabet = "{}[]\",:0123456789.eE+-truefalsnl \\u\n\t'/x\x01é"
    payloads = [damaged(draw, event(), alphabet) for _ in range(4000)]
    for tail in (" ", "\n", "x", "}", "]", ",", "{}", "//c", "\x00", ",1", "],[1", "}}", "﻿"):
        payloads += [event() + tail, tail + event()]
    structural = {"INVALID_JSON", "NOT_AN_OBJECT", "MISSING_FIELDS"}
    for payload, row in zip(payloads, judge(payloads), strict=True):
        found = row.error_code if row.error_code in structural else None
        assert found == shape(payload), payload


def test_damaged_timestamps(spark):
    """Whatever is accepted, Python accepts too, as the same instant."""
    draw = random.Random(12)
    right = ["2025-06-15T08:30:00Z", "2025-06-15T08:30:00.123456+07:00", "20250615T083000Z",
             "2025-06-15T08:30+0700", "2025-06-15 08:30:00,5-03", "2025-06-15T08Z"]
    texts = right + [damaged(draw, draw.choice(right), "0123456789-:T Z+.,tW") for _ in range(4000)]
    frame = spark.createDataFrame([(t,) for t in texts], "s string").select(
        "s", F.unix_micros(rfc3339_timestamp("s")).alias("micros")
    )
    accepted = frame.filter("micros IS NOT NULL").collect()
    assert {r.s for r in accepted} >= set(right)
    for row in accepted:
        moment = datetime.fromisoformat(row.s.replace("Z", "+00:00"))
        since = moment.astimezone(timezone.utc) - EPOCH
        assert (since.days * 86400 + since.seconds) * 10**6 + since.microseconds == row.micros
