"""Operator 11 against plain Python: counts, cuts, nested phrases, borders that fail."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from tripmill.llm import phrase_mining as mining
from tests.llm.conftest import DOC_SCHEMA, clashing, edge_rows, rows


def by_hand(docs, least, top):
    counts, totals = {}, Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, 6):
                grams = (tuple(words[i : i + k]) for i in range(len(words) - k + 1))
                counts.setdefault(lang, Counter()).update(grams)
    out = []
    for lang, count in counts.items():
        wanted = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        inside = {
            p[i:j]
            for p, a in wanted.items()
            for i in range(len(p))
            for j in range(i + 2, len(p) + 1)
            if j - i < len(p) and a >= wanted[p[i:j]]
        }
        scored = []
        for p in wanted.keys() - inside:
            a, n = wanted[p], totals[lang]
            cuts = ((1000 * a * n // (count[p[:k]] * count[p[k:]]), k) for k in range(1, len(p)))
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, totals[lang], -score))
    return sorted(out, key=repr)


def corpus(seed=7, n=160):
    pick = random.Random(seed)
    letters = ["alpha", "Beta", "gamma", "dé", "漢字", "e1", "f-g", "the", "of", "and"]
    phrases = ["the quick brown fox jumps", "of and the", "Beta gamma dé", "漢字 \t 漢字 漢字"]
    docs = []
    for i in range(n):
        parts = [pick.choice(phrases) if pick.random() < 0.4 else pick.choice(letters) for _ in range(40)]
        text = "".join(p + pick.choice([" ", " ", " ", "  ", "\t", ". ", ", ", "\n", "!", "\r"]) for p in parts)
        docs.append((i, text, pick.choice(["en", "en", None, "fr", ""]), "s", None))
    return docs


@pytest.mark.parametrize("least, top", [(10, 2000), (40, 5)])
def test_phrases_match_plain_python(spark, least, top):
    docs = corpus()
    got = mining.collocations(spark.createDataFrame(docs, DOC_SCHEMA).repartition(3), least, top)
    assert rows(got) == by_hand([(d[2], d[1]) for d in docs], least, top)


def test_edge_rows_clashing_columns_and_repeats(spark, documents):
    docs = edge_rows() * 2
    frame = clashing(spark.createDataFrame(docs, DOC_SCHEMA))
    assert rows(mining.collocations(frame, 3)) == by_hand([(d[2], d[1]) for d in docs], 3, 2000)


def test_empty_table(no_documents):
    assert rows(mining.collocations(no_documents)) == []


def test_phrases_that_the_sample_misses_are_found(spark, monkeypatch):
    """Nothing is proposed, so every frequent word fails the border and all phrases are left to find."""
    monkeypatch.setattr(mining, "SAMPLE", 1 << 40)
    docs = corpus(11, 60)
    frame = spark.createDataFrame(docs, DOC_SCHEMA)
    assert mining.sampled_phrases(frame, 20).count() == 0
    assert rows(mining.collocations(frame, 20)) == by_hand([(d[2], d[1]) for d in docs], 20, 2000)


def test_a_complete_sample_proposes_all(spark, monkeypatch):
    monkeypatch.setattr(mining, "SAMPLE", 1)
    docs = corpus(12, 60)
    got = mining.collocations(spark.createDataFrame(docs, DOC_SCHEMA), 20)
    assert rows(got) == by_hand([(d[2], d[1]) for d in docs], 20, 2000)


def test_maps_that_let_everything_through_change_nothing(spark, monkeypatch):
    full = mining.BitMap(np.full(1 << 13, 255, dtype=np.uint8))
    monkeypatch.setattr(mining, "bit_map", lambda phrases: full)
    docs = corpus(13, 40)
    got = mining.collocations(spark.createDataFrame(docs, DOC_SCHEMA), 12)
    assert rows(got) == by_hand([(d[2], d[1]) for d in docs], 12, 2000)


def test_scores_beyond_64_bits_are_exact(spark, monkeypatch):
    big = 9_000_000_000_000
    found = spark.createDataFrame(
        [("en", 0, "", 10**17), ("en", 1, "a", big + 7), ("en", 1, "b", big + 9), ("en", 2, "a b", big)],
        mining.NAMED,
    )
    monkeypatch.setattr(mining, "frequent_phrases", lambda docs, least: found)
    empty = spark.createDataFrame([], DOC_SCHEMA)
    score = 1000 * big * 10**17 // ((big + 7) * (big + 9))
    assert rows(mining.collocations(empty)) == [("en", 1, "a b", big, big + 7, big + 9, 10**17, score)]
