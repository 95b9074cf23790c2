"""Operator 13 against all audits of small conversations, and long ones against short ones."""

import random
import re
from hashlib import sha256
from itertools import product
from zlib import crc32

import pytest

from tripmill.llm import audit_trails as trails
from tripmill.llm import conversation_repair as repair
from tests.llm.conftest import rows

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
FORM = re.compile(r"(s?(ua)+)?")
COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def faults_by_hand(own):
    seen, out = set(), []
    for _, role, text in own:
        inside = re.sub(r"[\x20\x09-\x0D]", "", text)
        fault = "blank" if not inside else "duplicate" if (role, text) in seen else ""
        fault = fault or ("" if inside[-1] in ".!?" else "truncated")
        seen.add((role, text))
        out.append(fault)
    return out


def best_by_hand(own, faults):
    """(cost, audit, repaired lines) of the best of all sequences of edits with few inserted turns."""
    best = None

    def go(i, cost, audit, turns, inserted):
        nonlocal best
        initials = "".join(role[:1] for role, _ in turns)
        if not re.fullmatch(r"s?(ua)*u?", initials) or (best and cost > best[0]):
            return
        if i == len(own) and FORM.fullmatch(initials):
            found = (cost, audit, "\n".join(f"{r}:{t}" for r, t in turns))
            best = found if best is None else min(best, found)
        if inserted < 2 * len(own) + 2:
            for role in ("user", "assistant"):
                go(i, cost + 2, audit + "I", [*turns, (role, "")], inserted + 1)
        if i == len(own):
            return
        _, role, text = own[i]
        go(i + 1, cost + 3, audit + "D", turns, inserted)
        if faults[i] not in ("blank", "duplicate"):
            more = faults[i] == "truncated"
            go(i + 1, cost + more, audit + "K", [*turns, (role, text)], inserted)
            for other in ("user", "assistant"):
                go(i + 1, cost + 2 + more, audit + "R", [*turns, (other, text)], inserted)

    best = (3 * len(own), "D" * len(own), "")
    go(0, 0, "", [], 0)
    return best


def report_by_hand(conv_id, own):
    faults = faults_by_hand(own)
    cost, audit, text = best_by_hand(own, faults)
    numbers = [t for t, _, _ in own if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    pairs = zip((r[:1] for _, r, _ in own), [r[:1] for _, r, _ in own][1:])
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in pairs)
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (conv_id, gaps, *counts, illegal, cost, audit, sha256(text.encode()).hexdigest())


def ordered(own):
    return sorted(own, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))


def damaged_by_hand(table):
    kept = {}
    for conv_id, turn, role, text in table:
        own = kept.setdefault(conv_id, [])
        key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        fate = crc32(key.encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if fate == 1:
            text = ""
        elif fate == 2:
            text = re.sub("[.!?]", "", text)
        elif fate == 4:
            role = "user"
        own += [(turn, role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    return {k: ordered(v) for k, v in kept.items()}


def conversations(seed, n, most):
    pick = random.Random(seed)
    texts = ["Hello.", "No", "Well!", "", " \t\n", "Why?\x0b ", None, "x.y", "Hello.", " "]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None, ""]
    out = []
    for conv in range(n):
        turn = 0
        for _ in range(pick.randrange(1, most + 1)):
            turn += pick.choice([0, 1, 1, 1, 3])
            out.append((conv or None, pick.choice([turn] * 9 + [None]), pick.choice(roles), pick.choice(texts)))
    return out


def test_audits_are_the_best_of_all():
    pick = random.Random(5)
    for kinds in [*product(range(11), repeat=2), *(tuple(pick.choices(range(11), k=4)) for _ in range(150))]:
        own, faults = [], []
        for i, kind in enumerate(kinds):
            own.append((i, ["system", "user", "assistant", "tool", ""][(kind - 1) // 2] if kind else "user", f"{i}."))
            faults.append("blank" if not kind else "truncated" if (kind - 1) % 2 else "")
        cost, letters, tail = trails.audit(kinds)
        assert (cost, "".join(letters) + tail) == best_by_hand(own, faults)[:2]


@pytest.mark.parametrize("modulus", [1, 2, 7])
def test_hash_collisions_change_nothing(modulus):
    pick = random.Random(modulus)
    for size in (1, 5, 40, 200):
        kinds = pick.choices(range(11), k=size)
        assert trails.audit(kinds, modulus) == trails.audit(kinds)


def test_runs_compose_to_the_same_audit():
    pick = random.Random(3)
    for size in (3, 17, 64):
        kinds = pick.choices(range(11), k=size)
        moves = [trails.moves_of(k) for k in kinds]
        parts = [moves[i : i + 5] for i in range(0, size, 5)]
        whole = [trails.composed(p) for p in parts]
        ends = trails.composed(whole)[0]
        end = trails.choose_end(ends, lambda a, b: a - b)
        states, letters, state = trails.states_between(whole, 0, end), [], 0
        for part, leave in zip(parts, states):
            for move, after in zip(part, trails.states_between(part, state, leave)):
                letters.append(move[state][after][1])
                state = after
        assert (ends[end][0] + trails.tail_cost(end), letters, trails.TAILS[end]) == trails.audit(kinds)


def test_reports_match_plain_python(spark):
    table = conversations(1, 60, 5)
    frame = spark.createDataFrame(table, SCHEMA).selectExpr("*", "1 AS at", "2 AS copies", "3 AS fault").repartition(4)
    want = [report_by_hand(k, v) for k, v in damaged_by_hand(table).items()]
    assert rows(repair.audited_after_damage(frame), *COLUMNS) == sorted(want, key=repr)


def test_long_conversations_match_short_ones(spark, monkeypatch):
    table = conversations(2, 40, 30) + conversations(3, 3, 700) + [(7, 3, "user", "same.")] * 90
    frame = spark.createDataFrame(table, SCHEMA).repartition(6)
    want, turns = rows(repair.audited(frame)), rows(repair.repaired(frame))
    monkeypatch.setattr(repair, "LONG_ROWS", 8)
    monkeypatch.setattr(repair, "FAN", 3)
    long = repair.long_conversations(frame.fillna(" ", ["role", "text"])).count()
    assert 0 < long < 40
    assert rows(repair.audited(frame)) == want
    assert rows(repair.repaired(frame)) == turns


def test_rows_of_one_conversation_lie_in_many_tasks(spark):
    one = [(1, i % 700, "user" if i % 2 else "assistant", f"{i}.") for i in range(3000)]
    table = spark.createDataFrame(one, SCHEMA)
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    try:
        placed = repair.ordered_rows(table).selectExpr("shiftright(at, 33) AS task").groupBy("task").count()
        sizes = [r["count"] for r in placed.collect()]
    finally:
        spark.conf.unset(setting)
    assert len(sizes) > 4 and max(sizes) < 1500


def test_repaired_turns(spark):
    own = [(1, 0, "assistant", "Hi."), (1, 2, "user", "And"), (1, 3, "user", "Well."), (2, 0, "system", " ")]
    got = rows(repair.repaired(spark.createDataFrame(own, SCHEMA)))
    assert got == [
        (1, 0, "I", "user", ""), (1, 1, "K", "assistant", "Hi."), (1, 2, "K", "user", "And"),
        (1, 3, "R", "assistant", "Well."),
    ]


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert rows(repair.audited_after_damage(empty)) == [] == rows(repair.repaired(empty))
