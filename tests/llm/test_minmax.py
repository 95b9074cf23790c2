"""Operator 12 against plain Python: components, hubs, open lists, signatures."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripmill.llm import minmax_dedup as dedup
from tripmill.llm import set_pairs
from tests.llm.conftest import DOC_SCHEMA, clashing, edge_rows, prose, rows

SPACE = " \t\n\x0b\x0c\r"


def shingles(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in SPACE:
        text = text.replace(c, " ")
    words = [w for w in text.split(" ") if w]
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def by_hand(docs):
    sets = [shingles(d[1]) for d in docs]
    group = list(range(len(docs)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= 85 * (len(a) + len(sets[j]) - both):
                group[root(i)] = root(j)
    out = []
    for i, d in enumerate(docs):
        ids = [x[0] for k, x in enumerate(docs) if root(k) == root(i) and x[0] is not None]
        component = min(ids, default=None) if sets[i] else d[0]
        out.append((d[0], len(sets[i]), component, d[0] == component))
    return sorted(out, key=repr)


def copies(seed, families=25, each=8):
    pick = random.Random(seed)
    docs = []
    for family in range(families):
        words = prose(seed * 1000 + family, pick.choice([8, 40, 300])).split()
        for _ in range(each):
            changed = list(words)
            for _ in range(pick.randrange(0, 6)):
                changed[pick.randrange(len(changed))] = f"x{pick.randrange(10**6)}"
            docs.append((len(docs), " ".join(changed), "en", "s", None))
    pick.shuffle(docs)
    return docs


def test_near_copies_match_plain_python(spark):
    docs = copies(1) + edge_rows()
    got = dedup.near_duplicates(clashing(spark.createDataFrame(docs, DOC_SCHEMA).repartition(5)))
    assert rows(got) == by_hand(docs)


def test_empty_table(no_documents):
    assert rows(dedup.near_duplicates(no_documents)) == []


def test_lists_that_stay_open_are_compared_in_blocks(spark, monkeypatch):
    """Chains whose ends do not link, without any pivot round, in blocks of a few sets."""
    monkeypatch.setattr(dedup, "ROUNDS", 0)
    monkeypatch.setattr(dedup, "BLOCK", 4)
    words = prose(9, 200).split()
    docs = []
    for i in range(30):
        words = [*words[4:], *(f"n{i}.{k}" for k in range(4))]
        docs.append((i, " ".join(words), "en", "s", None))
    got = rows(dedup.near_duplicates(spark.createDataFrame(docs, DOC_SCHEMA)))
    assert got == by_hand(docs) and {r[2] for r in got} == {0}


def test_a_group_of_a_third_of_all_rows_has_no_hub(spark, monkeypatch):
    """The pivot's set is sent once for every 16 of its pairs, so no task has all of them."""
    monkeypatch.setattr(set_pairs, "CHUNK", 16)
    words = prose(4, 300).split()
    docs = [(i, " ".join([*words[:-1], f"end{i}"]), "en", "s", None) for i in range(600)]
    docs += [(i, prose(i, 60), "en", "s", None) for i in range(600, 1800)]
    frame = spark.createDataFrame(docs, DOC_SCHEMA).withColumn("text_hash", F.xxhash64("text"))
    sets = dedup.stored(dedup.document_sets(frame), "sets")
    members = dedup.listed(sets).withColumn("component", F.col("set_id"))
    pairs = dedup.pivot_pairs(members, 0)
    assert pairs.count() >= 599 and pairs.groupBy("b").count().where("count > 1").count() == 0
    got = rows(dedup.near_duplicates(frame))
    assert {r[2] for r in got if r[0] < 600} == {0} and all(r[3] for r in got if r[0] >= 600)


@pytest.mark.parametrize("percent", [30, 60, 85])
def test_signatures_estimate_similarity(percent):
    pick = np.random.default_rng(percent)
    errors = []
    for _ in range(40):
        pool = pick.integers(0, 1 << 63, 2000, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        shared = int(2000 * percent / 100)
        only = (2000 - shared) // 2
        a, b = np.unique(pool[: shared + only]), np.unique(np.append(pool[:shared], pool[shared + only :]))
        one, two = (np.frombuffer(x, "<u2") for x in dedup.signatures([a, b]))
        errors.append((one == two).mean() - percent / 100)
    spread = (percent / 100 * (1 - percent / 100) / (2 * dedup.PERMUTATIONS)) ** 0.5
    assert abs(np.mean(errors)) < spread and np.std(errors) < 1.4 * spread


def test_chance_of_a_missed_pair():
    assert (1 - 0.85**dedup.BAND) ** dedup.BANDS < 1e-8


def test_only_sets_alike_by_signature_travel_whole(spark, monkeypatch):
    """Sets that share a band's key with others and yet are alike none stay out of the exact step."""
    monkeypatch.setattr(dedup, "ROUNDS", 0)
    monkeypatch.setattr(dedup, "BAND", 1)
    monkeypatch.setattr(dedup, "BANDS", 2 * dedup.PERMUTATIONS)
    asked = []
    run = dedup.elements_of

    def watched(ids, docs, owners):
        asked.append(ids.count())
        return run(ids, docs, owners)

    monkeypatch.setattr(dedup, "elements_of", watched)
    shared = prose(70, 60).split()
    docs = [(i, " ".join([*shared, *prose(700 + i, 60).split()]), "en", "s", None) for i in range(40)]
    docs += [(40, docs[0][1] + " more", "en", "s", None)]
    got = rows(dedup.near_duplicates(spark.createDataFrame(docs, DOC_SCHEMA)))
    assert got == by_hand(docs) and asked == [2]
