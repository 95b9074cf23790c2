import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tripmill.llm import common, suffix_dedup
from tripmill.llm.suffix_dedup import WINDOW, dedup_report, multikey_order, sliding_min

from .conftest import clashing, prose


def brute(docs):
    """(doc_id, n_bytes, n_removed, n_spans, sha) by counting every window."""
    texts = [(i, (t or "").encode()) for i, t in docs]
    seen = Counter(t[i : i + WINDOW] for _, t in texts for i in range(len(t) - WINDOW + 1))
    out = []
    for doc_id, t in texts:
        gone = np.zeros(len(t) + 1, dtype=int)
        for i in range(len(t) - WINDOW + 1):
            if seen[t[i : i + WINDOW]] > 1:
                gone[i] += 1
                gone[i + WINDOW] -= 1
        gone = np.cumsum(gone)[:-1] > 0 if len(t) else np.zeros(0, bool)
        spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if len(t) else 0
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((repr(doc_id), len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def found(df):
    return sorted((repr(r[0]), *r[1:]) for r in dedup_report(df).collect())


def check(spark, docs, partitions=4):
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(partitions)
    assert found(df) == brute(docs)


def test_edge_documents(documents, no_documents):
    want = brute([(r.doc_id, r.text) for r in documents.collect()])
    assert found(clashing(documents)) == want
    assert found(no_documents) == []


def test_driver_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert found(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])


def shared_passages(seed, n=120):
    """Documents that share passages of lengths around the window with different surroundings."""
    pick = random.Random(seed)
    passages = [prose(seed + k, 120)[: pick.choice([390, 399, 400, 401, 420, 520, 600, 640])] for k in range(6)]
    docs = []
    for i in range(n):
        parts = []
        for _ in range(pick.randrange(1, 5)):
            parts.append(prose(1000 * seed + pick.randrange(10**6), pick.randrange(5, 90)))
            p = pick.choice(passages)
            cut = pick.randrange(0, 60)
            parts.append(pick.choice([p, p[cut:], p[: len(p) - cut], p[:200] + "X" + p[200:]]))
        docs.append((i, " ".join(parts)))
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_shared_passages(spark, seed):
    check(spark, shared_passages(seed))


def test_crowded_grams(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CROWD", 3)
    monkeypatch.setattr(suffix_dedup, "WINDOWS", 2000)
    monkeypatch.setattr(suffix_dedup, "BUCKET", 5)
    monkeypatch.setattr(common, "BROADCAST_ENTRIES", 0)
    check(spark, shared_passages(3))


def test_a_passage_of_all_documents_is_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CROWD", 8)
    monkeypatch.setattr(suffix_dedup, "BUCKET", 10)
    passage, boiler = prose(90, 300), prose(91, 90)[:430]
    docs = [(i, prose(9000 + i, 20 + i % 30) + passage + str(i)) for i in range(60)]
    docs += [(100 + i, prose(9500 + i, 3) + boiler + prose(9700 + i, 40)) for i in range(60)]
    check(spark, docs, 6)


def test_periodic_and_long_texts(spark, monkeypatch):
    unit = prose(5, 30)
    docs = [(1, "a" * 1500), (2, "b" * 399 + "a" * 450), (3, unit * 20), (4, unit[7:] * 9), (5, "ab" * 300),
            (6, prose(6, 60_000)), (7, "x" + prose(6, 60_000)[5:200_000]), (8, "c" * 400), (9, "d" * 399)]
    check(spark, docs)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.text(alphabet="ab\0", max_size=30), max_size=60))
def test_multikey_quicksort(texts):
    raw = [t.encode() for t in texts]
    width = 32
    keys = np.frombuffer(b"".join(r.ljust(width, b"\0") for r in raw), np.uint8).reshape(len(raw), width)
    order = multikey_order(keys.view(">u8"), raw) if raw else []
    padded = [raw[i].ljust(width, b"\0") for i in order]
    assert padded == sorted(padded) and sorted(order) == list(range(len(raw)))


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 50), min_size=1, max_size=80), st.integers(1, 20))
def test_sliding_min(values, size):
    size = min(size, len(values))
    want = [min(values[i : i + size]) for i in range(len(values) - size + 1)]
    assert sliding_min(np.array(values, np.uint64), size).tolist() == want


def test_buckets_do_not_name_what_a_task_knows(spark, monkeypatch):
    """Contexts of one crowd whose windows lie in many buckets give a row each, not one or two per bucket."""
    monkeypatch.setattr(suffix_dedup, "WINDOWS", 2000)
    monkeypatch.setattr(suffix_dedup, "CROWD", 8)
    monkeypatch.setattr(suffix_dedup, "SUFFIXES_EACH", 256, raising=False)
    counts, made = [], []
    run, maps = suffix_dedup.crowd_windows, type(spark.range(1)).mapInArrow

    def counted(suffixes, count):
        counts.append(count)
        return run(suffixes, count)

    def watched(df, function, schema, *more):
        out = maps(df, function, schema, *more)
        if function.__name__ == "compare":
            made.append(out.count())
        return out

    monkeypatch.setattr(suffix_dedup, "crowd_windows", counted)
    monkeypatch.setattr(type(spark.range(1)), "mapInArrow", watched)
    words = prose(50, 110).split()
    docs = [(i, " ".join([*words[:70], f"x{i}", *words[70:]])) for i in range(300)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        check(spark, docs, 6)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert 0 < made[0] <= 1.2 * counts[0]
