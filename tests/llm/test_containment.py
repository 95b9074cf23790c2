import random

import pytest

from tripmill.llm import containment
from tripmill.llm.containment import MISS, bands, most_bands
from tripmill.llm.decontaminate import contained_items, drop_contaminated
from tripmill.llm.license_scan import NOTICES, find_licenses

from .conftest import clashing, prose


def shingles(text):
    words = (text or "").lower().encode().split()
    if not words:
        return set()
    return {tuple(words)} if len(words) < 5 else {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def merged(rows):
    out = {}
    for i, text in rows:
        out.setdefault(i, set()).update(shingles(text))
    return out


def brute(docs, items):
    want = []
    for d, a in merged(docs).items():
        for i, b in merged(items).items():
            if b and 100 * len(a & b) >= 75 * len(b):
                want.append((repr(d), repr(i), len(b), len(a & b)))
    return sorted(want)


def found(docs, items):
    return sorted((repr(r[0]), repr(r[1]), r[2], r[3]) for r in contained_items(docs, items).collect())


ITEMS = [(i, prose(500 + i, 4 + 7 * i)) for i in range(12)] + [
    (20, "two words"), (21, None), (22, ""), (23, prose(503, 25)), (23, prose(503, 25)), (None, prose(530, 30)),
    (24, "a b c d e"), (25, "A B C D"),
]


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame(ITEMS, "item_id bigint, text string").repartition(3)


def leaking(seed):
    pick = random.Random(seed)
    docs = []
    for i in range(80):
        words = prose(9000 + i, pick.choice([0, 30, 400])).split()
        for _ in range(pick.choice([0, 1, 1, 3, 12])):
            item = (pick.choice(ITEMS)[1] or "").split()
            cut = pick.choice([0, 0, 1, 3])
            words += item[cut:] if pick.random() < 0.8 else item[: len(item) // 2]
        docs.append((i, " ".join(words)))
    return docs + [(0, "two words"), (77, "Two  WORDS"), (78, " ".join(t or "" for _, t in ITEMS * 3))]


def test_edge_documents(documents, no_documents, benchmark):
    docs = [(r.doc_id, r.text) for r in documents.collect()]
    assert found(clashing(documents), clashing(benchmark)) == brute(docs, ITEMS)
    assert found(no_documents, benchmark) == []
    assert found(documents, benchmark.limit(0)) == []


@pytest.mark.parametrize("seed,limit", [(1, 1024), (2, 60), (3, 0)])
def test_leaks(spark, benchmark, monkeypatch, seed, limit):
    """With a low limit large domains go through the inverted lists."""
    monkeypatch.setattr(containment, "MAX_BANDS", limit)
    docs = leaking(seed)
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    assert found(df, benchmark) == brute(docs, ITEMS)


def test_leaking_documents_go(spark, benchmark):
    docs = leaking(4) + [(None, prose(530, 30)), (None, "clean text of an unknown id")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    bad = {d for d, *_ in brute(docs, ITEMS)}
    for rows in (0, 1000):
        left = drop_contaminated(clashing(df), benchmark, broadcast_rows=rows)
        assert left.columns == clashing(df).columns
        assert sorted(repr(r.doc_id) for r in left.collect()) == sorted(repr(d) for d, _ in docs if repr(d) not in bad)


def test_bands_keep_the_promise():
    for set_class in range(0, 8):
        for ratio in range(-1, 6):
            if set_class + ratio < 0:
                continue
            n = most_bands(ratio)
            smallest, largest = 2**set_class, 2 ** (set_class + ratio + 1) - 1
            shared = -(-75 * smallest // 100)
            similarity = shared / (max(largest, shared) + smallest - shared)
            assert n >= bands(set_class + ratio, set_class)
            assert (1 - similarity) ** n <= MISS * 1.01 or similarity >= 1


def test_plans_run_no_python(documents, benchmark):
    for df in (contained_items(documents, benchmark), find_licenses(documents)):
        assert "Python" not in df._jdf.queryExecution().toString() and "Arrow" not in df._jdf.queryExecution().toString()


def slow_licenses(docs):
    templates = {(n, i): shingles(t) for n, ts in NOTICES.items() for i, t in enumerate(ts)}
    classes = {k: len(s).bit_length() - 1 for k, s in templates.items()}
    want = {}
    for doc_id, text in docs:
        words = (text or "").lower().encode().split()
        runs = [tuple(words)] if 0 < len(words) < 5 else [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        for key, parts in templates.items():
            c = classes[key]
            family = set().union(*[s for k, s in templates.items() if classes[k] == c])
            stride = 2 << c
            hits = [(p, s) for p, s in enumerate(runs) if s in family]
            for part in {p // stride - k for p, _ in hits for k in (0, 1)}:
                inside = [(p, s) for p, s in hits if part * stride <= p < (part + 2) * stride]
                shared = len({s for _, s in inside} & parts)
                if 100 * shared >= 75 * len(parts):
                    old = want.get((repr(doc_id), *key), (0, 0, 1 << 60))
                    want[(repr(doc_id), *key)] = (len(parts), max(old[1], shared), min(old[2], inside[0][0]))
    return sorted((*k, *v) for k, v in want.items())


def test_licenses(spark, documents, no_documents):
    pick = random.Random(8)
    docs = []
    every = [t for ts in NOTICES.values() for t in ts]
    for i in range(60):
        words = prose(700 + i, pick.choice([0, 5, 60])).split()
        for _ in range(pick.choice([0, 1, 2])):
            notice = pick.choice(every).split()
            if pick.random() < 0.3:
                notice[pick.randrange(len(notice))] = "changed"
            words += notice + prose(800 + i, pick.choice([0, 3, 30])).split()
        docs.append((i, " ".join(words)))
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    got = sorted((repr(r[0]), *r[1:]) for r in find_licenses(clashing(df)).collect())
    assert got == slow_licenses(docs) and len(got) > 20
    edge = [(r.doc_id, r.text) for r in documents.collect()]
    assert sorted((repr(r[0]), *r[1:]) for r in find_licenses(documents).collect()) == slow_licenses(edge)
    assert find_licenses(no_documents).collect() == []
