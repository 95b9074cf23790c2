import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tripmill.llm import common, components, jaccard_join
from tripmill.llm.jaccard_join import (
    bit_map,
    may_link,
    needed,
    one_of_each,
    prefix,
    set_of,
    subset_keys,
    subset_sizes,
)

from .conftest import clashing, prose


def shingles(text):
    words = [w.translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))) for w in (text or "").encode().split()]
    if not words:
        return frozenset()
    if len(words) < 5:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(docs):
    sets = [shingles(t) for _, t in docs]
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return sorted((repr(d), len(sets[i]), repr(least.get(root(i)))) for i, (d, _) in enumerate(docs))


def found(df):
    return sorted((repr(r.doc_id), r.n_shingles, repr(r.component_id)) for r in jaccard_join.components(df).collect())


def near_copies(seed, groups=8, size=14):
    """Groups of copies of a text with a share of words changed, and short texts."""
    pick = random.Random(seed)
    docs = []
    for g in range(groups):
        base = prose(seed * 100 + g, pick.choice([8, 12, 20, 60, 150])).split()
        for _ in range(size):
            words = list(base)
            for _ in range(int(len(words) * pick.choice([0, 0, 0.01, 0.03, 0.05, 0.1]))):
                words[pick.randrange(len(words))] = f"new{pick.randrange(10**6)}"
            if pick.random() < 0.2:
                words = words[pick.randrange(4) :]
            docs.append(" ".join(words))
    docs += [" ".join(pick.choices("abcdef", k=pick.randrange(1, 14))) for _ in range(60)]
    pick.shuffle(docs)
    return list(enumerate(docs))


def test_edge_documents(documents, no_documents):
    assert found(clashing(documents)) == brute([(r.doc_id, r.text) for r in documents.collect()])
    assert found(no_documents) == []


@pytest.mark.parametrize("seed,pivots", [(1, (1, 4)), (2, ()), (3, (2,))])
def test_near_copies(spark, monkeypatch, seed, pivots):
    monkeypatch.setattr(jaccard_join, "PIVOTS", pivots)
    monkeypatch.setattr(jaccard_join, "LONG", 3 + seed)
    monkeypatch.setattr(jaccard_join, "BLOCK", 8)
    monkeypatch.setattr(jaccard_join, "MIN_COMMON", 2)
    if seed == 3:
        monkeypatch.setattr(jaccard_join, "BROADCAST_ROWS", 0)
        monkeypatch.setattr(common, "BROADCAST_ENTRIES", 0)
    docs = near_copies(seed)
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(7)
    assert found(df) == brute(docs)


def test_a_hub_is_dealt_out(spark, monkeypatch):
    """A group of near copies holds a third of the rows: no place gets many pairs or many copies."""
    monkeypatch.setattr(jaccard_join, "PART", 16)
    monkeypatch.setattr(jaccard_join, "ELEMENTS", 500)
    base = prose(77, 60).split()
    docs = [(i, " ".join([*base[: i % 50], f"new{i}", *base[i % 50 + 1 :]])) for i in range(200)]
    docs += [(1000 + i, prose(5000 + i, 40)) for i in range(400)]
    met, placed, deal, place = [], [], jaccard_join.dealt, jaccard_join.elements_at

    def dealt(pairs, count):
        out = deal(pairs, count)
        for end in ("hub", "member"):
            met.extend(r["count"] for r in out.groupBy(end, f"{end}_part").count().collect())
        return out

    def elements_at(docs, places):
        placed.extend(len(r.hubs) for r in places.collect())
        return place(docs, places)

    monkeypatch.setattr(jaccard_join, "dealt", dealt)
    monkeypatch.setattr(jaccard_join, "elements_at", elements_at)
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(6)
    assert found(df) == brute(docs)
    assert sum(met) > 200 and max(met) <= 48 and max(placed) <= 48


def test_boundary_does_not_change_results(spark, monkeypatch):
    docs = [d for d in near_copies(4) if len(d[1].split()) < 30]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    want = brute(docs)
    for boundary in (0, 4, 9, 12):
        monkeypatch.setattr(jaccard_join, "light_boundary", lambda sets, b=boundary: b)
        assert found(df) == want


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 15), min_size=1, max_size=12), st.sets(st.integers(0, 15), min_size=1, max_size=12))
def test_linked_sets_share_keys(a, b):
    x, y = (np.array(sorted(s), dtype=np.uint64) for s in (a, b))
    linked = 100 * len(a & b) >= 75 * len(a | b)
    assert linked == (len(a & b) >= needed(len(a), len(b)))
    if linked:
        assert set(x[: prefix(len(x))]) & set(y[: prefix(len(y))])
        assert set(subset_keys(x, 12)) & set(subset_keys(y, 12))
        assert needed(len(a), len(b)) in subset_sizes(len(a), 12)
        assert may_link(bit_map(x), len(x), bit_map(y), len(y))


def test_bit_maps_rule_out_most_strangers():
    pick = np.random.default_rng(1)
    a, b = (np.unique(pick.integers(0, 2**63, n).astype(np.uint64)) for n in (900, 700))
    assert not may_link(bit_map(a), len(a), bit_map(b), len(b))
    near = np.unique(np.concatenate([a[60:], b[:60]]))
    assert may_link(bit_map(a), len(a), bit_map(near), len(near))


def test_set_numbers_ignore_order_and_repeats():
    values = np.arange(1, 50, dtype=np.uint64)
    assert set_of(values)[1] == set_of(np.concatenate([values[::-1], values]))[1]
    assert set_of(values)[1] != set_of(values[1:])[1]


def test_one_document_of_each_group_stays(documents, no_documents):
    texts = [(r.doc_id, r.text) for r in documents.collect()]
    left = one_of_each(clashing(documents))
    assert left.columns == clashing(documents).columns
    ids = [r.doc_id for r in left.collect()]
    groups = {}
    for doc_id, _, component in brute(texts):
        groups.setdefault(component, []).append(doc_id)
    assert sorted(map(repr, ids)) == sorted(
        c for c, members in groups.items() for _ in range(1 if c != "None" else len(members))
    )
    assert one_of_each(no_documents).collect() == []


def test_documents_of_equal_or_null_ids_stay_unless_they_link(spark):
    a, b, c, d, e = (prose(900 + i, 60) for i in range(5))
    rows = [(None, a), (None, b), (None, c), (7, c + " x"), (3, d), (3, e), (4, d + " x"), (5, a + " x"),
            (8, b + " x"), (8, b + " x"), (None, None), (None, ""), (9, "a b"), (9, "a b"), (None, prose(950, 60))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    left = sorted(((r.doc_id, r.text) for r in one_of_each(df).collect()), key=repr)
    # A numbered copy stands for the null ids; the one without a copy stays.
    want = [(7, c + " x"), (3, d), (3, e), (5, a + " x"), (8, b + " x"), (None, None), (None, ""), (9, "a b"),
            (None, prose(950, 60))]
    assert left == sorted(want, key=repr)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), min_size=1, max_size=40))
def test_components(spark, links):
    df = spark.createDataFrame(links, "a bigint, b bigint")
    got = {r.id: r.component for r in components.connected(df).collect()}
    reach = {x: {x} for link in links for x in link if link[0] != link[1]}
    for _ in reach:
        for a, b in links:
            if a != b:
                reach[a] = reach[b] = reach[a] | reach[b]
                for x in reach[a]:
                    reach[x] = reach[a]
    assert got == {x: min(r) for x, r in reach.items()}


def test_long_chain(spark):
    links = spark.range(200).selectExpr("id AS a", "id + 1 AS b")
    assert {r.component for r in components.connected(links).collect()} == {0}
