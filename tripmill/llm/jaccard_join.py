"""Operator 7, n-gram Jaccard join: size-aware, heavy sets by inverted lists, light ones by subsets.

Two documents link when the Jaccard similarity of their sets of five-word shingles is
75 percent or more. Equal sets are one node. To share enough elements,

* two light sets (few elements) must have a subset of the needed size in common, so
  all their subsets of the sizes that partners of any size may need become keys;
* other pairs must share one of their rarest elements: with ``n`` elements, one of the
  first ``n - ceil(0.75 n) + 1`` in an order common to all sets. These become keys
  as well, and sets with a key in common are found by scanning its list.

The boundary between light and heavy sets is where listing subsets begins to cost
more than scanning lists, judged by the mean length of the lists that small sets meet.
Elements seen twice or more in a block of documents are counted over all blocks and
come last in the order, so that common passages make no long lists.

Components do not need all links. In two rounds every list names pivots, those of its
members that are in most lists and so have been changed least; members are compared with
the pivots, and lists whose members are all connected are done. In lists that stay open
all pairs across components are compared, in long ones block against block. A bit map of
each set first gives a lower bound of how many elements only one of a pair has; pairs that
may still link are compared exactly, on whole sets (of 64-bit hashes).

Null or empty texts have the empty set and stand alone. Equal rows are linked by
their equal sets; a null id never becomes a component's name while there is another. An
empty table gives no rows; other columns are ignored. Members of a key are thinned to
one set a block before the shuffle and the rest is dealt out salted, so a key that
a third of all documents have is no task's burden. The pairs of a set with many partners are
dealt out over parts, and the set is sent to each part once.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tripmill.llm.common import bounded, columns_here, in_batches, in_small_batches, in_tasks, slices, stored
from tripmill.llm.components import connected
from tripmill.llm.wordhash import mixed, shingle_arrays

MIN_PCT = 75
#: Sets of more elements are never light.
MOST_LIGHT = 12
#: The order of elements knows the counts of at most so many common ones; it is any
#: order, and the results are the same for all orders.
COMMON = 500_000
MIN_COMMON = 4
PIVOTS = (1, 4)
#: Lists of more members are long; their members are compared in blocks of up to so many.
LONG = 64
BLOCK = 4096
#: Members, pairs and whole sets that a task takes on.
MEMBERS, PAIRS, WHOLE = 500_000, 50_000, 10_000
SALTS = 64
#: Pairs of a set that are joined to it at one place, and elements of sets in a batch of copies.
PART, ELEMENTS = 256, 1 << 19
BROADCAST_ROWS = 1_000_000

_SUBSET = 0xE7037ED1A0B428DB


def needed(n: int, m: int) -> int:
    """Elements that sets of these sizes must share to link."""
    return -(-MIN_PCT * (n + m) // (100 + MIN_PCT))


def prefix(n: int) -> int:
    """How many of a set's first elements must hold one that any partner has."""
    return n - -(-MIN_PCT * n // 100) + 1


def subset_sizes(n: int, boundary: int) -> list[int]:
    """Sizes of common subsets of a light set and its light partners."""
    low, high = -(-MIN_PCT * n // 100), min(100 * n // MIN_PCT, boundary)
    return sorted({needed(n, m) for m in range(low, high + 1)})


@lru_cache(maxsize=None)
def _choices(n: int, size: int) -> np.ndarray:
    return np.array(list(combinations(range(n), size)), dtype=np.int64).reshape(-1, size)


def subset_keys(elements: np.ndarray, boundary: int) -> np.ndarray:
    spread = mixed(elements ^ np.uint64(_SUBSET))
    keys = [
        mixed(
            spread[_choices(len(elements), size)].sum(1, dtype=np.uint64)
            + np.uint64(_SUBSET * size % (1 << 64))
        )
        for size in subset_sizes(len(elements), boundary)
    ]
    return np.concatenate(keys)


def set_of(shingles: np.ndarray) -> tuple[np.ndarray, int]:
    """The distinct elements in order, and a number for the set (signed 64 bits)."""
    elements = np.unique(shingles)
    total = mixed(elements).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(elements))
    return elements, int(mixed(total).view(np.int64)[0])


def bit_map(elements: np.ndarray) -> bytes:
    """One bit per element at its hash, in at least four times as many bits."""
    bits = max(64, 1 << int(4 * len(elements) - 1).bit_length())
    at = elements & np.uint64(bits - 1)
    out = np.zeros(bits, dtype=bool)
    out[at.astype(np.int64)] = True
    return np.packbits(out, bitorder="little").tobytes()


def may_link(left: bytes, n_left: int, right: bytes, n_right: int) -> bool:
    """False if the bit maps show that two sets share too little."""
    a, b = (np.frombuffer(x, dtype=np.uint64) for x in (left, right))
    # A bit of a shorter map stands for all bits of the longer one with its number's end.
    if len(a) > len(b):
        a = np.bitwise_or.reduce(a.reshape(-1, len(b)), axis=0)
    elif len(b) > len(a):
        b = np.bitwise_or.reduce(b.reshape(-1, len(a)), axis=0)
    only_a, only_b = int(np.bitwise_count(a & ~b).sum()), int(np.bitwise_count(b & ~a).sum())
    return min(n_left - only_a, n_right - only_b) >= needed(n_left, n_right)


SETS = (
    "doc_id bigint, n_shingles bigint, set_id bigint, bits binary, few array<bigint>,"
    " common array<bigint>"
)


def document_sets(docs: DataFrame) -> DataFrame:
    """One row per document, the bit map on the first row of a set in a batch; elements that a
    batch has in two sets or more ride on its first row."""

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        sizes, ids, bits, few, seen = [], [], [], [], {}
        for shingles in shingle_arrays(batch.column(1)):
            elements, set_id = set_of(shingles)
            sizes.append(len(elements))
            ids.append(set_id)
            bits.append(bit_map(elements) if set_id not in seen else None)
            few.append(elements.view(np.int64) if 0 < len(elements) <= MOST_LIGHT else None)
            if set_id not in seen:
                seen[set_id] = elements
        common = [None] * len(ids)
        if ids:
            every = np.sort(np.concatenate(list(seen.values())))
            again = every[1:] == every[:-1]
            # An element of k sets is listed k - 1 times.
            common[0] = every[1:][again].view(np.int64)
        return {
            "doc_id": batch.column(0), "n_shingles": sizes, "set_id": ids, "bits": bits, "few": few,
            "common": common,
        }

    return in_batches(docs, SETS, work)


def light_boundary(sets: DataFrame) -> int:
    """The largest size up to which subsets cost less than list scans, 0 if none."""
    small = sets.where("few IS NOT NULL").select("set_id", "few").dropDuplicates(["set_id"])
    lists = small.select(F.explode("few").alias("e")).groupBy("e").agg(F.count("*").alias("n"))
    mean = lists.agg(F.sum(F.col("n") * F.col("n")) / F.sum("n")).first()[0] or 1.0
    best = 0
    for n in range(1, MOST_LIGHT + 1):
        if sum(comb(n, size) for size in subset_sizes(n, n)) > prefix(n) * mean:
            break
        best = n
    return best


KEYS = "key bigint, salt int, set_id bigint, size int, shared boolean"


def keyed_sets(docs: DataFrame, boundary: int, order: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """The keys of every distinct set of a batch.

    For a key that several sets of the batch have, one set stands for the batch
    (salt 0), and the others are rows of their own, salted and marked as shared.
    """
    ranked = docs.sparkSession.sparkContext.broadcast(order)
    from_size = -(-MIN_PCT * (boundary + 1) // 100)

    def sorted_by_count(elements: np.ndarray, common: np.ndarray, counts: np.ndarray) -> np.ndarray:
        if not len(common):
            return elements
        at = np.minimum(np.searchsorted(common, elements), len(common) - 1)
        known = common[at] == elements
        if not known.any():
            return elements
        return elements[np.lexsort((elements, np.where(known, counts[at], 0)))]

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        common, counts = ranked.value
        keys, owners, sizes, seen = [], [], [], set()
        for shingles in shingle_arrays(batch.column(1)):
            elements, set_id = set_of(shingles)
            n = len(elements)
            if n == 0 or set_id in seen:
                continue
            seen.add(set_id)
            own = []
            if n <= boundary:
                own.append(subset_keys(elements, boundary))
            if n >= from_size:
                own.append(sorted_by_count(elements, common, counts)[: prefix(n)])
            own = np.unique(np.concatenate(own)) if len(own) > 1 else own[0]
            keys.append(own)
            owners.append(np.full(len(own), set_id, dtype=np.int64))
            sizes.append(np.full(len(own), n, dtype=np.int32))
        if not keys:
            return {"key": [], "salt": [], "set_id": [], "size": [], "shared": []}
        key, owner, size = map(np.concatenate, (keys, owners, sizes))
        by = np.lexsort((owner, key))
        key, owner, size = key[by], owner[by], size[by]
        first = np.concatenate([[True], key[1:] != key[:-1]])
        last = np.concatenate([key[1:] != key[:-1], [True]])
        salt = np.where(first, 0, 1 + (owner.view(np.uint64) % np.uint64(SALTS)).astype(np.int64))
        return {
            "key": key.view(np.int64), "salt": salt, "set_id": owner, "size": size,
            "shared": ~(first & last),
        }

    return in_batches(docs, KEYS, work)


def open_members(members: DataFrame, component: DataFrame | None) -> DataFrame:
    """The members, with their components, of the lists whose members are not all connected."""
    if component is None:
        return members.withColumn("component", F.col("set_id"))
    named = members.join(component.withColumnRenamed("id", "set_id"), "set_id", "left").withColumn(
        "component", F.coalesce("component", "set_id")
    )
    spread = named.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return named.join(spread.where("low <> high").select("key"), "key").select(
        "key", "set_id", "size", "lists", "component"
    )


def alike_in_size(a: str, b: str) -> str:
    return f"100 * least({a}, {b}) >= {MIN_PCT} * greatest({a}, {b})"


def pivot_pairs(members: DataFrame, pivots: int) -> DataFrame:
    """Distinct (a, b) of list members and the pivots of the list, across components.

    The first pivot is the member that is in most lists; chance has a part in the choice of others.
    """
    chance = ["1.0D"] + [f"(0.5D + pmod(xxhash64(set_id, {i}), 1000) / 2000D)" for i in range(1, pivots)]
    picked = members.groupBy("key").agg(
        *[
            F.max(F.struct(F.expr(f"lists * {c}"), "set_id", "size", "component")).alias(f"p{i}")
            for i, c in enumerate(chance)
        ]
    )
    each = F.array(*[
        F.struct(*[F.col(f"p{i}.{c}").alias(f"p_{c}") for c in ("set_id", "size", "component")])
        for i in range(pivots)
    ])
    picked = picked.select("key", F.explode(F.array_distinct(each)).alias("p")).select("key", "p.*")
    met = members.join(picked, "key").where("component <> p_component").where(
        alike_in_size("size", "p_size")
    )
    return met.selectExpr("least(set_id, p_set_id) AS a", "greatest(set_id, p_set_id) AS b").distinct()


def pairs_across(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Distinct (a, b) with a key in common, of different components, that may link."""
    sized = members.groupBy("key").agg(F.count("*").alias("n"))
    sized = members.join(sized, "key")
    short = sized.where(F.col("n") <= LONG)
    other = short.select("key", *[F.col(c).alias(f"o_{c}") for c in ("set_id", "size", "component")])
    met = short.join(other, "key").where("set_id < o_set_id AND component <> o_component").where(
        alike_in_size("size", "o_size")
    )
    pairs = met.select(F.col("set_id").alias("a"), F.col("o_set_id").alias("b")).distinct()
    return possible(pairs, sets).unionByName(pairs_of_blocks(sized.where(F.col("n") > LONG), sets)).distinct()


def pairs_of_blocks(members: DataFrame, sets: DataFrame) -> DataFrame:
    """As ``pairs_across`` for long lists: blocks of members meet in one task each, where pairs are
    made and judged by their bit maps without ever becoming rows."""
    members = stored(members, "join-long")
    maps = with_maps(members.select("set_id").distinct(), sets)
    cells = members.withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    cells = cells.withColumn("mine", F.expr("CAST(pmod(xxhash64(set_id), blocks) AS INT)"))
    cells = cells.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    cells = cells.select(
        "key", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"), "mine",
        "set_id", "component",
    ).join(maps, "set_id")
    cells = cells.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")

    def met(rows: list[dict]) -> pa.RecordBatch:
        """Pairs of one cell; longer bit maps are folded to the shortest."""
        ids = np.array([r["set_id"] for r in rows])
        size = np.array([r["n_shingles"] for r in rows])
        part = np.array([r["component"] for r in rows])
        mine = np.array([r["mine"] for r in rows])
        within = rows[0]["low"] == rows[0]["high"]
        raw = [np.frombuffer(r["bits"], dtype=np.uint64) for r in rows]
        left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        # Sets whose sizes are alike enough to link have maps of the same length or half of it.
        lengths = np.array([len(x) for x in raw])
        for words in np.unique(lengths):
            near = np.flatnonzero((lengths == words) | (lengths == 2 * words))
            maps = np.stack([np.bitwise_or.reduce(raw[k].reshape(-1, words), axis=0) for k in near])
            for i in np.flatnonzero(lengths[near] == words):
                k = near[i]
                j = np.flatnonzero(
                    (part[near] != part[k])
                    & ((lengths[near] > words) | (ids[near] > ids[k]))
                    & (within | (mine[near] != mine[k]))
                    & (100 * np.minimum(size[near], size[k]) >= MIN_PCT * np.maximum(size[near], size[k]))
                )
                if not len(j):
                    continue
                only_i = np.bitwise_count(maps[i] & ~maps[j]).sum(1, dtype=np.int64)
                only_j = np.bitwise_count(maps[j] & ~maps[i]).sum(1, dtype=np.int64)
                need = -(-MIN_PCT * (size[k] + size[near][j]) // (100 + MIN_PCT))
                j = near[j[np.minimum(size[k] - only_i, size[near][j] - only_j) >= need]]
                left.append(np.full(len(j), ids[k]))
                right.append(ids[j])
        a, b = np.concatenate(left), np.concatenate(right)
        columns = [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))]
        return pa.RecordBatch.from_arrays(columns, names=["a", "b"])

    def run(batches):
        now, rows = None, []
        for batch in batches:
            for row in batch.to_pylist():
                cell = (row["key"], row["low"], row["high"])
                if cell != now and rows:
                    yield met(rows)
                    rows = []
                now = cell
                rows.append(row)
        if rows:
            yield met(rows)

    return cells.mapInArrow(run, "a bigint, b bigint")


def small(df: DataFrame) -> DataFrame:
    """Marked for broadcast if it has few rows, else left to a shuffle."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def with_maps(ids: DataFrame, sets: DataFrame) -> DataFrame:
    """(set_id, bits, n_shingles) of the given sets."""
    wanted = stored(ids, "join-ids")
    maps = sets.where("bits IS NOT NULL").select("set_id", "bits", "n_shingles")
    maps = maps.join(small(wanted), "set_id").dropDuplicates(["set_id"])
    return stored(in_tasks(maps, wanted.count(), PAIRS), "join-maps")


def dealt(pairs: DataFrame, count: int) -> DataFrame:
    """(hub, hub_part, member, member_part) for each pair (a, b); the hub is the one in more pairs.

    The pairs of a set that is in more than ``PART`` are dealt out over parts of about as many, so
    what is joined to a set is joined to its parts, by many tasks.
    """
    ends = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id")))
    busy = ends.groupBy("id").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"))
    busy = small(stored(in_tasks(busy.where("parts > 1"), count, MEMBERS), "join-busy"))
    for c in "ab":
        parts = busy.select(F.col("id").alias(c), F.col("parts").alias(f"{c}_parts"))
        pairs = pairs.join(parts, c, "left").fillna(1, [f"{c}_parts"])
    pairs = pairs.selectExpr(
        "a_parts >= b_parts AS a_hub",
        "named_struct('id', a, 'part', CAST(pmod(xxhash64(b), a_parts) AS INT)) AS a",
        "named_struct('id', b, 'part', CAST(pmod(xxhash64(a), b_parts) AS INT)) AS b",
    ).selectExpr("IF(a_hub, a, b) AS hub", "IF(a_hub, b, a) AS member")
    return stored(
        pairs.selectExpr(
            "hub.id AS hub", "hub.part AS hub_part", "member.id AS member", "member.part AS member_part"
        ),
        "join-dealt",
    )


def as_pairs(found: DataFrame) -> DataFrame:
    return found.selectExpr("least(hub, member) AS a", "greatest(hub, member) AS b")


def possible(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs that the bit maps do not rule out."""
    pairs = stored(pairs, "join-pairs")
    count = pairs.count()
    ids = in_tasks(pairs.select(F.col("a").alias("set_id")).union(pairs.select("b")).distinct(), count, PAIRS)
    maps = with_maps(ids, sets)
    both = dealt(pairs, count)
    for c in ("hub", "member"):
        own = maps.select(F.col("set_id").alias(c), F.col("bits").alias(f"{c}_bits"), F.col("n_shingles").alias(f"{c}_n"))
        copies = both.select(c, f"{c}_part").distinct().join(own, c)
        both = in_tasks(both.join(in_tasks(copies, count, PAIRS), [c, f"{c}_part"]), count, PAIRS)
    both = both.select("hub", "member", "hub_bits", "hub_n", "member_bits", "member_n")

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        columns = (batch.column(k).to_pylist() for k in range(2, 6))
        keep = pa.array([may_link(*four) for four in zip(*columns)], pa.bool_())
        return {"hub": batch.column(0).filter(keep), "member": batch.column(1).filter(keep)}

    return as_pairs(in_batches(both, "hub bigint, member bigint", work))


COPIES = "hub bigint, hub_part int, set_id bigint, elements array<bigint>"


def elements_at(docs: DataFrame, places: DataFrame) -> DataFrame:
    """(hub, hub_part, set_id, elements) for every place (owner, set_id, hubs, parts) of a set.

    The copies leave in batches of a bounded size, however many places a set has.
    """
    places = bounded(stored(places, "join-places"), "hubs")
    rows = docs.join(places, docs["doc_id"].eqNullSafe(places["owner"]))
    rows = rows.select("text", "set_id", "hubs", "parts")
    names = ["hub", "hub_part", "set_id", "elements"]

    def batch_of(out: list[tuple[int, int, int, np.ndarray]]) -> pa.RecordBatch:
        hub, part, set_id, elements = zip(*out)
        ends = np.cumsum([0, *map(len, elements)])
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(elements)))
        columns = [pa.array(hub, pa.int64()), pa.array(part, pa.int32()), pa.array(set_id, pa.int64()), lists]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def run(batches):
        out, size = [], 0
        for batch in slices(batches):
            places = zip(*[batch.column(k).to_pylist() for k in (1, 2, 3)])
            for shingles, (set_id, hubs, parts) in zip(shingle_arrays(batch.column(0)), places):
                elements, found = set_of(shingles)
                if found != set_id:  # another text may have the same document id
                    continue
                elements = elements.view(np.int64)
                for hub, part in zip(hubs, parts):
                    out.append((hub, part, set_id, elements))
                    size += len(elements)
                    if size >= ELEMENTS:
                        yield batch_of(out)
                        out, size = [], 0
        if out:
            yield batch_of(out)

    return in_small_batches(rows).mapInArrow(run, COPIES)


def verified(pairs: DataFrame, docs: DataFrame, owners: DataFrame) -> DataFrame:
    """The pairs whose whole sets are similar enough.

    A set travels once for every pair in which it is the member, and once for every part of the
    pairs in which it is the hub. A row of places has about ``PART`` of them at most.
    """
    pairs = stored(pairs, "join-possible")
    count = pairs.count()

    def few(df: DataFrame) -> DataFrame:
        return in_tasks(df, count, PAIRS)

    def listed(places: DataFrame, *by: str) -> DataFrame:
        lists = places.groupBy(*by).agg(F.collect_list(F.struct("hub", "hub_part")).alias("p"))
        return few(lists.select("set_id", F.col("p.hub").alias("hubs"), F.col("p.hub_part").alias("parts")))

    met = dealt(pairs, count)
    members = listed(met.withColumn("set_id", F.col("member")), "set_id", "member_part")
    hubs = few(met.select("hub", "hub_part").distinct()).withColumn("set_id", F.col("hub"))
    hubs = listed(hubs.withColumn("some", F.expr(f"hub_part DIV {PART}")), "set_id", "some")
    left = elements_at(docs, hubs.join(owners, "set_id")).select("hub", "hub_part", F.col("elements").alias("first"))
    right = elements_at(docs, members.join(owners, "set_id"))
    met = in_tasks(right.join(left, ["hub", "hub_part"]), count, WHOLE)
    met = met.withColumn("shared", F.size(F.array_intersect("elements", "first")))
    met = met.withColumn("both", F.size("elements") + F.size("first"))
    found = met.where(f"100 * shared >= {MIN_PCT} * (both - shared)")
    return few(as_pairs(found.select("hub", F.col("set_id").alias("member"))).distinct())


def set_components(docs: DataFrame, sets: DataFrame) -> DataFrame | None:
    """(id, component) of the sets that link with another set; None if there are none."""
    counts = sets.select(F.explode("common").alias("e")).groupBy("e").agg(F.count("*").alias("n"))
    top = counts.where(F.col("n") >= MIN_COMMON).orderBy(F.desc("n"), "e").limit(COMMON)
    common, times = columns_here(top)
    common = common.view(np.uint64)
    by = np.argsort(common)
    order = (common[by], times[by])
    keyed = keyed_sets(docs, light_boundary(sets), order)
    lists = Window.partitionBy("key", "salt")
    met = keyed.withColumn("low", F.min("set_id").over(lists)).withColumn(
        "high", F.max("set_id").over(lists)
    )
    members = met.where("shared OR low <> high").select("key", "set_id", "size").distinct()
    members = stored(members, "join-keys")
    count = members.count()
    lists = in_tasks(members.groupBy("set_id").agg(F.count("*").alias("lists")), count, MEMBERS)
    members = stored(in_tasks(members.join(lists, "set_id"), count, MEMBERS), "join-members")
    owners = sets.groupBy("set_id").agg(F.min("doc_id").alias("owner"))
    owners = stored(in_tasks(owners, count, MEMBERS), "join-owners")

    def opened(component: DataFrame | None) -> DataFrame:
        current = in_tasks(open_members(members, component), count, MEMBERS)
        return current if component is None else stored(current, "join-open")

    current, links, component = opened(None), None, None
    for pivots in PIVOTS:
        pairs = in_tasks(pivot_pairs(current, pivots), count, MEMBERS)
        links = with_links(links, verified(possible(pairs, sets), docs, owners))
        component = stored(connected(links), "join-components")
        current = opened(component)
    if current.limit(1).count():
        links = with_links(links, verified(pairs_across(current, sets), docs, owners))
        component = connected(links)
    return component


def with_links(links: DataFrame | None, more: DataFrame) -> DataFrame:
    return stored(more if links is None else links.unionByName(more), "join-links")


def grouped_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, set_id, node) per row of ``doc_id, text``; ``node`` is the component's set."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    sets = stored(document_sets(docs), "join-documents")
    component = set_components(docs, sets)
    rows = sets.select("doc_id", "n_shingles", "set_id")
    if component is None:
        return rows.withColumn("node", F.col("set_id"))
    rows = rows.join(component.withColumnRenamed("id", "set_id"), "set_id", "left")
    return rows.select("doc_id", "n_shingles", "set_id", F.coalesce("component", "set_id").alias("node"))


def components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of ``doc_id, text``."""
    rows = grouped_rows(docs)
    full = rows.where("n_shingles > 0")
    least = full.groupBy("node").agg(F.min("doc_id").alias("component_id"))
    joined = full.join(least, "node").select("doc_id", "n_shingles", "component_id")
    alone = rows.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return joined.unionByName(alone)


def numbered(docs: DataFrame) -> DataFrame:
    """(own_id, own_set, doc) per row, ``own_set`` null without shingles; of rows of one id and set
    that a batch has, the first."""
    id_and_text = docs.select(F.col("doc_id").cast("bigint").alias("own_id"), "text", F.struct(*docs.columns).alias("doc"))

    def run(batches):
        for batch in slices(batches):
            own, keep, seen = [], [], set()
            for doc_id, shingles in zip(batch.column(0).to_pylist(), shingle_arrays(batch.column(1))):
                elements, set_id = set_of(shingles)
                own.append(set_id if len(elements) else None)
                keep.append(not len(elements) or (doc_id, set_id) not in seen)
                seen.add((doc_id, set_id))
            columns = [batch.column(0), pa.array(own, pa.int64()), batch.column(2)]
            out = pa.RecordBatch.from_arrays(columns, names=["own_id", "own_set", "doc"])
            yield out.filter(pa.array(keep, pa.bool_()))

    schema = StructType([
        StructField("own_id", LongType()), StructField("own_set", LongType()),
        StructField("doc", id_and_text.schema["doc"].dataType),
    ])
    return in_small_batches(id_and_text).mapInArrow(run, schema)


def one_of_each(docs: DataFrame) -> DataFrame:
    """One document of each component, that of the least id; all columns stay.

    What goes is decided by id and set of shingles together, so documents of equal or null ids
    whose texts do not link all stay, and so do texts without shingles. A null id stands for a
    component only if it has no other; of several sets with the least id the least set stays,
    and of several rows with that id and set one.
    """
    found = stored(grouped_rows(docs).where("n_shingles > 0"), "join-result")
    pairs = found.groupBy("node", "doc_id", "set_id").agg(F.count("*").alias("times"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "set_id")).alias("head")
    heads = pairs.groupBy("node").agg(first)
    judged = pairs.join(heads, "node").selectExpr(
        "doc_id AS gone_id", "set_id AS gone_set", "times",
        "doc_id <=> head.doc_id AND set_id = head.set_id AS stays",
    )
    judged = stored(judged.where("NOT stays OR times > 1"), "join-gone")

    def matching(marks: DataFrame):
        return left["own_id"].eqNullSafe(marks["gone_id"]) & (left["own_set"] == marks["gone_set"])

    left = numbered(docs)
    gone = small(judged.where("NOT stays"))
    left = left.join(gone, matching(gone), "left_anti")
    again = judged.where("stays")
    if again.limit(1).count():
        left = stored(left, "join-left")
        again = small(again)
        many = left.join(again, matching(again), "left_semi")
        many = many.groupBy("own_id", "own_set").agg(F.first("doc").alias("doc")).select("own_id", "own_set", "doc")
        left = left.join(again, matching(again), "left_anti").unionByName(many)
    return left.select("doc.*")
