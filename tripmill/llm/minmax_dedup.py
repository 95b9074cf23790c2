"""Operator 12, MinHash near-dedup: signatures of minima and maxima, confirmed on whole sets.

Two documents link when the Jaccard similarity of their sets of five-word shingles is 85
percent or more. Equal sets are one node. A set's elements go through ``PERMUTATIONS``
permutations, of each of which both the least and the greatest value are kept: that halves
the hashing for signatures of ``2 * PERMUTATIONS`` values. As a set's least and greatest
element under one permutation exclude each other, their matches vary less together than
those of two permutations; no band has both.

Sets that agree in all ``BAND`` values of a band share its key; a pair that links shares
none of the ``BANDS`` keys with a chance of 1e-8. In every list of sets with a key in
common the one that is in most lists is the pivot, and each set is confirmed against
the best pivot that it meets, on whole sets of 64-bit hashes. Lists whose sets are all
connected then are done. After ``ROUNDS`` such rounds, blocks of the lists that stay open
meet in one task each. There all pairs across components are judged by their signatures,
each in the first band that it shares. Only sets that some pair of a block takes for alike
meet again with their whole sets, to be judged exactly; only links become rows. That is quadratic in texts that share keys and yet do not link.

Null or empty texts have the empty set and stand alone. Equal rows are linked by their
equal sets; a null id names a component only if there is no other. An empty table gives
no rows; other columns are ignored. A key that a third of all sets have is counted by
partial sums, and its rows lie in as many tasks as Spark's splitting of skewed joins makes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import in_batches, in_small_batches, slices, stored
from tripmill.llm.components import connected
from tripmill.llm.set_pairs import elements_of, set_of, shared_elements, similar_pairs
from tripmill.llm.wordhash import mixed, shingle_arrays

MIN_PCT = 85
BAND, BANDS = 6, 39
PERMUTATIONS = BAND * BANDS // 2
VALUE_BYTES = 2
#: Six standard deviations below the mean of equal values at the limit.
AGREE = int(2 * PERMUTATIONS * 0.85 - 6 * (2 * PERMUTATIONS * 0.85 * 0.15) ** 0.5)
ROUNDS = 2
BLOCK = 256
#: Elements that are hashed at a time.
GROUP = 1 << 15

_FACTORS = (mixed(np.arange(1, PERMUTATIONS + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_SPREAD = np.uint32(0x9E3779B1)

SETS = "doc_id bigint, text_hash bigint, n_shingles bigint, set_id binary, signature binary"


def signatures(sets: list[np.ndarray]) -> list[bytes]:
    """Per set, none of them empty, the minima and then the maxima of its elements under all permutations."""
    out: list[bytes] = []
    at = 0
    while at < len(sets):
        end, size = at, 0
        while end < len(sets) and (end == at or size + len(sets[end]) <= GROUP):
            size += len(sets[end])
            end += 1
        own = sets[at:end]
        starts = np.cumsum([0, *map(len, own[:-1])])
        elements = (np.concatenate(own) >> np.uint64(32)).astype(np.uint32)
        kept = np.empty((2 * PERMUTATIONS, len(own)), dtype=np.uint32)
        for i, factor in enumerate(_FACTORS):
            values = elements * factor
            kept[i] = np.minimum.reduceat(values, starts)
            kept[PERMUTATIONS + i] = np.maximum.reduceat(values, starts)
        short = ((kept * _SPREAD) >> np.uint32(32 - 8 * VALUE_BYTES)).astype("<u2")
        out += [row.tobytes() for row in np.ascontiguousarray(short.T)]
        at = end
    return out


def document_sets(docs: DataFrame) -> DataFrame:
    """One row per document, the signature on the first row of a set in a batch."""

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        sizes, ids, firsts, sets, seen = [], [], [], [], set()
        for i, shingles in enumerate(shingle_arrays(batch.column(2))):
            elements, set_id = set_of(shingles)
            sizes.append(len(elements))
            ids.append(set_id)
            if len(elements) and set_id not in seen:
                seen.add(set_id)
                firsts.append(i)
                sets.append(elements)
        signature: list[bytes | None] = [None] * len(ids)
        for i, value in zip(firsts, signatures(sets)):
            signature[i] = value
        return {
            "doc_id": batch.column(0), "text_hash": batch.column(1), "n_shingles": sizes, "set_id": ids,
            "signature": signature,
        }

    return in_batches(docs.select("doc_id", "text_hash", "text"), SETS, work, 512)


def listed(sets: DataFrame) -> DataFrame:
    """(key, band, set_id, size, lists): the sets of every key that different sets share."""
    width = BAND * VALUE_BYTES
    key = f"xxhash64(band, substring(signature, {width} * band + 1, {width}))"
    signed = sets.where("signature IS NOT NULL")
    keyed = signed.select(
        "set_id", F.col("n_shingles").alias("size"),
        F.explode(F.expr(f"transform(sequence(0, {BANDS - 1}), band -> struct({key} AS key, band))")).alias("at"),
    ).select("at.*", "set_id", "size")
    # Any two different sets differ in this number, but for a chance of 1e-19 per pair: such a pair loses one key.
    number = F.xxhash64("set_id")
    shared = keyed.groupBy("key").agg(F.min(number).alias("low"), F.max(number).alias("high"))
    members = keyed.join(shared.where("low <> high").select("key"), "key").distinct()
    members = stored(members, "minmax-keys")
    lists = members.groupBy("set_id").agg(F.count("*").alias("lists"))
    return stored(members.join(lists, "set_id").select("key", "band", "set_id", "size", "lists"), "minmax-members")


def open_members(members: DataFrame, component: DataFrame) -> DataFrame:
    """The members, with their components, of the lists whose members are not all connected."""
    named = members.join(component.withColumnRenamed("id", "set_id"), "set_id", "left")
    named = stored(named.withColumn("component", F.coalesce("component", "set_id")), "minmax-named")
    spread = named.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return stored(named.join(spread.where("low <> high").select("key"), "key"), "minmax-open")


def pivot_pairs(members: DataFrame, turn: int) -> DataFrame:
    """(a, b): every set and the best pivot of its lists that is alike in size and not connected with it."""
    weight = F.col("lists") if turn == 0 else F.expr(f"lists * (1 + pmod(xxhash64(set_id, {turn}), 8))")
    names = ("set_id", "size", "component")
    pivot = F.max(F.struct(weight.alias("weight"), *names)).alias("pivot")
    pivots = members.groupBy("key").agg(pivot).select(
        "key", "pivot.weight", *(F.col(f"pivot.{c}").alias(f"p_{c}") for c in names)
    )
    met = members.join(pivots, "key").where(
        f"component <> p_component AND 100 * least(size, p_size) >= {MIN_PCT} * greatest(size, p_size)"
    )
    best = met.groupBy("set_id").agg(F.max(F.struct("weight", "p_set_id")).alias("best"))
    return best.select(F.col("best.p_set_id").alias("a"), F.col("set_id").alias("b"))


def links_across(members: DataFrame, sets: DataFrame, docs: DataFrame, owners: DataFrame) -> DataFrame:
    """(a, b): the pairs of a list, of different components, that link."""
    counts = members.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    ids = stored(members.select("set_id").distinct(), "minmax-ids")
    signed = sets.where("signature IS NOT NULL").select("set_id", "signature").join(ids, "set_id")
    signed = stored(signed.groupBy("set_id").agg(F.first("signature").alias("signature")), "minmax-signatures")
    cells = members.join(counts, "key").withColumn("mine", F.expr("CAST(pmod(xxhash64(set_id), blocks) AS INT)"))
    cells = cells.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))).select(
        "key", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"), "band", "mine",
        "set_id", "component", "size",
    )
    names = cells.columns
    near = in_small_batches(in_cells(cells.join(signed, "set_id"), [*names, "signature"]))
    near = stored(near.mapInArrow(by_cell(near_sets), NEAR), "minmax-near")
    elements = elements_of(near.select("set_id").distinct(), docs, owners)
    full = near.join(signed, "set_id").join(elements, "set_id")
    full = in_small_batches(in_cells(full, [*names, "signature", "elements"]))
    return full.mapInArrow(by_cell(linked_sets), "a binary, b binary").distinct()


NEAR = "key bigint, low int, high int, band int, mine int, set_id binary, component binary, size bigint"


def in_cells(rows: DataFrame, names: list[str]) -> DataFrame:
    cell = ("key", "low", "high")
    return rows.select(*names).repartition(*cell).sortWithinPartitions(*cell)


def by_cell(work: Callable[[list[tuple]], pa.RecordBatch]):
    """A function for ``mapInArrow`` that works on the rows of one cell at a time."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        now, rows = None, []
        for batch in slices(batches):
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[:3] != now and rows:
                    yield work(rows)
                    rows = []
                now = row[:3]
                rows.append(row)
        if rows:
            yield work(rows)

    return run


def alike(rows: list[tuple]) -> Iterator[tuple[int, np.ndarray]]:
    """Each set of a cell with the later ones that are alike by their signatures, in their first shared band."""
    _, low, high, band, mine, _, component, size, signature = list(zip(*rows))[:9]
    values = np.stack([np.frombuffer(x, dtype="<u2") for x in signature])
    bands = values.reshape(len(values), BANDS, BAND)
    size, mine = np.array(size), np.array(mine)
    part = np.unique(np.array(component, dtype=object), return_inverse=True)[1]
    for i in range(len(values)):
        rest = slice(i + 1, len(values))
        fit = (part[rest] != part[i]) & ((low[0] == high[0]) | (mine[rest] != mine[i]))
        fit &= 100 * np.minimum(size[rest], size[i]) >= MIN_PCT * np.maximum(size[rest], size[i])
        j = i + 1 + np.flatnonzero(fit)
        j = j[(values[j] == values[i]).sum(1) >= AGREE] if len(j) else j
        j = j[(bands[j] == bands[i]).all(2).argmax(1) == band[0]] if len(j) else j
        if len(j):
            yield i, j


def near_sets(rows: list[tuple]) -> pa.RecordBatch:
    """The rows of one cell that are alike another one of it; most cells have none."""
    kept = sorted({int(k) for i, j in alike(rows) for k in (i, *j)})
    columns = list(zip(*[rows[k][:8] for k in kept])) or [()] * 8
    names = [field.split()[0] for field in NEAR.split(", ")]
    kinds = [pa.int64(), *[pa.int32()] * 4, pa.binary(), pa.binary(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def linked_sets(rows: list[tuple]) -> pa.RecordBatch:
    """The links of one cell, judged on whole sets."""
    own = [np.frombuffer(row[9], dtype=np.uint64) for row in rows]
    left, right = [], []
    for i, j in alike(rows):
        for k in j.tolist():
            shared = shared_elements(own[i], own[k])
            if 100 * shared >= MIN_PCT * (len(own[i]) + len(own[k]) - shared):
                left.append(rows[i][5])
                right.append(rows[k][5])
    return pa.RecordBatch.from_arrays([pa.array(left, pa.binary()), pa.array(right, pa.binary())], names=["a", "b"])


def set_components(docs: DataFrame, sets: DataFrame) -> DataFrame | None:
    """(id, component) of the sets that link with another one; None if there are none."""
    members = listed(sets)
    owner = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("owner")
    listed_ids = members.select("set_id").distinct()
    owners = sets.select("set_id", "doc_id", "text_hash").join(listed_ids, "set_id").groupBy("set_id").agg(owner)
    owners = stored(owners.select("set_id", "owner.doc_id", "owner.text_hash"), "minmax-owners")
    links = component = None
    current = members.withColumn("component", F.col("set_id"))
    for turn in range(ROUNDS + 1):
        if not current.limit(1).count():
            break
        if turn < ROUNDS:
            found = similar_pairs(pivot_pairs(current, turn), docs, owners, MIN_PCT)
        else:
            found = links_across(current, sets, docs, owners)
        links = stored(found if links is None else links.unionByName(found), "minmax-links")
        component = stored(connected(links), "minmax-components")
        current = open_members(members, component)
    return component


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``doc_id, text``."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    docs = docs.withColumn("text_hash", F.xxhash64("text"))
    sets = stored(document_sets(docs), "minmax-sets")
    component = set_components(docs, sets)
    rows = sets.select("doc_id", "n_shingles", "set_id")
    if component is None:
        rows = rows.withColumn("node", F.col("set_id"))
    else:
        rows = rows.join(component.withColumnRenamed("id", "set_id"), "set_id", "left")
        rows = rows.withColumn("node", F.coalesce("component", "set_id"))
    full = rows.where("n_shingles > 0")
    least = full.groupBy("node").agg(F.min("doc_id").alias("component_id"))
    joined = full.join(least, "node").select("doc_id", "n_shingles", "component_id")
    alone = rows.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return joined.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
