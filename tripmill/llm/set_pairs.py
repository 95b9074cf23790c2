"""Exact similarity of pairs of shingle sets, many of which may have one set in common."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import BATCH_BYTES, in_small_batches, slices, stored
from tripmill.llm.wordhash import mixed, shingle_arrays

#: Sets that are compared with one copy of a hub's set.
CHUNK = 256
#: Copies of a hub's set that one row asks for.
COPIES = 64
BROADCAST_ROWS = 1_000_000
#: Pairs that a task takes on.
EACH = 20_000
_OTHER = np.uint64(0xC2B2AE3D27D4EB4F)


def set_of(shingles: np.ndarray) -> tuple[np.ndarray, bytes]:
    """The distinct elements in order, and 128 bits that stand for the set."""
    elements = np.unique(shingles)
    size = np.uint64(len(elements))
    sums = [mixed(elements ^ other).sum(dtype=np.uint64, keepdims=True) + size for other in (np.uint64(0), _OTHER)]
    return elements, mixed(np.concatenate(sums)).tobytes()


def small(df: DataFrame) -> DataFrame:
    """Marked for broadcast if it has few rows, else left to a shuffle."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def similar_pairs(pairs: DataFrame, docs: DataFrame, owners: DataFrame, min_pct: int) -> DataFrame:
    """The (a, b) of ``pairs`` whose sets have a Jaccard similarity of ``min_pct`` percent or more.

    ``docs`` has the columns ``doc_id, text, text_hash``, ``owners`` (set_id, doc_id, text_hash) names
    a text of every set. A set travels once for every pair in which it is ``b``; the set of
    ``a`` travels once for every ``CHUNK`` of its pairs, which are dealt over tasks, so no
    set is a hub of one task however many partners it has.
    """
    pairs = stored(pairs, "pairs")
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("parts"))
    parts = stored(parts, "pairs-hubs")
    many = small(parts.where("parts > 1"))
    dealt = F.expr("CAST(pmod(xxhash64(b), coalesce(parts, 1)) AS INT)")
    members = pairs.join(many, "a", "left").select(
        F.col("b").alias("set_id"), F.col("a").alias("hub"), dealt.alias("part"), F.lit(0).alias("copies")
    )
    hubs = parts.withColumn("part", F.explode(F.expr(f"sequence(0, parts - 1, {COPIES})"))).select(
        F.col("a").alias("set_id"), F.col("a").alias("hub"), "part",
        F.least(F.lit(COPIES), F.col("parts") - F.col("part")).alias("copies"),
    )
    places = stored(members.unionByName(hubs).join(owners, "set_id"), "pairs-places")
    sets = _read(docs, places)
    tasks = max(1, -(-pairs.count() // EACH))
    sets = sets.repartition(tasks, "hub", "part").sortWithinPartitions("hub", "part", "member")
    return in_small_batches(sets).mapInArrow(_compared(min_pct), "a binary, b binary").distinct()


def elements_of(ids: DataFrame, docs: DataFrame, owners: DataFrame) -> DataFrame:
    """(set_id, elements): the whole sets, as bytes of their elements in order."""
    asked = ids.join(owners, "set_id").select(
        "set_id", "doc_id", "text_hash", F.col("set_id").alias("hub"), F.lit(0).alias("part"), F.lit(0).alias("copies")
    )
    sets = _read(docs, stored(asked, "pairs-places"))
    return stored(sets.groupBy("set_id").agg(F.first("elements").alias("elements")), "pairs-elements")


def shared_elements(one: np.ndarray, other: np.ndarray) -> int:
    near = np.minimum(np.searchsorted(one, other), len(one) - 1)
    return int((one[near] == other).sum())


def _read(docs: DataFrame, places: DataFrame) -> DataFrame:
    """The sets that ``places`` asks for, read from the texts that have them."""
    asked = small(places.withColumnsRenamed({"doc_id": "owner_id", "text_hash": "owner_hash"}))
    met = F.col("doc_id").eqNullSafe(F.col("owner_id")) & (F.col("text_hash") == F.col("owner_hash"))
    found = docs.join(asked, met).select("text", "set_id", "hub", "part", "copies")
    return in_small_batches(found).mapInArrow(_sets_sent, _SENT)


_SENT = "hub binary, part int, member boolean, set_id binary, elements binary"


def _sets_sent(batches) -> Iterator[pa.RecordBatch]:
    """The sets of the asked texts, the hubs' in as many copies as asked for."""
    names = ["hub", "part", "member", "set_id", "elements"]

    def sent(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.binary(), pa.int32(), pa.bool_(), pa.binary(), pa.binary())
        columns = zip(*rows) if rows else [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    for batch in slices(batches, 256):
        rows, size = [], 0
        asked = zip(*(batch.column(i).to_pylist() for i in range(1, 5)))
        for shingles, (set_id, hub, part, copies) in zip(shingle_arrays(batch.column(0)), asked):
            elements, found = set_of(shingles)
            if found != set_id:  # another text of the same id and hash
                continue
            data = elements.tobytes()
            for copy in range(max(copies, 1)):
                rows.append((hub, part + copy, not copies, set_id, data))
                size += len(data)
                if size > BATCH_BYTES:
                    yield sent(rows)
                    rows, size = [], 0
        yield sent(rows)


def _compared(min_pct: int):
    def run(batches) -> Iterator[pa.RecordBatch]:
        hub, place, own = None, None, np.empty(0, np.uint64)
        for batch in slices(batches):
            left, right = [], []
            for at, part, member, set_id, data in zip(*(c.to_pylist() for c in batch.columns)):
                elements = np.frombuffer(data, dtype=np.uint64)
                if not member:
                    hub, place, own = at, (at, part), elements
                elif place == (at, part):
                    shared = shared_elements(own, elements)
                    if 100 * shared >= min_pct * (len(own) + len(elements) - shared):
                        left.append(hub)
                        right.append(set_id)
            yield pa.RecordBatch.from_arrays(
                [pa.array(left, pa.binary()), pa.array(right, pa.binary())], names=["a", "b"]
            )

    return run
