"""Operator 9, scores of documents by models learnt from the corpus.

Two models learn from the training documents: word frequencies with one added to
each count, and the online logistic context mixing of ``mixing``. Documents whose
``crc32`` of the id, as text, leaves 2 when divided by 7 are held out; a null id is
the empty text. All documents are scored.

Word counts are complete. The most frequent words, ``TOP`` at most, are at hand in
every task; all other words of a document are joined with the table of counts. The
mixing model is learnt by every task on its documents in turn; then the counts are
added up, and the weights averaged by how many decisions they rest on. Its tables
grow with the fourth root of the training bytes: 4 MB up to 32 MB of text, 32 MB at 30 GB,
256 MB at 100 TB. They are broadcast, and a task that learns holds twice as much. Weights
depend on which documents a task learns from, so scores vary with the partitioning.

Null or empty texts have one token, the end. Repeated rows are learnt from and
scored each for itself. An empty table gives no rows; without any training document
all words are unknown and the mixing model is even. Other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import ROWS, columns_here, in_batches, slices, stored, text_bytes
from tripmill.llm.mixing import (
    CELLS,
    GATES,
    ORDERS,
    Coder,
    Model,
    Trainer,
    packed_logits,
    pair_counts,
)
from tripmill.llm.wordhash import byte_groups, word_hashes

FOLDS, HELD_OUT = 7, 2
#: Words at hand in every task: the slots of a table, of which each holds one word.
TOP = 1 << 19
SLOTS = 1 << 21
#: The token at the end of every text.
END_HASH = np.uint64(0x2545F4914F6CDD1D)
#: Counts travel in pieces of so many slots.
SEGMENT = 1 << 13

WORDS = "kind int, value bigint, n bigint"
LEARNT = "part int, segment int, numbers binary"
SCORES = (
    "row bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base double,"
    " score double, rest array<bigint>, times array<int>"
)


def held_out(doc_id: int | None) -> bool:
    text = b"" if doc_id is None else str(doc_id).encode()
    return zlib.crc32(text) % FOLDS == HELD_OUT


def training_mask(ids: pa.Array) -> list[bool]:
    return [not held_out(i) for i in ids.to_pylist()]


def count_words(docs: DataFrame) -> DataFrame:
    """(kind, value, n): words (kind 0, by hash) and pairs of bytes (kind 1) of the training
    documents."""

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        kept = batch.filter(pa.array(training_mask(batch.column(0)), pa.bool_()))
        found, numbers = [], np.zeros((256, 256), dtype=np.int64)
        for _, data, offsets in byte_groups(kept.column(1)) if kept.num_rows else ():
            found.append(word_hashes(data, offsets)[0])
            numbers += pair_counts(data, offsets)
        if not found:
            return {"kind": [], "value": [], "n": []}
        values, n = np.unique(np.concatenate(found), return_counts=True)
        values = np.concatenate([values, [END_HASH]]).view(np.int64)
        n = np.concatenate([n, [kept.num_rows]])
        pairs = np.flatnonzero(numbers)
        return {
            "kind": np.repeat([0, 1], [len(n), len(pairs)]).astype(np.int32),
            "value": np.concatenate([values, pairs]),
            "n": np.concatenate([n, numbers.ravel()[pairs]]),
        }

    # More texts at a time share more words.
    return in_batches(docs, WORDS, work, 4 * ROWS)


def learnt(docs: DataFrame, coder: Broadcast) -> DataFrame:
    """What each task learns: pieces of its count tables (by part), weights (-1), corrections (-2)."""

    def run(batches):
        trainer = Trainer(coder.value)
        for batch in slices(batches):
            kept = batch.filter(pa.array(training_mask(batch.column(0)), pa.bool_()))
            trainer.learn(text_bytes(kept.column(1)))
        if not trainer.events.any():
            return
        weighted = np.concatenate([trainer.weights * trainer.events[:, None], trainer.events[:, None]], 1)
        rows = [(-1, 0, weighted.tobytes()), (-2, 0, trainer.cells.tobytes())]
        for part, counts in enumerate(trainer.counts):
            counts = counts.reshape(-1, 2)
            for at in range(0, len(counts), SEGMENT):
                piece = counts[at : at + SEGMENT]
                if piece.any():
                    rows.append((part, at // SEGMENT, sparse(piece.ravel())))
                if len(rows) >= 32:
                    yield batch_of(rows)
                    rows = []
        yield batch_of(rows)

    return docs.mapInArrow(run, LEARNT)


def batch_of(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    part, segment, numbers = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(part, pa.int32()), pa.array(segment, pa.int32()), pa.array(numbers, pa.binary())],
        names=["part", "segment", "numbers"],
    )


def sparse(numbers: np.ndarray) -> bytes:
    """The numbers that are not zero, then their places."""
    at = np.flatnonzero(numbers)
    return numbers[at].astype(np.int32).tobytes() + at.astype(np.uint16).tobytes()


def add_sparse(total: np.ndarray, raw: pa.Buffer) -> None:
    n = raw.size // 6
    total[np.frombuffer(raw, np.uint16, n, 4 * n)] += np.frombuffer(raw, np.int32, n)


def added_up(pieces: DataFrame) -> DataFrame:
    """Sums of equal pieces; counts become logits. One piece is in memory at a time."""

    def finished(part: int, segment: int, total: np.ndarray) -> tuple[int, int, bytes]:
        if part < 0:
            return part, segment, total.tobytes()
        return part, segment, packed_logits(total.reshape(-1, 2)).tobytes()

    def run(batches):
        now, total, counted = None, None, False
        for batch in batches:
            done = []
            keys = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            for key, raw in zip(keys, batch.column(2)):
                if key != now:
                    if now is not None:
                        done.append(finished(*now, total))
                    counted = key[0] >= 0
                    now, total = key, np.zeros(2 * SEGMENT, np.int64) if counted else 0.0
                if counted:
                    add_sparse(total, raw.as_buffer())
                else:
                    total = total + np.frombuffer(raw.as_buffer(), np.float64)
            if done:
                yield batch_of(done)
        if now is not None:
            yield batch_of([finished(*now, total)])

    return pieces.repartition("part", "segment").sortWithinPartitions("part", "segment").mapInArrow(run, LEARNT)


def train(docs: DataFrame, coder: Coder) -> Model:
    """The mixing model of all training documents. Its tables come to the driver, 4 bytes a slot."""
    logits = [np.zeros(1 << b, dtype=np.float32) for b in coder.table_bits]
    weights = np.full((GATES, len(ORDERS)), 0.4)
    cells = np.zeros((GATES * CELLS, 2))
    shared = docs.sparkSession.sparkContext.broadcast(coder)
    for row in added_up(learnt(docs, shared)).toLocalIterator():
        if row.part == -1:
            sums = np.frombuffer(row.numbers, np.float64).reshape(GATES, -1)
            known = sums[:, -1] > 0
            weights[known] = sums[known, :-1] / sums[known, -1:]
        elif row.part == -2:
            cells = np.frombuffer(row.numbers, np.float64).reshape(-1, 2)
        else:
            piece = np.frombuffer(row.numbers, np.float32)
            logits[row.part][row.segment * SEGMENT : row.segment * SEGMENT + len(piece)] = piece
    return Model(coder, logits, weights, cells)


def word_table(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent words by slot: hash and count. Of words that share a slot the more
    frequent one is kept."""
    keys, n = columns_here(counts.orderBy(F.desc("n"), "value").limit(TOP))
    by = np.lexsort((keys, n))
    keys, n = keys.view(np.uint64)[by], n[by]
    slots = (keys % np.uint64(SLOTS)).astype(np.int64)
    hashes, numbers = np.zeros(SLOTS, dtype=np.uint64), np.zeros(SLOTS, dtype=np.int64)
    hashes[slots], numbers[slots] = keys, n
    # Written one after the other, so that hash and count are of the same word.
    numbers[slots] = np.where(hashes[slots] == keys, n, numbers[slots])
    return hashes, numbers


def scores(docs: DataFrame) -> DataFrame:
    """One row per document of ``doc_id, text``: the base figures and the model's score."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    found = count_words(docs).groupBy("kind", "value").agg(F.sum("n").alias("n"))
    found = stored(found, "word-counts")
    counts = found.where("kind = 0").select("value", "n")
    total, distinct = counts.agg(F.sum("n"), F.count("*")).first()
    total, distinct = int(total or 0), int(distinct)
    # 65,536 rows at most.
    pairs, times = columns_here(found.where("kind = 1").select("value", "n"))
    byte_pairs = np.zeros(1 << 16, dtype=np.int64)
    byte_pairs[pairs] = times
    coder = Coder(byte_pairs.reshape(256, 256))
    context = docs.sparkSession.sparkContext
    # 32 MB; and the size that ``table_bits`` allows.
    words = context.broadcast(word_table(counts))
    model = context.broadcast(train(docs, coder))
    space = total + distinct + 1

    def run(batches):
        hashes, numbers = words.value
        row = TaskContext.get().partitionId() << 33
        for batch in slices(batches):
            out: dict[str, list] = {"n_tokens": [], "n_known": [], "base": [], "rest": [], "times": []}
            for _, data, offsets in byte_groups(batch.column(1)):
                tokens, begins = word_hashes(data, offsets)
                slots = (tokens % np.uint64(SLOTS)).astype(np.int64)
                n = np.where(hashes[slots] == tokens, numbers[slots], 0)
                logs = np.where(n > 0, np.log10((n + 1) / space), 0.0)
                for a, b in zip(begins[:-1].tolist(), begins[1:].tolist()):
                    mine = n[a:b] > 0
                    rest, times = np.unique(tokens[a:b][~mine], return_counts=True)
                    out["rest"].append(rest.view(np.int64))
                    out["times"].append(times.astype(np.int32))
                    out["n_tokens"].append(b - a + 1)
                    out["n_known"].append(int(mine.sum()))
                    out["base"].append(float(logs[a:b].sum()))
            size = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(row, row + size), pa.int64()),
                    batch.column(0),
                    pa.array([held_out(i) for i in batch.column(0).to_pylist()], pa.bool_()),
                    pa.array(out["n_tokens"], pa.int64()),
                    pa.array(out["n_known"], pa.int64()),
                    pa.array(out["base"], pa.float64()),
                    pa.array(model.value.log10_probabilities(text_bytes(batch.column(1))), pa.float64()),
                    pa.array(out["rest"], pa.list_(pa.int64())),
                    pa.array(out["times"], pa.list_(pa.int32())),
                ],
                names=["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "score", "rest", "times"],
            )
            row += size

    scored = stored(docs.mapInArrow(run, SCORES), "document-scores")
    rest = scored.select("row", F.explode(F.arrays_zip("rest", "times")).alias("r"))
    rest = rest.select("row", F.col("r.rest").alias("value"), F.col("r.times").alias("times"))
    end = int(END_HASH.view(np.int64))
    # Every text has the end token; its count joins nothing.
    end_count = (counts.where(F.col("value") == end).select("n").first() or [0])[0]
    rare = rest.join(counts, "value", "left")
    n = F.coalesce("n", F.lit(0))
    sums = rare.groupBy("row").agg(
        F.sum(F.when(n > 0, F.col("times")).otherwise(0)).alias("more_known"),
        F.sum(F.col("times") * F.log10((n + 1) / F.lit(float(space)))).alias("more"),
    )
    joined = scored.drop("rest", "times").join(sums, "row", "left")
    end_log = float(np.log10((end_count + 1) / space))
    return joined.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0)) + int(end_count > 0)).alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0)) + end_log).alias("base_score"),
        "score",
    )
