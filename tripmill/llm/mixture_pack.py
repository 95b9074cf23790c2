"""Operator 10, mixture-controlled packing by deficit round-robin over source queues.

Every source is a queue of tokens. In each round, which is worth one window of
``seq_len`` tokens, a queue's deficit grows by its share of the window; it is
served whole portions of ``serve`` tokens as far as its deficit goes and carries
the rest over. What is served is laid end to end and cut into windows, so all
windows but the last are full. As documents may be cut anywhere, what a queue
has been served after ``r`` rounds is a formula of ``r``: any task can begin at
any window with the deficits that all windows before it, in whatever partition,
have left. Only the totals of the queues are shared, never a list of documents.

Every source is a queue of its own, however many there are. Above ``MAX_QUEUES`` sources the
queues are served in the order of their shares and totals: what all queues of one share have
been served is then known from their sorted totals, so a token's place takes a search per
different share, not a sum over all queues. Shares are rounded to ``SHARE_BITS``
significant bits there, which leaves few different ones (each within 2 % of its true value). A source is behind its share by less than a
portion at any time; those of equal small shares get their portions in the same round. Only
the different pairs of share and total come to the driver and the tasks: the total number of tokens bounds
them, as totals that differ add up to it.

Null texts are empty: one end token. A null source is the queue of the empty
name. Repeated rows are packed once each. An empty table gives no piece. Other
columns are ignored. A source that ``shares`` does not name, or names with 0, has the least share.
Memory: one Arrow batch of texts or token ids.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Mapping
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmill.llm.common import columns_here, in_batches, slices, stored, text_bytes
from tripmill.operators.dedup import rank_latest_spread

SEQ_LEN = 1024
#: Tokens of the smallest portion that a queue is served.
SERVE = 128
END_ID = 0
#: Up to so many queues are added up one by one.
MAX_QUEUES = 512
#: Above that: significant bits of a share, units a queue has on average, units in all at most.
SHARE_BITS = 6
UNITS_EACH = 128
MAX_UNITS = 1 << 30
#: The shares of all queues are whole numbers that add up to about so many.
SHARES = 1 << 16
#: The offsets of blocks are broadcast up to so many rows of some 60 bytes, else joined by shuffle.
BROADCAST_ROWS = 1_000_000

#: Fixed value: the pattern by which the vocabulary's tokenizer splits a text.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

BLOCKS = "block bigint, source string, doc_id bigint, before bigint, n_tokens bigint, ids binary"
PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint,"
    " sequence_id bigint, offset bigint"
)


@lru_cache(maxsize=2)
def encoding(path: str) -> tuple[tiktoken.Encoding, np.dtype]:
    """The byte-level BPE of a tokenizer file, and the narrowest type of its ids.

    A vocabulary of this kind spells each byte as a printable character: the
    printable ones as themselves, the others from code point 256 on. Its ids are
    the ranks of its merges, which is all the faster encoder needs. Added tokens are
    cut out of a text before it is split, wherever they stand.
    """
    with open(path, encoding="utf-8") as file:
        stored_file = json.load(file)
    vocabulary = stored_file["model"]["vocab"]
    added = {token["content"]: token["id"] for token in stored_file["added_tokens"]}
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    spelled = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
    ranks = {
        bytes(spelled[c] for c in token): rank
        for token, rank in vocabulary.items()
        if all(c in spelled for c in token) and token not in added
    }
    made = tiktoken.Encoding(path, pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=added)
    most = max(*ranks.values(), *added.values())
    return made, np.dtype("<u2" if most < 1 << 16 else "<u4")


def tokenized(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Token ids of each document, numbered within its block and source.

    A block is what one task reads; ``before`` counts the tokens of the same
    source that come earlier in the block.
    """
    rows = docs.select(
        F.col("doc_id").cast("bigint"), "text", F.coalesce(F.col("source"), F.lit("")).alias("source")
    )

    def run(batches):
        bpe, kind = encoding(vocabulary)
        block, sums = TaskContext.get().partitionId(), {}
        for batch in slices(batches):
            ids, counts, before = [], [], []
            sources = batch.column(2).to_pylist()
            for text, source in zip(text_bytes(batch.column(1)), sources):
                found = bpe.encode(text.decode("utf-8", "replace"), allowed_special="all")
                found.append(END_ID)
                before.append(sums.get(source, 0))
                sums[source] = before[-1] + len(found)
                counts.append(len(found))
                ids.append(np.array(found, kind).tobytes())
            blocks = pa.array([block] * batch.num_rows, pa.int64())
            columns = [blocks, batch.column(2), batch.column(0), pa.array(before, pa.int64())]
            columns += [pa.array(counts, pa.int64()), pa.array(ids, pa.binary())]
            names = ["block", "source", "doc_id", "before", "n_tokens", "ids"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(run, BLOCKS)


@dataclass(frozen=True)
class Schedule:
    """Who is served when: the totals and shares of the queues, in queue order."""

    totals: np.ndarray
    shares: np.ndarray
    seq_len: int
    serve: int

    def served(self, rounds: np.ndarray) -> np.ndarray:
        """Tokens that each queue has been served after so many rounds (a row per number)."""
        rounds = np.asarray(rounds, dtype=np.int64)[:, None]
        portions = rounds * (self.shares * self.seq_len) // (self.shares.sum() * self.serve)
        return np.minimum(portions * self.serve, self.totals)

    def round_of(self, queue: np.ndarray, portion: np.ndarray) -> np.ndarray:
        """The round that serves a queue's portion of that number, both counted from 0."""
        need = (portion + 1) * (self.shares.sum() * self.serve)
        each = self.shares[queue] * self.seq_len
        return -(-need // each) - 1

    def place(self, queue: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Where in the whole stream a queue's token of that number lies."""
        rounds = self.round_of(queue, token // self.serve)
        out = np.empty(len(token), dtype=np.int64)
        step = max(1, 4_000_000 // max(1, len(self.totals)))
        for i in range(0, len(token), step):
            part, mine = rounds[i : i + step], queue[i : i + step, None]
            earlier = np.arange(len(self.totals))[None, :] < mine
            after, before = self.served(part + 1), self.served(part)
            own = np.take_along_axis(before, mine, 1)[:, 0]
            base = np.where(earlier, after, before).sum(1)
            out[i : i + step] = base + token[i : i + step] - own
        return out


@dataclass(frozen=True)
class ManyQueues:
    """As ``Schedule``, for queues that lie in the order of their shares and, within these, totals.

    ``totals``, ``shares`` and ``queues`` describe each different pair of them and how many
    queues it has. A queue's number is its place in that order.
    """

    totals: np.ndarray
    shares: np.ndarray
    queues: np.ndarray
    seq_len: int
    serve: int

    def __post_init__(self) -> None:
        def before(values: np.ndarray) -> np.ndarray:
            return np.concatenate([[0], np.cumsum(values)]).astype(np.int64)

        heads = np.flatnonzero(np.diff(self.shares, prepend=-1))
        put = object.__setattr__
        put(self, "whole", int((self.shares * self.queues).sum()))
        put(self, "starts", before(self.queues))
        put(self, "tokens", before(self.totals * self.queues))
        put(self, "classes", list(zip(heads.tolist(), [*heads[1:].tolist(), len(self.shares)])))

    def limit(self, share: np.ndarray | int, rounds: np.ndarray) -> np.ndarray:
        """Tokens that a queue of that share may have been served after so many rounds, if it has them."""
        turns, rest = np.divmod(rounds * self.seq_len, self.whole)  # no product passes 64 bits
        return (turns * share + rest * share // self.whole) // self.serve * self.serve

    def round_of(self, share: np.ndarray, portion: np.ndarray) -> np.ndarray:
        """The round that serves a queue's portion of that number, both counted from 0."""
        need = (portion + 1) * self.serve
        guess = need.astype(np.longdouble) * self.whole / (share.astype(np.longdouble) * self.seq_len)
        after = np.maximum(1, np.ceil(guess).astype(np.int64))
        while (early := (after > 1) & (self.limit(share, after - 1) >= need)).any():
            after -= early
        while (late := self.limit(share, after) < need).any():
            after += late
        return after - 1

    def filled(self, low: int, high: int, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens served to all queues of the pairs ``low`` to ``high``, and the first pair that is not used up."""
        used = low + np.searchsorted(self.totals[low:high], limit, "right")
        open_queues = self.starts[high] - self.starts[used]
        return self.tokens[used] - self.tokens[low] + limit * open_queues, used

    def place(self, queue: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Where in the whole stream a queue's token of that number lies."""
        pair = np.searchsorted(self.starts, queue, "right") - 1
        share = self.shares[pair]
        rounds = self.round_of(share, token // self.serve)
        out = token - np.minimum(self.limit(share, rounds), self.totals[pair])
        for low, high in self.classes:
            ahead, own, behind = pair >= high, (pair >= low) & (pair < high), pair < low
            for later, whole in ((1, ahead), (0, behind)):
                at = np.flatnonzero(whole | own)
                limit = self.limit(int(self.shares[low]), rounds[at] + later)
                all_of, used = self.filled(low, high, limit)
                # Of the queue's own class: those before it in this round, the others in the last one.
                first = np.minimum(used, pair[at])
                each = np.where(pair[at] < used, self.totals[np.minimum(pair[at], high - 1)], limit)
                part = self.tokens[first] - self.tokens[low] + each * (queue[at] - self.starts[first])
                mine = own[at]
                out[at] += np.where(mine, part if later else all_of - part, all_of)
        return out


def pieces_of(
    schedule: Schedule | ManyQueues, queue: np.ndarray, first: np.ndarray, count: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Cuts documents: (document, start in it, length, place in the stream) of every piece.

    ``first`` is the number of the document's first token in its queue.
    """
    serve, seq_len = schedule.serve, schedule.seq_len
    low, high = first // serve, (first + count - 1) // serve
    doc = np.repeat(np.arange(len(first)), high - low + 1)
    begin = np.cumsum(high - low + 1) - (high - low + 1)
    portion = np.arange(len(doc)) - begin[doc] + low[doc]
    start = np.maximum(portion * serve, first[doc])
    length = np.minimum((portion + 1) * serve, (first + count)[doc]) - start
    place = schedule.place(queue[doc], start)
    # A portion, at most a window long, may run over the end of a window once.
    room = seq_len - place % seq_len
    over = length > room
    index = np.repeat(np.arange(len(doc)), 1 + over)
    second = np.concatenate([[False], index[1:] == index[:-1]]) if len(index) else over
    doc, start, place = doc[index], start[index], place[index]
    room, length = room[index], length[index]
    length = np.where(second, length - room, np.minimum(length, room))
    start, place = start + np.where(second, room, 0), place + np.where(second, room, 0)
    # Portions that follow each other in one window are one piece.
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (
        (doc[1:] != doc[:-1]) | (place[1:] != place[:-1] + length[:-1]) | (place[1:] % seq_len == 0)
    )
    heads = np.flatnonzero(new)
    length = np.add.reduceat(length, heads) if len(heads) else length
    return doc[heads], (start - first[doc])[heads], length, place[heads]


def pack(
    docs: DataFrame,
    vocabulary: str,
    shares: Mapping[str, float] | None = None,
    seq_len: int = SEQ_LEN,
    serve: int = SERVE,
) -> DataFrame:
    """Pack ``doc_id, text, source`` into windows; a row per piece, in the columns of ``PIECES``.

    ``shares`` gives the wanted share of tokens by source; without it each
    source gets its share of all tokens, and all queues end together.
    """
    if not 0 < serve <= seq_len:
        raise ValueError("serve must be from 1 to seq_len")
    blocks = stored(tokenized(docs, vocabulary), "pack-tokens")
    sums = blocks.groupBy("block", "source").agg(F.sum("n_tokens").alias("tokens"))
    sums = stored(sums, "pack-sums")
    numbered = few_queues if sums.select("source").distinct().limit(MAX_QUEUES + 1).count() <= MAX_QUEUES else many_queues
    schedule, queues = numbered(sums, shares, seq_len, serve)
    if not len(schedule.totals):
        return docs.sparkSession.createDataFrame([], PIECES)

    earlier = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("block", "source", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("offset"))
    offsets = stored(starts.join(queues, "source"), "pack-offsets")
    if offsets.count() <= BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    rows = blocks.join(offsets, ["block", "source"]).select(
        "doc_id", "queue", (F.col("offset") + F.col("before")).alias("at"), "n_tokens", "ids"
    )

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        queue, at, count = (batch.column(i).to_numpy().astype(np.int64) for i in (1, 2, 3))
        doc, start, length, place = pieces_of(schedule, queue, at, count)
        narrow = encoding(vocabulary)[1]
        sums, last, ids = [], -1, None
        raw = batch.column(4)
        for d, s, n in zip(doc.tolist(), start.tolist(), length.tolist()):
            if d != last:
                last, ids = d, np.frombuffer(raw[d].as_buffer(), narrow).astype("<u4")
            sums.append(zlib.crc32(ids[s : s + n]))
        return {
            "doc_id": batch.column(0).take(pa.array(doc)),
            "start": start,
            "length": length,
            "ids_crc32": sums,
            "doc_tokens": count[doc],
            "sequence_id": place // seq_len,
            "offset": place % seq_len,
        }

    return in_batches(rows, PIECES, work)


def few_queues(
    sums: DataFrame, shares: Mapping[str, float] | None, seq_len: int, serve: int
) -> tuple[Schedule, DataFrame]:
    """The schedule of at most ``MAX_QUEUES`` sources, and (source, queue)."""
    spark = sums.sparkSession
    totals = {
        r.source: r.tokens
        for r in sums.groupBy("source").agg(F.sum("tokens").alias("tokens")).collect()
    }
    names = sorted(totals)
    wanted = np.array([(shares or totals).get(q, 0) for q in names], dtype=float)
    whole = np.maximum(1, np.rint(wanted / max(wanted.sum(), 1e-300) * SHARES)).astype(np.int64)
    counts = np.array([totals[q] for q in names], dtype=np.int64)
    numbers = spark.createDataFrame([(q, i) for i, q in enumerate(names)], "source string, queue bigint")
    return Schedule(counts, whole, seq_len, serve), F.broadcast(numbers)


def many_queues(
    sums: DataFrame, shares: Mapping[str, float] | None, seq_len: int, serve: int
) -> tuple[ManyQueues, DataFrame]:
    """The schedule of any number of sources, and (source, queue). Sources stay in Spark."""
    spark = sums.sparkSession
    wanted = sums.groupBy("source").agg(F.sum("tokens").alias("total"))
    if shares:
        given = spark.createDataFrame([(k, float(v)) for k, v in shares.items()], "source string, wanted double")
        wanted = wanted.join(given, "source", "left").fillna(0.0, "wanted")
    else:
        wanted = wanted.withColumn("wanted", F.col("total").cast("double"))
    wanted = stored(wanted, "pack-wanted")
    n, all_wanted = wanted.agg(F.count("*"), F.sum("wanted")).first()
    units = min(max(SHARES, UNITS_EACH * n), MAX_UNITS)
    share = F.greatest(F.lit(1), F.rint(F.col("wanted") / F.lit(max(all_wanted, 1e-300)) * F.lit(units))).cast("bigint")
    # The lowest bits go, down to so many significant ones.
    step = F.expr(f"shiftleft(1L, greatest(0, length(bin(share)) - {SHARE_BITS}))")
    queues = wanted.withColumn("share", share)
    queues = queues.withColumn("share", (F.col("share") + F.floor(step / 2)).cast("bigint"))
    queues = queues.withColumn("share", F.col("share") - F.col("share") % step).select("source", "total", "share")
    queues = stored(queues, "pack-queues")
    pairs = stored(queues.groupBy("share", "total").agg(F.count("*").alias("queues")), "pack-pairs")
    share, total, count = columns_here(pairs)
    order = np.lexsort((total, share))
    schedule = ManyQueues(total[order], share[order], count[order], seq_len, serve)
    # Where a pair's queues begin; a queue's place among them is its rank by name.
    listed = list(zip(share[order].tolist(), total[order].tolist(), schedule.starts.tolist()))
    begin = spark.createDataFrame(listed, "share bigint, total bigint, begin bigint")
    if len(listed) <= BROADCAST_ROWS:
        begin = F.broadcast(begin)
    ranked = rank_latest_spread(queues, ["share", "total"], ["source"])
    number = (F.col("begin") + F.col("row_number") - 1).alias("queue")
    return schedule, stored(ranked.join(begin, ["share", "total"]).select("source", number), "pack-numbers")
