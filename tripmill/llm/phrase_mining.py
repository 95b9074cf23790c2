"""Operator 11, phrase collocation mining: Toivonen's sampling with exact counts.

A phrase is two to five neighbouring words of a piece of text; it is a candidate if its
language has it ``MIN_COUNT`` times or more. One document in ``SAMPLE`` proposes phrases,
level by level, at a lowered limit. One pass over all documents then counts the proposed
phrases and their negative border: every phrase whose two parts, without its last and
without its first word, are proposed, and every single word. If phrases of the border turn
out to be frequent, phrases that the pass did not count may be frequent too. A second pass
counts all that may: what the first one found, and whatever it did not count whose parts
all may be frequent, level by level. All parts of a frequent phrase are frequent, so that
closes the set. The sample decides how much work the passes do, not what is found.

The first pass counts by 40 bits of the phrases' hashes, which can only make a count too
high; the second one counts what is left by text, exactly. Sets of phrases reach the tasks
as bit maps of hashes, of ``MAX_BITS`` bits at most: what they let through by chance is
counted as well, everywhere alike. Within a batch of rows phrases are told apart by 64 bits,
so two of the some 100,000 phrases that it sends are mixed up with a chance of 1e-9.

Null and empty texts have no words. Null languages count as ``und``. Equal rows all count.
Phrases alike in score and count are ordered by their bytes. An empty table gives no rows.
Other columns are ignored; ``doc_id`` has a part in the choice of the sample only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmill.llm.common import in_small_batches, slices, stored
from tripmill.llm.wordhash import byte_groups, mixed, place_powers

MIN_COUNT = 100
MAX_WORDS = 5
TOP = 2000
SAMPLE = 8
#: Sampled phrases are proposed from this share of the count to be expected of a rare candidate.
LOWERED = 0.4
#: Bits of a phrase's hash that counts travel with.
HASH_BITS = 40
MIN_BITS, MAX_BITS = 1 << 16, 1 << 28
BITS_EACH = 16
#: Bits of one row of the map on its way to the driver.
MAP_PART = 1 << 16
#: Phrases that a task sends at a time.
SENT = 100_000

#: Blanks part words; marks and line ends part pieces.
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPREAD = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E6C63D0676A9A99))
_PLACES = mixed(np.arange(11, 11 + MAX_WORDS, dtype=np.uint64)) | np.uint64(1)

NAMED = "lang string, k int, phrase string, n bigint"


class Words:
    """The words of a batch of texts in order: hash, row, piece, place in ``text``.

    ``text`` has every word in lower case and one blank after it, so a phrase of
    neighbouring words is one slice.
    """

    def __init__(self, texts: pa.Array) -> None:
        parts: list[tuple[np.ndarray, ...]] = []
        base = breaks_before = 0
        for row, data, offsets in byte_groups(texts):
            kind, lower = _KIND[data], _LOWER[data]
            first, last = _word_edges(kind == 0, offsets)
            lengths = last - first
            ends = np.cumsum(lengths + 1)
            text = np.full(int(ends[-1]) if len(ends) else 0, 32, dtype=np.uint8)
            filled = np.ones(len(text), dtype=bool)
            filled[ends - 1] = False
            text[filled] = lower[kind == 0]
            up, down = place_powers(len(data) + 1)
            hashes = _between(_SPREAD[lower] * up[: len(data)], first, last) * down[first]
            breaks = np.cumsum(kind == 2) + breaks_before
            rows = np.searchsorted(offsets, first, side="right") - 1 + row
            # Rows and breaks only grow, so their sum changes at every break and at every new row.
            piece = breaks[first] + rows if len(first) else rows
            parts.append((text, mixed(hashes), rows, piece, ends - 1 - lengths + base, ends - 1 + base))
            base += len(text)
            breaks_before = int(breaks[-1]) if len(breaks) else breaks_before
        kinds = (np.uint8, np.uint64, *[np.int64] * 4)
        self.text, self.hashes, self.row, self.piece, self.first, self.last = (
            np.concatenate([np.empty(0, kind), *[p[i] for p in parts]]) for i, kind in enumerate(kinds)
        )

    def __len__(self) -> int:
        return len(self.hashes)

    def phrases(self, at: np.ndarray, k: int) -> pa.Array:
        """The texts of the phrases of ``k`` words from the given words."""
        start, stop = self.first[at], self.last[at + k - 1]
        lengths = stop - start
        offsets = np.zeros(len(at) + 1, dtype=np.int32)
        np.cumsum(lengths, out=offsets[1:])
        taken = np.repeat(start - offsets[:-1], lengths) + np.arange(int(offsets[-1]))
        return pa.StringArray.from_buffers(
            len(at), pa.py_buffer(offsets.tobytes()), pa.py_buffer(self.text[taken].tobytes())
        )


def _word_edges(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte of each word and the byte after it; words end where their text ends."""
    start, stop = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    stop[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    heads, tails = edges[edges < len(inside)], edges[edges > 0] - 1
    start[heads] = inside[heads]
    stop[tails] = inside[tails]
    return np.flatnonzero(start), np.flatnonzero(stop) + 1


def _between(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values, out=sums[1:])
    return sums[last] - sums[first]


class BitMap:
    """Which hashes belong to a set, or may belong to it."""

    def __init__(self, bits: np.ndarray) -> None:
        self.bits = bits
        self.shift = np.uint64(65 - (8 * len(bits)).bit_length())

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes >> self.shift
        return (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def bit_map(phrases: DataFrame) -> BitMap:
    """The map of a table's column ``h``; only its bits come to the driver."""
    wanted = max(MIN_BITS, min(MAX_BITS, BITS_EACH * phrases.count()))
    bits = 1 << (wanted - 1).bit_length()
    at = phrases.select(F.shiftright("h", HASH_BITS + 1 - bits.bit_length()).alias("at"))
    parts = at.groupBy((F.col("at") / MAP_PART).cast("bigint").alias("part")).agg(
        F.collect_set((F.col("at") % MAP_PART).cast("int")).alias("ones")
    )

    def pack(batches):
        for batch in batches:
            packed = []
            for ones in batch.column(1):
                row = np.zeros(MAP_PART, dtype=bool)
                row[ones.values.to_numpy()] = True
                packed.append(np.packbits(row, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["part", "bits"])

    out = np.zeros(bits // 8, dtype=np.uint8)
    for row in parts.mapInArrow(pack, "part bigint, bits binary").toLocalIterator():
        out[row["part"] * MAP_PART // 8 :][: MAP_PART // 8] = np.frombuffer(row["bits"], dtype=np.uint8)
    return BitMap(out)


def language_seed(lang: str) -> int:
    return int.from_bytes(blake2b(lang.encode(), digest_size=8).digest(), "little")


def levels_of(words: Words, codes: np.ndarray, names: list[str], most: int) -> Iterator[tuple]:
    """(k, hashes, whole) for 1 to ``most`` words: a number for the phrase of ``k`` words that begins at
    each word, and whether it lies in one piece. Lengths and languages have numbers of their own."""
    sums = np.array([language_seed(x) for x in names], dtype=np.uint64)[codes]
    for k in range(1, most + 1):
        size = max(0, len(words) - k + 1)
        sums = sums[:size] + words.hashes[k - 1 :][:size] * _PLACES[k - 1]
        yield k, mixed(sums + np.uint64(k)), words.piece[:size] == words.piece[k - 1 :][:size]


def both(has: np.ndarray) -> np.ndarray:
    """Whether a set has both parts of the phrases that are longer by a word."""
    return has[:-1] & has[1:]


def coded(batch: pa.RecordBatch) -> tuple[Words, np.ndarray, pa.Array]:
    """The words of a batch ``lang, text``, the number of each one's language, the languages."""
    langs = batch.column(0).dictionary_encode()
    words = Words(batch.column(1))
    return words, langs.indices.to_numpy()[words.row].astype(np.int64), langs.dictionary


def runs(hashes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One place of every different hash among the places ``at``, and how many places have it."""
    by = at[np.argsort(hashes[at], kind="stable")]
    new = np.ones(len(by), dtype=bool)
    new[1:] = hashes[by[1:]] != hashes[by[:-1]]
    starts = np.flatnonzero(new)
    return by[starts], np.diff(np.append(starts, len(by)))


def counted(docs: DataFrame, levels: list[int], known: BitMap | None) -> DataFrame:
    """(h, n): occurrences in ``lang, text`` of the phrases of the given numbers of words of which
    ``known`` has both parts, and of all words, by ``HASH_BITS`` bits of their hashes."""
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches):
        for batch in slices(batches):
            words, codes, names = coded(batch)
            parts, most = None, max(levels)
            for k, hashes, whole in levels_of(words, codes, names.to_pylist(), most):
                if k in levels:
                    wanted = whole if k == 1 else whole & both(parts)[: len(whole)]
                    short = hashes >> np.uint64(64 - HASH_BITS)
                    at, times = runs(short, np.flatnonzero(wanted))
                    for i in range(0, len(at), SENT):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(short[at[i : i + SENT]].view(np.int64)), pa.array(times[i : i + SENT])],
                            names=["h", "n"],
                        )
                if k < most:
                    parts = shared.value.has(hashes) if shared.value else None

    rows = in_small_batches(docs.select("lang", "text")).mapInArrow(run, "h bigint, n bigint")
    return rows.groupBy("h").agg(F.sum("n").alias("n"))


def named(docs: DataFrame, proposed: BitMap, frequent: BitMap) -> DataFrame:
    """(lang, k, phrase, n): exact counts, by text, of all phrases that may still be frequent.

    Those are phrases that the first pass counted and ``frequent`` has, and phrases that it
    did not count, not having both parts ``proposed``, if both parts may be frequent. Every
    part of a frequent phrase is of one of the two kinds, so one such pass finds them all.
    The number of all words of a language is the row of level 0.
    """
    maps = docs.sparkSession.sparkContext.broadcast((proposed, frequent))

    def run(batches):
        for batch in slices(batches):
            words, codes, names = coded(batch)
            total = np.bincount(codes, minlength=len(names))
            has = np.flatnonzero(total)
            yield out(names, has, 0, pa.array([""] * len(has), pa.string()), total[has])
            sampled, often = maps.value
            may = counted_before = None
            for k, hashes, whole in levels_of(words, codes, names.to_pylist(), MAX_WORDS):
                now = whole & often.has(hashes)
                if k > 1:
                    now = whole & both(may) & (often.has(hashes) | ~both(counted_before))
                at, times = runs(hashes, np.flatnonzero(now))
                for i in range(0, len(at), SENT):
                    here = at[i : i + SENT]
                    yield out(names, codes[here], k, words.phrases(here, k), times[i : i + SENT])
                may, counted_before = now, sampled.has(hashes)

    def out(names, codes, k, phrases, times) -> pa.RecordBatch:
        level = pa.array(np.full(len(codes), k, np.int32))
        columns = [names.take(pa.array(codes)), level, phrases, pa.array(times.astype(np.int64))]
        return pa.RecordBatch.from_arrays(columns, names=["lang", "k", "phrase", "n"])

    rows = in_small_batches(docs.select("lang", "text")).mapInArrow(run, NAMED)
    return rows.groupBy("lang", "k", "phrase").agg(F.sum("n").alias("n"))


def sampled_phrases(docs: DataFrame, least: int) -> DataFrame:
    """(h) of the phrases of up to ``MAX_WORDS - 1`` words that the sample has often enough."""
    limit = max(2, math.ceil(least * LOWERED / SAMPLE))
    chosen = F.pmod(F.xxhash64("doc_id", "text"), F.lit(SAMPLE)) == 0
    sample = stored(docs.where(chosen).select("lang", "text"), "phrases-sample")
    found, known = [], None
    for k in range(1, MAX_WORDS):
        often = counted(sample, [k], known).where(F.col("n") >= limit).select("h")
        found.append(stored(often, "phrases-proposed"))
        known = bit_map(found[-1])
    return reduce(DataFrame.unionByName, found)


def frequent_phrases(docs: DataFrame, least: int = MIN_COUNT) -> DataFrame:
    """(lang, k, phrase, n) of all words and phrases of ``least`` occurrences or more, and the number
    of all words per language as level 0."""
    proposed = bit_map(sampled_phrases(docs, least))
    often = counted(docs, list(range(1, MAX_WORDS + 1)), proposed).where(F.col("n") >= least)
    frequent = bit_map(stored(often.select("h"), "phrases-counted"))
    found = named(docs, proposed, frequent).where((F.col("n") >= least) | (F.col("k") == 0))
    return stored(found, "phrases-frequent")


def collocations(docs: DataFrame, least: int = MIN_COUNT, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the strongest phrases of each language."""
    docs = docs.select("doc_id", F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    found = frequent_phrases(docs, least)
    totals = found.where("k = 0").select("lang", F.col("n").alias("total"))
    counts = found.where("k > 0").select("lang", "phrase", F.col("n").alias("f"))
    candidates = found.where("k > 1").select("lang", "k", "phrase", F.col("n").alias("a"))

    def counts_of(part: str, name: str) -> DataFrame:
        return counts.select("lang", F.col("phrase").alias(part), F.col("f").alias(name))

    words = F.split("phrase", " ")
    cuts = candidates.withColumn("cut", F.explode(F.expr("sequence(1, k - 1)")))
    cuts = cuts.withColumn("head", F.array_join(F.slice(words, 1, F.col("cut")), " ")).withColumn(
        "tail", F.array_join(F.slice(words, F.col("cut") + 1, F.col("k") - F.col("cut")), " ")
    )
    cuts = cuts.join(counts_of("head", "l"), ["lang", "head"]).join(counts_of("tail", "r"), ["lang", "tail"])
    whole = "CAST({} AS DECIMAL(18, 0))".format
    cuts = cuts.join(totals, "lang").withColumn(
        "score", F.expr(f"CAST((1000 * {whole('a')} * {whole('total')}) div ({whole('l')} * {whole('r')}) AS BIGINT)")
    )
    least = cuts.groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "cut", "a", "l", "r", F.col("total").alias("n"))).alias("best")
    )
    # Whatever is inside a longer phrase of the same count is inside one that is longer by a word.
    inner = candidates.where("k > 2").withColumn("side", F.explode(F.array(F.lit(1), F.lit(2))))
    inner = inner.select(
        "lang", F.array_join(F.slice(words, F.col("side"), F.col("k") - 1), " ").alias("phrase"),
        F.col("a").alias("longer"),
    )
    inner = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = least.join(inner, ["lang", "phrase"], "left").where("longer IS NULL OR longer < best.a")
    order = Window.partitionBy("lang").orderBy(F.desc("best.score"), F.desc("best.a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "best.a", "best.l", "best.r", "best.n", "best.score"
    )
