"""Operator 1, suffix-array dedup: byte strings of 400 bytes that occur more than once.

A full suffix array has an entry for every byte. Here it is sparse: of the grams of 128
bytes in any 400-byte window the one with the least hash is its anchor, and as the
choice depends on the window's bytes only, equal windows have equal anchors at equal
places. Only suffixes at anchors are sorted, one for some 130 bytes of text, and
only where another suffix begins with the same gram.

* An anchor's context holds all windows that it anchors: 272 bytes before it and 400
  from it on, or up to the text's ends. Contexts that occur twice are repeats as a
  whole; that takes hashes of them only, added up before they are shuffled.
* Suffixes of grams with several different contexts are range-partitioned by their
  leading gram, with the splitters that Spark samples, and sorted in their bucket by
  multikey quicksort. Suffixes that share a gram never fall into two buckets,
  so all neighbours that share a gram are compared, and the common prefixes
  of neighbours give those of all pairs. With the common part before the anchors they tell
  which windows two suffixes share.
* Grams with more than ``CROWD`` contexts would fill a bucket, and all pairs of
  them would be too many. Their windows are hashed and dealt out by hash instead.

Equality of grams and contexts is equality of 64-bit hashes, two for a context.
Null and empty texts have no bytes. Texts of less than 400 bytes keep all bytes. Equal
texts are worked on once; repeated rows are repeats of each other. Empty tables give no
rows; other columns are ignored. Texts of any length are read in pieces of 128 KB.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import bounded, give_back, in_batches, in_small_batches, slices, stored, text_bytes
from tripmill.llm.wordhash import BASE, INVERSE, mixed, powers

WINDOW = 400
GRAM = 128
#: A window's anchor lies at most so many bytes after its start.
REACH = WINDOW - GRAM
STEP = 1 << 17
CROWD = 512
#: Suffixes in a bucket, and windows in one of a crowd's buckets.
BUCKET = 10_000
WINDOWS = 1_000_000
#: A crowd's suffixes that a task hashes.
SUFFIXES_EACH = 2048
#: The start of a window that travels without the name of its context.
MUTE = np.int16(-1)
#: A context is dealt out if it has more than one in so many of all places.
SHARE = 65_536
#: Suffixes of a text that are cut at a time.
PLACES = 4096

ANCHORS = "text_id bigint, at bigint, `before` int, `after` int, gram bigint, context bigint"


class Hashes:
    """Hashes of any part of a byte array."""

    up = powers(BASE, 1)
    down = powers(INVERSE, 1)

    def __init__(self, data: np.ndarray) -> None:
        n = len(data)
        if len(Hashes.up) < n + 1:
            Hashes.up, Hashes.down = powers(BASE, n + 1), powers(INVERSE, n + 1)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * Hashes.up[:n], out=self.sums[1:])

    def of(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        return mixed((self.sums[last] - self.sums[first]) * Hashes.down[first])

    def of_all(self, size: int) -> np.ndarray:
        """Of every part of ``size`` bytes."""
        count = len(self.sums) - size
        return mixed((self.sums[size:] - self.sums[:count]) * Hashes.down[:count])


def sliding_min(values: np.ndarray, size: int) -> np.ndarray:
    """The least of every ``size`` values in a row, by minima from both ends of blocks."""
    n = len(values)
    blocks = -(-n // size)
    padded = np.full(blocks * size, np.iinfo(values.dtype).max, dtype=values.dtype)
    padded[:n] = values
    table = padded.reshape(blocks, size)
    forward = np.minimum.accumulate(table, axis=1).ravel()
    backward = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[: n - size + 1], forward[size - 1 : n])


def segments(texts: list[bytes]) -> Iterator[tuple[int, int, bytes, int, int]]:
    """(text, offset, bytes, first window, number of windows): long texts in pieces that
    hold the contexts of all their windows."""
    for i, text in enumerate(texts):
        windows = len(text) - WINDOW + 1
        for start in range(0, windows, STEP):
            low = max(0, start - REACH)
            part = text[low : start + STEP + REACH + WINDOW]
            yield i, low, part, start - low, min(STEP, windows - start)


def anchors_of(texts: list[bytes]) -> Iterator[dict[str, np.ndarray]]:
    """The anchors of texts, some texts at a time: text, place, reach of the context, hashes."""
    group, size = [], 0
    for segment in segments(texts):
        group.append(segment)
        size += len(segment[2])
        if size >= STEP:
            yield group_anchors(group)
            group, size = [], 0
    if group:
        yield group_anchors(group)


def group_anchors(group: list[tuple[int, int, bytes, int, int]]) -> dict[str, np.ndarray]:
    data = np.frombuffer(b"".join(part for _, _, part, _, _ in group), dtype=np.uint8)
    text, low, lengths, first, count = (
        np.array(c, dtype=np.int64) for c in zip(*[(i, o, len(p), f, n) for i, o, p, f, n in group])
    )
    begins = np.cumsum(lengths) - lengths
    hashes = Hashes(data)
    grams = hashes.of_all(GRAM)
    # The lower half is the place: of equal grams the first one counts.
    ranked = grams & np.uint64(0xFFFFFFFF00000000) | np.arange(len(grams), dtype=np.uint64)
    least = sliding_min(ranked, REACH + 1)
    own = np.repeat(np.arange(len(group)), count)
    starts = np.arange(len(own)) + np.repeat(begins + first - (np.cumsum(count) - count), count)
    at = (least[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.ones(len(at), dtype=bool)
    new[1:] = at[1:] != at[:-1]
    at, own = at[new], own[new]
    ends = begins + lengths
    left = np.maximum(at - REACH, begins[own])
    right = np.minimum(at + WINDOW, ends[own])
    before, after = at - left, right - at
    context = mixed(hashes.of(left, right) + (before * 1000 + after).astype(np.uint64))
    return {
        "text": text[own], "at": at - begins[own] + low[own], "before": before, "after": after,
        "gram": grams[at].view(np.int64), "context": context.view(np.int64),
    }


def find_anchors(texts: DataFrame) -> DataFrame:
    """The anchors of every text of ``text_id, text``; equal texts of a batch are read once."""

    def run(batches):
        for batch in slices(batches):
            ids = batch.column(0).to_numpy()
            first = np.sort(np.unique(ids, return_index=True)[1])
            kept = batch.take(pa.array(first))
            for found in anchors_of(text_bytes(kept.column(1))):
                text = found.pop("text")
                columns = {"text_id": ids[first][text]} | found
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[n].astype(t)) for n, t in zip(names, kinds)], names=names
                )

    names = ["text_id", "at", "before", "after", "gram", "context"]
    kinds = [np.int64, np.int64, np.int32, np.int32, np.int64, np.int64]
    return texts.mapInArrow(run, ANCHORS)


def multikey_order(keys: np.ndarray, raw: list[bytes]) -> np.ndarray:
    """The order of equally long keys, given as rows of big-endian words, by multikey quicksort."""
    out, todo = [], [(np.arange(len(keys)), 0)]
    while todo:
        rows, depth = todo.pop()
        if len(rows) <= 32 or depth == keys.shape[1]:
            if depth < keys.shape[1]:
                rows = np.array(sorted(rows.tolist(), key=raw.__getitem__), dtype=np.int64)
            out.append(rows)
            continue
        column = keys[rows, depth]
        sample = np.sort(column[:: max(1, len(rows) // 64)])
        pivot = sample[len(sample) // 2]
        less, more = column < pivot, column > pivot
        # The last one pushed is the first one done.
        todo += [(rows[more], depth), (rows[~less & ~more], depth + 1), (rows[less], depth)]
        todo = [t for t in todo if len(t[0])]
    return np.concatenate(out) if out else np.empty(0, np.int64)


def matrix(parts: list[bytes], width: int) -> np.ndarray:
    """Parts as rows of bytes, filled up with zeros."""
    joined = b"".join(p.ljust(width, b"\0") for p in parts)
    return np.frombuffer(joined, dtype=np.uint8).reshape(len(parts), width)


def common(a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """How many leading bytes pairs of rows share, ``most`` at most."""
    differ = a != b
    first = np.where(differ.any(1), differ.argmax(1), a.shape[1])
    return np.minimum(first, most)


def bucket_windows(
    gram: np.ndarray, context: np.ndarray, left: list[bytes], right: list[bytes]
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per suffix of a bucket the least and the most bytes by which a window that it shares with
    another suffix begins before the anchor (-1: no such window); also the suffixes kept.

    ``left`` is what lies before the anchor, backwards.
    """
    words = matrix(right, WINDOW)
    keys = words.reshape(len(right), -1).view(">u8")
    order = multikey_order(keys, right)
    # A suffix that came twice, from copies of a text, is one.
    _, once = np.unique(context[order], return_index=True)
    order = order[np.sort(once)]
    gram, words = gram[order], words[order]
    lefts = matrix([left[i] for i in order], REACH)
    n_left = np.array([len(left[i]) for i in order], dtype=np.int64)
    n_right = np.array([len(right[i]) for i in order], dtype=np.int64)
    n = len(order)
    least, most = np.full(n, REACH + 1), np.full(n, -1)
    # Only suffixes of one gram are compared; they are neighbours, though a gram's
    # suffixes may be parted by their ends.
    if n > 1:
        step = common(words[1:], words[:-1], np.minimum(n_right[1:], n_right[:-1]))
        i = np.arange(n - 1)
        shared = step.copy()
        distance = 1
        while True:
            near = gram[i] == gram[i + distance]
            i, shared = i[near], shared[near]
            if not len(i):
                break
            j = i + distance
            back = common(lefts[i], lefts[j], np.minimum(n_left[i], n_left[j]))
            # Windows begin from back to 400 - shared bytes before the anchor.
            low = np.maximum(0, WINDOW - shared)
            meets = back >= low
            for k in (i[meets], j[meets]):
                np.minimum.at(least, k, low[meets])
                np.maximum.at(most, k, back[meets])
            distance += 1
            inside = i + distance < n
            i, shared = i[inside], shared[inside]
            shared = np.minimum(shared, step[i + distance - 1])
    return order, least, most


SHARED = "gram bigint, context bigint, low int, high int"
SUFFIXES = "gram bigint, context bigint, crowd boolean, `left` binary, `right` binary"


def shared_windows(suffixes: DataFrame, count: int) -> DataFrame:
    """(gram, context, low, high) of suffixes that share windows, by sorted buckets."""
    lead = F.substring("right", 1, GRAM)
    buckets = max(1, -(-count // BUCKET))
    dealt = suffixes.repartitionByRange(buckets, lead)

    def run(batches):
        parts = list(batches)
        if not sum(b.num_rows for b in parts):
            return
        table = pa.Table.from_batches(parts)
        gram, context = (table.column(n).to_numpy() for n in ("gram", "context"))
        left, right = (table.column(n).to_pylist() for n in ("left", "right"))
        order, least, most = bucket_windows(gram, context, left, right)
        kept = np.flatnonzero(most >= 0)
        order = order[kept]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(gram[order]), pa.array(context[order]),
                pa.array(least[kept].astype(np.int32)), pa.array(most[kept].astype(np.int32)),
            ],
            names=["gram", "context", "low", "high"],
        )
        del parts, table, left, right
        give_back()

    return dealt.mapInArrow(run, SHARED)


PACKED = "bucket int, hashes binary, contexts binary, starts binary"


def crowd_windows(suffixes: DataFrame, count: int) -> DataFrame:
    """As ``shared_windows``, for grams with many contexts: windows are compared by their hashes.

    Windows travel in one row per bucket and 1,024 suffixes; buckets are cut by hash. A window
    that these suffixes share travels once, so one that all have is no bucket's burden. What they
    share gives each context a range of starts; its windows from within travel without its
    name, for other suffixes' sake, and buckets name only contexts whose range grows.
    """
    # Suffixes of one gram lie together over all tasks, as they have windows in common.
    suffixes = suffixes.repartitionByRange(max(1, -(-count // SUFFIXES_EACH)), "gram", "context")
    suffixes = suffixes.dropDuplicates(["gram", "context"]).sortWithinPartitions("gram")
    buckets = max(1, -(-count * (REACH + 1) // WINDOWS))

    def pack(batches):
        # A suffix has some 5 kB of windows.
        for batch in slices(batches, 1024):
            hashes, contexts, starts = [], [], []
            grams = batch.column(0).to_numpy().view(np.uint64)
            columns = (batch.column(k).to_pylist() for k in (1, 3, 4))
            for gram, i, left, right in zip(grams, *columns):
                found = Hashes(np.frombuffer(left[::-1] + right, dtype=np.uint8)).of_all(WINDOW)
                # How far before the anchor each window begins. A window may lie around several
                # anchors of its text, so it is told apart by gram and distance.
                start = len(left) - np.arange(len(found))
                hashes.append(mixed(found ^ mixed(gram + start.astype(np.uint64))))
                starts.append(start.astype(np.int16))
                contexts.append(np.full(len(found), i, dtype=np.int64))
            if not hashes:
                continue
            columns = [np.concatenate(c) for c in (hashes, contexts, starts)]
            order = np.argsort(columns[0], kind="stable")
            hashes, contexts, starts = (c[order] for c in columns)
            first = np.concatenate([[True], hashes[1:] != hashes[:-1]])
            twice = ~first
            twice[:-1] |= ~first[1:]
            # What these suffixes have twice is a repeat already: it travels once, for the others.
            owners, low, high = ranges(contexts[twice], starts[twice])
            yield ends_of(owners, low, high)
            if len(owners):
                at = np.minimum(np.searchsorted(owners, contexts), len(owners) - 1)
                mute = (owners[at] == contexts) & (low[at] <= starts) & (starts <= high[at])
                contexts, starts = np.where(mute, 0, contexts), np.where(mute, MUTE, starts)
            columns = [c[first] for c in (hashes, contexts, starts)]
            where = columns[0] % np.uint64(buckets)
            order = np.argsort(where, kind="stable")
            edges = np.searchsorted(where[order], np.arange(buckets + 1, dtype=np.uint64))
            full = np.flatnonzero(edges[1:] > edges[:-1])
            cut = [[c[order[edges[k] : edges[k + 1]]].tobytes() for k in full] for c in columns]
            yield pa.RecordBatch.from_arrays(
                [pa.array(full.astype(np.int32)), *[pa.array(c, pa.binary()) for c in cut]],
                names=["bucket", "hashes", "contexts", "starts"],
            )

    def ranges(contexts: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each context, in order, with the first and the last of its starts."""
        order = np.lexsort((starts, contexts))
        contexts, starts = contexts[order], starts[order]
        edge = contexts[1:] != contexts[:-1]
        first = np.flatnonzero(np.concatenate([[len(contexts) > 0], edge])[: len(contexts)])
        last = np.flatnonzero(np.concatenate([edge, [len(contexts) > 0]])[: len(contexts)])
        return contexts[first], starts[first], starts[last]

    def ends_of(contexts: np.ndarray, low: np.ndarray, high: np.ndarray) -> pa.RecordBatch:
        """The first and the last start of each context as one row without hashes, for any bucket."""
        ends = (np.concatenate([contexts, contexts]).tobytes(), np.concatenate([low, high]).tobytes())
        rows = [(int(contexts[0]) % buckets, b"", *ends)] if len(contexts) else []
        bucket, *columns = zip(*rows) if rows else [()] * 4
        return pa.RecordBatch.from_arrays(
            [pa.array(bucket, pa.int32()), *[pa.array(c, pa.binary()) for c in columns]],
            names=["bucket", "hashes", "contexts", "starts"],
        )

    def compared(rows: list[tuple[bytes, bytes, bytes]], known: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
        """A bucket's windows that occur twice, with those known to do so, as ends of their contexts."""
        hashes = np.frombuffer(b"".join(r[0] for r in rows), np.uint64)
        contexts = np.frombuffer(b"".join(r[1] for r in rows), np.int64)
        starts = np.frombuffer(b"".join(r[2] for r in rows), np.int16)
        order = np.argsort(hashes, kind="stable")
        same = hashes[order[1:]] == hashes[order[:-1]]
        twice = np.zeros(len(order), dtype=bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        twice &= starts != MUTE
        more = [np.frombuffer(b"".join(k[i] for k in known), t) for i, t in ((0, np.int64), (1, np.int16))]
        columns = ranges(np.concatenate([contexts[twice], more[0]]), np.concatenate([starts[twice], more[1]]))
        return pa.RecordBatch.from_arrays(
            [pa.array(c.astype(t)) for c, t in zip(columns, (np.int64, np.int32, np.int32))],
            names=["context", "low", "high"],
        )

    def compare(batches):
        bucket, rows, known = None, [], []
        for batch in batches:
            for number, *columns in zip(*[batch.column(k).to_pylist() for k in range(4)]):
                if number != bucket and bucket is not None:
                    yield compared(rows, known)
                    rows, known = [], []
                bucket = number
                if columns[0]:
                    rows.append(columns)
                else:
                    known.append(columns[1:])
        if bucket is not None:
            yield compared(rows, known)
        give_back()

    packed = suffixes.mapInArrow(pack, PACKED).repartition(buckets, "bucket")
    found = packed.sortWithinPartitions("bucket").mapInArrow(compare, "context bigint, low int, high int")
    ends = found.groupBy("context").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    return suffixes.select("gram", "context").join(ends, "context").select("gram", "context", "low", "high")


def suffixes_of(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes around the wanted anchors (text_id, at, gram, context, crowd)."""
    fields = ("at", "gram", "context", "crowd")
    listed = wanted.groupBy("text_id").agg(F.collect_list(F.struct(*fields)).alias("a"))
    listed = stored(listed.select("text_id", *[F.col(f"a.{n}").alias(n) for n in fields]), "suffix-places")
    rows = texts.join(bounded(listed, "at"), "text_id").select("text", *fields)

    names = ["gram", "context", "crowd", "left", "right"]

    def batch_of(kept: list[list[pa.Array]], left: list[bytes], right: list[bytes]) -> pa.RecordBatch:
        columns = [pa.concat_arrays(c) for c in zip(*kept)]
        columns += [pa.array(left, pa.binary()), pa.array(right, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def run(batches):
        kept, left, right = [], [], []
        for batch in slices(batches, 256):
            for k, text in enumerate(text_bytes(batch.column(0))):
                places, *others = (batch.column(c)[k].values for c in range(1, 5))
                for first in range(0, len(places), PLACES):
                    at = places.slice(first, PLACES).to_pylist()
                    kept.append([c.slice(first, PLACES) for c in others])
                    left += [text[max(0, a - REACH) : a][::-1] for a in at]
                    right += [text[a : a + WINDOW] for a in at]
                    if len(left) >= PLACES:
                        yield batch_of(kept, left, right)
                        kept, left, right = [], [], []
        if kept:
            yield batch_of(kept, left, right)

    return in_small_batches(rows).mapInArrow(run, SUFFIXES)


def dealt_join(shared: DataFrame, ends: DataFrame, contexts: DataFrame) -> DataFrame:
    """The places of contexts joined with what is known of each; places of a context that holds
    more than one in ``SHARE`` of them are dealt out over parts.

    At most ``SHARE`` contexts can hold that many, so their list is broadcast.
    """
    key = ["gram", "context"]
    total = contexts.agg(F.sum("n")).first()[0] or 0
    most = max(BUCKET, -(-total // SHARE))
    busy = contexts.where(F.col("n") > most).select(*key, F.ceil(F.col("n") / most).cast("int").alias("parts"))
    busy = F.broadcast(stored(busy, "suffix-busy"))
    part = F.expr("CAST(pmod(xxhash64(text_id, at), coalesce(parts, 1)) AS INT)")
    places = shared.join(busy, key, "left").withColumn("part", part)
    parts = F.expr("sequence(0, coalesce(parts, 1) - 1)")
    known = ends.join(busy, key, "left").withColumn("part", F.explode(parts))
    return places.drop("parts").join(known.drop("parts"), [*key, "part"])


def repeats(texts: DataFrame) -> DataFrame:
    """(text_id, starts, ends): the maximal runs of a text's bytes that lie in repeated windows.

    ``texts`` has a row per document: text_id, text.
    """
    anchors = stored(find_anchors(texts), "suffix-anchors")
    place = F.struct("text_id", "at")
    grams = anchors.groupBy("gram").agg(F.min(place).alias("low"), F.max(place).alias("high"))
    grams = stored(grams.where("low <> high").select("gram"), "suffix-grams")
    shared = stored(anchors.join(grams, "gram"), "suffix-shared")
    contexts = shared.groupBy("gram", "context").agg(
        F.min(place).alias("low"), F.max(place).alias("high"),
        F.first("before").alias("before"), F.first("after").alias("after"), F.count("*").alias("n"),
    )
    contexts = stored(contexts, "suffix-contexts")
    whole = contexts.where("low <> high").select("gram", "context", "before", "after")
    several = contexts.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1")
    several = several.select("gram", (F.col("n") > CROWD).alias("crowd"))
    wanted = contexts.join(several, "gram").select(
        F.col("low.text_id").alias("text_id"), F.col("low.at").alias("at"), "gram", "context", "crowd"
    )
    suffixes = stored(suffixes_of(texts.where(F.octet_length("text") >= WINDOW), wanted), "suffixes")
    sizes = {r.crowd: r["count"] for r in suffixes.groupBy("crowd").count().collect()}
    found = shared_windows(suffixes.where("NOT crowd"), sizes.get(False, 0))
    if sizes.get(True):
        found = found.unionByName(crowd_windows(suffixes.where("crowd"), sizes[True]))
    parts = found.select(
        "gram", "context", F.col("high").alias("before"), (F.lit(WINDOW) - F.col("low")).alias("after")
    )
    # A context that is a repeat as a whole may also be among the parts: spans are merged later.
    ends = whole.unionByName(parts).groupBy("gram", "context").agg(
        F.max("before").alias("b"), F.max("after").alias("a")
    )
    spans = dealt_join(shared, ends, contexts).select(
        "text_id", F.struct((F.col("at") - F.col("b")).alias("start"), (F.col("at") + F.col("a")).alias("end")).alias("span")
    )
    length = F.octet_length("text").cast("bigint")
    copies = texts.groupBy("text_id").agg(F.count("*").alias("n"), F.max(length).alias("size"))
    copied = copies.where((F.col("n") > 1) & (F.col("size") >= WINDOW)).select(
        "text_id", F.struct(F.lit(0).cast("bigint").alias("start"), F.col("size").alias("end")).alias("span")
    )
    listed = spans.unionByName(copied).groupBy("text_id").agg(
        F.array_sort(F.collect_set("span")).alias("spans")
    )

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        runs = [merged(found) for found in batch.column(1).to_pylist()]
        return {
            "text_id": batch.column(0),
            "starts": [[s for s, _ in own] for own in runs],
            "ends": [[e for _, e in own] for own in runs],
        }

    return in_batches(listed, "text_id bigint, starts array<bigint>, ends array<bigint>", work)


REPORT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    """Sorted spans as maximal runs."""
    out: list[list[int]] = []
    for span in spans:
        if out and span["start"] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], span["end"])
        else:
            out.append([span["start"], span["end"]])
    return [tuple(run) for run in out]


def with_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text, starts, ends) per document of ``doc_id, text``; null where nothing goes."""
    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    ).withColumn("text_id", F.xxhash64("text"))
    runs = bounded(stored(repeats(texts.select("text_id", "text")), "suffix-runs"), "starts")
    return texts.join(runs, "text_id", "left").select("doc_id", "text", "starts", "ends")


def dedup_report(docs: DataFrame) -> DataFrame:
    """Per document how much of it goes and the digest of what stays, in the columns of ``REPORT``."""

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        rows = []
        ends = batch.column(3).to_pylist()
        for text, starts, stops in zip(text_bytes(batch.column(1)), batch.column(2).to_pylist(), ends):
            runs, kept, at = list(zip(starts or (), stops or ())), hashlib.sha256(), 0
            for start, end in runs:
                kept.update(text[at:start])
                at = end
            kept.update(text[at:])
            rows.append((len(text), sum(e - s for s, e in runs), len(runs), kept.hexdigest()))
        columns = list(zip(*rows)) or [()] * 4
        names = ("n_bytes", "n_removed", "n_spans", "kept_sha256")
        return {"doc_id": batch.column(0)} | dict(zip(names, map(list, columns)))

    return in_batches(with_runs(docs), REPORT, work)
