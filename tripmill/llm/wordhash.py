"""Hashes of words and word shingles over whole Arrow batches, with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are worked on in groups of about so many bytes, so their arrays stay in
#: the processor's cache.
GROUP_BYTES = 200_000
SHINGLE = 5

_WHITE = np.zeros(256, dtype=bool)
_WHITE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: Any odd numbers without a pattern would do.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
_PLACES = np.array([pow(0xD1342543DE82EF95, k + 1, 1 << 64) for k in range(64)], dtype=np.uint64)
_LENGTH = np.array([0xA0761D6478BD642F], dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit values spread evenly, one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, dtype=np.uint64)
    out[0], done, step = 1, 1, base
    while done < n:
        more = min(done, n - done)
        out[done : done + more] = out[:more] * np.uint64(step)
        done, step = done + more, step * step % (1 << 64)
    return out


class _Table:
    """Powers as far as any group has needed them."""

    up = powers(BASE, 1)
    down = powers(INVERSE, 1)

    @classmethod
    def reach(cls, n: int) -> None:
        if len(cls.up) < n:
            cls.up, cls.down = powers(BASE, n), powers(INVERSE, n)


def place_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least ``n`` powers of ``BASE`` and of ``INVERSE``."""
    _Table.reach(n)
    return _Table.up, _Table.down


def byte_groups(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of consecutive rows of a string column; null as empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(offsets, offsets[row] + GROUP_BYTES, side="right")) - 1
        end = min(max(end, row + 1), len(column))
        yield row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a group of texts, A-Z as a-z, and where each text's words begin."""
    n = len(data)
    if n == 0:
        return np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = ~_WHITE[data]
    start, stop = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    stop[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    heads = edges[edges < n]
    start[heads] = inside[heads]
    tails = edges[edges > 0] - 1
    stop[tails] = inside[tails]
    first, last = np.flatnonzero(start), np.flatnonzero(stop) + 1
    _Table.reach(n + 1)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((_LOWER[data].astype(np.uint64) + np.uint64(1)) * _Table.up[:n], out=sums[1:])
    hashes = mixed((sums[last] - sums[first]) * _Table.down[first])
    return hashes, np.searchsorted(first, offsets)


def shingle_arrays(column: pa.Array, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """Per text the hashes of its ``size``-word shingles in order, repeated ones included.

    A text of fewer words is one shingle; a text without words has none.
    """
    for _, data, offsets in byte_groups(column):
        hashes, begins = word_hashes(data, offsets)
        count = max(0, len(hashes) - size + 1)
        whole = np.zeros(count, dtype=np.uint64)
        for k in range(size):
            whole += hashes[k : k + count] * _PLACES[k]
        whole = mixed(whole)
        for a, b in zip(begins[:-1].tolist(), begins[1:].tolist()):
            if b - a >= size:
                yield whole[a : b - size + 1]
            elif b > a:
                part = (hashes[a:b] * _PLACES[: b - a]).sum(dtype=np.uint64, keepdims=True)
                yield mixed(part + _PLACES[b - a] * _LENGTH)
            else:
                yield hashes[:0]
