"""Logistic mixing of hashed-context bit predictors, over arrays of texts.

A byte is coded as the path to it in the Huffman tree of the byte before, so frequent
bytes need few decisions. For each decision every predictor looks up its counts of
zeros and ones by a hash of the tree node and its context, the last 2, 3 or 5 bytes.
The logits of the counts are mixed with weights that a gate selects, by how often the
two longest contexts have been seen; a last stage corrects the mix by what it
has been worth before. Each text starts from an empty context and ends with a byte
that no UTF-8 text holds, so the probabilities of all texts add up to one.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

#: Context lengths in bytes, and the binary logarithms of the tables' sizes, which hold for
#: up to ``2 ** LEARNT`` bytes learnt from; sixteen times as many bytes have twice the slots.
ORDERS = (2, 3, 5)
BITS = (18, 18, 19)
LEARNT = 25
#: No decision is taken for more certain than this, so all texts have some probability.
SURE = 1e-7
END = 0xFF
BACK = 5
PIECE = 1 << 14
#: Bytes worked on in one step: small enough that its arrays stay in the processor's cache.
STEP = 1 << 13
#: Bytes looked up among the remembered ones in one step.
LOOKED_UP = 1 << 15
#: How many bytes with their contexts a task remembers the score of, as a power of two; 16 bytes each.
REMEMBERED = 19
GATES = 16
CELLS = 64
RATE = 0.02
PRIOR = 0.4

_HASH = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1)


def paths(counts: np.ndarray) -> list[list[tuple[int, int]]]:
    """Per byte its path of (node, bit) in the Huffman tree of these counts, plus one each."""
    heap = [(int(c) + 1, i) for i, c in enumerate(counts)]
    heapq.heapify(heap)
    parent: dict[int, tuple[int, int]] = {}
    number = 256
    while len(heap) > 1:
        (a, left), (b, right) = heapq.heappop(heap), heapq.heappop(heap)
        parent[left], parent[right] = (number, 0), (number, 1)
        heapq.heappush(heap, (a + b, number))
        number += 1
    found: dict[int, list[tuple[int, int]]] = {number - 1: []}
    for at in sorted(parent, reverse=True):
        node, bit = parent[at]
        found[at] = [*found[node], (node - 256, bit)]
    return [found[byte] for byte in range(256)]


def pieces(texts: list[bytes]) -> Iterator[tuple[int, bytes]]:
    """(text, bytes) with ``BACK`` bytes of context ahead; long texts in several pieces."""
    lead = bytes([END]) * BACK
    for i, text in enumerate(texts):
        whole = lead + text + bytes([END])
        for at in range(0, len(whole) - BACK, PIECE):
            yield i, whole[at : at + PIECE + BACK]


def groups(texts: list[bytes], step: int | None = None) -> Iterator[tuple[np.ndarray, list[int], np.ndarray]]:
    """(bytes, texts, lengths) of pieces joined until there are enough for one step."""
    step = step or STEP
    joined, owners, lengths, size = [], [], [], 0
    for i, piece in pieces(texts):
        joined.append(piece)
        owners.append(i)
        lengths.append(len(piece))
        size += len(piece)
        if size >= step:
            yield np.frombuffer(b"".join(joined), np.uint8), owners, np.array(lengths)
            joined, owners, lengths, size = [], [], [], 0
    if joined:
        yield np.frombuffer(b"".join(joined), np.uint8), owners, np.array(lengths)


def pair_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How often each byte follows each byte, ends of texts included; shape (256, 256)."""
    before = np.full(len(data), END, dtype=np.int64)
    before[1:] = data[:-1]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    before[heads] = END
    found = np.bincount(before * 256 + data, minlength=1 << 16).reshape(256, 256)
    tails = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    found[:, END] += np.bincount(data[tails], minlength=256)
    found[END, END] += len(offsets) - 1 - len(tails)
    return found


def table_bits(size: int) -> tuple[int, ...]:
    """The binary logarithms of the tables' sizes for so many bytes to learn from."""
    more = max(0, -(-((max(size, 1) - 1).bit_length() - LEARNT) // 4))
    return tuple(b + more for b in BITS)


class Coder:
    """Turns bytes into decisions and their places in the tables."""

    def __init__(self, counts: np.ndarray) -> None:
        """``counts`` has how often each byte (column) follows each byte (row)."""
        self.table_bits = table_bits(int(counts.sum()))
        common = paths(counts.sum(0))
        lengths, starts, nodes, bits, lists, begins = [], [], [], [], {}, {}
        for tree in range(257):
            # Bytes that nothing was seen to follow share the tree of all bytes, number 256.
            if tree == 256 or counts[tree].any():
                lists[tree] = common if tree == 256 else paths(counts[tree])
                begins[tree] = []
                for path in lists[tree]:
                    begins[tree].append(len(nodes))
                    nodes.extend(tree * 256 + node for node, _ in path)
                    bits.extend(bit for _, bit in path)
        for before in range(256):
            tree = before if before in lists else 256
            lengths.extend(map(len, lists[tree]))
            starts.extend(begins[tree])
        self.lengths = np.array(lengths, dtype=np.int64)
        self.starts = np.array(starts, dtype=np.int64)
        self.bits = np.array(bits, dtype=bool)
        self.spread = np.array(nodes, dtype=np.uint32) * np.uint32(_HASH[4])

    def decisions(
        self, data: np.ndarray, lengths: np.ndarray
    ) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
        """Bits, their slots per predictor, and where each piece's decisions begin."""
        bits, slots, begins = self.decisions_of(*in_context(data, lengths))
        return bits, slots, begins[np.cumsum(lengths - BACK) - (lengths - BACK)]

    def decisions_of(
        self, byte: np.ndarray, back: list[np.ndarray]
    ) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
        """Bits, their slots per predictor, and where each byte's decisions begin."""
        byte = (back[0] * np.uint32(256) + byte).astype(np.int64)
        count, starts = self.lengths.take(byte), self.starts.take(byte)
        ends = np.cumsum(count)
        first = ends - count
        # Running sums: the byte of each decision, and its place in the list of all paths.
        which = np.zeros(int(ends[-1]) if len(ends) else 0, dtype=np.int64)
        which[first[1:]] = 1
        np.cumsum(which, out=which)
        path = np.ones(len(which), dtype=np.int64)
        path[first[:1]] = starts[:1]
        path[first[1:]] = starts[1:] - starts[:-1] - count[:-1] + 1
        np.cumsum(path, out=path)
        spread = self.spread.take(path)
        two = back[0] | back[1] << np.uint32(8)
        three = two | back[2] << np.uint32(16)
        five = (three | back[3] << np.uint32(24)) * np.uint32(_HASH[0]) ^ back[4] * np.uint32(_HASH[1])
        slots = []
        for k, (context, bits) in enumerate(zip((two, three, five), self.table_bits)):
            mixed = (context * np.uint32(_HASH[k]) + np.uint32(k)).take(which)
            mixed += spread
            mixed ^= mixed >> np.uint32(15)
            mixed *= np.uint32(_HASH[3])
            mixed >>= np.uint32(32 - bits)
            slots.append(mixed)
        return self.bits.take(path), slots, first


def in_context(data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The bytes of pieces without their leads, and the bytes before them, the nearest first."""
    begins = np.cumsum(lengths) - lengths
    scored = np.ones(len(data), dtype=bool)
    scored[(begins[:, None] + np.arange(BACK)).ravel()] = False
    at = np.flatnonzero(scored)
    wide = data.astype(np.uint32)
    return wide.take(at), [wide.take(at - k) for k in range(1, BACK + 1)]


def seen(n: np.ndarray) -> np.ndarray:
    """How often a context has been seen, in four steps."""
    return (n > 0).view(np.int8) + (n > 2).view(np.int8) + (n > 15).view(np.int8)


def mixed_logits(weights: np.ndarray, gate: np.ndarray, logits: list[np.ndarray]) -> np.ndarray:
    """The weighted sum of the logits, with the weights that the gate selects."""
    weights = weights.T.astype(np.float32, order="C")
    mix = weights[0].take(gate)
    mix *= logits[0]
    for own, x in zip(weights[1:], logits[1:]):
        part = own.take(gate)
        part *= x
        mix += part
    return mix


def squashed(x: np.ndarray) -> np.ndarray:
    out = np.exp(-x)
    out += 1
    return np.divide(1, out, out=out)


def cell_of(mix: np.ndarray, gate: np.ndarray) -> np.ndarray:
    level = mix * np.float32(4)
    level += np.float32(CELLS // 2 + 0.5)
    np.clip(level, 0, CELLS - 1, out=level)
    return gate * CELLS + level.astype(np.int64)


class Trainer:
    """Predicts, then learns: counts, weights and corrections of one task's texts."""

    def __init__(self, coder: Coder) -> None:
        self.coder = coder
        # Zeros and ones of a slot lie side by side and are read as one number.
        self.counts = [np.zeros(2 << b, dtype=np.int32) for b in coder.table_bits]
        self.weights = np.full((GATES, len(ORDERS)), 0.4)
        self.squares = np.full((GATES, len(ORDERS)), 1e-6)
        self.cells = np.zeros((GATES * CELLS, 2))
        self.events = np.zeros(GATES)

    def learn(self, texts: list[bytes]) -> None:
        prior = np.float32(PRIOR)
        for data, _, lengths in groups(texts):
            bit, slots, _ = self.coder.decisions(data, lengths)
            logits, levels = [], []
            for j, (counts, slot) in enumerate(zip(self.counts, slots)):
                both = counts.view(np.int64).take(slot).view(np.int32)
                zeros, ones = both[0::2].astype(np.float32), both[1::2].astype(np.float32)
                if j >= len(ORDERS) - 2:
                    levels.append(seen(ones + zeros))
                ones += prior
                zeros += prior
                ones /= zeros
                logits.append(np.log(ones, out=ones))
            gate = (levels[0] * 4 + levels[1]).astype(np.int64)
            mix = mixed_logits(self.weights, gate, logits)
            error = squashed(mix)
            np.subtract(bit, error, out=error, dtype=np.float32)
            cell = cell_of(mix, gate) * 2 + bit
            cells = np.bincount(cell, minlength=2 * GATES * CELLS)
            self.cells += cells.reshape(-1, 2)
            per_gate = cells.reshape(GATES, -1).sum(1)
            scale = 1 / np.maximum(per_gate, 1)
            for j, x in enumerate(logits):
                gradient = np.bincount(gate, weights=error * x, minlength=GATES) * scale
                self.squares[:, j] += gradient**2
                self.weights[:, j] += RATE * gradient / np.sqrt(self.squares[:, j])
            self.events += per_gate
            for counts, slot in zip(self.counts, slots):
                slot <<= np.uint32(1)
                slot += bit
                np.add.at(counts, slot.astype(np.int64), np.int32(1))


def packed_logits(counts: np.ndarray) -> np.ndarray:
    """Logits of (zeros, ones) rows as 32-bit floats whose two lowest bits hold ``seen``."""
    zeros, ones = counts[:, 0], counts[:, 1]
    logit = np.log((ones + PRIOR) / (zeros + PRIOR)).astype(np.float32)
    raw = logit.view(np.uint32) & np.uint32(0xFFFFFFFC)
    return (raw | seen(zeros + ones).astype(np.uint32)).view(np.float32)


@dataclass
class Model:
    """What all tasks have learnt together; it does not change while texts are scored."""

    coder: Coder
    logits: list[np.ndarray]
    weights: np.ndarray
    cells: np.ndarray

    def log10_probabilities(self, texts: list[bytes]) -> np.ndarray:
        """The base-10 logarithm of the probability of each text.

        A byte's probability depends on it and the bytes before it alone. What was worked out
        is remembered by all of them, in a table of fixed size where the last one has the slot.
        """
        out = np.zeros(len(texts))
        known = self.__dict__.get("known")
        if known is None:
            # Keys are 48 bits, so this one is of no byte. A key and its logarithm are one number of
            # 16 bytes, so that they are written together.
            known = self.known = np.full(2 << REMEMBERED, 1 << 63, dtype=np.uint64).view(np.complex128)
        for data, owners, lengths in groups(texts, LOOKED_UP):
            byte, back = in_context(data, lengths)
            key = (back[4] << np.uint32(8) | back[3]).astype(np.uint64)
            key <<= np.uint64(32)
            key |= back[2] << np.uint32(24) | back[1] << np.uint32(16) | back[0] << np.uint32(8) | byte
            slot = (key * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - REMEMBERED)).astype(np.int64)
            found = known.take(slot).view(np.uint64)
            logs = found[1::2].copy().view(np.float64)
            new = np.flatnonzero(found[0::2] != key)
            for at in range(0, len(new), STEP):
                part = new[at : at + STEP]
                logs[part] = self.byte_logs(byte.take(part), [b.take(part) for b in back])
            pairs = np.stack([key.take(new), logs.take(new).view(np.uint64)], 1)
            known[slot.take(new)] = pairs.view(np.complex128)[:, 0]
            begins = np.cumsum(lengths - BACK) - (lengths - BACK)
            np.add.at(out, owners, np.add.reduceat(logs, begins))
        return out

    def byte_logs(self, byte: np.ndarray, back: list[np.ndarray]) -> np.ndarray:
        """The base-10 logarithm of the probability of each byte after the bytes before it."""
        # The correction is a table too: what to make of a mix in each cell, by the true bit.
        total = self.cells.sum(1) + 8
        share, trust = (self.cells[:, 1] / total).astype(np.float32), (8 / total).astype(np.float32)
        half = np.float32(0.5)
        bit, slots, begins = self.coder.decisions_of(byte, back)
        found = [table.take(slot) for table, slot in zip(self.logits, slots)]
        levels = [x.view(np.uint32) & np.uint32(3) for x in found[-2:]]
        gate = (levels[0] * np.uint32(4) + levels[1]).astype(np.int64)
        mix = mixed_logits(self.weights, gate, found)
        cell = cell_of(mix, gate)
        p = squashed(mix)
        p *= (half * (trust + 1)).take(cell)
        p += (half * share).take(cell)
        # Both bits keep a chance, and their chances add up to one.
        p *= np.float32(1 - 2 * SURE)
        p += np.float32(SURE)
        p = np.where(bit, p, 1 - p)
        return np.add.reduceat(np.log10(p, out=p), begins, dtype=np.float64)
