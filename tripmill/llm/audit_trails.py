"""Cheapest edits of a sequence of turns, the least in ASCII order among equals.

The initials of a conversation's roles must read ``(s?(ua)+)?``. Four states follow
them: nothing yet, after a system turn, after a user turn, after an assistant turn. A row
takes one state to another by inserted turns and its own edit; the letters of these are
its label. No label begins another one, as each ends with the row's edit, so audits of the
same rows are compared label by label, and a beginning that loses once has lost.

The best audits to each state share their beginnings as linked nodes. A node knows its
ancestors at all powers of two and a rolling hash of its labels; two audits are compared
at the first label after their longest common beginning, which is searched from the
largest power down. Beginnings of equal hash are verified once by walking their links; a
collision is then settled label by label.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence
from functools import cmp_to_key, lru_cache
from itertools import zip_longest

STATES = range(4)
#: State after a turn by the initial of its role.
STEP = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
#: What an inserted or renamed turn is.
ROLE = ("user", "user", "assistant", "user")
COST = {"D": 3, "I": 2, "K": 0, "R": 2}
TRUNCATED_COST = 1
#: Turns inserted at the end, by state.
TAILS = ("", "II", "I", "")
DELETED = 0
INITIALS = "sua"
#: Places of other roles, which the pattern lacks, and of the empty role, which adds no initial to it.
OTHER, EMPTY = 3, 4
MODULUS = (1 << 61) - 1
BASE = 0x1B873593CC9E2D51 % MODULUS

#: What a row or a run of rows does: per state before and after the cost and the label, or None.
Moves = Sequence[Sequence[tuple[int, object] | None]]


def kind_of(role: str, must_go: bool, truncated: bool) -> int:
    """A number for all that matters about a row."""
    if must_go:
        return DELETED
    at = EMPTY if not role else INITIALS.find(role[0])
    return 1 + 2 * (at if at >= 0 else OTHER) + truncated


@lru_cache(maxsize=None)
def moves_of(kind: int) -> Moves:
    """The best way from state to state over one row."""
    extra = TRUNCATED_COST if kind and (kind - 1) % 2 else 0
    at = (kind - 1) // 2
    best: list[list[tuple[int, str] | None]] = [[None] * len(STATES) for _ in STATES]
    for before in STATES:
        state = before
        for inserted in range(3):
            ways = [(state, "D", 0)]
            if kind:
                renamed = STEP[state][ROLE[state][0]]
                ways.append((renamed, "R", extra))
                if at == EMPTY:
                    ways.append((state, "K", extra))
                elif at != OTHER and INITIALS[at] in STEP[state]:
                    ways.append((STEP[state][INITIALS[at]], "K", extra))
            for after, edit, more in ways:
                found = (inserted * COST["I"] + COST[edit] + more, "I" * inserted + edit)
                known = best[before][after]
                best[before][after] = found if known is None else min(known, found)
            state = STEP[state][ROLE[state][0]]
    return best


class Trails:
    """Audits as nodes linked to the node before; node 0 is the empty one."""

    def __init__(self, modulus: int = MODULUS) -> None:
        self.modulus = modulus
        self.labels: list[object] = [""]
        self.states: list[int] = [0]
        self.hashes = [0]
        self.ups: list[list[int]] = [[]]
        self.equal: set[tuple[int, int]] = set()

    def add(self, node: int, label: object, state: int) -> int:
        ups, k = [node], 0
        while k < len(self.ups[ups[k]]):
            ups.append(self.ups[ups[k]][k])
            k += 1
        code = zlib.crc32(str(label).encode()) + 1
        self.hashes.append((self.hashes[node] * BASE + code) % self.modulus)
        self.labels.append(label)
        self.states.append(state)
        self.ups.append(ups)
        return len(self.labels) - 1

    def same(self, a: int, b: int) -> bool:
        """Whether two audits of equal hash are equal indeed."""
        walked = []
        while a != b and (a, b) not in self.equal:
            if self.labels[a] != self.labels[b]:
                return False
            walked.append((a, b))
            a, b = self.ups[a][0], self.ups[b][0]
        self.equal.update(walked)
        return True

    def compare(self, a: int, b: int) -> int:
        """Negative, 0 or positive as audit ``a`` of as many labels is less, equal or greater."""
        if a == b:
            return 0
        if self.hashes[a] == self.hashes[b]:
            return 0 if self.same(a, b) else self.compare_all(a, b)
        left, right = a, b
        for k in reversed(range(len(self.ups[a]))):
            if k < len(self.ups[left]):
                up, other = self.ups[left][k], self.ups[right][k]
                if self.hashes[up] != self.hashes[other]:
                    left, right = up, other
        if self.labels[left] == self.labels[right] or not self.same(self.ups[left][0], self.ups[right][0]):
            return self.compare_all(a, b)
        return -1 if self.labels[left] < self.labels[right] else 1

    def compare_all(self, a: int, b: int) -> int:
        for x, y in zip_longest(self.path(a, self.labels), self.path(b, self.labels)):
            if x != y:
                return -1 if x < y else 1
        return 0

    def path(self, node: int, values: list) -> list:
        """The values of a node and of all before it, the first one first."""
        out = []
        while node:
            out.append(values[node])
            node = self.ups[node][0]
        return out[::-1]


def run_through(trails: Trails, items: Sequence[Moves], entry: int) -> list[tuple[int, int] | None]:
    """Per state the cost and the node of the best audit of all items that begins in ``entry``."""
    now: list[tuple[int, int] | None] = [None] * len(STATES)
    now[entry] = (0, 0)
    for moves in items:
        after: list[tuple[int, int] | None] = [None] * len(STATES)
        for target in STATES:
            best = None
            for source in STATES:
                here, move = now[source], moves[source][target]
                if here is None or move is None:
                    continue
                cost = here[0] + move[0]
                if best is None or cost < best[0]:
                    best = (cost, here[1], move[1])
                elif cost == best[0]:
                    order = trails.compare(here[1], best[1])
                    if order < 0 or (order == 0 and move[1] < best[2]):
                        best = (cost, here[1], move[1])
            if best is not None:
                after[target] = (best[0], trails.add(best[1], best[2], target))
        now = after
    return now


def tail_cost(state: int) -> int:
    return COST["I"] * len(TAILS[state])


def choose_end(ends: list[tuple[int, int] | None], compare) -> int:
    """The state in which the best whole audit ends; ``compare`` orders what the ends hold besides costs."""
    best = -1
    for state, end in enumerate(ends):
        if end is None:
            continue
        if best < 0:
            best = state
            continue
        gain = end[0] + tail_cost(state) - ends[best][0] - tail_cost(best)
        if gain < 0 or (gain == 0 and compare(end[1], ends[best][1]) < 0):
            best = state
    return best


def audit(kinds: Sequence[int], modulus: int = MODULUS) -> tuple[int, list[str], str]:
    """(cost, label per row, inserted at the end) of the best audit of a conversation."""
    if modulus == MODULUS and len(kinds) <= 32:
        return _short(bytes(kinds))
    return _audit(kinds, modulus)


@lru_cache(maxsize=1 << 14)
def _short(kinds: bytes) -> tuple[int, list[str], str]:
    return _audit(kinds, MODULUS)


def _audit(kinds: Sequence[int], modulus: int) -> tuple[int, list[str], str]:
    trails = Trails(modulus)
    ends = run_through(trails, [moves_of(kind) for kind in kinds], 0)
    state = choose_end(ends, trails.compare)
    cost, node = ends[state]
    return cost + tail_cost(state), trails.path(node, trails.labels), TAILS[state]


def composed(items: Sequence[Moves]) -> list[list[tuple[int, int] | None]]:
    """A run of items as one: per state before and after the cost and the rank of the audit."""
    trails = Trails()
    ends = [run_through(trails, items, entry) for entry in STATES]
    nodes = [end[1] for row in ends for end in row if end]
    rank, last = {}, None
    for node in sorted(nodes, key=cmp_to_key(trails.compare)):
        rank[node] = 0 if last is None else rank[last] + (trails.compare(last, node) != 0)
        last = node
    return [[(end[0], rank[end[1]]) if end else None for end in row] for row in ends]


def states_between(items: Sequence[Moves], entry: int, end: int) -> list[int]:
    """The state after each item on the best way through a run."""
    trails = Trails()
    return trails.path(run_through(trails, items, entry)[end][1], trails.states)
