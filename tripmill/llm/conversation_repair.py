"""Operator 13, conversation structure repair: the cheapest edits that give a conversation its form.

Rows of a conversation are taken by turn, null turns first, then by role and text (bytes).
A row is *blank* without any character but ASCII white space, else a *duplicate* if role
and text came before, else *truncated* if its last other character is none of ``.!?``. Blank
rows and duplicates are deleted. Edits and costs are those of ``audit_trails``, which finds
the cheapest audit, the least in ASCII order among equals, with a persistent dynamic programme.

Conversations of up to ``LONG_ROWS`` rows and ``LONG_BYTES`` bytes are worked on one after
the other where a sort by conversation brings them. Longer ones are ordered by ranges, so
that their rows lie in many tasks, equal rows as one with a number of copies. There runs of
``1 << FAN`` neighbours become one item each, by their costs and the order of their audits
from state to state; these are run together likewise until one is left. The way chosen for
it is then followed down to the rows. A SHA-256 cannot be cut, so ``audited`` at last
streams each conversation through one task, which holds no more of it than its audit.

Null roles and texts count as one blank, null ids are one conversation. A row of an empty
role may stay anywhere, as it adds no initial. Rows alike in all
columns are duplicates of the first one. An empty table gives no rows. Other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import sha256
from itertools import groupby
from operator import itemgetter
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StringType, StructType

from tripmill.llm import audit_trails as trails
from tripmill.llm.common import in_small_batches, stored

LONG_ROWS = 2048
LONG_BYTES = 4 << 20
#: A run has up to 2 to this power of neighbours.
FAN = 11
BROADCAST_ROWS = 1_000_000
BLANKS = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")
#: Characters of a text by which rows are dealt to tasks.
RANGE_CHARS = 128
SENT = 1024


class Edited(NamedTuple):
    """A row with what happens to it; the copies after the first are deleted."""

    turn: int | None
    role: str
    text: str
    copies: int
    fault: str
    edits: str


def trimmed(text: Column) -> Column:
    return F.rtrim(text, F.lit(BLANKS))


def of_same(left: DataFrame, right: DataFrame, *columns: str, how: str = "inner") -> DataFrame:
    """Rows joined by conversation, null ids being equal, and by further columns."""
    names = ["conv_id", *columns]
    rest = [c for c in right.columns if c not in names]
    right = right.select(*(F.col(c).alias(f"other_{c}") for c in names), *rest)
    condition = F.col("conv_id").eqNullSafe(F.col("other_conv_id"))
    for name in columns:
        condition &= F.col(name) == F.col(f"other_{name}")
    return left.join(right, condition, how).drop(*(f"other_{c}" for c in names))


def long_conversations(rows: DataFrame) -> DataFrame:
    size = rows.groupBy("conv_id").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
    long = size.where((F.col("n") > LONG_ROWS) | (F.col("bytes") > LONG_BYTES)).select("conv_id")
    return stored(long, "repair-long")


def fault_of(text: str, seen: bool) -> str:
    end = text.rstrip(BLANKS)
    if not end:
        return "blank"
    return "duplicate" if seen else "" if end.endswith(ENDS) else "truncated"


def kind_of(role: str, fault: str) -> int:
    return trails.kind_of(role, fault in ("blank", "duplicate"), fault == "truncated")


def stream(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def short_edits(rows: Iterable[tuple]) -> Iterator[tuple[object, Iterable[Edited]]]:
    """(id, edited rows) of conversations that fit into memory, from their sorted rows."""
    for conv_id, group in groupby(rows, key=itemgetter(0)):
        seen: set[tuple[str, str]] = set()
        own = []
        for _, turn, role, text in group:
            own.append((turn, role, text, 1, fault_of(text, (role, text) in seen)))
            seen.add((role, text))
        _, labels, _ = trails.audit([kind_of(row[1], row[4]) for row in own])
        yield conv_id, [Edited(*row, label) for row, label in zip(own, labels)]


def long_edits(rows: Iterable[tuple]) -> Iterator[tuple[object, Iterable[Edited]]]:
    """The same from sorted rows whose edits are known; a conversation is never in memory."""
    for conv_id, group in groupby(rows, key=itemgetter(0)):
        yield conv_id, (Edited(*row[1:]) for row in group)


def turns_left(rows: Iterable[Edited]) -> Iterator[tuple[Edited | None, str, str, str]]:
    """(row, edit, role, text) of the turns of a repaired conversation; turns added at the end have no row."""
    state = 0
    for row in rows:
        for edit in row.edits:
            if edit != "D":
                role = row.role if edit == "K" else trails.ROLE[state]
                yield row, edit, role, "" if edit == "I" else row.text
                state = trails.STEP[state][role[0]] if role else state
    for edit in trails.TAILS[state]:
        yield None, edit, trails.ROLE[state], ""
        state = trails.STEP[state][trails.ROLE[state][0]]


REPORT = (
    "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint,"
    " audit string, repaired_sha256 string"
)
TURNS = "position bigint, edit string, role string, text string"


def report(conv_id: object, rows: Iterable[Edited]) -> Iterator[tuple]:
    """The row of a conversation in ``audited``, whose rows are read once."""
    low = last = before = None
    different = illegal = cost = 0
    faults = dict.fromkeys(("blank", "duplicate", "truncated", ""), 0)
    letters: list[str] = []

    def watched() -> Iterator[Edited]:
        nonlocal low, last, before, different, illegal, cost
        for row in rows:
            if row.turn is not None:
                low = row.turn if low is None else low
                different += row.turn != last
                last = row.turn
            initial = row.role[:1]
            illegal += before is not None and before + initial not in ("su", "ua", "au")
            # A copy follows a row of the same role.
            illegal += row.copies - 1
            before = initial
            faults[row.fault] += 1
            faults["blank" if row.fault == "blank" else "duplicate"] += row.copies - 1
            letters.append(row.edits + "D" * (row.copies - 1))
            if row.fault == "truncated" and not row.edits.endswith("D"):
                cost += trails.TRUNCATED_COST
            yield row

    digest, between = sha256(), ""
    for row, edit, role, text in turns_left(watched()):
        digest.update(f"{between}{role}:{text}".encode())
        between = "\n"
        if row is None:
            letters.append(edit)
    audit = "".join(letters)
    cost += sum(price * audit.count(edit) for edit, price in trails.COST.items())
    gaps = 0 if low is None else last - low + 1 - different
    yield (conv_id, gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit,
           digest.hexdigest())


def turns(conv_id: object, rows: Iterable[Edited]) -> Iterator[tuple]:
    """The repaired turns of a conversation, in order."""
    for position, (_, edit, role, text) in enumerate(turns_left(rows)):
        yield conv_id, position, edit, role, text


def mapped(df: DataFrame, work, schema: StructType) -> DataFrame:
    """``mapInArrow`` with a function from a task's rows to rows."""
    fields = to_arrow_schema(schema)

    def send(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows) if rows else [()] * len(fields)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, fields)], schema=fields
        )

    def run(batches):
        out: list[tuple] = []
        size = 0
        for row in work(stream(batches)):
            out.append(row)
            size += sum(len(x) for x in row if isinstance(x, str))
            if len(out) >= SENT or size >= LONG_BYTES:
                yield send(out)
                out, size = [], 0
        yield send(out)

    return in_small_batches(df).mapInArrow(run, schema)


def with_id(df: DataFrame, rest: str) -> StructType:
    return StructType([df.schema["conv_id"], *StructType.fromDDL(rest)])


def order() -> list[Column]:
    return [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.col("role")]


def small(df: DataFrame) -> DataFrame:
    """Marked for broadcast if it has few rows, else left to a shuffle."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def ordered_rows(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies, fault, at) of long conversations; ``at`` is their order."""
    copies = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies"))
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = copies.groupBy("conv_id", "role", "text").agg(F.min(place).alias("first"))
    known = of_same(copies, first, "role", "text")
    end = trimmed(F.col("text"))
    fault = F.when(end == "", "blank").when(place != F.col("first"), "duplicate")
    fault = fault.when(F.substring(end, -1, 1).isin(*ENDS), "").otherwise("truncated")
    dealt = known.withColumn("fault", fault).drop("first").repartitionByRange(*order(), F.substring("text", 1, RANGE_CHARS))
    dealt = dealt.sortWithinPartitions(*order(), "text")
    return stored(dealt.withColumn("at", F.monotonically_increasing_id()), "repair-rows")


ITEM = "at bigint, kind int, copies bigint, costs array<bigint>, ranks array<int>"


def moves_of(item: dict) -> trails.Moves:
    """What a row with its copies, or a run of rows, does."""
    if item["kind"] is not None:
        more = trails.COST["D"] * (item["copies"] - 1)
        found = trails.moves_of(item["kind"])
        return [[(m[0] + more, m[1]) if m else None for m in row] for row in found] if more else found
    pairs = [(c, r) if c >= 0 else None for c, r in zip(item["costs"], item["ranks"])]
    width = len(trails.STATES)
    return [pairs[i : i + width] for i in range(0, len(pairs), width)]


def runs_of(items: DataFrame) -> DataFrame:
    """(conv_id, at, own): the items of every run of neighbours."""
    own = F.collect_list(F.struct("at", "kind", "copies", "costs", "ranks")).alias("own")
    return items.groupBy("conv_id", F.shiftright("at", FAN).alias("run")).agg(own).withColumnRenamed("run", "at")


def in_order(own: list[dict]) -> list[dict]:
    return sorted(own, key=itemgetter("at"))


def run_together(items: DataFrame) -> DataFrame:
    """Every run of neighbours as one item."""

    def work(rows):
        for conv_id, at, own in rows:
            pairs = [p or (-1, -1) for row in trails.composed([moves_of(x) for x in in_order(own)]) for p in row]
            yield conv_id, at, None, None, [p[0] for p in pairs], [p[1] for p in pairs]

    return mapped(runs_of(items), work, with_id(items, ITEM))


def chosen_ends(items: DataFrame) -> DataFrame:
    """(conv_id, at, entry, leave) of the one item that stands for a whole conversation."""

    def work(rows):
        for conv_id, at, *rest in rows:
            ends = moves_of(dict(zip(("kind", "copies", "costs", "ranks"), rest)))[0]
            yield conv_id, at, 0, trails.choose_end(ends, lambda a, b: a - b)

    return mapped(items, work, with_id(items, "at bigint, entry int, leave int"))


def ways_below(items: DataFrame, ways: DataFrame) -> DataFrame:
    """The way through every item of the runs that ``ways`` pass, and the edits of rows."""
    met = of_same(runs_of(items), ways, "at").select("conv_id", "own", "entry", "leave")

    def work(rows):
        for conv_id, own, entry, leave in rows:
            own = in_order(own)
            moves = [moves_of(x) for x in own]
            for item, move, state in zip(own, moves, trails.states_between(moves, entry, leave)):
                edits = move[entry][state][1] if item["kind"] is not None else None
                yield conv_id, item["at"], entry, state, edits
                entry = state

    return mapped(met, work, with_id(items, "at bigint, entry int, leave int, edits string"))


def edited_long(rows: DataFrame) -> DataFrame:
    """The rows of long conversations with their edits, in order within tasks."""
    placed = ordered_rows(rows)
    initial = F.substring("role", 1, 1)
    number = F.when(initial == "", trails.EMPTY)
    for at, letter in enumerate(trails.INITIALS):
        number = number.when(initial == letter, at)
    number = number.otherwise(trails.OTHER)
    kind = F.when(F.col("fault").isin("blank", "duplicate"), trails.DELETED).otherwise(
        1 + 2 * number + (F.col("fault") == "truncated").cast("int")
    )
    items = placed.select(
        "conv_id", "at", kind.cast("int").alias("kind"), "copies",
        F.lit(None).cast("array<bigint>").alias("costs"), F.lit(None).cast("array<int>").alias("ranks"),
    )
    levels = [items, stored(run_together(items), "repair-runs")]
    while levels[-1].groupBy("conv_id").count().where("count > 1").limit(1).count():
        levels.append(stored(run_together(levels[-1]), "repair-runs"))
    ways = chosen_ends(levels[-1])
    for level in reversed(levels[:-1]):
        ways = stored(ways_below(level, ways.select("conv_id", "at", "entry", "leave")), "repair-ways")
    met = of_same(placed, ways.select("conv_id", "at", "edits"), "at")
    met = met.select("conv_id", "at", "turn", "role", "text", "copies", "fault", "edits")
    return met.repartition("conv_id").sortWithinPartitions(F.asc_nulls_first("conv_id"), "at").drop("at")


def finished(conversations: DataFrame, finish, schema: str) -> DataFrame:
    """``finish`` on the edited rows of every conversation."""
    blank = F.lit(" ")
    rows = conversations.select(
        "conv_id", F.col("turn").cast(LongType()).alias("turn"),
        F.coalesce(F.col("role").cast(StringType()), blank).alias("role"),
        F.coalesce(F.col("text").cast(StringType()), blank).alias("text"),
    )
    out = with_id(rows, schema)

    def ended(edits):
        return lambda sorted_rows: (x for own in edits(sorted_rows) for x in finish(*own))

    long = long_conversations(rows)
    if not long.limit(1).count():
        return mapped(rows.repartition("conv_id").sortWithinPartitions(*order(), "text"), ended(short_edits), out)
    few = small(long)
    rest = of_same(rows, few, how="left_anti")
    rest = rest.repartition("conv_id").sortWithinPartitions(*order(), "text")
    apart = edited_long(of_same(rows, few, how="left_semi"))
    return mapped(rest, ended(short_edits), out).unionByName(mapped(apart, ended(long_edits), out))


def audited(conversations: DataFrame) -> DataFrame:
    """Per conversation of ``conv_id, turn, role, text``: its faults, the audit, the repaired text's hash.

    (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256). ``gaps``
    is the number of turns missing between the least and the greatest one, ``illegal`` that of
    neighbours whose roles do not follow each other. The hash is of lines ``role:text``.
    """
    return finished(conversations, report, REPORT)


def repaired(conversations: DataFrame) -> DataFrame:
    """The turns of the repaired conversations: (conv_id, position, edit, role, text)."""
    return finished(conversations, turns, TURNS)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows as a faulty export has them, by the check sum of ``conv_id:turn``: one in 20 each dropped,
    emptied, without sentence marks, twice, or as a user's."""
    blank = F.lit(" ")
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")))
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"),
        (F.crc32(key.cast("binary")) % 20).alias("fate"),
    ).where("fate <> 0")
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ".!?", ""))
    rows = rows.withColumn("text", text.otherwise(F.col("text")))
    rows = rows.withColumn("role", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")))
    times = F.when(F.col("fate") == 3, 2).otherwise(1)
    return rows.withColumn("copy", F.explode(F.array_repeat(F.lit(0), times))).drop("copy", "fate")


def audited_after_damage(conversations: DataFrame) -> DataFrame:
    """``audited`` of the damaged rows, with a row of zeros for conversations that lost all of theirs."""
    found = audited(damaged(conversations))
    ids = conversations.select("conv_id").distinct()
    joined = of_same(ids, found, how="left")
    values = []
    for field in StructType.fromDDL(REPORT):
        nothing = sha256().hexdigest() if field.name == "repaired_sha256" else "" if field.dataType == StringType() else 0
        values.append(F.coalesce(field.name, F.lit(nothing)).alias(field.name))
    return joined.select("conv_id", *values)
