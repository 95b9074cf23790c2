"""Rounding and summation of binary floating point money and distances."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNITS = 10_000.0
FINER = 1e12


def exact_sum(column: Column) -> Column:
    """Sum of doubles that does not depend on the order of the rows.

    Values are added as whole ten-thousandths, and what they have beyond four
    decimals as whole trillionths, both in 64-bit integers. Reruns and other
    partitionings give the same bits; a value or sum beyond 9.2e14, an infinite
    one or NaN is an error.
    """
    units = F.rint(column * UNITS).cast("bigint")
    rest = F.rint((column - units / UNITS) * FINER).cast("bigint")
    return F.sum(units) / UNITS + F.sum(rest) / FINER


def rounded_ratio(total: Column, count: Column, scale: int = 2) -> Column:
    """``total / count``, half away from zero at ``scale``; NULL when ``count`` is 0.

    Divides as decimals, one division per group, because a mean of cents often
    lies exactly between two cents and a binary quotient falls on either side.
    Totals of 1e24 and more are an error.
    """
    exact = F.try_divide(total.cast("decimal(30,6)"), count.cast("decimal(20,0)"))
    return F.round(exact, scale).cast("double")


def half_even(column: str, scale: int = 2) -> Column:
    """Round the exact binary value, ties to even, as event enrichment does.

    ``round`` and ``bround`` round the shortest decimal text instead: for them
    2.675 is a tie, while the stored double lies below it. ``column`` is a
    name or an SQL expression.
    """
    return F.expr(f"try_cast(format_number({column}, '0.{'0' * scale}') AS DOUBLE)")


def to_integer(column: Column) -> Column:
    """Number to bigint, rounding half away from zero instead of truncating."""
    return F.round(column).cast("bigint")
