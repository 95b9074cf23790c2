"""The order of rows inside a file, for filters on any of several columns."""

from __future__ import annotations

BITS = 6


def interleaved(*dimensions: tuple[str, int, int], bits: int = BITS) -> str:
    """SQL of a row's place on a space-filling curve (Z-order) over some whole-number expressions.

    Each dimension is (expression, least, greatest value) and is cut into ``2 ** bits`` equal
    cells; nulls and lower values are in the first cell, greater ones in the last. The bits of the
    cells alternate, the highest first, so rows that follow each other are near in all dimensions,
    and a row group covers a small range of each. A sort by the columns one after the other
    would do so for the first one only.
    """
    if not dimensions or len(dimensions) * bits > 62:
        raise ValueError("from 1 dimension to 62 bits in all")
    cells = 1 << bits
    terms = []
    for place, (value, least, greatest) in enumerate(reversed(dimensions)):
        scaled = f"floor((coalesce({value}, {least}) - {least}) * {cells}D / {greatest - least + 1})"
        cell = f"CAST(least({cells - 1}, greatest(0, {scaled})) AS BIGINT)"
        terms += [
            f"shiftleft(shiftright({cell}, {bit}) & 1L, {bit * len(dimensions) + place})" for bit in range(bits)
        ]
    return " + ".join(terms)
