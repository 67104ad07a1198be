"""Exact quantiles and order statistics of whole columns.

A rank is found by narrowing: the present values are counted into cells of a
monotone function, the cell that holds the rank becomes the next range, and this
repeats until that cell holds one value. The first cells are half octaves, so any
spread of magnitudes is cut well; the following ones are equal parts of the cell's
own smallest and largest value. Two or three passes are usual whatever the number of
rows, all columns together. A pass is one aggregate with map-side combine over at
most ``CELLS`` cells per wanted rank; cells, not values, reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from derrick.functions import valid

CELLS = 4096
_FIRST_RANGE = 5000  # beyond any half octave of a double


class ColumnSize(NamedTuple):
    rows: int  # with a value
    missing: int  # null or NaN


class Place(NamedTuple):
    """The value at a rank, and where its equals lie among the sorted values."""

    value: float
    below: int
    equal: int


@dataclass(frozen=True)
class _Cell:
    low: float
    high: float
    below: int
    rows: int


def column_sizes(df: DataFrame, columns: Iterable[str]) -> dict[str, ColumnSize]:
    """Size of each column, all in one pass."""
    names = list(columns)
    if not names:
        return {}
    counts = [F.count(valid(c)).alias(f"n{i}") for i, c in enumerate(names)]
    row = df.agg(F.count(F.lit(1)).alias("all"), *counts).first()
    return {c: ColumnSize(row[f"n{i}"], row["all"] - row[f"n{i}"]) for i, c in enumerate(names)}


def _half_octave(x: Column) -> Column:
    """Monotone cell number of any double: sign and half octaves of the size."""
    size = F.floor(2 * F.log2(F.abs(x))) + F.lit(2 * 1080)
    far = F.least(size, F.lit(_FIRST_RANGE - 1)).cast("int")
    return (
        F.when(x == 0, F.lit(0))
        .when(F.abs(x) == F.lit(math.inf), F.signum(x).cast("int") * _FIRST_RANGE)
        .otherwise(F.signum(x).cast("int") * far)
    )


def _part(x: Column, cell: _Cell) -> Column:
    """Number of the equal part of the cell in which ``x`` lies; null outside."""
    low, high = F.lit(cell.low), F.lit(cell.high)
    return F.when(
        x.between(low, high), F.floor((x - low) / (high - low) * CELLS).cast("int")
    )


def _count(df: DataFrame, asked: Sequence[tuple[Column, Column]]) -> list[dict[int, _Cell]]:
    """Cells with rows, per (value, cell number) pair; ``below`` counts from the pair's
    own first cell."""
    marks = [
        F.struct(F.lit(i).alias("i"), cell.alias("cell"), x.alias("x"))
        for i, (x, cell) in enumerate(asked)
    ]
    mark = marks[0] if len(marks) == 1 else F.explode(F.array(*marks))
    rows = (
        df.select(mark.alias("m"))
        .select("m.*")
        .filter("cell IS NOT NULL")
        .groupBy("i", "cell")
        .agg(F.min("x").alias("low"), F.max("x").alias("high"), F.count(F.lit(1)).alias("rows"))
        .collect()
    )
    out: list[dict[int, _Cell]] = [{} for _ in asked]
    below = [0] * len(asked)
    for r in sorted(rows, key=lambda r: (r["i"], r["cell"])):
        out[r["i"]][r["cell"]] = _Cell(r["low"], r["high"], below[r["i"]], r["rows"])
        below[r["i"]] += r["rows"]
    return out


def _holding(cells: Mapping[int, _Cell], rank: int) -> _Cell:
    return next(c for c in cells.values() if c.below <= rank < c.below + c.rows)


class Places(NamedTuple):
    rows: dict[str, int]  # present values of each column
    at: dict[str, dict[int, Place]]


def places(
    df: DataFrame, columns: Sequence[str], ranks: Callable[[str, int], Iterable[int]]
) -> Places:
    """The values at ``ranks(column, rows)``, zero-based among a column's present
    values; ranks beyond the last value are an error."""
    columns = list(dict.fromkeys(columns))
    out = Places({}, {c: {} for c in columns})
    if not columns:
        return out
    values = {c: valid(c) for c in columns}
    first = _count(df, [(x, F.when(x.isNotNull(), _half_octave(x))) for x in values.values()])
    # (column, rank) -> the cell that holds it, ``below`` from the column's start.
    open_: dict[tuple[str, int], _Cell] = {}
    for c, cells in zip(columns, first):
        rows = out.rows[c] = sum(cell.rows for cell in cells.values())
        asked = set(ranks(c, rows))
        if asked and not 0 <= min(asked) <= max(asked) < rows:
            raise IndexError(f"{c} has {rows} values, asked for ranks up to {max(asked)}")
        open_ |= {(c, r): _holding(cells, r) for r in asked}
    while open_:
        for (c, rank), cell in list(open_.items()):
            if cell.low == cell.high:
                out.at[c][rank] = Place(cell.low, cell.below, cell.rows)
                del open_[c, rank]
        ranges = list(dict.fromkeys((c, cell) for (c, _), cell in open_.items()))
        if not ranges:
            break
        found = _count(df, [(values[c], _part(values[c], cell)) for c, cell in ranges])
        inner = dict(zip(ranges, found))
        for (c, rank), cell in list(open_.items()):
            part = _holding(inner[c, cell], rank - cell.below)
            open_[c, rank] = _Cell(part.low, part.high, cell.below + part.below, part.rows)
    return out


def order_statistics(
    df: DataFrame, ranks: Mapping[str, Iterable[int]]
) -> dict[str, dict[int, float]]:
    """Values at zero-based ranks of each column's present values."""
    found = places(df, list(ranks), lambda c, rows: ranks[c])
    return {c: {r: p.value for r, p in at.items()} for c, at in found.at.items()}


def _interpolate(low: float, high: float, part: float) -> float:
    # The form that stays monotone when part is close to one.
    step = high - low
    return high - step * (1 - part) if part >= 0.5 else low + step * part


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float]
) -> dict[str, list[float | None]]:
    """Linear-interpolated quantiles per column; a column without values gives None."""

    def around(column: str, rows: int) -> set[int]:
        ends = (f((rows - 1) * p) for p in probs for f in (math.floor, math.ceil))
        return set(ends) if rows else set()

    found = places(df, columns, around)

    def quantile(c: str, p: float) -> float | None:
        if not found.rows[c]:
            return None
        place = (found.rows[c] - 1) * p
        low, high = math.floor(place), math.ceil(place)
        return _interpolate(found.at[c][low].value, found.at[c][high].value, place - low)

    return {c: [quantile(c, p) for p in probs] for c in columns}
