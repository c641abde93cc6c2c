"""Exact quantiles of a column in at most five passes, without a sort.

The first pass counts values in cells of the logarithm, ``LOG_CELLS`` to each power of two, which
brackets every rank within a few per cent of its value however the data are spread. Each
further pass cuts a bracket into ``CELLS`` equal parts, and doubles have no more than ``2^49`` values
between such ends, so three of them leave one value; a fourth covers rounding. A bracket whose least and
largest values agree is finished at once.

A pass is one aggregate over one column, combined map-side. Its cells are added up by a window over
cells, not values, and only the cell of each wanted rank comes to the driver. Any map that
never turns two values round would do, so results do not depend on how exactly it rounds.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CELLS = 1 << 16
LOG_CELLS = 8
MAX_PASSES = 5


@dataclass
class Search:
    """One bracket still under search: values in ``[low, high]``, ``below`` rows before it."""

    low: float
    high: float
    below: int
    ranks: list[int]


def log_cell(x: Column) -> Column:
    """Cells by sign and logarithm; they never decrease as ``x`` grows."""
    size = F.floor((F.log2(F.abs(x)) + 1_100) * LOG_CELLS).cast("int") + 1
    return F.when(x == 0, 0).when(x > 0, size).otherwise(-size)


def order_statistics(df: DataFrame, column: str, ranks: Sequence[int] | None = None, *, fractions=None):
    """Values at 0-based ranks of the sorted column, as ``(values by rank, row count)``.

    With ``fractions`` the ranks around each quantile position are looked up.
    """
    by_rank, n, _ = search(df, column, ranks, fractions=fractions)
    return by_rank, n


def search(df: DataFrame, column: str, ranks: Sequence[int] | None = None, *, fractions=None) -> tuple[dict[int, float], int, int]:
    """As ``order_statistics``, with the number of passes over the data."""
    value = F.col(column).cast("double")
    values = df.select(value.alias("x")).where(F.col("x").isNotNull())
    finite = F.abs("x") < float("inf")
    cell = F.when(finite & ~F.isnan("x"), log_cell(F.col("x")))
    # A few thousand cells at most, whatever the data.
    cells = _counted(values.select("x", F.lit(0).alias("g"), cell.alias("b"))).collect()
    if not cells:
        raise ValueError("quantiles of an empty sample")
    if any(row["b"] is None for row in cells):
        raise ValueError("sample must be finite")
    n = sum(row["n"] for row in cells)
    if fractions is not None:
        ranks = sorted({r for q in fractions for r in around(q, n)})
    found: dict[int, float] = {}
    searches, below = [], 0
    for row in sorted(cells, key=lambda r: r["b"]):
        searches += _narrow(row, below, [r for r in ranks if below <= r < below + row["n"]], found)
        below += row["n"]
    passes = 1
    while searches:
        if passes == MAX_PASSES:
            raise AssertionError("a bracket of one value was not reached")
        searches = _refine(values, searches, found)
        passes += 1
    return {r: found[r] for r in ranks}, n, passes


def around(fraction: float, n: int) -> tuple[int, int]:
    position = fraction * (n - 1)
    low = math.floor(position)
    return low, min(low + 1, n - 1)


def interpolate(fraction: float, n: int, by_rank: dict[int, float]) -> float:
    position = fraction * (n - 1)
    low, high = around(fraction, n)
    a, b, t = by_rank[low], by_rank[high], position - low
    return b - (b - a) * (1 - t) if t >= 0.5 else a + (b - a) * t


def quantiles(df: DataFrame, column: str, fractions: Sequence[float]) -> tuple[list[float], int]:
    """Linearly interpolated quantiles and the number of values."""
    by_rank, n = order_statistics(df, column, fractions=fractions)
    return [interpolate(q, n, by_rank) for q in fractions], n


def _counted(cells: DataFrame) -> DataFrame:
    return cells.groupBy("g", "b").agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("low"), F.max("x").alias("high"))


def _narrow(row, below: int, ranks: list[int], found: dict[int, float]) -> list[Search]:
    """Settle the ranks whose value a cell shows; what is left of it, if anything."""
    ends = {below: row["low"], below + row["n"] - 1: row["high"]}
    for r in ranks:
        if row["low"] == row["high"]:
            found[r] = row["low"]
        elif r in ends:
            found[r] = ends[r]
    rest = [r for r in ranks if r not in found]
    return [Search(row["low"], row["high"], below, rest)] if rest else []


def _refine(values: DataFrame, searches: list[Search], found: dict[int, float]) -> list[Search]:
    x = F.col("x")
    group, cell = F.lit(None).cast("int"), F.lit(None).cast("int")
    for i, s in enumerate(searches):
        inside = x.between(s.low, s.high)
        # Halved before subtracting, so that a range wider than the largest double is safe.
        position = (x / 2 - s.low / 2) / (s.high / 2 - s.low / 2)
        group = F.when(inside, i).otherwise(group)
        cell = F.when(inside, F.least(F.floor(position * CELLS), F.lit(CELLS - 1)).cast("int")).otherwise(cell)
    counted = _counted(values.select(x, group.alias("g"), cell.alias("b")).where(F.col("g").isNotNull()))
    before = F.sum("n").over(Window.partitionBy("g").orderBy("b")) - F.col("n")
    wanted = F.lit(False)
    for i, s in enumerate(searches):
        for r in s.ranks:
            wanted |= (F.col("g") == i) & (F.col("below") <= r - s.below) & (F.col("below") + F.col("n") > r - s.below)
    following = []
    for row in counted.withColumn("below", before).where(wanted).collect():
        s = searches[row["g"]]
        below = s.below + row["below"]
        following += _narrow(row, below, [r for r in s.ranks if below <= r < below + row["n"]], found)
    return following
