"""Resampling onto regular grids. Rows are aggregated to cells before any ordering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import idiv, timestamp_of


def dense_grid(
    cells: DataFrame,
    key: Sequence[str],
    cell: str,
    step: int = 1,
    zero: Sequence[str] = (),
    pos: str = "pos",
) -> DataFrame:
    """Fill the holes of an aggregated table: one row per step between a key's first and
    last cell. Measures of a hole are null, those named in ``zero`` are 0."""
    key = list(key)
    span = cells.groupBy(*key).agg(F.min(cell).alias("_lo"), F.max(cell).alias("_hi"))
    full = span.select(
        *key, F.posexplode(F.sequence("_lo", "_hi", F.lit(step).cast("bigint"))).alias("_p", cell)
    ).withColumn(pos, (F.col("_p") + 1).cast("bigint"))
    out = full.drop("_p").join(cells, [*key, cell], "left")
    return out.withColumns({z: F.coalesce(F.col(z), F.lit(0)) for z in zero})


def to_cells(
    df: DataFrame, key: Sequence[str], time: str, step: int, measures: dict[str, Column]
) -> DataFrame:
    """Aggregate rows to cells of ``step`` time units; ``cell`` is the cell's start."""
    start = (idiv(time, step) * step).alias("cell")
    return df.groupBy(*key, start).agg(*[m.alias(n) for n, m in measures.items()])


def grid_mean(df: DataFrame, key: Sequence[str], time: str, value: str, step: int) -> DataFrame:
    """Mean per cell on a dense grid; empty cells are null."""
    return dense_grid(to_cells(df, key, time, step, {"value": F.avg(value)}), key, "cell", step)


def grid_count(df: DataFrame, key: Sequence[str], time: str, step: int) -> DataFrame:
    """Count per cell on a dense grid; empty cells are 0."""
    cells = to_cells(df, key, time, step, {"n": F.count(F.lit(1))})
    return dense_grid(cells, key, "cell", step, zero=["n"])


def ohlc(
    df: DataFrame, key: Sequence[str], time: str, tie: str, value: str, step: int
) -> DataFrame:
    """Open, high, low, close per cell; ``tie`` orders rows of equal time."""
    at = F.struct(time, tie)
    return to_cells(
        df, key, time, step,
        {"open": F.min_by(value, at), "high": F.max(value), "low": F.min(value),
         "close": F.max_by(value, at)},
    )


def month_number(date: str | Column) -> Column:
    return (F.year(date) * 12 + F.month(date) - 1).cast("bigint")


def upsample_forward(
    cells: DataFrame, key: Sequence[str], cell: str, value: str, step: int = 1
) -> DataFrame:
    """Denser grid with the last known value carried forward (one row per cell, so a key's
    group is bounded by the calendar)."""
    grid = dense_grid(cells, key, cell, step)
    back = Window.partitionBy(*key).orderBy(cell).rowsBetween(Window.unboundedPreceding, 0)
    return grid.withColumn(value, F.last(value, ignorenulls=True).over(back))


def cell_start(cell: str, step: int) -> Column:
    return timestamp_of(F.col(cell) * step)
