"""Ordered work on keyed series without putting one key into one task.

A key may hold a third of all rows, so a plain ``partitionBy(key)`` window over raw
rows is not safe. Two layouts replace it:

* *cells*: a coarse, monotone prefix of the order (an hour, a day, a range of ids), given or measured.
  Row work happens inside (key, cell); what crosses a cell edge is a small summary per
  cell, scanned over the cell table and joined back.
* *chunks*: once rows carry a gap-free position, fixed runs of positions. Bounded frames
  (lag, rolling, sliding arrays) get the few neighbouring rows copied into the chunk.

Summary joins carry no broadcast hint: adaptive execution broadcasts them when the
measured size allows and shuffles them otherwise.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import ALL, attach, idiv
from ..session import settle

CHUNK_ROWS = 1 << 16
CELL_ROWS = 1 << 20
LEVELS = 24  # a level divides a range by two at least


def measured_cells(
    df: DataFrame, key: Sequence[str], by: Sequence[str], target: int = CELL_ROWS
) -> tuple[DataFrame, list[str], DataFrame]:
    """Cells from measured counts: ``df`` with the cell columns, their names, and the rows ``_n`` per key and cell.

    A key's range of the first ``by`` column (numbers) is cut evenly; every cell that holds more than ``target`` rows
    is cut again over the range it really covers, so a burst or a single value far away costs a level, not
    a task. Rows equal in a column are cut by the next one, and only rows equal in all of them stay together.
    Cells ascend with ``by``, nulls first. The cell tables hold a few rows per ``target`` rows and are only joined.
    """
    key, names = list(key), []
    spans = [f(c).cast("double").alias(f"_{n}{i}") for i, c in enumerate(by) for n, f in (("lo", F.min), ("hi", F.max))]
    counts = settle(df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), *spans), "cells")

    def spread(i: int) -> Column:
        lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        return F.coalesce((lo < hi) & (hi - lo < float("inf")), F.lit(False))

    varies = F.lit(False)
    for i in range(len(by)):
        varies = varies | spread(i)
    heavy = counts.where((F.col("_n") > target) & varies)
    for level in range(LEVELS):
        if heavy.isEmpty():
            break
        at = [*key, *names]
        parts = F.ceil(2 * F.col("_n") / target)
        number = F.lit(0).cast("bigint")
        for i in reversed(range(len(by))):
            lo, hi, x = F.col(f"_lo{i}"), F.col(f"_hi{i}"), F.col(by[i]).cast("double")
            here = F.coalesce(F.floor((x - lo) / (hi - lo) * parts), F.lit(-1))
            number = F.when(spread(i), here).otherwise(number)
        edges = ["_n", *[f"_{n}{i}" for i in range(len(by)) for n in ("lo", "hi")]]
        fresh = [f"_at{i}" for i in range(len(at))]
        if at == [ALL]:  # a join on a constant would be a cross join
            df = attach(df, heavy.select(ALL, *edges), at)
        else:
            small = heavy.select(*[F.col(c).alias(n) for c, n in zip(at, fresh)], *edges)
            df = df.join(small, [F.col(c).eqNullSafe(F.col(n)) for c, n in zip(at, fresh)], "left")
        name = f"_measured{level}"
        df = df.withColumn(name, F.coalesce(F.when(F.col("_n").isNotNull(), number), F.lit(0))).drop(*edges, *fresh)
        names.append(name)
        counts = settle(df.groupBy(*key, *names).agg(F.count(F.lit(1)).alias("_n"), *spans), "cells")
        heavy = counts.where((F.col("_n") > target) & varies)
    return df, names, counts.select(*key, *names, "_n")


def _named_cells(df: DataFrame, cells: Sequence[Column]) -> tuple[DataFrame, list[str]]:
    """Add the cells; a null cell becomes the lowest value of its type, where nulls sort."""
    names = [f"_cell{i}" for i in range(len(cells))]
    df = df.withColumns(dict(zip(names, cells)))
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return df.withColumns({n: F.coalesce(F.col(n), _lowest(kinds[n])) for n in names}), names


def _with_key(df: DataFrame, key: Sequence[str]) -> DataFrame:
    for k in key:
        df = df.where(F.col(k).isNotNull())
    return df


def _lowest(kind: str) -> Column:
    if kind == "string":
        return F.lit("")
    if kind in ("date", "timestamp", "timestamp_ntz"):
        return F.lit("0001-01-01").cast(kind)
    if kind in ("float", "double"):
        return F.lit(float("-inf")).cast(kind)
    return F.lit(-(2**31)).cast(kind) if kind == "int" else F.lit(-(2**63)).cast(kind)


def positions(
    df: DataFrame,
    key: Sequence[str],
    by: Sequence[str],
    cells: Sequence[Column] | None = None,
    out: str = "pos",
    total: str | None = None,
) -> DataFrame:
    """1-based position of each row in its key's total order ``by``. Rows with a null key
    belong to no series and are left out, as grouped pandas operations do.

    ``cells`` must be monotone in ``by`` (rows of a smaller cell come first); without them they are
    measured. Counts per cell are combined map-side; only the count table is scanned per key.
    """
    key = list(key)
    if cells is None:
        df, names, counts = measured_cells(df, key, by)
        if not names:  # no key has more rows than a cell
            rank = F.row_number().over(Window.partitionBy(*key).orderBy(*by)).cast("bigint")
            df = df.withColumn(out, rank) if total is None else attach(df.withColumn(out, rank), counts.withColumnRenamed("_n", total), key)
            return _with_key(df, key)
    else:
        df, names = _named_cells(df, cells)
        counts = df.groupBy(*key, *names).agg(F.count(F.lit(1)).alias("_n"))
    per_key = Window.partitionBy(*key)
    before = per_key.orderBy(*names).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    if total:
        offsets = offsets.withColumn(total, F.sum("_n").over(per_key))
    rank = F.row_number().over(Window.partitionBy(*key, *names).orderBy(*by))
    return (
        df.withColumn("_rn", rank)
        .join(offsets.drop("_n"), [*key, *names])
        .withColumn(out, (F.col("_off") + F.col("_rn")).cast("bigint"))
        .drop("_off", "_rn", *names)
    )


def running_sum(
    df: DataFrame,
    key: Sequence[str],
    by: Sequence[str],
    cells: Sequence[Column] | None,
    sums: dict[str, str],
    exclusive: bool = False,
    target: int = CELL_ROWS,
) -> DataFrame:
    """Running sums ``{source column: output column}`` along the order, cell by cell (measured ones of about
    ``target`` rows if none are given)."""
    key = list(key)
    df, names = _named_cells(df, cells) if cells is not None else measured_cells(df, key, by, target)[:2]
    end = -1 if exclusive else 0
    if not names:  # no key has more rows than a cell
        whole = Window.partitionBy(*key).orderBy(*by).rowsBetween(Window.unboundedPreceding, end)
        df = df.withColumns({o: F.coalesce(F.sum(c).over(whole), F.lit(0)) for c, o in sums.items()})
        return _with_key(df, key)
    totals = df.groupBy(*key, *names).agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
    before = (
        Window.partitionBy(*key).orderBy(*names).rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = totals.select(
        *key, *names,
        *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_o_{c}") for c in sums],
    )
    local = (
        Window.partitionBy(*key, *names).orderBy(*by).rowsBetween(Window.unboundedPreceding, end)
    )
    out = df.withColumns({f"_l_{c}": F.coalesce(F.sum(c).over(local), F.lit(0)) for c in sums})
    out = out.join(offsets, [*key, *names])
    out = out.withColumns({o: F.col(f"_o_{c}") + F.col(f"_l_{c}") for c, o in sums.items()})
    return out.drop(*names, *[f"_l_{c}" for c in sums], *[f"_o_{c}" for c in sums])


def framed(
    df: DataFrame,
    key: Sequence[str],
    pos: str,
    before: int,
    after: int,
    columns: Callable[[Window], dict[str, Column]],
    rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Add window columns whose frames reach ``before`` rows back and ``after`` rows ahead.

    ``pos`` is the gap-free position inside the key. Each row lands in its own chunk and,
    near an edge, in the neighbouring chunks that need it; the copies are dropped after
    the window. Every task group holds at most ``rows + before + after`` rows.
    """
    p = F.col(pos) - 1
    first = idiv(F.greatest(p - after, F.lit(0)), rows)
    last = idiv(p + before, rows)
    spread = df.withColumn("_own", idiv(p, rows)).withColumn(
        "_chunk", F.explode(F.sequence(first, last))
    )
    w = Window.partitionBy(*key, "_chunk").orderBy(pos)
    done = spread.withColumns(columns(w))
    return done.where(F.col("_own") == F.col("_chunk")).drop("_own", "_chunk")


def neighbours(
    df: DataFrame,
    key: Sequence[str],
    pos: str,
    value: str,
    extra: Sequence[str] = (),
    rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Nearest valid observation at or before (``prev``) and at or after (``next``) each row.

    Both are structs (pos, value, *extra) or null. The carry over a chunk edge is the
    last / first valid struct per chunk, scanned over the chunk table.
    """
    key = list(key)
    valid = F.when(F.col(value).isNotNull(), F.struct(pos, value, *extra))
    df = df.withColumn("_chunk", idiv(F.col(pos) - 1, rows)).withColumn("_valid", valid)
    edge = df.groupBy(*key, "_chunk").agg(
        F.max("_valid").alias("_last"), F.min("_valid").alias("_first")
    )
    chunks = Window.partitionBy(*key).orderBy("_chunk")
    edge = edge.select(
        *key, "_chunk",
        F.max("_last").over(chunks.rowsBetween(Window.unboundedPreceding, -1)).alias("_carry_prev"),
        F.min("_first").over(chunks.rowsBetween(1, Window.unboundedFollowing)).alias("_carry_next"),
    )
    local = Window.partitionBy(*key, "_chunk").orderBy(pos)
    back = local.rowsBetween(Window.unboundedPreceding, 0)
    ahead = (
        Window.partitionBy(*key, "_chunk")
        .orderBy(F.col(pos).desc())
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    df = df.withColumn("_p", F.last("_valid", ignorenulls=True).over(back)).withColumn(
        "_n", F.last("_valid", ignorenulls=True).over(ahead)
    )
    return (
        df.join(edge, [*key, "_chunk"])
        .withColumn("prev", F.coalesce("_p", "_carry_prev"))
        .withColumn("next", F.coalesce("_n", "_carry_next"))
        .drop("_chunk", "_valid", "_p", "_n", "_carry_prev", "_carry_next")
    )
