"""Joins that need care: group sizes, lookups, as-of, intervals, tolerance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import attach, idiv
from ..session import settle
from .ordered import CELL_ROWS, framed, measured_cells


def with_group_size(df: DataFrame, key: Sequence[str], out: str) -> DataFrame:
    """Attach each group's row count. A count window would gather a hot group in one task;
    the aggregate combines map-side and is joined back."""
    sizes = df.groupBy(*key).agg(F.count(F.lit(1)).alias(out))
    return attach(df, sizes, key)


def lookup(df: DataFrame, table: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join of a per-slot profile; rows without a profile keep nulls."""
    return df.join(settle(table, "lookup"), list(on), "left")


def class_weights(df: DataFrame, labels: Sequence[str], out: str = "weight") -> DataFrame:
    """Weight 1 / class count looked up per row."""
    w = df.groupBy(*labels).agg((1.0 / F.count(F.lit(1))).alias(out))
    return attach(df, w, labels)


def asof(
    left: DataFrame,
    right: DataFrame,
    key: Sequence[str],
    left_time: str,
    right_time: str,
    right_tie: str,
    value: str,
    target: int = CELL_ROWS,
) -> DataFrame:
    """Last ``value`` of ``right`` at or before each left row's time.

    Both sides are unioned and ordered once per key and measured cell of about ``target`` rows of either
    side; a right row sorts before a left row of equal time. The value standing at the end of a cell is
    carried to later cells through the cell table, so no key is gathered in one task.
    """
    key = list(key)
    payload = F.struct(*[F.col(c) for c in left.columns])
    stamp = F.struct(F.col(right_time).alias("t"), F.col(right_tie).alias("tie"), value)
    r = right.select(
        *key, F.col(right_time).alias("_t"), F.lit(0).alias("_side"), F.col(right_tie).alias("_tie"),
        stamp.alias("_obs"),
    )
    lt = left.select(*key, F.col(left_time).alias("_t"), F.lit(1).alias("_side"), payload.alias("_row"))
    # Left rows number themselves where times and sides are equal, so that any burst can be cut.
    both = lt.withColumn("_tie", F.xxhash64("_row")).unionByName(r, allowMissingColumns=True)
    both, cell, _ = measured_cells(both, key, ["_t", "_side", "_tie"], target)
    at = [*key, *cell]
    ends = both.groupBy(*at).agg(F.max("_obs").alias("_end"))
    before = Window.partitionBy(*key).orderBy(*(cell or key)).rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select(*at, F.max("_end").over(before).alias("_carry"))
    inside = (
        Window.partitionBy(*at).orderBy("_t", "_side", "_tie")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    seen = both.withColumn("_local", F.last("_obs", ignorenulls=True).over(inside))
    found = seen.where(F.col("_side") == 1).join(carry, at, "left")
    hit = F.coalesce("_local", "_carry")
    return found.select("_row.*", hit["t"].alias("matched_t"), hit[value].alias(f"asof_{value}"))


def _by_bucket(windows: DataFrame, begin: str, end: str, bucket: int) -> DataFrame:
    return windows.where(F.col(end) > F.col(begin)).withColumn(
        "_bucket", F.explode(F.sequence(idiv(begin, bucket), idiv(F.col(end) - 1, bucket)))
    )


def interval_join(
    points: DataFrame, windows: DataFrame, time: str, begin: str, end: str, bucket: int,
    key: Sequence[str] = (), how: str = "inner",
) -> DataFrame:
    """Points inside ``[begin, end)`` windows as an equi join on time buckets plus a filter.

    A point lies in one bucket, so no pair appears twice. ``left_anti`` and ``left_semi``
    keep points in no / some window.
    """
    w = _by_bucket(windows, begin, end, bucket).withColumnsRenamed({c: f"_k_{c}" for c in key})
    p = points.withColumn("_bucket", idiv(time, bucket)).alias("p")
    w = w.alias("w")
    inside = (
        (F.col("p._bucket") == F.col("w._bucket"))
        & (F.col(f"p.{time}") >= F.col(f"w.{begin}"))
        & (F.col(f"p.{time}") < F.col(f"w.{end}"))
    )
    for c in key:
        inside = inside & (F.col(f"p.{c}") == F.col(f"w._k_{c}"))
    j = p.join(w, inside, how)
    if how in ("left_anti", "left_semi"):
        return j.drop("_bucket")
    keep = [F.col(f"p.{c}") for c in points.columns]
    keep += [F.col(f"w.{c}") for c in windows.columns if c not in key and c not in points.columns]
    return j.select(*keep)


def near_flags(
    df: DataFrame, key: Sequence[str], pos: str, columns: dict[str, Column], tolerance: int,
    rows: int | None = None,
) -> DataFrame:
    """Maximum of each column over positions within +-tolerance, without forming pairs."""
    extra = {"rows": rows} if rows else {}

    def cols(w):
        f = w.rangeBetween(-tolerance, tolerance)
        return {name: F.max(c).over(f) for name, c in columns.items()}

    return framed(df, key, pos, tolerance, tolerance, cols, **extra)


def macro_join(
    rows: DataFrame, left: DataFrame, right: DataFrame, period: str, values: Sequence[str]
) -> DataFrame:
    """Outer join of two period tables, left join to ``rows`` (one row per period), then
    forward fill. All three tables hold one row per calendar period."""
    macro = left.join(right, period, "full_outer")
    back = Window.partitionBy().orderBy(period).rowsBetween(Window.unboundedPreceding, 0)
    joined = rows.join(macro, period, "left")
    return joined.withColumns({v: F.last(v, ignorenulls=True).over(back) for v in values})


def split_by_ids(df: DataFrame, ids: DataFrame, on: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose id is listed and the rest."""
    return df.join(ids, on, "left_semi"), df.join(ids, on, "left_anti")


def best_combination(
    options: DataFrame, group: str, option: str, cost: str, gain: str, budget: float | None
) -> DataFrame:
    """Largest summed gain with one option per group whose summed cost fits the budget.

    ``options`` is a small aggregated table (groups x options). The product is never formed:
    groups are folded in one after the other and a partial choice is kept only when no other
    one is at most as dear and at least as good. The one row holds nulls when no choice fits, without
    any group and with a null budget.
    """
    per_group = options.groupBy(group).agg(
        F.array_sort(
            F.collect_list(
                F.struct(F.col(cost).alias("cost"), F.col(gain).alias("gain"), F.col(option).alias("option"))
            )
        ).alias("_o")
    )
    one = per_group.agg(F.array_sort(F.collect_list(F.struct(group, "_o"))).alias("_groups"))
    nothing = F.array(
        F.struct(
            F.lit(0.0).alias("cost"), F.lit(0.0).alias("gain"),
            F.array().cast("array<string>").alias("choice"),
        )
    )

    def extend(acc: Column, g: Column) -> Column:
        grown = F.flatten(
            F.transform(
                acc,
                lambda a: F.transform(
                    g["_o"],
                    lambda o: F.struct(
                        (a["cost"] + o["cost"]).alias("cost"),
                        (a["gain"] + o["gain"]).alias("gain"),
                        F.concat(a["choice"], F.array(o["option"].cast("string"))).alias("choice"),
                    ),
                ),
            )
        )
        return F.filter(grown, lambda a: a["cost"] <= F.lit(budget).cast("double"))

    def undominated(acc: Column) -> Column:
        def beaten(a, b):
            no_worse = (b["cost"] <= a["cost"]) & (b["gain"] >= a["gain"])
            return no_worse & ((b["cost"] < a["cost"]) | (b["gain"] > a["gain"]))

        return F.filter(acc, lambda a: ~F.exists(acc, lambda b: beaten(a, b)))

    front = F.aggregate("_groups", nothing, lambda acc, g: undominated(extend(acc, g)))
    best = F.get(
        F.array_sort(
            front,
            lambda a, b: F.when(a["gain"] > b["gain"], -1).when(a["gain"] < b["gain"], 1)
            .when(a["cost"] < b["cost"], -1).when(a["cost"] > b["cost"], 1).otherwise(0),
        ),
        F.lit(0),
    )
    return one.select(F.when(F.size("_groups") > 0, best).alias("_b")).select("_b.*")
