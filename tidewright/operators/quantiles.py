"""Exact quantiles per key with bounded task memory.

The built-in exact ``percentile`` keeps every distinct value of a group in one buffer.
Here the ranks are located in an equal-width histogram first; only the values of the
few buckets that hold a wanted rank are then grouped and ordered. A wanted bucket that is
still heavy (long tails squeeze most rows into one bucket) is divided again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import ALL, attach, keyed
from ..session import settle

BUCKETS = 1 << 14
HEAVY_ROWS = 1 << 22


def exact_quantiles(
    df: DataFrame,
    key: Sequence[str],
    value: str,
    probs: dict[str, float],
    buckets: int = BUCKETS,
    heavy: int = HEAVY_ROWS,
) -> DataFrame:
    """Linear-interpolation quantiles, one row per key: ``{output column: probability}``."""
    df, key = keyed(df, key)
    place = {o: (F.col("_n") - 1) * F.lit(float(p)) for o, p in probs.items()}
    sides = [f(h).cast("bigint") for h in place.values() for f in (F.floor, F.ceil)]
    rows = df.where(F.col(value).isNotNull()).select(*key, F.col(value).cast("double").alias("_x"))
    at, wanted = list(key), None
    while True:
        bucket = f"_b{len(at) - len(key)}"
        rows, wanted = _locate(rows, at, bucket, buckets, wanted, F.array_distinct(F.array(*sides)))
        at.append(bucket)
        most = wanted.where(F.col("_lo") < F.col("_hi")).agg(F.max("_c")).first()[0] or 0
        rows = rows.join(wanted.select(*at), at, "left_semi")
        if most <= heavy:
            break
        rows = settle(rows, "quantile-rows")

    counts = rows.groupBy(*at, "_x").agg(F.count(F.lit(1)).alias("_cx"))
    order = Window.partitionBy(*at).orderBy("_x").rowsBetween(Window.unboundedPreceding, 0)
    end = F.col("_before") + F.sum("_cx").over(order)
    hit = (
        counts.join(wanted.select(*at, "_before", "_n", "_r"), at)
        .withColumn("_end", end)
        .withColumn("_rank", F.explode(_inside("_r", F.col("_end") - F.col("_cx"), F.col("_end"))))
    )
    picked = hit.groupBy(*key, "_n").agg(*[
        F.max(F.when(F.col("_rank") == f(h).cast("bigint"), F.col("_x"))).alias(f"_{side}_{o}")
        for o, h in place.items()
        for side, f in (("lo", F.floor), ("hi", F.ceil))
    ])
    value_at = [
        (F.col(f"_lo_{o}") + (h - F.floor(h)) * (F.col(f"_hi_{o}") - F.col(f"_lo_{o}"))).alias(o)
        for o, h in place.items()
    ]
    return picked.select(*key, *value_at).drop(ALL)


def _inside(ranks: str, first: Column, end: Column) -> Column:
    return F.filter(ranks, lambda r: (r >= first) & (r < end))


def _locate(
    rows: DataFrame, at: list[str], bucket: str, buckets: int, wanted: DataFrame | None, ranks: Column
) -> tuple[DataFrame, DataFrame]:
    """Divide each group into buckets; return the bucketed rows and the buckets with a wanted
    rank: size, value range, rows before them and their ranks."""
    span = rows.groupBy(*at).agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
    width = F.nullif(F.col("_hi") - F.col("_lo"), F.lit(0.0))
    number = F.coalesce(F.floor((F.col("_x") - F.col("_lo")) / width * buckets), F.lit(0))
    rows = attach(rows, span, at).select(*at, "_x", number.cast("bigint").alias(bucket))
    hist = rows.groupBy(*at, bucket).agg(
        F.count(F.lit(1)).alias("_c"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi")
    )
    group = Window.partitionBy(*at)
    upto = group.orderBy(bucket).rowsBetween(Window.unboundedPreceding, 0)
    before = F.sum("_c").over(upto) - F.col("_c")
    if wanted is None:
        hist = hist.withColumn("_before", before).withColumn("_n", F.sum("_c").over(group))
        hist = hist.withColumn("_r", ranks)
    else:
        outer = wanted.select(*at, F.col("_before").alias("_start"), "_n", "_r")
        hist = hist.withColumn("_in", before).join(outer, at)
        hist = hist.withColumn("_before", F.col("_start") + F.col("_in")).drop("_start", "_in")
    hist = hist.withColumn("_r", _inside("_r", F.col("_before"), F.col("_before") + F.col("_c")))
    # A few rows per key: written once, so the histogram is not computed again.
    return rows, settle(hist.where(F.size("_r") > 0), "quantile-buckets")


def melt(df: DataFrame, keep: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Wide doubles to long rows (feature, value)."""
    return df.select(
        *keep,
        F.explode(
            F.array(
                *[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"))
                  for c in columns]
            )
        ).alias("_fv"),
    ).select(*keep, "_fv.feature", "_fv.value")
