"""Group and whole-table aggregates."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import idiv, log_factorial, sample_skewness, scalar_row
from .gram import cross_products
from .quantiles import exact_quantiles, melt


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles and max per column, long form, exact quartiles."""
    long = melt(df, [], columns)
    base = long.groupBy("feature").agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"), F.stddev("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    )
    quarts = exact_quantiles(long, ["feature"], "value", {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    return base.join(quarts, "feature", "left")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = scalar_row(df.agg(F.count(F.lit(1)).alias("n")))["n"]
    return counts.withColumn("share", F.col("n") / total)


def group_mean_top(df: DataFrame, by: str, value: str, k: int) -> DataFrame:
    means = df.groupBy(by).agg(F.avg(value).alias("mean"), F.count(F.lit(1)).alias("n"))
    return means.orderBy(F.col("mean").desc(), by).limit(k)


def bin_features(
    df: DataFrame, segment: str, pos: str, size: int, sensors: Sequence[str],
    controlled: Sequence[str],
) -> DataFrame:
    """Mean, std and skewness of sensors and the first controlled value per (segment, bin)."""
    aggs = []
    for s in sensors:
        aggs += [
            F.avg(s).alias(f"{s}_mean"), F.stddev(s).alias(f"{s}_std"),
            sample_skewness(s).alias(f"{s}_skew"),
        ]
    aggs += [F.min_by(c, pos).alias(f"{c}_first") for c in controlled]
    return df.groupBy(segment, idiv(F.col(pos) - 1, size).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), *aggs
    )


def pivot_counts(df: DataFrame, row: str, column: str, levels: Sequence[str]) -> DataFrame:
    """Counts as a wide table with the share of each level in its row; ``total`` counts all rows, also
    those of other levels."""
    wide = df.groupBy(row).agg(
        *[F.count(F.when(F.col(column) == v, 1)).alias(f"n_{i}") for i, v in enumerate(levels)],
        F.count(F.lit(1)).alias("total"),
    )
    return wide.withColumns(
        {f"share_{i}": F.try_divide(F.col(f"n_{i}"), F.col("total")) for i in range(len(levels))}
    )


def equal_width_bin(x: str, lo: str, hi: str, bins: int) -> Column:
    """Bin 0..bins-1 of equal width; the last bin is closed on the right."""
    width = F.nullif(F.col(hi) - F.col(lo), F.lit(0.0))
    at = F.floor((F.col(x) - F.col(lo)) / width * bins).cast("bigint")
    return F.when(F.col(x).isNotNull(), F.least(F.coalesce(at, F.lit(0)), F.lit(bins - 1)))


def with_range(df: DataFrame, column: str) -> DataFrame:
    """Attach the global minimum and maximum (``_lo``, ``_hi``)."""
    span = scalar_row(
        df.agg(F.min(column).cast("double").alias("lo"), F.max(column).cast("double").alias("hi"))
    )
    df = df.withColumn("_span", span)
    return df.withColumns({"_lo": F.col("_span.lo"), "_hi": F.col("_span.hi")}).drop("_span")


def target_rate_by_category(df: DataFrame, column: str, target: str) -> DataFrame:
    return df.groupBy(F.col(column).cast("string").alias("level")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(target).alias("rate")
    )


def target_rate_by_bin(df: DataFrame, column: str, target: str, bins: int) -> DataFrame:
    binned = with_range(df, column).withColumn("level", equal_width_bin(column, "_lo", "_hi", bins))
    return target_rate_by_category(binned, "level", target)


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width histogram: bin, left edge, count, density."""
    b = with_range(df.where(F.col(column).isNotNull()), column)
    counts = b.groupBy("_lo", "_hi", equal_width_bin(column, "_lo", "_hi", bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("n")
    )
    width = (F.col("_hi") - F.col("_lo")) / bins
    total = F.sum("n").over(Window.partitionBy())
    return counts.select(
        "bin", (F.col("_lo") + F.col("bin") * width).alias("left"), "n",
        (F.col("n") / total / F.nullif(width, F.lit(0.0))).alias("density"),
    )


def histogram2d(df: DataFrame, x: str, y: str, xbins: int, ybins: int) -> DataFrame:
    bx = with_range(df, x).withColumn("xbin", equal_width_bin(x, "_lo", "_hi", xbins))
    by = with_range(bx.drop("_lo", "_hi"), y)
    by = by.withColumn("ybin", equal_width_bin(y, "_lo", "_hi", ybins))
    return by.groupBy("xbin", "ybin").agg(F.count(F.lit(1)).alias("n"))


def correlation_long(df: DataFrame, columns: Sequence[str], complete: bool = False) -> DataFrame:
    """All pairwise Pearson coefficients (a < b), null where a column doesn't vary. By default each pair uses
    its own complete rows, with ``complete`` only the rows without any null."""
    r = cross_products(df, columns, complete).correlation()
    rows = [
        (a, b, None if np.isnan(r[i, i + 1 + j]) else float(r[i, i + 1 + j]))
        for i, a in enumerate(columns) for j, b in enumerate(columns[i + 1 :])
    ]
    return df.sparkSession.createDataFrame(rows, "a string, b string, r double")


def profile_by(df: DataFrame, slots: dict[str, Column], value: str) -> DataFrame:
    """Mean and std of ``value`` per slot of several calendar units, one exploded pass."""
    tagged = df.select(
        value,
        F.explode(
            F.array(*[
                F.struct(F.lit(k).alias("unit"), c.cast("bigint").alias("slot"))
                for k, c in slots.items()
            ])
        ).alias("_u"),
    )
    return tagged.groupBy("_u.unit", "_u.slot").agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev(value).alias("std")
    )


def poisson_fit(df: DataFrame, slot: str, count: str) -> DataFrame:
    """Observed share of each count per slot next to the Poisson share of the slot's mean."""
    counts = df.groupBy(slot, F.col(count).alias("k")).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(slot)
    total = F.sum("_n").over(w)
    mean = F.sum(F.col("_n") * F.col("k")).over(w) / total
    log_p = F.col("k") * F.log("mu") - F.col("mu") - log_factorial("k")
    return counts.select(
        slot, "k", mean.alias("mu"), (F.col("_n") / total).alias("observed")
    ).withColumn("poisson", F.when(F.col("mu") > 0, F.exp(log_p)).otherwise((F.col("k") == 0).cast("double")))
