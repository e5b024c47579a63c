"""Projection, filtering and cleaning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import attach, scalar_row
from .quantiles import exact_quantiles, melt


def reorder(
    df: DataFrame, drop: Sequence[str] = (), rename: dict[str, str] | None = None,
    first: Sequence[str] = (),
) -> DataFrame:
    """Drop, rename and move columns to the front."""
    df = df.drop(*drop).withColumnsRenamed(rename or {})
    return df.select(*first, *[c for c in df.columns if c not in first])


def null_shares(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null share per column, long form, from one aggregate pass."""
    one = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns])
    return melt(one, [], columns).withColumnRenamed("value", "null_share")


def drop_sparse_columns(df: DataFrame, limit: float, exempt: Sequence[str] = ()) -> DataFrame:
    """Drop columns whose null share is above ``limit``; one row of shares reaches the driver."""
    columns = [c for c in df.columns if c not in exempt]
    shares = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns]).first()
    return df.drop(*[c for c in columns if (shares[c] or 0.0) > limit])


def iqr_bounds(df: DataFrame, key: Sequence[str], value: str, whisker: float = 1.5) -> DataFrame:
    q = exact_quantiles(df, key, value, {"q1": 0.25, "q3": 0.75})
    reach = (F.col("q3") - F.col("q1")) * whisker
    return q.select(*key, (F.col("q1") - reach).alias("lo"), (F.col("q3") + reach).alias("hi"))


def iqr_split(
    df: DataFrame, key: Sequence[str], value: str, removed: bool = False
) -> DataFrame:
    """Rows inside the whiskers of their key, or with ``removed`` the complement. A null value is no
    outlier; with an empty ``key`` the whiskers are those of the whole table."""
    inside = F.coalesce(F.col(value).between(F.col("lo"), F.col("hi")), F.lit(True))
    joined = attach(df, iqr_bounds(df, key, value), key)
    return joined.where(~inside if removed else inside).drop("lo", "hi")


def clip(value: str, low: float | None = None, high: float | None = None) -> Column:
    """Clip to bounds; null stays null (``greatest`` alone would skip it)."""
    c = F.col(value)
    bounded = c
    if low is not None:
        bounded = F.greatest(bounded, F.lit(low))
    if high is not None:
        bounded = F.least(bounded, F.lit(high))
    return F.when(c.isNotNull(), bounded)


def relative_values(df: DataFrame, population: str, per: float = 100_000.0) -> DataFrame:
    """``pct*`` columns to shares, ``num*`` columns to counts per ``per`` inhabitants."""
    out = {}
    for c in df.columns:
        if c.startswith("pct"):
            out[c] = F.col(c) / 100
        elif c.startswith("num"):
            out[c] = F.col(c) / (F.col(population) / per)
    return df.withColumns(out)


def column_kinds(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """binary (exactly two distinct values), constant or numeric, without a distinct shuffle:
    a column is binary when no value lies strictly between its minimum and maximum."""
    ends = scalar_row(
        df.agg(
            *[F.min(c).alias(f"lo_{c}") for c in columns],
            *[F.max(c).alias(f"hi_{c}") for c in columns],
        )
    )
    between = [
        F.count(F.when((F.col(c) > F.col(f"_e.lo_{c}")) & (F.col(c) < F.col(f"_e.hi_{c}")), 1))
        .alias(c)
        for c in columns
    ]
    spread = [F.max(F.col(f"_e.hi_{c}") > F.col(f"_e.lo_{c}")).alias(f"_s_{c}") for c in columns]
    one = df.select(*columns).withColumn("_e", ends).agg(*between, *spread)
    rows = F.array(*[
        F.struct(
            F.lit(c).alias("feature"),
            F.when(~F.col(f"_s_{c}"), "constant").when(F.col(c) == 0, "binary")
            .otherwise("numeric").alias("kind"),
        )
        for c in columns
    ])
    return one.select(F.explode(rows).alias("_r")).select("_r.*")


def safe_std(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Sample std per column with 1 in place of 0, and a flag for constant columns."""
    one = df.agg(*[F.stddev(c).alias(c) for c in columns])
    long = melt(one, [], columns).withColumnRenamed("value", "std")
    return long.select(
        "feature", "std",
        F.when(F.col("std") == 0, 1.0).otherwise(F.col("std")).alias("safe_std"),
        (F.col("std") == 0).alias("constant"),
    )


def drop_constant_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    same = df.agg(*[(F.min(c).eqNullSafe(F.max(c))).alias(c) for c in columns]).first()
    return df.drop(*[c for c in columns if same[c]])
