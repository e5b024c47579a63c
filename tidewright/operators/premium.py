"""Membership in a derived list of dear zones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import attach, scalar_row
from ..session import settle
from .quantiles import exact_quantiles


def premium_flag(df: DataFrame, zone: str, price: str, share: float, out: str = "premium") -> DataFrame:
    """1 for rows of zones whose mean price reaches the ``share`` quantile of zone means."""
    means = settle(df.groupBy(zone).agg(F.avg(price).alias("_mean")), "zones")
    cut = scalar_row(exact_quantiles(means, [], "_mean", {"q": share}))["q"]
    flags = means.select(zone, F.when(F.col("_mean") >= cut, 1).otherwise(0).cast("bigint").alias(out))
    return attach(df, flags, [zone])
