"""Scaling, encoding, transforms, weights, decomposition. Statistics come from training rows
only and reach the rows as a scalar row, never as a join."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import scalar_row
from ..session import settle
from .ordered import framed, positions
from .quantiles import exact_quantiles, melt


def standardise(
    df: DataFrame, columns: Sequence[str], train: Column | None = None, population: bool = False
) -> DataFrame:
    """(x - mean) / std with the training rows' statistics; a zero std counts as 1."""
    std = F.stddev_pop if population else F.stddev
    rows = df.where(train) if train is not None else df
    stats = scalar_row(rows.agg(
        *[F.avg(c).alias(f"m_{c}") for c in columns], *[std(c).alias(f"s_{c}") for c in columns]
    ))
    df = df.withColumn("_st", stats)
    return df.withColumns({
        c: (F.col(c) - F.col(f"_st.m_{c}")) / F.coalesce(F.nullif(F.col(f"_st.s_{c}"), F.lit(0.0)), F.lit(1.0))
        for c in columns
    }).drop("_st")


def minmax(df: DataFrame, columns: Sequence[str], train: Column | None = None) -> DataFrame:
    rows = df.where(train) if train is not None else df
    stats = scalar_row(rows.agg(
        *[F.min(c).alias(f"lo_{c}") for c in columns], *[F.max(c).alias(f"hi_{c}") for c in columns]
    ))
    df = df.withColumn("_st", stats)
    return df.withColumns({
        c: F.try_divide((F.col(c) - F.col(f"_st.lo_{c}")).cast("double"), F.col(f"_st.hi_{c}") - F.col(f"_st.lo_{c}"))
        for c in columns
    }).drop("_st")


def robust(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(x - median) / IQR with exact quartiles."""
    q = exact_quantiles(
        melt(df, [], columns), ["feature"], "value", {"q1": 0.25, "q2": 0.5, "q3": 0.75}
    )
    # One row per feature: the map's size is fixed by the column list.
    maps = scalar_row(q.agg(F.map_from_entries(F.collect_list(F.struct("feature", F.struct("q1", "q2", "q3")))).alias("m")))
    df = df.withColumn("_q", maps["m"])
    return df.withColumns({
        c: (F.col(c) - F.col("_q")[c]["q2"])
        / F.coalesce(F.nullif(F.col("_q")[c]["q3"] - F.col("_q")[c]["q1"], F.lit(0.0)), F.lit(1.0))
        for c in columns
    }).drop("_q")


def by_max(df: DataFrame, columns: Sequence[str], train: Column | None = None) -> DataFrame:
    rows = df.where(train) if train is not None else df
    stats = scalar_row(rows.agg(*[F.max(c).alias(c) for c in columns]))
    df = df.withColumn("_st", stats)
    return df.withColumns(
        {c: F.try_divide(F.col(c).cast("double"), F.col(f"_st.{c}")) for c in columns}
    ).drop("_st")


def onehot(
    df: DataFrame, column: str, levels: Sequence[str], drop_first: bool = False, prefix: str | None = None
) -> DataFrame:
    """0/1 column per listed level, in sorted order."""
    use = sorted(levels)[1 if drop_first else 0 :]
    name = prefix or column
    return df.withColumns(
        {f"{name}_{v}": F.when(F.col(column) == v, 1).otherwise(0).cast("bigint") for v in use}
    )


def label_codes(df: DataFrame, column: str, out: str) -> DataFrame:
    """Codes 0.. in sorted level order; the level table is the distinct values only."""
    levels = df.select(column).where(F.col(column).isNotNull()).distinct().withColumn("_all", F.lit(1))
    # A prefix is monotone in the text, so even very many levels are ordered cell by cell.
    ranked = positions(levels, ["_all"], [column], [F.substring(column, 1, 4)], "_pos")
    codes = ranked.select(column, (F.col("_pos") - 1).alias(out))
    return df.join(settle(codes, "codes"), column, "left")


def cyclic_month(df: DataFrame, month: Column, year: Column) -> DataFrame:
    """sin / cos of the month and the year scaled by population std."""
    angle = month * (2 * math.pi / 12)
    d = df.withColumns({"month_sin": F.sin(angle), "month_cos": F.cos(angle), "_y": year.cast("double")})
    st = scalar_row(d.agg(F.avg("_y").alias("m"), F.stddev_pop("_y").alias("s")))
    d = d.withColumn("_st", st)
    std = F.coalesce(F.nullif(F.col("_st.s"), F.lit(0.0)), F.lit(1.0))
    return d.withColumn("year_scaled", (F.col("_y") - F.col("_st.m")) / std).drop("_y", "_st")


def boxcox(x: Column, lam: float) -> Column:
    return F.log(x) if lam == 0 else (F.pow(x, F.lit(lam)) - 1) / lam


def boxcox_fit(df: DataFrame, column: str, lambdas: Sequence[float]) -> DataFrame:
    """Profile log-likelihood of each lambda of the grid from one aggregate pass."""
    x = F.col(column)
    one = df.where(x > 0).agg(
        F.count(x).alias("n"), F.sum(F.log(x)).alias("logs"),
        *[F.var_pop(boxcox(x, lam)).alias(f"v{i}") for i, lam in enumerate(lambdas)],
    )
    rows = F.array(*[
        F.struct(
            F.lit(float(lam)).alias("lam"),
            (-F.col("n") / 2 * F.log(f"v{i}") + (lam - 1) * F.col("logs")).alias("loglik"),
        )
        for i, lam in enumerate(lambdas)
    ])
    return one.select(F.explode(rows).alias("_r")).select("_r.*")


def boxcox_transform(df: DataFrame, column: str, lambdas: Sequence[float], out: str) -> DataFrame:
    """Box-Cox at the best lambda of the grid, then standardised (population std)."""
    fit = boxcox_fit(df, column, lambdas)
    best = fit.agg(F.max_by("lam", F.struct("loglik", "lam")).alias("lam")).first()["lam"]
    d = df.withColumn(out, boxcox(F.col(column), best))
    return standardise(d, [out], population=True)


def decompose(
    df: DataFrame, key: Sequence[str], pos: str, value: str, period: int, phase: Column,
    multiplicative: bool = False,
) -> DataFrame:
    """Trend (centred moving average of one period, half weights at both ends when it is
    even), seasonal component per phase (normalised to mean 0 or 1), residual."""
    key = list(key)
    half = period // 2

    def cols(w):
        f = w.rowsBetween(-half, half)
        full = F.count(value).over(f) == 2 * half + 1
        total = F.sum(value).over(f)
        if period % 2 == 0:
            total = total - (F.lag(value, half).over(w) + F.lead(value, half).over(w)) / 2
        return {"trend": F.when(full, total / period)}

    d = framed(df, key, pos, half, half, cols).withColumn("phase", phase)
    off = F.try_divide(F.col(value), F.col("trend")) if multiplicative else F.col(value) - F.col("trend")
    season = d.groupBy(*key, "phase").agg(F.avg(off).alias("_raw"))
    w = Window.partitionBy(*key)
    centre = F.avg("_raw").over(w)
    season = season.select(
        *key, "phase",
        (F.col("_raw") / centre if multiplicative else F.col("_raw") - centre).alias("seasonal"),
    )
    j = d.join(season, [*key, "phase"])
    if multiplicative:
        resid = F.try_divide(F.col(value), F.col("trend") * F.col("seasonal"))
    else:
        resid = F.col(value) - F.col("trend") - F.col("seasonal")
    return j.withColumn("residual", resid)
