"""Run-to-failure and survival operators on positioned machine rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import hash31, idiv, unit_hash


def censor(df: DataFrame, key: str, pos: str, length: str, seed: int, lower: float = 0.0) -> DataFrame:
    """Cut each run at a hashed point of at least the ``lower`` share of its length; with
    ``lower=0`` a run may lose all its rows."""
    share = lower + (1.0 - lower) * unit_hash(key, seed)
    return df.where(F.col(pos) <= F.floor(F.col(length) * share))


def cutoff_mask(
    df: DataFrame, key: str, pos: str, length: str, low: int, high: int, seed: int
) -> DataFrame:
    """Drop the last low..high-1 rows of each run (hashed per run) and mask the target as -1."""
    cut = F.lit(low) + F.pmod(hash31(key, seed), F.lit(high - low))
    return df.where(F.col(pos) <= F.col(length) - cut).withColumn("rul", F.lit(-1).cast("bigint"))


def empirical_hazard(lengths: DataFrame, length: str, width: int) -> DataFrame:
    """Failures, runs at risk, hazard and survival per bin of cycles, from run lengths only."""
    bins = lengths.groupBy(idiv(F.col(length) - 1, width).alias("bin")).agg(
        F.count(F.lit(1)).alias("failures")
    )
    later = Window.orderBy("bin").rowsBetween(0, Window.unboundedFollowing)
    upto = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    risk = bins.withColumn("at_risk", F.sum("failures").over(later))
    hazard = F.col("failures") / F.col("at_risk")
    logs = F.sum(F.when(hazard < 1, F.log1p(-hazard)).otherwise(0.0)).over(upto)
    dead = F.max(F.when(hazard >= 1, 1).otherwise(0)).over(upto)
    return risk.withColumn("hazard", hazard).withColumn(
        "survival", F.when(dead == 1, 0.0).otherwise(F.exp(logs))
    )


def logistic(intercept: float, weights: dict[str, float], shift: dict[str, Column] | None = None) -> Column:
    """Logistic score of the columns; ``shift`` adds an offset to some of them."""
    z = F.lit(float(intercept))
    for c, w in weights.items():
        x = F.col(c) + shift[c] if shift and c in shift else F.col(c)
        z = z + F.lit(float(w)) * x
    return 1.0 / (1.0 + F.exp(-z))


def lookahead(
    df: DataFrame, horizon: int, cycle: str, intercept: float, weights: dict[str, float], prefix: str = "s"
) -> DataFrame:
    """Survival for each look-ahead h = 0..horizon as columns ``s_0 .. s_h``. The product runs
    inside the row, so rows are not repeated."""
    columns, alive = {}, F.lit(1.0)
    for h in range(horizon + 1):
        hazard = logistic(intercept, weights, {cycle: F.lit(float(h))})
        columns[f"{prefix}_{h}"] = 1.0 - hazard
    df = df.withColumns({f"_q_{h}": c for h, c in enumerate(columns.values())})
    out = {}
    for h in range(horizon + 1):
        alive = alive * F.col(f"_q_{h}")
        out[f"{prefix}_{h}"] = alive
    return df.withColumns(out).drop(*[f"_q_{h}" for h in range(horizon + 1)])


def counterfactual(
    reference: DataFrame, column: str, values: Sequence[float], score: Column, out: str
) -> DataFrame:
    """One reference row with ``column`` swept over ``values``, scored."""
    swept = reference.drop(column).withColumn(column, F.explode(F.array(*[F.lit(float(v)) for v in values])))
    return swept.withColumn(out, score)


def hazard_model(df: DataFrame, columns: Sequence[str], label: str, weight: str):
    """Weighted logistic fit of 'fails now' given the sensors and the cycle."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    x = VectorAssembler(inputCols=list(columns), outputCol="_x").transform(df)
    fit = LogisticRegression(featuresCol="_x", labelCol=label, weightCol=weight, maxIter=50).fit(x)
    return fit.intercept, dict(zip(columns, [float(c) for c in fit.coefficients]))
