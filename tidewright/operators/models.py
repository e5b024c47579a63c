"""MLlib models: distributed fits behind small functions. Each returns predictions or a
metric table; only coefficients and metrics reach the driver."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import (
    GBTRegressor,
    GeneralizedLinearRegression,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import attach, hash31
from .ordered import framed, positions


def vectorise(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol="_x", handleInvalid="skip").transform(df)


def scored(model, rows: DataFrame, columns: Sequence[str], outputs: Sequence[str]) -> DataFrame:
    """``rows`` with the model's ``outputs`` (``score``: a classifier's probability of class 1); rows that
    lack a feature stay, with null outputs."""
    kept = VectorAssembler(inputCols=list(columns), outputCol="_x", handleInvalid="keep").transform(rows)
    whole = F.lit(True)
    for c in columns:
        whole = whole & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    done = model.transform(kept.withColumn("_whole", whole))
    if "score" in outputs:
        done = done.withColumn("score", vector_to_array("probability")[1])
    return done.withColumns({c: F.when(F.col("_whole"), F.col(c)) for c in outputs}).drop("_x", "_whole")


def linear(
    train: DataFrame, rows: DataFrame, columns: Sequence[str], target: str, reg: float = 0.0, out: str = "pred"
) -> DataFrame:
    """Least squares (``reg`` = 0) or ridge predictions for ``rows``."""
    fit = LinearRegression(
        featuresCol="_x", labelCol=target, predictionCol=out, regParam=reg, elasticNetParam=0.0, solver="normal"
    ).fit(vectorise(train, columns))
    return scored(fit, rows, columns, [out])


def simple_ols(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2")
    )


def balanced_weights(df: DataFrame, label: str, out: str = "_w") -> DataFrame:
    """n / (classes * class count) per row."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    all_rows = Window.partitionBy()
    w = F.sum("_n").over(all_rows) / (F.count(F.lit(1)).over(all_rows) * F.col("_n"))
    return attach(df, counts.select(label, w.alias(out)), [label])


def logistic_balanced(
    train: DataFrame, rows: DataFrame, columns: Sequence[str], label: str, scaled: bool = True
) -> DataFrame:
    stages = [StandardScaler(inputCol="_x", outputCol="_z", withMean=True)] if scaled else []
    model = LogisticRegression(
        featuresCol="_z" if scaled else "_x", labelCol=label, weightCol="_w", maxIter=50
    )
    fit = Pipeline(stages=[*stages, model]).fit(vectorise(balanced_weights(train, label), columns))
    return scored(fit, rows, columns, ["score", "prediction"]).drop("_z")


def forest(
    train: DataFrame, rows: DataFrame, columns: Sequence[str], target: str, trees: int, depth: int,
    seed: int, classify: bool = False, out: str = "pred",
) -> DataFrame:
    if classify:
        model = RandomForestClassifier(
            featuresCol="_x", labelCol=target, weightCol="_w", numTrees=trees, maxDepth=depth, seed=seed
        )
        fit = model.fit(vectorise(balanced_weights(train, target), columns))
        return scored(fit, rows, columns, ["score", "prediction"])
    model = RandomForestRegressor(
        featuresCol="_x", labelCol=target, predictionCol=out, numTrees=trees, maxDepth=depth, seed=seed
    )
    return scored(model.fit(vectorise(train, columns)), rows, columns, [out])


def boosted(
    train: DataFrame, rows: DataFrame, columns: Sequence[str], target: str, rounds: int, depth: int, seed: int, out: str = "pred"
) -> DataFrame:
    model = GBTRegressor(
        featuresCol="_x", labelCol=target, predictionCol=out, maxIter=rounds, maxDepth=depth, seed=seed
    )
    return scored(model.fit(vectorise(train, columns)), rows, columns, [out])


def poisson_arrivals(train: DataFrame, rows: DataFrame, columns: Sequence[str], count: str) -> DataFrame:
    """Poisson rate by a log-linear model; the mean is the rate, the std its square root."""
    glm = GeneralizedLinearRegression(
        family="poisson", link="log", featuresCol="_x", labelCol=count, predictionCol="mean",
        maxIter=50, regParam=1e-6,
    )
    fit = glm.fit(vectorise(train, columns))
    return scored(fit, rows, columns, ["mean"]).withColumn("std", F.sqrt("mean"))


def gauss_heteroscedastic(train: DataFrame, rows: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Mean by least squares, then log variance by least squares on the log squared residual.
    The constant is the mean of ln(chi-square with one degree of freedom)."""
    x = vectorise(train, columns)
    mean = LinearRegression(featuresCol="_x", labelCol=target, predictionCol="mean", solver="normal").fit(x)
    residual = F.col(target) - F.col("mean")
    logs = mean.transform(x).withColumn("_lv", F.log(residual * residual + 1e-12) + 1.2703628454614782)
    spread = LinearRegression(featuresCol="_x", labelCol="_lv", predictionCol="_plv", solver="normal").fit(logs)
    both = scored(spread, scored(mean, rows, columns, ["mean"]), columns, ["_plv"])
    return both.withColumn("std", F.exp(F.col("_plv") / 2)).drop("_plv")


def grid_search(
    df: DataFrame, columns: Sequence[str], target: str, regs: Sequence[float], nets: Sequence[float], folds: int, seed: int
) -> DataFrame:
    """Cross-validated mean and std of the absolute error per parameter pair, best first.

    MLlib solves these fits from means and products alone, so one pass sums them per fold, and every (fold, pair) is
    fitted on a few rows that have the same moments as its training rows. One more pass adds up all errors.
    """
    names = [*columns, target]
    fold = F.pmod(hash31(F.xxhash64(*names), seed), F.lit(folds)).cast("int")
    known = F.lit(True)
    for c in columns:
        known = known & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    rows = df.where(known).select(fold.alias("_fold"), *[F.col(c).cast("double").alias(c) for c in names])
    y, p = F.col(target), len(names)
    seen = rows.agg(F.count(F.when(y.isNull() | F.isnan(y), 1)), *[F.avg(c) for c in names]).first()
    if seen[0]:
        raise ValueError(f"{target} has null or NaN values")
    centre = np.array([m or 0.0 for m in seen[1:]])
    x = [F.col(c) - F.lit(float(m)) for c, m in zip(names, centre)]
    pairs = [(i, j) for i in range(p) for j in range(i, p)]
    sums = rows.groupBy("_fold").agg(F.count(F.lit(1)), *map(F.sum, x), *[F.sum(x[i] * x[j]) for i, j in pairs]).collect()
    moments = {r[0]: np.array(r[1:], dtype=float) for r in sums}

    def like_training(f: int) -> DataFrame:
        total = sum((m for k, m in moments.items() if k != f), np.zeros(1 + p + len(pairs)))
        if not total[0]:
            raise ValueError("a fold has no training rows")
        mean, square = total[1 : p + 1] / total[0], np.zeros((p, p))
        for (i, j), v in zip(pairs, total[p + 1 :] / total[0]):
            square[i, j] = square[j, i] = v
        cov = square - np.outer(mean, mean)
        std = np.sqrt(np.maximum(np.diag(cov), 0.0))
        std[std <= 1e-13 * (np.abs(centre) + np.abs(mean))] = 0.0
        safe = np.where(std > 0, std, 1.0)
        value, vector = np.linalg.eigh(np.where(np.outer(std, std) > 0, cov / np.outer(safe, safe), 0.0))
        axes = (vector * np.sqrt(np.maximum(value, 0.0) * p)).T * std
        made = np.concatenate([axes, -axes]) + centre + mean
        return df.sparkSession.createDataFrame([(Vectors.dense(r[:-1]), float(r[-1])) for r in made], ["_x", target])

    model = LinearRegression(featuresCol="_x", labelCol=target, maxIter=30)
    grid = ParamGridBuilder().addGrid(model.regParam, list(regs)).addGrid(model.elasticNetParam, list(nets)).build()
    errors = [F.lit(None).cast("double")] * len(grid)
    for f in range(folds):
        training = like_training(f).coalesce(1).cache()
        for g, params in enumerate(grid):
            fit = model.fit(training, params)
            pred = sum((F.lit(float(w)) * F.col(c) for c, w in zip(columns, fit.coefficients)), F.lit(float(fit.intercept)))
            errors[g] = F.when(F.col("_fold") == f, F.abs(y - pred)).otherwise(errors[g])
        training.unpersist()
    found = rows.groupBy("_fold").agg(*[F.avg(e) for e in errors]).collect()
    mae = np.full((folds, len(grid)), np.nan)
    for r in found:
        mae[r[0]] = r[1:]
    table = df.sparkSession.createDataFrame(
        [(float(q[model.regParam]), float(q[model.elasticNetParam]), float(m), float(s)) for q, m, s in zip(grid, mae.mean(axis=0), mae.std(axis=0))],
        "reg double, net double, mae double, mae_std double",
    )
    return table.orderBy("mae", "reg", "net")


def residual_hybrid(
    train: DataFrame, rows: DataFrame, columns: Sequence[str], target: str, reg: float, trees: int, depth: int, seed: int
) -> DataFrame:
    """Ridge, a forest on its residuals, and the sum of both."""
    line = LinearRegression(
        featuresCol="_x", labelCol=target, predictionCol="_lin", regParam=reg, elasticNetParam=0.0, solver="normal"
    ).fit(vectorise(train, columns))
    both = scored(line, train, columns, ["_lin"]).withColumn("_res", F.col(target) - F.col("_lin"))
    base = scored(line, rows, columns, ["_lin"])
    added = forest(both.where("_res is not null").drop("_lin"), base, columns, "_res", trees, depth, seed, out="_add")
    return added.withColumn("pred", F.col("_lin") + F.col("_add")).drop("_lin", "_add")


def stack(
    train: DataFrame, rows: DataFrame, columns: Sequence[str], target: str, ident: str, folds: int, seed: int
) -> DataFrame:
    """Two base models; a ridge on their out-of-fold predictions, next to the mean, the median
    and the average weighted by 1 / residual std."""
    def bases(part: DataFrame, to: DataFrame) -> DataFrame:
        return forest(part, linear(part, to, columns, target, 0.1, "_b0"), columns, target, 8, 4, seed, out="_b1")

    folded = train.withColumn("_fold", F.pmod(hash31(ident, seed), F.lit(folds)))
    out_of_fold = None
    for f in range(folds):
        one = bases(folded.where(F.col("_fold") != f), folded.where(F.col("_fold") == f))
        out_of_fold = one if out_of_fold is None else out_of_fold.unionByName(one)
    names = ["_b0", "_b1"]
    sd = out_of_fold.agg(*[F.stddev(F.col(target) - F.col(b)).alias(b) for b in names]).first()
    w = [1.0 / max(sd[b] or 0.0, 1e-9) for b in names]
    top = LinearRegression(featuresCol="_x", labelCol=target, predictionCol="stacked", regParam=0.01, solver="normal")
    fit = top.fit(vectorise(out_of_fold, names))
    done = scored(fit, bases(train, rows), names, ["stacked"])
    b0, b1 = F.col("_b0"), F.col("_b1")
    # The median of two base models is their mean.
    return done.withColumns({
        "mean": (b0 + b1) / 2, "weighted": (b0 * w[0] + b1 * w[1]) / (w[0] + w[1]),
    }).drop("_b0", "_b1")


def ar_forecast(
    df: DataFrame, key: str, pos: str, value: str, max_order: int, horizon: int, season: int | None = 12
) -> DataFrame:
    """Per key: difference once, least-squares AR with the order of lowest AIC and sin / cos of
    the season (None: neither) as exogenous columns, recursive forecast of ``horizon`` steps.

    Rows only meet in bounded frames and in sums: the products of a row's difference, lags and season columns are added
    up per key and number of lags at hand, so the equations of every order follow from ``max_order + 1`` rows
    per key, however long its series. Rows with a null key or value are left out; a key with fewer than
    eight differences keeps its last value (order 0).
    """
    p = max_order
    ranked = positions(df.where(F.col(value).isNotNull()).select(key, pos, value), [key], [pos], out="_i")

    def lags(w: Window) -> dict:
        v = F.col(value).cast("double")
        return {f"_d{k}": F.lag(v, k).over(w) - F.lag(v, k + 1).over(w) for k in range(p + 1)}

    rows = framed(ranked, [key], "_i", p + 1, 0, lags)
    turn = F.col(pos) * (2 * np.pi / season) if season else None
    waves = [F.sin(turn), F.cos(turn)] if season else []
    names = [f"_t{j}" for j in range(p + 2 + len(waves))]  # 1, lags, waves, the difference itself
    terms = [F.lit(1.0), *[F.coalesce(f"_d{k}", F.lit(0.0)) for k in range(1, p + 1)], *waves, F.col("_d0")]
    n = len(terms)
    upper = [(i, j) for i in range(n) for j in range(i, n)]
    sums = (
        rows.where(F.col("_d0").isNotNull())
        .select(key, F.least(F.col("_i") - 2, F.lit(p)).alias("_lags"), *[t.alias(c) for t, c in zip(terms, names)])
        .groupBy(key, "_lags").agg(*[F.sum(F.col(names[i]) * F.col(names[j])).alias(f"_g{i}_{j}") for i, j in upper])
    )
    sums = sums.select(key, F.struct("_lags", F.array(*[f"_g{i}_{j}" for i, j in upper]).alias("g")).alias("_s"))
    recent = F.struct(F.col(pos).cast("bigint").alias("at"), F.col(value).cast("double").alias("v"), F.array(*[f"_d{k}" for k in range(p + 1)]).alias("d"))
    ends = rows.groupBy(key).agg(F.max_by(recent, "_i").alias("_end"))
    per_key = ends.join(sums.groupBy(key).agg(F.collect_list("_s").alias("_sums")), key, "left")

    def solve(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            found = [r for k, end, own in zip(part[key], part["_end"], part["_sums"]) for r in forecast(k, end, own)]
            yield pd.DataFrame(found, columns=[key, pos, "step", "ar_order", "forecast"])

    def forecast(k, end, own) -> Iterator[tuple]:
        grams = np.zeros((p + 1, n, n))
        for s in own if own is not None else []:
            for (i, j), g in zip(upper, s["g"]):
                grams[s["_lags"], i, j] = grams[s["_lags"], j, i] = g
        order, b = _best_order(grams)
        at, level = int(end["at"]), float(end["v"])
        past = [float(x) for x in end["d"] if x is not None and x == x]
        for h in range(1, horizon + 1):
            step = 0.0
            if order:
                turn = 2 * np.pi * (at + h) / season if season else 0.0
                step = float(b @ np.r_[1.0, past[:order], [np.sin(turn), np.cos(turn)] if season else []])
            past.insert(0, step)
            level += step
            yield k, at + h, h, order, level

    kind = df.schema[key].dataType.simpleString()
    return per_key.mapInPandas(solve, f"{key} {kind}, {pos} bigint, step bigint, ar_order bigint, forecast double")


def _best_order(grams: np.ndarray) -> tuple[int, np.ndarray]:
    """Order of lowest AIC and its coefficients from the products of the rows with 0, 1, ... lags; the last
    row of products is the target's. Order 0 where there is too little to fit."""
    most, n = len(grams) - 1, grams.shape[1]
    whole, best = grams.sum(axis=0)[0, 0], (np.inf, 0, np.zeros(0))
    for order in range(1, most + 1):
        if whole < 2 * order + 6:
            break
        g = grams[order:].sum(axis=0)
        x = [0, *range(1, order + 1), *range(most + 1, n - 1)]
        scale = np.sqrt(np.maximum(np.diag(g)[x], 1e-300))
        own = g[np.ix_(x, x)] / np.outer(scale, scale)
        b = np.linalg.lstsq(own, g[x, -1] / scale, rcond=1e-11)[0] / scale
        r = np.r_[-b, 1.0]
        sse = float(r @ g[np.ix_([*x, n - 1], [*x, n - 1])] @ r)
        aic = g[0, 0] * np.log(max(sse, 1e-12) / g[0, 0]) + 2 * len(x)
        if aic < best[0]:
            best = (aic, order, b)
    return best[1], best[2]


def recursive_forecast(
    df: DataFrame, key: str, pos: str, value: str, lags: Sequence[int], horizon: int
) -> DataFrame:
    """Pooled least squares on lag columns over all keys (one distributed fit), then per-key
    forecasts that feed each prediction back as a lag."""
    from .windows import lag_by_position

    names = [f"{value}_lag_{k}" for k in lags]
    lagged = lag_by_position(df.select(key, pos, value), [key], pos, value, lags).na.drop()
    fit = LinearRegression(featuresCol="_x", labelCol=value, regParam=1e-6, solver="normal").fit(vectorise(lagged, names))
    weights, intercept = fit.coefficients.toArray(), float(fit.intercept)
    deep = max(lags)

    def roll(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(pos)
        past, at = pdf[value].tolist(), int(pdf[pos].iloc[-1])
        rows = []
        for h in range(1, horizon + 1):
            if len(past) < deep:
                break
            step = intercept + float(sum(w * past[-k] for w, k in zip(weights, lags)))
            past.append(step)
            rows.append((pdf[key].iloc[0], at + h, h, step))
        return pd.DataFrame(rows, columns=[key, pos, "step", "forecast"])

    kind = df.schema[key].dataType.simpleString()
    sizes = df.groupBy(key).agg(F.max(pos).alias("_last"))
    tail = df.select(key, pos, value).join(sizes, key).where(F.col(pos) > F.col("_last") - deep).drop("_last")
    return tail.groupBy(key).applyInPandas(roll, f"{key} {kind}, {pos} bigint, step bigint, forecast double")
