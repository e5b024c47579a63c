"""Anomaly models: mixtures, PCA, isolation trees, reconstruction error."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import SparkContext
from pyspark.ml.clustering import GaussianMixture, GaussianMixtureModel
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.common import _py2java
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Matrices, Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import hash31, scalar_row
from ..session import settle
from .quantiles import exact_quantiles, melt
from .scale import standardise


EPSILON = float(np.finfo(float).eps)  # MLlib's floor of a density


def assemble(df: DataFrame, columns: Sequence[str], out: str = "x") -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=out, handleInvalid="skip").transform(df)


def fit_mixture(df: DataFrame, features: str, k: int, seed: int, iterations: int = 30) -> GaussianMixtureModel:
    rows = settle(_coordinates(df, features), "mixture")
    return _maximised(rows, [(_begun(df, features, k, seed), None)], iterations)[0]


def _coordinates(df: DataFrame, features: str, *others: str) -> DataFrame:
    """The coordinates of a vector column as columns ``x0`` ... , next to ``others``."""
    first = df.select(features).first()
    x = df.select(vector_to_array(features).alias("_x"), *others)
    return x.select(*[F.col("_x")[i].alias(f"x{i}") for i in range(len(first[0]) if first else 0)], *others)


def _begun(df: DataFrame, features: str, k: int, seed: int) -> GaussianMixtureModel:
    """MLlib's seeded random start."""
    return GaussianMixture(featuresCol=features, k=k, seed=seed, maxIter=0).fit(df)


def _rebuilt(like: GaussianMixtureModel, weights: np.ndarray, means: np.ndarray, covs: np.ndarray) -> GaussianMixtureModel:
    sc = SparkContext._active_spark_context
    ml = sc._jvm.org.apache.spark.ml
    gaussian = ml.stat.distribution.MultivariateGaussian
    shares, parts = sc._gateway.new_array(sc._jvm.double, len(weights)), sc._gateway.new_array(gaussian, len(weights))
    for i, (w, m, c) in enumerate(zip(weights, means, covs)):
        shares[i] = float(w)
        parts[i] = gaussian(_py2java(sc, Vectors.dense(m)), _py2java(sc, Matrices.dense(len(m), len(m), c.ravel(order="F"))))
    model = GaussianMixtureModel(ml.clustering.GaussianMixtureModel(like.uid, shares, parts))
    return model.setFeaturesCol(like.getFeaturesCol())


def _exponent(weight: float, mean: np.ndarray, cov: np.ndarray, centre: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Logarithm of weight * density as coefficients of 1, z and z z' (upper half), z = (x - centre) / scale. As
    MLlib does, eigenvalues that vanish against the largest one are left out."""
    d, u = np.linalg.eigh(cov)
    kept = d > EPSILON * d.max() * len(d)
    a = (u[:, kept] / d[kept]) @ u[:, kept].T * np.outer(scale, scale)
    m = (mean - centre) / scale
    square = -(a - np.diag(np.diag(a)) / 2)
    const = math.log(weight) if weight > 0 else -np.inf
    const -= 0.5 * (len(d) * math.log(2 * math.pi) + np.log(d[kept]).sum() + m @ a @ m)
    return np.r_[const, a @ m, square[np.triu_indices(len(d))]]


def _maximised(
    rows: DataFrame, begun: Sequence[tuple[GaussianMixtureModel, int | None]], iterations: int, tolerance: float = 0.01
) -> list[GaussianMixtureModel]:
    """MLlib's expectation maximisation (its density floor, its stop) from the ``begun`` models on all ``rows``
    (``x0`` ...), each without the rows of its ``_fold`` if one is given.

    A pass serves all models that still move: a batch is one matrix of 1, z and z z', the exponents and
    the weighted sums of all components are its products. Partitions emit their sums.
    """
    names = [c for c in rows.columns if c != "_fold"]
    d = len(names)
    one = rows.agg(*[f(c) for f in (F.avg, F.stddev_pop) for c in names]).first()
    centre = np.array([v or 0.0 for v in one[:d]])
    scale = np.array([v or 1.0 for v in one[d:]])
    up = np.triu_indices(d)
    state = [(np.array(m.weights), np.array([g.mean.toArray() for g in m.gaussians]), np.array([g.cov.toArray() for g in m.gaussians])) for m, _ in begun]
    likely, before = [-float(np.finfo(float).max)] * len(begun), [0.0] * len(begun)

    for _ in range(iterations):
        moving = [i for i in range(len(begun)) if abs(likely[i] - before[i]) > tolerance]
        if not moving:
            break
        told = [(i, begun[i][1], np.array([_exponent(*g, centre, scale) for g in zip(*state[i])])) for i in moving]

        def expected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = {i: np.zeros(1 + t.size) for i, _, t in told}
            for b in batches:
                z = (np.stack([b.column(c).to_numpy() for c in range(d)]) - centre[:, None]) / scale[:, None]
                whole = np.concatenate([np.ones((1, z.shape[1])), z, z[up[0]] * z[up[1]]])
                fold = b.column(d).to_numpy() if b.num_columns > d else None
                for i, out, t in told:
                    m = whole if out is None else np.ascontiguousarray(whole[:, fold != out])
                    p = EPSILON + np.exp(t @ m)
                    total = p.sum(axis=0)
                    sums[i] += np.r_[np.log(total).sum(), ((p / total) @ m.T).ravel()]
            yield pa.RecordBatch.from_arrays([pa.array(sums, pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], ["i", "s"])

        got = rows.mapInArrow(expected, "i int, s binary").toPandas()
        for i, _, t in told:
            s = sum(np.frombuffer(v) for v in got["s"][got["i"] == i])
            before[i], likely[i] = likely[i], float(s[0])
            s = s[1:].reshape(t.shape)
            w, z = s[:, 0], s[:, 1 : d + 1] / s[:, :1]
            square = np.zeros((len(w), d, d))
            square[:, up[0], up[1]] = square[:, up[1], up[0]] = s[:, d + 1 :] / s[:, :1]
            covs = (square - z[:, :, None] * z[:, None, :]) * np.outer(scale, scale)
            state[i] = (w / w.sum(), centre + scale * z, covs)
    return [_rebuilt(m, *s) for (m, _), s in zip(begun, state)]


def log_density(x: Column, model: GaussianMixtureModel, dims: int) -> Column:
    """Mixture log density as a column expression on the fitted parameters."""
    logs = []
    for weight, g in zip(model.weights, model.gaussians):
        mean = g.mean.toArray()
        low = np.linalg.cholesky(g.cov.toArray() + 1e-9 * np.eye(dims))
        inv = np.linalg.inv(low)
        quad = F.lit(0.0)
        for i in range(dims):
            row = F.lit(0.0)
            for j in range(i + 1):
                row = row + F.lit(float(inv[i, j])) * (x[j] - F.lit(float(mean[j])))
            quad = quad + row * row
        const = math.log(max(weight, 1e-300)) - 0.5 * dims * math.log(2 * math.pi)
        const -= float(np.log(np.diag(low)).sum())
        logs.append(F.lit(const) - 0.5 * quad)
    if len(logs) == 1:
        return logs[0]
    parts = F.array(*logs)
    top = F.array_max(parts)
    return top + F.log(F.aggregate(parts, F.lit(0.0), lambda s, v: s + F.exp(v - top)))


def score_mixture(rows: DataFrame, columns: Sequence[str], model: GaussianMixtureModel) -> DataFrame:
    """``mixture_density`` of all ``rows`` in Arrow batches; rows that lack a feature stay, with null outputs."""
    d = len(columns)
    parts = []
    for w, g in zip(model.weights, model.gaussians):
        cov = g.cov.toArray()
        value, vector = np.linalg.eigh(cov)
        kept = value > EPSILON * value.max() * d
        low = np.linalg.cholesky(cov + 1e-9 * np.eye(d))
        const = math.log(max(w, 1e-300)) - 0.5 * d * math.log(2 * math.pi) - float(np.log(np.diag(low)).sum())
        height = -0.5 * (d * math.log(2 * math.pi) + float(np.log(value[kept]).sum()))
        parts.append((w, g.mean.toArray()[:, None], np.linalg.inv(low), const, (vector[:, kept] / np.sqrt(value[kept])).T, height))

    @F.pandas_udf("log_density double, component int, top_posterior double")
    def score(part: pd.DataFrame) -> pd.DataFrame:
        x = part.to_numpy(dtype=float).T
        logs, shares = np.empty((len(parts), x.shape[1])), np.empty((len(parts), x.shape[1]))
        for i, (w, mean, inv, const, root, height) in enumerate(parts):
            z = x - mean
            logs[i] = const - 0.5 * ((inv @ z) ** 2).sum(axis=0)
            shares[i] = EPSILON + w * np.exp(height - 0.5 * ((root @ z) ** 2).sum(axis=0))
        top = logs.max(axis=0)
        done = {"log_density": top + np.log(np.exp(logs - top).sum(axis=0)), "component": shares.argmax(axis=0).astype(np.int32)}
        return pd.DataFrame(done | {"top_posterior": shares.max(axis=0) / shares.sum(axis=0)})

    whole = F.lit(True)
    for c in columns:
        whole = whole & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    done = rows.withColumn("_s", score(F.struct(*[F.col(c).cast("double").alias(c) for c in columns])))
    outputs = ["log_density", "component", "top_posterior"]
    return done.withColumns({c: F.when(whole, F.col(f"_s.{c}")) for c in outputs}).drop("_s")


def mixture_density(df: DataFrame, features: str, model: GaussianMixtureModel, dims: int) -> DataFrame:
    """Log density, most likely component and its posterior per row."""
    scored = model.setFeaturesCol(features).setPredictionCol("component").transform(df)
    return scored.withColumn("_x", vector_to_array(features)).withColumns({
        "log_density": log_density(F.col("_x"), model, dims),
        "top_posterior": F.array_max(vector_to_array("probability")),
    }).drop("_x")


def select_components(
    df: DataFrame, features: str, ks: Sequence[int], dims: int, ident: str, folds: int, seed: int
) -> DataFrame:
    """Mean held-out log density per number of components. One fit per (k, fold), all of them in the same passes;
    every held-out score is one aggregate and the table has one row per k."""
    folded = df.withColumn("_fold", F.pmod(hash31(ident, seed), F.lit(folds)).cast("int"))
    rows = settle(_coordinates(folded.where(F.col("_fold").isNotNull()), features, "_fold"), "mixture")
    begun = [(_begun(folded.where(F.col("_fold") != f), features, k, seed), f) for k in ks for f in range(folds)]
    x = F.array(*[c for c in rows.columns if c != "_fold"])
    fitted = _maximised(rows, begun, 30)
    held = [F.avg(F.when(F.col("_fold") == f, log_density(x, m, dims))) for m, (_, f) in zip(fitted, begun)]
    scores = np.array(rows.agg(*held).first(), dtype=float).reshape(len(ks), folds)
    means = [(int(k), float(np.mean(s))) for k, s in zip(ks, scores)]
    return df.sparkSession.createDataFrame(means, "k bigint, mean_log_density double")


def _standard_vector(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Standardised columns with nulls at the mean (0), as vector ``_v``."""
    z = standardise(df, columns)
    z = z.withColumns({c: F.coalesce(F.col(c), F.lit(0.0)) for c in columns})
    return assemble(z, columns, "_v")


def pca_mixture_outliers(df: DataFrame, columns: Sequence[str], seed: int) -> DataFrame:
    """Scale, fill with the mean, two components, two-part mixture; the smaller part is the
    outlier set."""
    v = _standard_vector(df, columns)
    p = PCA(k=2, inputCol="_v", outputCol="_p").fit(v).transform(v)
    model = fit_mixture(p, "_p", 2, seed)
    part = model.setPredictionCol("_part").transform(p)
    sizes = {r["_part"]: r["count"] for r in part.groupBy("_part").count().collect()}
    small = min((0, 1), key=lambda i: (sizes.get(i, 0), i))
    return part.withColumn("outlier", F.col("_part") == small)


def reconstruction_errors(df: DataFrame, columns: Sequence[str], k: int) -> DataFrame:
    """Squared error of a k-component PCA reconstruction on standardised columns, per feature
    (``err_*``) and in total; the projection is a column expression."""
    z = _standard_vector(df, columns)
    pc = PCA(k=k, inputCol="_v", outputCol="_p").fit(z).pc.toArray()
    back = pc @ pc.T
    errors = {}
    for i, c in enumerate(columns):
        rebuilt = sum((F.lit(float(back[i, j])) * F.col(d) for j, d in enumerate(columns)), F.lit(0.0))
        errors[f"err_{c}"] = (F.col(c) - rebuilt) ** 2
    out = z.withColumns(errors)
    return out.withColumn("error", sum((F.col(e) for e in errors), F.lit(0.0))).drop("_v")


def error_ranking(errors: DataFrame, columns: Sequence[str], anomalous: Column, top: int) -> DataFrame:
    """Mean error per feature over the anomalous rows, largest first."""
    long = melt(errors.where(anomalous), [], columns)
    mean = long.groupBy("feature").agg(F.avg("value").alias("mean_error"))
    return mean.orderBy(F.col("mean_error").desc(), "feature").limit(top)


def _average_path(n: float) -> float:
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + 0.5772156649015329) - 2.0 * (n - 1.0) / n


def _grow(x: np.ndarray, limit: int, rng: np.random.Generator) -> dict[str, np.ndarray]:
    """One isolation tree as flat arrays (feature -1 marks a leaf)."""
    feature, cut, left, right, path = [], [], [], [], []

    def node(rows: np.ndarray, depth: int) -> int:
        me = len(feature)
        feature.append(-1), cut.append(0.0), left.append(me), right.append(me)
        path.append(depth + _average_path(len(rows)))
        spread = np.flatnonzero(rows.max(axis=0) > rows.min(axis=0)) if len(rows) > 1 else []
        if depth < limit and len(spread):
            f = int(rng.choice(spread))
            at = rng.uniform(rows[:, f].min(), rows[:, f].max())
            side = rows[:, f] < at
            feature[me], cut[me] = f, at
            left[me], right[me] = node(rows[side], depth + 1), node(rows[~side], depth + 1)
        return me

    node(x, 0)
    return {k: np.array(v) for k, v in dict(feature=feature, cut=cut, left=left, right=right, path=path).items()}


def isolation_scores(
    df: DataFrame, columns: Sequence[str], ident: str, trees: int, sample: int,
    contamination: float, seed: int,
) -> DataFrame:
    """Isolation-forest score per row and the ``contamination`` share of highest scores.

    A tree is defined on ``sample`` rows, so growing needs trees * sample hashed rows on the
    driver, whatever the table's size; scoring runs in Arrow batches.
    """
    pick = hash31(F.xxhash64(ident, *columns), seed)
    grown_from = (
        df.where(F.greatest(*[F.col(c).isNull().cast("int") for c in columns]) == 0)
        .select(*columns, pick.alias("_h")).orderBy("_h", *columns).limit(trees * sample).toPandas()
    )
    rng = np.random.default_rng(seed)
    x = grown_from[list(columns)].to_numpy(dtype=float)
    x = x[rng.permutation(len(x))]
    size = max(1, min(sample, len(x) // trees or 1))
    limit = math.ceil(math.log2(max(size, 2)))
    forest = [_grow(x[i * size : (i + 1) * size], limit, rng) for i in range(trees)]
    norm = _average_path(size) or 1.0

    @F.pandas_udf("double")
    def score(part: pd.DataFrame) -> pd.Series:
        m = part.to_numpy(dtype=float)
        total = np.zeros(len(m))
        for t in forest:
            at = np.zeros(len(m), dtype=int)
            for _ in range(limit):
                f = t["feature"][at]
                inner = f >= 0
                go = m[np.arange(len(m)), np.maximum(f, 0)] < t["cut"][at]
                at = np.where(inner, np.where(go, t["left"][at], t["right"][at]), at)
            total += t["path"][at]
        return pd.Series(np.exp2(-total / len(forest) / norm))

    scored = df.withColumn("score", score(F.struct(*columns)))
    cut = scalar_row(exact_quantiles(scored, [], "score", {"q": 1.0 - contamination}))["q"]
    return scored.withColumn("outlier", F.col("score") > cut)
