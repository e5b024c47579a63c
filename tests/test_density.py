import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidewright.functions.exprs import hash31
from tidewright.operators import anomaly, density


def direct(train, w, x, h):
    """Negative log density by all pairs, in log space."""
    out = np.empty(len(x))
    for i in range(0, len(x), 200):
        e = -0.5 * ((x[i : i + 200, None] - train[None, :]) / h[i : i + 200, None]) ** 2
        top = e.max(axis=1)
        total = np.log((w * np.exp(e - top[:, None])).sum(axis=1)) + top
        out[i : i + 200] = -(total - np.log(w.sum()) - np.log(h[i : i + 200]) - 0.5 * np.log(2 * np.pi))
    return out


def test_moments_equal_all_pairs(spark):
    """1e5 distinct continuous training values, outliers up to where only the nearest point counts."""
    rng = np.random.default_rng(4)
    v = np.r_[rng.normal(0, 3, 60_000), rng.exponential(20, 40_000)]
    x = np.r_[rng.choice(v, 800), rng.uniform(-40, 400, 700), [1e6, -1e6, 0.0]]
    h = np.where(np.arange(len(x)) % 2, 0.7, 1.0)
    train = spark.createDataFrame(pd.DataFrame({"slot": 1, "v": v, "w": 1}))
    points = spark.createDataFrame(pd.DataFrame({"slot": 1, "v": x, "h": h}))
    got = {(r["v"], r["h"]): r["signal"] for r in density.kde_scores(train, points, ["slot"], "v", "h").collect()}
    want = direct(v, np.ones(len(v)), x, h)
    have = np.array([got[k] for k in zip(x, h)])
    assert np.abs(have - want).max() <= 1e-8 * np.abs(want).max() and np.abs((have - want) / want).max() < 1e-8


def test_one_hot_cell_makes_no_pairs(spark):
    """All points of a slot within one cell: the plan's work is a sum, so 2e5 points take no tile."""
    rng = np.random.default_rng(5)
    v = rng.normal(0, 1e-3, 200_000)
    train = spark.createDataFrame(pd.DataFrame({"slot": 1, "v": v, "w": 2}))
    got = density.kde_scores(train, train.limit(300), ["slot"], "v", 1.0).toPandas()
    want = direct(v, np.full(len(v), 2.0), got["v"].to_numpy(), np.ones(len(got)))
    assert np.abs(got["signal"].to_numpy() - want).max() < 1e-10


def test_bandwidths_without_a_scale(spark):
    """A missing or zero bandwidth gives no density, and no other point changes."""
    train = spark.createDataFrame([(1, 0.0, 1), (1, 2.0, 1), (2, 5.0, 1)], "slot int, v double, w int")
    points = spark.createDataFrame([(1, 1.0, 1.0), (1, 0.5, None), (3, 1.0, 1.0)], "slot int, v double, h double")
    got = {(r["slot"], r["v"]): r["signal"] for r in density.kde_scores(train, points, ["slot"], "v", "h").collect()}
    assert got[1, 1.0] == pytest.approx(direct(np.array([0.0, 2.0]), np.ones(2), np.ones(1), np.ones(1))[0])
    assert (3, 1.0) not in got and got.get((1, 0.5)) in (None,) or np.isnan(got[1, 0.5])


def test_rule_without_a_key(spark):
    df = spark.range(1000).select((F.col("id") % 37).cast("double").alias("v"))
    one = density.bandwidth_rule(df, [], "v").first()["h"]
    per = density.bandwidth_rule(df.withColumn("k", F.lit(1)), ["k"], "v").first()["h"]
    assert one == per


def test_mixture_scores_every_row(spark):
    """Rows without a feature keep their place; the others' density is that of the fitted mixture."""
    from tidewright.operators import anomaly

    rng = np.random.default_rng(6)
    pdf = pd.DataFrame({"id": range(202), "a": np.r_[rng.normal(2, 3, 200), np.nan, 1.0], "b": np.r_[rng.normal(0, 1, 201), np.nan]})
    df = spark.createDataFrame(pdf).withColumn("b", F.nanvl("b", F.lit(None)))
    model = anomaly.fit_mixture(anomaly.assemble(df, ["a", "b"]), "x", 2, seed=1)
    got = anomaly.score_mixture(df, ["a", "b"], model).toPandas().sort_values("id")
    assert len(got) == 202 and got["log_density"].tail(2).isna().all() and got["component"].tail(2).isna().all()
    x, total = pdf[["a", "b"]].to_numpy()[:200], 0.0
    for w, g in zip(model.weights, model.gaussians):
        z, cov = x - g.mean.toArray(), g.cov.toArray()
        e = -0.5 * np.einsum("ni,ij,nj->n", z, np.linalg.inv(cov), z) - np.log(2 * np.pi) - 0.5 * np.log(np.linalg.det(cov))
        total = total + w * np.exp(e)
    np.testing.assert_allclose(got["log_density"].head(200), np.log(total), rtol=1e-5)


def test_mixtures_equal_mllib(spark, monkeypatch):
    """All fits of a selection in the same passes over packed rows, each as MLlib's own."""
    from pyspark.ml.clustering import GaussianMixture

    rng = np.random.default_rng(3)
    x = np.r_[rng.normal([0, 1e4, 5], [1, 3e3, 0.1], (700, 3)), rng.normal([4, 2e4, 6], [2, 1e3, 0.5], (300, 3))]
    df = spark.createDataFrame(pd.DataFrame(x, columns=list("abc")).assign(id=np.arange(len(x)))).repartition(3).cache()
    v = anomaly.assemble(df, list("abc")).cache()
    own = GaussianMixture(featuresCol="x", k=3, seed=5, maxIter=30).fit(v)
    iterations, fit = [], GaussianMixture.fit
    monkeypatch.setattr(GaussianMixture, "fit", lambda self, d, params=None: iterations.append(self.getMaxIter()) or fit(self, d, params))
    got = anomaly.fit_mixture(v, "x", 3, seed=5)
    assert iterations == [0]
    np.testing.assert_allclose(got.weights, own.weights, rtol=1e-7)
    for g, w in zip(got.gaussians, own.gaussians):
        np.testing.assert_allclose(g.mean.toArray(), w.mean.toArray(), rtol=1e-7)
        np.testing.assert_allclose(g.cov.toArray(), w.cov.toArray(), rtol=1e-5, atol=1e-7)
    a = anomaly.score_mixture(df, list("abc"), got).orderBy("id").toPandas()
    b = anomaly.mixture_density(v, "x", own, 3).orderBy("id").toPandas()
    assert list(a["component"]) == list(b["component"])
    for c in ("log_density", "top_posterior"):
        np.testing.assert_allclose(a[c], b[c], rtol=1e-7)
    few = anomaly.select_components(v, "x", [2, 3], 3, "id", 2, 7).collect()
    folded = v.withColumn("_fold", F.pmod(hash31("id", 7), F.lit(2)))
    for r in few:
        means = []
        for f in range(2):
            m = fit(GaussianMixture(featuresCol="x", k=r["k"], seed=7, maxIter=30), folded.where(F.col("_fold") != f))
            held = folded.where(F.col("_fold") == f).select(vector_to_array("x").alias("x"))
            means.append(held.agg(F.avg(anomaly.log_density(F.col("x"), m, 3))).first()[0])
        assert r["mean_log_density"] == pytest.approx(np.mean(means), abs=1e-7)
