"""Splits, relevance and models on planted data; properties of survival and decisions."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewright.operators import anomaly, decisions, joins, models, relevance, splits, survival


@pytest.fixture(scope="module")
def planted(spark):
    """y depends on a and b; c and d are noise."""
    rng = np.random.default_rng(11)
    x = rng.normal(size=(1500, 4))
    y = 4 * x[:, 0] - 2 * x[:, 1] + 0.3 * rng.normal(size=1500) + 5
    pdf = pd.DataFrame(x, columns=list("abcd")).assign(y=y, id=np.arange(1500), cls=(y > 5).astype(int))
    return spark.createDataFrame(pdf).cache()


COLS = list("abcd")


def mae(df, pred="pred"):
    return df.agg(F.avg(F.abs(F.col("y") - F.col(pred)))).first()[0]


def baseline(df):
    return df.withColumn("m", F.lit(df.agg(F.avg("y")).first()[0])).agg(F.avg(F.abs(F.col("y") - F.col("m")))).first()[0]


def test_splits_are_disjoint_complete_and_grouped(spark):
    df = spark.range(4000).withColumn("g", F.col("id") % 37).withColumn("c", (F.col("id") % 10 == 0).cast("int"))
    r = splits.random_split(df, "id", {"a": 0.5, "b": 0.3, "c": 0.2}, 1).groupBy("part").count().collect()
    n = {x["part"]: x["count"] for x in r}
    assert sum(n.values()) == 4000 and abs(n["a"] - 2000) < 200 and abs(n["b"] - 1200) < 200
    g = splits.group_split(df, "g", 0.6, 2).groupBy("g").agg(F.countDistinct("part").alias("k")).agg(F.max("k")).first()[0]
    assert g == 1
    s = {(x["c"], x["part"]): x["count"] for x in splits.stratified_split(df, "c", "id", 0.25, 3).groupBy("c", "part").count().collect()}
    assert s[0, "test"] == 900 and s[1, "test"] == 100
    masked = splits.mask_n(df.withColumn("v", F.lit(1.0)), "v", "id", 17, 4, "m")
    assert masked.where("m IS NULL").count() == 17
    assert splits.kfold(df, "id", 5, 6).select("fold").distinct().count() == 5


def test_relevance_finds_the_causes(planted):
    rank = {r["feature"]: r["rank"] for r in relevance.rfe(planted, COLS, "y", 2).collect()}
    assert [f for f in COLS if rank[f] == 1] == ["a", "b"]
    assert {r["feature"] for r in relevance.lasso(planted, COLS, "y", 0.3).collect()} == {"a", "b"}
    w0, w = relevance.linear_model(planted, COLS, "y")
    assert w["a"] == pytest.approx(4, abs=0.05) and w0 == pytest.approx(5, abs=0.05)
    imp = relevance.permutation_importance(planted, "id", COLS, "y", w0, w, 2, 5).orderBy(F.col("score").desc())
    assert [r["feature"] for r in imp.collect()][:2] == ["a", "b"]
    subset = relevance.subset_search(planted.where("id % 3 > 0"), planted.where("id % 3 = 0"), COLS, "y").orderBy("rmse")
    assert {"a", "b"} <= set(subset.first()["features"].split(",")) and subset.count() == 15
    b = {r["feature"]: r["verdict"] for r in relevance.boruta(planted, "id", COLS, "y", 5, 8, 5, 1, alpha=0.2).collect()}
    assert b["a"] == "confirmed" and b["c"] != "confirmed"


def test_sampled_attributions_add_up(planted):
    from pyspark.ml.regression import LinearRegression

    fit = LinearRegression(featuresCol="_x", labelCol="y").fit(models.vectorise(planted, COLS))

    def predict(df, vector, to):
        return fit.setFeaturesCol(vector).setPredictionCol(to).transform(df)

    phi = relevance.shapley_sampled(planted, "id", COLS, predict, 2, 3).toPandas().sort_values("id")
    w = dict(zip(COLS, fit.coefficients))
    x = planted.toPandas().sort_values("id")
    for c in COLS:
        # On average the background's mean is taken off.
        assert phi[f"phi_{c}"].mean() == pytest.approx(0.0, abs=1e-6)
        slope = np.polyfit(x[c], phi[f"phi_{c}"], 1)[0]
        assert slope == pytest.approx(w[c], abs=0.25)


def test_model_permutation_over_blocks(planted):
    """The rise is that of pairing rows at random, whatever the block; unused columns have none."""
    held = planted.where("id % 3 = 0").withColumn("d", F.when(F.col("id") > 0, F.col("d")))
    got = relevance.model_permutation(held, "id", COLS, "y", lambda f: f.withColumn("pred", 5 + 4 * F.col("a") - 2 * F.col("b")), 8, 3, rows=64)
    got = got.toPandas().set_index("feature")
    x = held.toPandas().dropna()
    base = (x["y"] - 5 - 4 * x["a"] + 2 * x["b"]).to_numpy()
    for c, weight in (("a", 4), ("b", -2)):
        pairs = base[:, None] + weight * (x[c].to_numpy()[:, None] - x[c].to_numpy()[None])
        assert got["score"][c] == pytest.approx(np.abs(pairs).mean() - np.abs(base).mean(), rel=0.06)
    assert got["score"][["c", "d"]].abs().max() < 1e-12 and (got["std"][["a", "b"]] > 0).all()
    assert relevance.model_permutation(held.limit(0), "id", COLS, "y", lambda f: f.withColumn("pred", F.col("a")), 2).count() == 0


def test_permutation_keeps_the_multiset(planted):
    p = relevance.permuted(planted.select("id", "a"), "id", ["a"], 3).toPandas()
    assert len(p) == 1500 and sorted(p["a"]) == sorted(p["p_a"]) and (p["a"] != p["p_a"]).mean() > 0.9


def test_regressors_beat_the_mean(planted):
    train, test = planted.where("id % 4 > 0"), planted.where("id % 4 = 0")
    bar = baseline(test)
    assert mae(models.linear(train, test, COLS, "y")) < 0.1 * bar
    assert mae(models.forest(train, test, COLS, "y", 10, 6, 1)) < 0.6 * bar
    assert mae(models.boosted(train, test, COLS, "y", 10, 4, 1)) < 0.6 * bar
    assert mae(models.residual_hybrid(train, test, COLS, "y", 0.1, 5, 3, 1)) < 0.1 * bar
    assert mae(models.stack(train, test, COLS, "y", "id", 2, 1), "stacked") < 0.15 * bar
    scored = models.logistic_balanced(train, test, COLS, "cls")
    assert scored.agg(F.avg(((F.col("score") > 0.5).cast("int") == F.col("cls")).cast("int"))).first()[0] > 0.9


def test_mixture_and_outliers(spark):
    rng = np.random.default_rng(1)
    x = np.vstack([rng.normal(0, 1, (400, 2)), rng.normal(12, 1, (40, 2))])
    df = spark.createDataFrame(pd.DataFrame(x, columns=["a", "b"]).assign(id=np.arange(440)))
    v = anomaly.assemble(df, ["a", "b"])
    m = anomaly.fit_mixture(v, "x", 2, seed=1)
    d = anomaly.mixture_density(v, "x", m, 2).toPandas()
    weights, want = np.array(m.weights), np.zeros(440)
    for w, g in zip(weights, m.gaussians):
        c, mu = g.cov.toArray(), g.mean.toArray()
        q = np.einsum("ij,jk,ik->i", x - mu, np.linalg.inv(c), x - mu)
        want += w * np.exp(-0.5 * q) / (2 * np.pi * np.sqrt(np.linalg.det(c)))
    np.testing.assert_allclose(np.exp(d.sort_values("id")["log_density"]), want, rtol=1e-4)
    flagged = anomaly.pca_mixture_outliers(df, ["a", "b"], 1).where("outlier").toPandas()["id"]
    assert set(flagged) == set(range(400, 440))
    far = spark.createDataFrame(pd.DataFrame(rng.normal(0, 1, (600, 2)), columns=["a", "b"]).assign(id=np.arange(600)))
    far = far.unionByName(spark.createDataFrame([(30.0, 30.0, 999)], "a double, b double, id bigint"))
    top = anomaly.isolation_scores(far, ["a", "b"], "id", 20, 128, 0.02, 3).orderBy(F.col("score").desc()).first()
    assert top["id"] == 999 and top["outlier"]


def test_survival_properties(spark):
    df = spark.createDataFrame(pd.DataFrame({"cycle": np.arange(50.0)}))
    s = survival.lookahead(df, 4, "cycle", -3.0, {"cycle": 0.05}).toPandas()
    steps = s[[f"s_{h}" for h in range(5)]].to_numpy()
    assert (np.diff(steps, axis=1) <= 0).all() and (steps >= 0).all() and (steps <= 1).all()
    runs = spark.createDataFrame([(n,) for n in (3, 5, 5, 12, 30)], "f bigint")
    h = survival.empirical_hazard(runs, "f", 5).orderBy("bin").collect()
    assert [(r["bin"], r["failures"], r["at_risk"]) for r in h] == [(0, 3, 5), (2, 1, 2), (5, 1, 1)]
    assert h[-1]["survival"] == 0.0 and h[0]["survival"] == pytest.approx(0.4)


def test_perfect_prediction_has_no_regret(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"i": np.repeat(np.arange(50), 3), "o": np.tile(np.arange(3), 50), "c": rng.random(150)})
    df = spark.createDataFrame(pdf.assign(p=pdf["c"]))
    for f in (decisions.regret, decisions.self_contrastive, decisions.spo_plus):
        assert f(df, ["i"], "o", "c", "p").first()[0] == pytest.approx(0.0)
    tie = spark.createDataFrame([(0, 0, 9.0, 1.0), (0, 1, 2.0, 1.0)], "i int, o int, c double, p double")
    r = decisions.choose(tie, ["i"], "o", "c", "p").first()
    assert r["chosen"] == 0 and r["best_cost"] == 2.0


def test_best_combination_is_exhaustive(spark):
    import itertools

    rng = np.random.default_rng(3)
    pdf = pd.DataFrame([(g, o, float(rng.integers(1, 20)), float(rng.integers(1, 30))) for g in range(4) for o in range(4)], columns=["g", "o", "cost", "gain"])
    got = joins.best_combination(spark.createDataFrame(pdf), "g", "o", "cost", "gain", 30.0).first()
    groups = [list(x[["cost", "gain"]].itertuples(index=False, name=None)) for _, x in pdf.groupby("g")]
    ok = [(sum(c for c, _ in p), sum(v for _, v in p)) for p in itertools.product(*groups)]
    best = max((v, -c) for c, v in ok if c <= 30.0)
    assert (got["gain"], -got["cost"]) == best


def test_best_combination_without_a_fitting_choice(spark):
    """The row of nulls that SQL's max and min_by give over no rows."""
    table = spark.createDataFrame([("a", 0, 5.0, 1.0), ("a", 1, 6.0, 2.0), ("b", 0, 4.0, 1.0)], "g string, o int, cost double, gain double")
    for options, budget in ((table, 8.9), (table, None), (table.limit(0), 10.0)):
        got = joins.best_combination(options, "g", "o", "cost", "gain", budget).collect()
        assert [(r["cost"], r["gain"], r["choice"]) for r in got] == [(None, None, None)]
    assert joins.best_combination(table, "g", "o", "cost", "gain", 9.0).first()["gain"] == 2.0


def test_forecasts_follow_a_trend(spark):
    m = np.arange(60)
    df = spark.createDataFrame(pd.DataFrame({"k": "a", "pos": m + 1, "v": 100 + 2.0 * m}))
    ar = models.ar_forecast(df, "k", "pos", "v", 2, 3).orderBy("step").toPandas()
    np.testing.assert_allclose(ar["forecast"], 100 + 2.0 * np.arange(60, 63), atol=1e-3)
    rec = models.recursive_forecast(df, "k", "pos", "v", [1, 2], 3).orderBy("step").toPandas()
    np.testing.assert_allclose(rec["forecast"], 100 + 2.0 * np.arange(60, 63), atol=0.5)


def test_ar_equals_least_squares_on_the_series(spark):
    """Sums per key and number of lags give the fit that all rows of a key give; null rows don't count."""
    rng = np.random.default_rng(8)
    series = {"a": np.cumsum(rng.normal(0, 1, 80)) + 5 * np.sin(np.arange(80) * np.pi / 6), "b": rng.normal(9, 1, 40), "c": np.array([3.0, 5.0])}
    table = [(k, i + 1, float(x)) for k, v in series.items() for i, x in enumerate(v)] + [("c", 3, None), (None, 1, 1.0)]
    got = models.ar_forecast(spark.createDataFrame(table, "k string, pos bigint, v double"), "k", "pos", "v", 3, 4).toPandas()
    assert set(got["k"]) == set(series)
    for k, v in series.items():
        d, at = np.diff(v), np.arange(2, len(v) + 1)
        fits = []
        for o in range(1, 4):
            if len(d) < 2 * o + 6:
                break
            x = np.array([[1.0, *d[i - o : i][::-1], np.sin(at[i] * np.pi / 6), np.cos(at[i] * np.pi / 6)] for i in range(o, len(d))])
            b = np.linalg.lstsq(x, d[o:], rcond=None)[0]
            fits.append((len(x) * np.log(((d[o:] - x @ b) ** 2).mean()) + 2 * x.shape[1], o, b))
        past, level = list(d[::-1]), v[-1]
        own = got[got["k"] == k].sort_values("step")
        order, b = min(fits, key=lambda f: f[0])[1:] if fits else (0, None)
        for h, r in enumerate(own.itertuples(), 1):
            season = (len(v) + h) * np.pi / 6
            past.insert(0, float(b @ np.r_[1.0, past[:order], np.sin(season), np.cos(season)]) if order else 0.0)
            level += past[0]
            assert r.ar_order == order and r.pos == len(v) + h
            np.testing.assert_allclose(r.forecast, level, rtol=1e-8)


def test_asof_with_small_cells(spark):
    rng = np.random.default_rng(4)
    left = pd.DataFrame({"k": "a", "at": rng.integers(0, 300, 80), "id": np.arange(80)})
    right = pd.DataFrame({"k": "a", "t": rng.integers(20, 300, 40), "tie": np.arange(40), "v": rng.random(40)})
    got = joins.asof(spark.createDataFrame(left), spark.createDataFrame(right), ["k"], "at", "t", "tie", "v", 7)
    got = got.toPandas().set_index("id").sort_index()
    want = pd.merge_asof(left.sort_values("at", kind="stable"), right.sort_values(["t", "tie"]), left_on="at", right_on="t").set_index("id").sort_index()
    np.testing.assert_array_equal(got["asof_v"].to_numpy(float), want["v"].to_numpy())


def _normal(ident, seed, std):
    def unit(i, s):
        h = (i % 2**31 * 1103515245 + s * 7919 + 12345) % 2**31
        h = h // 32768 + h % 32768 * 65536
        return (h % 2**31 * 1103515245 + 12345) % 2**31 / 2.0**31

    return std * np.sqrt(-2.0 * np.log(1.0 - unit(ident, seed))) * np.cos(unit(ident, seed + 1) * 2 * np.pi)


@pytest.mark.parametrize("rows", [1 << 16, 40])
def test_smoothed_losses_exchange_a_row_once(spark, monkeypatch, rows):
    """All draws and losses against loops; one exchange by instance, with a heavy instance one more with partial results."""
    monkeypatch.setattr(decisions, "HEAVY_ROWS", rows)
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"oid": np.r_[np.repeat(np.arange(12), 5), np.full(60, 99)], "ln": np.r_[np.tile(np.arange(5), 12), np.arange(60)]})
    pdf = pdf.assign(c=rng.normal(10, 3, len(pdf)).round(2), ch=rng.normal(10, 3, len(pdf)).round(2))
    df = spark.createDataFrame(pdf).repartition(4)
    got = decisions.smoothed(df, ["oid"], "ln", "c", "ch", F.expr("oid * 100 + ln"), 3, 2.0, 42)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == (1 if rows > 60 else 2)
    want = {"regret": [], "self_contrastive": [], "spo_plus": []}
    for _, g in pdf.groupby("oid"):
        c, best = g["c"].to_numpy(), int(np.lexsort((g["ln"], g["c"]))[0])
        for d in range(3):
            p = g["ch"].to_numpy() + np.array([_normal(int(i) * 3 + d, 42, 2.0) for i in g["oid"] * 100 + g["ln"]])
            want["regret"].append(c[p.argmin()] - c.min())
            want["self_contrastive"].append(p[best] - p.min())
            want["spo_plus"].append((2 * p - c)[best] - (2 * p - c).min())
    assert {r["metric"]: r["loss"] for r in got.collect()} == {k: pytest.approx(np.mean(v)) for k, v in want.items()}
    none = decisions.smoothed(df.limit(0), ["oid"], "ln", "c", "ch", F.col("ln"), 3, 2.0, 42).collect()
    assert [r["loss"] for r in none] == [None] * 3


def test_grid_search_equals_cross_validation(spark, planted):
    """Fits from moments against MLlib's own cross-validation; a constant column and a null in a column among them."""
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.regression import LinearRegression
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    from tidewright.functions.exprs import hash31

    df = planted.withColumn("d", F.lit(3.0)).withColumn("c", F.when(F.col("id") % 7 > 0, F.col("c") + 1000.0))
    model = LinearRegression(featuresCol="_x", labelCol="y", maxIter=30)
    grid = ParamGridBuilder().addGrid(model.regParam, [0.01, 1.0]).addGrid(model.elasticNetParam, [0.0, 0.5, 1.0]).build()
    folded = models.vectorise(df, COLS).withColumn("_fold", F.pmod(hash31(F.xxhash64(*COLS, "y"), 7), F.lit(3)).cast("int"))
    cv = CrossValidator(estimator=model, estimatorParamMaps=grid, numFolds=3, foldCol="_fold", evaluator=RegressionEvaluator(labelCol="y", metricName="mae")).fit(folded)
    want = {(p[model.regParam], p[model.elasticNetParam]): (m, s) for p, m, s in zip(grid, cv.avgMetrics, cv.stdMetrics)}
    got = models.grid_search(df, COLS, "y", [0.01, 1.0], [0.0, 0.5, 1.0], 3, 7).collect()
    assert len(got) == 6 and [r["mae"] for r in got] == sorted(r["mae"] for r in got)
    for r in got:
        assert (r["mae"], r["mae_std"]) == pytest.approx(want[r["reg"], r["net"]], abs=1e-7)
    with pytest.raises(ValueError, match="null"):
        models.grid_search(df.withColumn("y", F.when(F.col("id") > 5, F.col("y"))), COLS, "y", [0.1], [0.0], 3, 7)


def test_grid_search_passes_over_the_rows_three_times(spark, planted, tmp_path):
    """No pass per fold and parameter pair."""
    from pyspark.ml.regression import LinearRegression

    sizes, fit = [], LinearRegression.fit
    LinearRegression.fit = lambda self, df, params=None: sizes.append(df.count()) or fit(self, df, params)
    try:
        models.grid_search(planted, COLS, "y", [0.01, 1.0], [0.0, 1.0], 3, 7).collect()
    finally:
        LinearRegression.fit = fit
    assert sizes == [10] * 12
