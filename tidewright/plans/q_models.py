"""Queries: feature relevance and MLlib models."""

from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from ..functions.exprs import hash31, scalar_row, unit_hash
from ..operators import alarms, models, relevance
from ..session import released, settle
from .bindings import FEATURES, h31, rnd
from .q_sources import features_long, out
from .q_windows import sales_positions
from .registry import query

PREDICTORS = ["qty", "disc", "tax", "psize", "retail", "total"]
WEIGHTS = {"qty": 2.1, "disc": -15.0, "tax": 4.0, "psize": 0.02, "retail": 0.05, "total": 0.0001}


def feat(t, *names):
    """FEAT with an id from all columns: rows of equal id are equal, so ties do no harm. Only the columns
    ``names`` are written, if given."""
    f = t.feat()
    f = f.withColumn("id", F.xxhash64(*f.columns)).withColumn("kprice", F.col("price") / 1000.0)
    with released(t.spark):
        return settle(f.select(*names) if names else f, "feat")


def halves(f, seed=51):
    return f.where(unit_hash("oid", seed) < 0.7), f.where(unit_hash("oid", seed) >= 0.7)


@query("fs_variance", "SELECT * FROM (" + features_long(FEATURES, f"SELECT '{{c}}' AS feature, {rnd('var_pop({c})', 1)} AS score FROM feat") + ") WHERE score > 1")
def fs_variance(t):
    return out(relevance.variance_select(t.feat(), FEATURES, 1.0), 1)


_FU = features_long(FEATURES[:1] + FEATURES[2:], f"SELECT '{{c}}' AS feature, {rnd('power(corr({c}, price), 2) / (1 - power(corr({c}, price), 2)) * (count(*) - 2)', 4)} AS score FROM feat")


@query("fs_univariate", f"SELECT * FROM ({_FU}) ORDER BY score DESC LIMIT 4")
def fs_univariate(t):
    return out(relevance.top_features(relevance.univariate_scores(t.feat(), PREDICTORS, "price"), 4), 4)


@query("fs_rfe")
def fs_rfe(t):
    return relevance.rfe(feat(t), PREDICTORS, "kprice", 3)


@query("fs_lasso")
def fs_lasso(t):
    return out(relevance.lasso(feat(t), PREDICTORS, "kprice", 0.05))


@query("fs_tree")
def fs_tree(t):
    return out(relevance.tree_select(relevance.forest_importance(feat(t), PREDICTORS, "kprice", 12, 5, 7)))


@query("fs_permutation")
def fs_permutation(t):
    f = feat(t, "id", *PREDICTORS, "kprice")
    intercept, weights = relevance.linear_model(f, PREDICTORS, "kprice")
    return out(relevance.permutation_importance(f, "id", PREDICTORS, "kprice", intercept, weights, 3, 60))


@query("fs_permutation_forest")
def fs_permutation_forest(t):
    """Absolute error of a forest on rows it has not seen, 20 repeats."""
    train, test = halves(feat(t))
    fitted = models.vectorise(train, PREDICTORS)
    forest = RandomForestRegressor(featuresCol="_x", labelCol="kprice", predictionCol="pred", numTrees=12, maxDepth=5, seed=7).fit(fitted)
    return out(relevance.model_permutation(test, "id", PREDICTORS, "kprice", lambda f: forest.transform(models.vectorise(f, PREDICTORS)), 20, 60))


@query("fs_boruta")
def fs_boruta(t):
    return out(relevance.boruta(feat(t, "id", *PREDICTORS, "kprice"), "id", PREDICTORS, "kprice", 6, 6, 4, 70, alpha=0.2))


@query(
    "fs_shapley_linear",
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {rnd(f'avg(abs({w}::DOUBLE * ({c} - (SELECT avg({c}) FROM feat))))', 5)} AS score FROM feat"
        for c, w in WEIGHTS.items()
    ),
)
def fs_shapley_linear(t):
    return out(relevance.shapley_importance(relevance.shapley_linear(t.feat(), WEIGHTS), list(WEIGHTS)), 5)


@query("fs_shapley_sampled")
def fs_shapley_sampled(t):
    """Mean absolute attribution of a forest's predictions."""
    from pyspark.ml.regression import RandomForestRegressor

    f = feat(t)
    x = models.vectorise(f, PREDICTORS)
    fit = RandomForestRegressor(featuresCol="_x", labelCol="kprice", numTrees=6, maxDepth=4, seed=7).fit(x)

    def predict(df, vector, to):
        return fit.setFeaturesCol(vector).setPredictionCol(to).transform(df)

    phi = relevance.shapley_sampled(f, "id", PREDICTORS, predict, 1, 81)
    return out(relevance.shapley_importance(phi, PREDICTORS))


@query(
    "fs_union",
    "SELECT feature FROM (SELECT * FROM (" + features_long(PREDICTORS, "SELECT '{c}' AS feature, var_pop({c}) AS score FROM feat") + ") ORDER BY score DESC LIMIT 2)"
    f" UNION SELECT feature FROM (SELECT * FROM ({_FU}) ORDER BY score DESC LIMIT 3)",
)
def fs_union(t):
    f = t.feat()
    by_variance = relevance.top_features(relevance.variance_scores(f, PREDICTORS), 2)
    by_f = relevance.top_features(relevance.univariate_scores(f, PREDICTORS, "price"), 3)
    return relevance.union_selected([by_variance, by_f], PREDICTORS[:3], t.spark)


@query("fs_subset_search")
def fs_subset_search(t):
    train, test = halves(feat(t))
    return out(relevance.subset_search(train, test, PREDICTORS, "kprice"))


@query("fs_ablation")
def fs_ablation(t):
    return out(relevance.ablation(feat(t, *FEATURES, "y"), FEATURES, "y"), 5)


def regression_rows(df, target="kprice", pred="pred", digits=4):
    return out(df.select("oid", "ln", F.col(target).alias("actual"), F.col(pred).alias("pred")), digits)


_TRAIN = f"{h31('oid', 51)} / 2147483648.0 < 0.7"


@query(
    "ml_linear",
    f"""WITH f AS (SELECT oid, ln, qty, psize, price / 1000.0 AS kprice, {_TRAIN} AS tr FROM feat),
        s AS (SELECT avg(qty) AS mq, avg(psize) AS ms, avg(kprice) AS my, var_pop(qty) AS vq, var_pop(psize) AS vs, covar_pop(qty, psize) AS c,
          covar_pop(qty, kprice) AS cq, covar_pop(psize, kprice) AS cs FROM f WHERE tr),
        b AS (SELECT mq, ms, my, (cq * vs - cs * c) / (vq * vs - c * c) AS bq, (cs * vq - cq * c) / (vq * vs - c * c) AS bs FROM s)
        SELECT oid, ln, {rnd('kprice', 5)} AS actual, {rnd('my + bq * (qty - mq) + bs * (psize - ms)', 5)} AS pred FROM f, b WHERE NOT tr""",
)
def ml_linear(t):
    """Least squares on two predictors, checked against the closed form."""
    train, test = halves(feat(t))
    return regression_rows(models.linear(train, test, ["qty", "psize"], "kprice"), digits=5)


@query("ml_linear_all")
def ml_linear_all(t):
    train, test = halves(feat(t))
    return regression_rows(models.linear(train, test, PREDICTORS, "kprice"))


@query("ml_ridge")
def ml_ridge(t):
    train, test = halves(feat(t))
    return regression_rows(models.linear(train, test, PREDICTORS, "kprice", reg=0.5))


@query(
    "ml_simple_ols",
    f"SELECT {rnd('regr_slope(price, qty)', 4)} AS slope, {rnd('regr_intercept(price, qty)', 3)} AS intercept, {rnd('regr_r2(price, qty)')} AS r2 FROM feat",
)
def ml_simple_ols(t):
    return out(models.simple_ols(t.feat(), "qty", "price"), slope=4, intercept=3)


@query("ml_logistic_balanced")
def ml_logistic_balanced(t):
    f = t.scored().withColumnRenamed("score", "risk").withColumn("noise", F.pmod(hash31("id", 52), F.lit(100)) / 100.0)
    train, test = f.where(unit_hash("id", 53) < 0.8), f.where(unit_hash("id", 53) >= 0.8)
    p = models.logistic_balanced(train, test, ["risk", "actual", "noise"], "y")
    return out(p.select("id", "y", "score"))


@query("ml_forest")
def ml_forest(t):
    train, test = halves(feat(t))
    return regression_rows(models.forest(train, test, PREDICTORS, "kprice", 10, 5, 7))


@query("ml_forest_classifier")
def ml_forest_classifier(t):
    f = t.scored().withColumnRenamed("score", "risk")
    train, test = f.where(unit_hash("id", 53) < 0.8), f.where(unit_hash("id", 53) >= 0.8)
    return out(models.forest(train, test, ["risk", "actual"], "y", 10, 5, 7, classify=True).select("id", "y", "score"))


@query("ml_gbt")
def ml_gbt(t):
    train, test = halves(feat(t))
    return regression_rows(models.boosted(train, test, PREDICTORS, "kprice", 8, 4, 7))


@query("ml_poisson_arrivals")
def ml_poisson_arrivals(t):
    g = t.grid(total=True).withColumn("weekday", ((F.col("h") / 24).cast("bigint") + 3) % 7 / 6.0)
    hours = [f"hour_{i}" for i in range(1, 24)]
    g = g.withColumns({h: F.when(F.col("h") % 24 == i + 1, 1.0).otherwise(0.0) for i, h in enumerate(hours)})
    past = g.where(F.col("pos") <= 0.7 * scalar_row(g.agg(F.max("pos").alias("n")))["n"])
    p = models.poisson_arrivals(past, g, [*hours, "weekday"], "n")
    return out(p.select("h", "n", "mean", "std"), 4)


@query("ml_gauss_hetero")
def ml_gauss_hetero(t):
    m = t.mach_scored().withColumn("kprice", F.col("price") / 1000.0).withColumn("age", F.col("cycle") / 100.0)
    train = m.where(unit_hash("machine", 54) < 0.7)
    p = models.gauss_heteroscedastic(train, m, ["age", "qty", "kprice"], "rul")
    return out(p.select("machine", "cycle", "mean", "std"), 4)


@query("ml_cv_grid")
def ml_cv_grid(t):
    return out(models.grid_search(feat(t, *PREDICTORS, "kprice"), PREDICTORS, "kprice", [0.01, 1.0], [0.0, 1.0], 3, 7))


@query("ml_residual_hybrid")
def ml_residual_hybrid(t):
    train, test = halves(feat(t))
    return regression_rows(models.residual_hybrid(train, test, PREDICTORS, "kprice", 0.1, 8, 4, 7))


@query("ml_stack")
def ml_stack(t):
    train, test = halves(feat(t))
    s = models.stack(train, test, PREDICTORS, "kprice", "id", 2, 7)
    return out(s.select("oid", "ln", F.col("kprice").alias("actual"), "stacked", "mean", "weighted"), 4)


@query("ml_ar_forecast")
def ml_ar_forecast(t):
    return out(models.ar_forecast(sales_positions(t), "zone", "m", "price", 4, 12), 3)


@query("ml_recursive_lags")
def ml_recursive_lags(t):
    return out(models.recursive_forecast(sales_positions(t), "zone", "pos", "price", [1, 3, 12], 12), 3)


@query(
    "eval_regression_by_group",
    f"""SELECT grp, count(*) AS n, {rnd('sqrt(avg((actual - pred)^2))')} AS rmse, {rnd('avg(abs(actual - pred))')} AS mae FROM scored GROUP BY 1""",
)
def eval_regression_by_group(t):
    m = alarms.regression_metrics(t.scored(), "actual", "pred", ["grp"])
    return out(m.select("grp", "n", "rmse", "mae"))
