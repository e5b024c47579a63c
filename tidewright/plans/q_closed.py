"""Fitted models on inputs for which SQL has the solution in closed form."""

from pyspark.sql import functions as F

from ..functions.exprs import scalar_row, unit_hash
from ..operators import fill, models, relevance
from ..session import settle
from .bindings import h31, rnd
from .q_sources import out
from .q_windows import SM, sales_positions
from .registry import query


@query(
    "ml_poisson_hours",
    f"""WITH g AS (SELECT h, n, h % 24 AS hour, pos <= 0.7::DOUBLE * max(pos) OVER () AS past FROM grid_total),
        m AS (SELECT hour, avg(n) AS mean FROM g WHERE past GROUP BY 1)
        SELECT h, {rnd('mean', 3)} AS mean, {rnd('sqrt(mean)', 3)} AS std FROM g JOIN m USING (hour)""",
)
def ml_poisson_hours(t):
    """One indicator per hour: the rate of an hour is its mean count."""
    g = t.grid(total=True)
    hours = [f"hour_{i}" for i in range(1, 24)]
    g = g.withColumns({h: F.when(F.col("h") % 24 == i + 1, 1.0).otherwise(0.0) for i, h in enumerate(hours)})
    past = g.where(F.col("pos") <= 0.7 * scalar_row(g.agg(F.max("pos").alias("n")))["n"])
    return out(models.poisson_arrivals(past, g, hours, "n").select("h", "mean", "std"), 3)


_TRAIN = f"{h31('id', 53)} / 2147483648.0 < 0.8"


@query(
    "ml_logistic_binary",
    f"""WITH s AS (SELECT id, y, score > 0.5 AS x, {_TRAIN} AS tr FROM scored),
        w AS (SELECT count(*) / 2.0 / sum(y) AS w1, count(*) / 2.0 / sum(1 - y) AS w0 FROM s WHERE tr),
        p AS (SELECT x, any_value(w1) * sum(y) / (any_value(w1) * sum(y) + any_value(w0) * sum(1 - y)) AS p FROM s, w WHERE tr GROUP BY 1)
        SELECT id, {rnd('p', 3)} AS score FROM s JOIN p USING (x) WHERE NOT tr""",
)
def ml_logistic_binary(t):
    """One binary feature: the fitted probability is the weighted share of its side."""
    f = t.scored().withColumn("x", (F.col("score") > 0.5).cast("double")).drop("score")
    train, test = f.where(unit_hash("id", 53) < 0.8), f.where(unit_hash("id", 53) >= 0.8)
    return out(models.logistic_balanced(train, test, ["x"], "y").select("id", "score"), 3)


@query(
    "ml_recursive_one_lag",
    f"""WITH {SM}, k AS (SELECT zone, pos, price / 1000.0 AS v FROM sm),
        l AS (SELECT v AS y, lag(v) OVER (PARTITION BY zone ORDER BY pos) AS x FROM k),
        b AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM l WHERE x IS NOT NULL AND y IS NOT NULL),
        e AS (SELECT zone, arg_max(pos, pos) AS pos, arg_max(v, pos) AS v FROM k GROUP BY zone)
        SELECT zone, pos + step AS pos, step, {rnd('power(b, step) * v + a * (power(b, step) - 1) / (b - 1)', 2)} AS forecast
        FROM e, b, (SELECT unnest(range(1, 7)) AS step)""",
)
def ml_recursive_one_lag(t):
    """One lag: each forecast is intercept + slope * the one before."""
    s = sales_positions(t).withColumn("price", F.col("price") / 1000.0)
    return out(models.recursive_forecast(s, "zone", "pos", "price", [1], 6), 2)


@query(
    "ml_ar_one",
    f"""WITH {SM}, k AS (SELECT zone, m, price / 1000.0 AS v FROM sm WHERE price IS NOT NULL),
        d AS (SELECT zone, m, v, v - lag(v) OVER (PARTITION BY zone ORDER BY m) AS d FROM k),
        l AS (SELECT zone, d AS y, lag(d) OVER (PARTITION BY zone ORDER BY m) AS x FROM d),
        b AS (SELECT zone, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM l WHERE x IS NOT NULL AND y IS NOT NULL GROUP BY 1),
        e AS (SELECT zone, count(d) AS n, max(m) AS m, arg_max(v, m) AS v, arg_max(d, m) AS d FROM d GROUP BY 1),
        f AS (SELECT *, b * (1 - power(b, step)) / (1 - b) AS g FROM e LEFT JOIN b USING (zone), (SELECT unnest(range(1, 7)) AS step))
        SELECT zone, (m + step)::BIGINT AS m, step, CASE WHEN n >= 8 THEN 1 ELSE 0 END::BIGINT AS ar_order,
               {rnd('CASE WHEN n >= 8 THEN v + a / (1 - b) * (step - g) + d * g ELSE v END', 3)} AS forecast FROM f""",
)
def ml_ar_one(t):
    """One lag of the differences and no season: slope and intercept give every forecast."""
    s = sales_positions(t).withColumn("price", F.col("price") / 1000.0)
    return out(models.ar_forecast(s, "zone", "m", "price", 1, 6, season=None), 3)


@query(
    "fs_lasso_one",
    f"""SELECT 'qty' AS feature, {rnd('sign(corr(qty, price)) * greatest(abs(corr(qty, price)) * stddev_samp(price) / 1000.0 - 0.5, 0) / stddev_samp(qty)', 3)} AS score FROM feat""",
)
def fs_lasso_one(t):
    """One column: the coefficient is the covariance after a soft threshold."""
    f = t.feat().select("qty", (F.col("price") / 1000.0).alias("kprice"))
    return out(relevance.lasso(f, ["qty"], "kprice", 0.5), 3)


@query(
    "fs_rfe_two",
    """WITH s AS (SELECT corr(qty, price) AS rq, corr(psize, price) AS rp, corr(qty, psize) AS c FROM feat)
       SELECT 'qty' AS feature, CASE WHEN abs(rq - c * rp) >= abs(rp - c * rq) THEN 1 ELSE 2 END::BIGINT AS rank FROM s
       UNION ALL SELECT 'psize', CASE WHEN abs(rq - c * rp) >= abs(rp - c * rq) THEN 2 ELSE 1 END::BIGINT FROM s""",
)
def fs_rfe_two(t):
    """Two standardised features: the weaker partial coefficient goes first."""
    return relevance.rfe(t.feat(), ["qty", "psize"], "price", 1)


@query(
    "fs_subset_two",
    f"""WITH f AS (SELECT qty, psize, price / 1000.0 AS y, {h31('oid', 51)} / 2147483648.0 < 0.7 AS tr FROM feat),
        s AS (SELECT avg(qty) AS mq, avg(psize) AS mp, avg(y) AS my, var_pop(qty) AS vq, var_pop(psize) AS vp, covar_pop(qty, psize) AS c,
              covar_pop(qty, y) AS cq, covar_pop(psize, y) AS cp FROM f WHERE tr),
        e AS (SELECT y - my - cq / vq * (qty - mq) AS a, y - my - cp / vp * (psize - mp) AS b,
              y - my - (cq * vp - cp * c) / (vq * vp - c * c) * (qty - mq) - (cp * vq - cq * c) / (vq * vp - c * c) * (psize - mp) AS ab
              FROM f, s WHERE NOT tr)
        SELECT 'qty' AS features, 1::BIGINT AS size, {rnd('sqrt(avg(a * a))', 4)} AS rmse FROM e
        UNION ALL SELECT 'psize', 1, {rnd('sqrt(avg(b * b))', 4)} FROM e UNION ALL SELECT 'qty,psize', 2, {rnd('sqrt(avg(ab * ab))', 4)} FROM e""",
)
def fs_subset_two(t):
    """Two predictors: all three regressions in closed form."""
    f = t.feat().withColumn("kprice", F.col("price") / 1000.0)
    train, test = f.where(unit_hash("oid", 51) < 0.7), f.where(unit_hash("oid", 51) >= 0.7)
    return out(relevance.subset_search(train, test, ["qty", "psize"], "kprice"), 4)


_TURN = f"({h31('id', 60)} + r * 104729)"


@query(
    "fs_permutation_one",
    f"""WITH s AS (SELECT id, actual, pred, {_TRAIN} AS tr FROM scored),
        b AS (SELECT regr_slope(actual, pred) AS b, regr_intercept(actual, pred) AS a FROM s WHERE tr),
        n AS (SELECT ceil(count(*) / 1024.0)::BIGINT AS blocks FROM s WHERE NOT tr),
        h AS (SELECT id, actual, pred, r, {h31(_TURN, 61)} % blocks AS block, {h31(_TURN, 62)} AS turn FROM s, n, (SELECT unnest(range(0, 20)) AS r) WHERE NOT tr),
        p AS (SELECT *, coalesce(lead(pred) OVER w, first_value(pred) OVER w) AS other FROM h WINDOW w AS (PARTITION BY r, block ORDER BY turn, id)),
        e AS (SELECT r, avg(abs(actual - a - b * other)) AS error, avg(abs(actual - a - b * pred)) AS whole FROM p, b GROUP BY 1)
        SELECT 'pred' AS feature, {rnd('avg(error) - avg(whole)', 5)} AS score, {rnd('stddev(error)', 5)} AS std FROM e""",
)
def fs_permutation_one(t):
    """One linear column on held-out rows: slope and intercept give every error."""
    f = t.scored().select("id", "actual", "pred")
    train, test = f.where(unit_hash("id", 53) < 0.8), f.where(unit_hash("id", 53) >= 0.8)
    w0, w = relevance.linear_model(train, ["pred"], "actual")
    test = test.withColumnRenamed("pred", "x")
    r = relevance.model_permutation(test, "id", ["x"], "actual", lambda c: c.withColumn("pred", w0 + w["pred"] * F.col("x")), 20, 60, 1024)
    return out(r.withColumn("feature", F.lit("pred")), 5)


@query(
    "fill_chained_two",
    f"""WITH x AS (SELECT oid, ln, CASE WHEN (oid * 7 + ln) % 10 NOT IN (3, 7) THEN qty END AS a,
                          CASE WHEN (oid * 7 + ln) % 10 NOT IN (5, 7) THEN price END AS b FROM feat),
        m AS (SELECT avg(a) AS ma, avg(b) AS mb FROM x),
        c AS (SELECT avg((a - ma) * (b - mb)) AS ab, avg((a - ma) * (a - ma)) AS aa, avg((b - mb) * (b - mb)) AS bb FROM x, m)
        SELECT oid, ln, {rnd('coalesce(a, ma + ab / bb / 1.001 * (b - mb), ma)', 4)} AS a,
               {rnd('coalesce(b, mb + ab / aa / 1.001 * (a - ma), mb)', 3)} AS b FROM x, m, c""",
)
def fill_chained_two(t):
    """With two columns an equation has one predictor; where both are missing the rounds end at the means."""
    place = F.pmod(F.col("oid") * 7 + F.col("ln"), F.lit(10))
    f = t.feat().select(
        "oid", "ln", F.when(~place.isin(3, 7), F.col("qty")).alias("a"), F.when(~place.isin(5, 7), F.col("price")).alias("b")
    )
    f = fill.fill_chained(settle(f, "feat"), ["a", "b"]).select("oid", "ln", F.col("a_filled").alias("a"), F.col("b_filled").alias("b"))
    return out(f, 4, b=3)


@query("fill_chained")
def fill_chained(t):
    """Every numeric feature from its four best predictors."""
    names = ["qty", "price", "disc", "tax", "psize", "retail", "total"]
    f = fill.fill_chained(t.feat_table(masked=True).select("oid", "ln", *names), names, top=4)
    return out(f.select("oid", "ln", F.col("qty_filled").alias("qty"), F.col("price_filled").alias("price")), 3)
