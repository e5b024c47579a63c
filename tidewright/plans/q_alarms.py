"""Queries: joins, alarm evaluation, threshold sweeps, model metrics."""

from pyspark.sql import functions as F

from ..functions.exprs import DAY, hash31, idiv, micros
from ..operators import alarms, joins
from .bindings import h31, rnd
from .q_sources import out
from .registry import query

THR = alarms.Grid(50.0, 4.0, 100)
COSTS = dict(c_alarm=1.0, c_missed=25.0, c_late=10.0)
TOL = 2


@query("join_group_size", "SELECT machine, count(*) AS n, max(cycle) AS length, min(rul) AS last_rul, sum(rul)::BIGINT AS total FROM mach GROUP BY 1")
def join_group_size(t):
    """Group sizes joined back, rul = size - cycle, checked per machine."""
    sized = joins.with_group_size(t.mach().drop("rul", "ftime"), ["machine"], "size")
    sized = sized.withColumn("rul", F.col("size") - F.col("cycle"))
    return sized.groupBy("machine").agg(
        F.count(F.lit(1)).alias("n"), F.max("size").alias("length"), F.min("rul").alias("last_rul"),
        F.sum("rul").alias("total"),
    )


@query(
    "join_profile_lookup",
    f"""WITH p AS (SELECT h % 168 AS slot, stddev(v) AS sd FROM grid GROUP BY 1)
        SELECT key, h, {rnd('v / nullif(sd, 0)', 5)} AS scaled FROM grid LEFT JOIN p ON h % 168 = slot""",
)
def join_profile_lookup(t):
    g = t.grid().withColumn("slot", F.col("h") % 168)
    profile = g.groupBy("slot").agg(F.stddev("v").alias("sd"))
    j = joins.lookup(g, profile, ["slot"])
    return out(j.select("key", "h", F.try_divide("v", "sd").alias("scaled")), 5)


@query(
    "join_weight_map",
    f"""SELECT o_orderkey AS id, {rnd('1.0 / count(*) OVER (PARTITION BY o_orderpriority)', 9)} AS weight FROM orders""",
)
def join_weight_map(t):
    w = joins.class_weights(t.orders.select("o_orderkey", "o_orderpriority"), ["o_orderpriority"])
    return out(w.select(F.col("o_orderkey").alias("id"), "weight"), 9)


@query(
    "join_asof",
    """WITH o AS (SELECT o_orderkey AS id, CASE o_orderpriority WHEN '1-URGENT' THEN 'click' WHEN '2-HIGH' THEN 'error' WHEN '3-MEDIUM' THEN 'purchase' WHEN '4-NOT SPECIFIED' THEN 'signup' ELSE 'view' END AS key,
         epoch_us(TIMESTAMP '2024-01-01') + (epoch_us(o_orderdate) - epoch_us(TIMESTAMP '1995-01-01')) // 80 AS at_us FROM orders)
       SELECT id, o.key, at_us, CAST(s.t AS DOUBLE) AS matched_t, s.value AS asof_value FROM o ASOF LEFT JOIN ser s ON o.key = s.key AND o.at_us >= s.t""",
)
def join_asof(t):
    """Last event value of the mapped type at or before each (rescaled) order time."""
    pairs = [("1-URGENT", "click"), ("2-HIGH", "error"), ("3-MEDIUM", "purchase"), ("4-NOT SPECIFIED", "signup"), ("5-LOW", "view")]
    mapping = F.create_map(*[F.lit(x) for p in pairs for x in p])
    start = micros(F.lit("1995-01-01").cast("timestamp"))
    origin = micros(F.lit("2024-01-01").cast("timestamp"))
    o = t.orders.select(
        F.col("o_orderkey").alias("id"), mapping[F.col("o_orderpriority")].alias("key"),
        (origin + idiv(micros("o_orderdate") - start, 80)).alias("at_us"),
    )
    ser = t.ser()
    j = joins.asof(o, ser, ["key"], "at_us", "t", "event_id", "value")
    return j.withColumn("matched_t", F.col("matched_t").cast("double"))


_INSIDE = 's.t >= w."begin" AND s.t < w."end"'


@query("join_interval_windows", f"SELECT s.event_id, w.pos, w.label FROM ser s JOIN windows w ON {_INSIDE}")
def join_interval_windows(t):
    j = joins.interval_join(t.ser(), t.windows(), "t", "begin", "end", DAY)
    return j.select("event_id", "pos", "label")


@query("join_interval_anti", f"SELECT s.event_id, s.key FROM ser s WHERE NOT EXISTS (SELECT 1 FROM windows w WHERE {_INSIDE})")
def join_interval_anti(t):
    return joins.interval_join(t.ser(), t.windows(), "t", "begin", "end", DAY, how="left_anti").select("event_id", "key")


_POSITIVE = f"(CASE WHEN {h31('event_id', 11)} % 50 = 0 THEN 1 ELSE 0 END)"
_ANOM = f"a AS (SELECT *, {_POSITIVE} AS anom FROM ser_pos)"
_NEAR = f"""{_ANOM}, n AS (SELECT *, max(anom) OVER w AS na, max(value) OVER w AS ns FROM a
  WINDOW w AS (PARTITION BY key ORDER BY pos ROWS BETWEEN {TOL} PRECEDING AND {TOL} FOLLOWING))"""


def anomalous(t):
    return t.ser_pos().withColumn("anom", F.when(F.pmod(hash31("event_id", 11), F.lit(50)) == 0, 1).otherwise(0))


@query(
    "join_tolerance",
    f"""WITH {_ANOM} SELECT p.event_id, CASE WHEN EXISTS (SELECT 1 FROM a q WHERE q.key = p.key AND q.anom = 1 AND abs(q.pos - p.pos) <= {TOL}) THEN 'tp' ELSE 'fp' END AS outcome
        FROM a p WHERE p.value > 120
        UNION ALL SELECT p.event_id, 'fn' FROM a p WHERE p.anom = 1 AND NOT EXISTS (SELECT 1 FROM a q WHERE q.key = p.key AND q.value > 120 AND abs(q.pos - p.pos) <= {TOL})""",
)
def join_tolerance(t):
    near = joins.near_flags(
        anomalous(t), ["key"], "pos",
        {"near_anom": F.col("anom"), "near_pred": F.when(F.col("value") > 120, 1).otherwise(0)}, TOL,
    )
    kinds = F.array_compact(F.array(
        F.when(F.col("value") > 120, F.when(F.col("near_anom") == 1, "tp").otherwise("fp")),
        F.when((F.col("anom") == 1) & (F.col("near_pred") == 0), "fn"),
    ))
    return near.select("event_id", F.explode(kinds).alias("outcome"))


_BUILDING = "(SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')"


@query("join_semi_ids", f"SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN {_BUILDING}")
def join_semi_ids(t):
    return _split(t)[0]


@query("join_anti_ids", f"SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN {_BUILDING}")
def join_anti_ids(t):
    return _split(t)[1]


def _split(t):
    ids = t.customer.where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return joins.split_by_ids(t.orders.select("o_orderkey", "o_custkey"), ids, "o_custkey")


_OPT = """o AS (SELECT p_type AS g, p_size % 4 AS opt, round(sum(p_retailprice) / 1000.0, 2) AS cost, count(*) * 1.0::DOUBLE AS gain FROM part GROUP BY 1, 2),
  cap AS (SELECT sum(c) * 0.9::DOUBLE AS budget FROM (SELECT min(cost) + 0.5 * (max(cost) - min(cost)) AS c FROM o GROUP BY g))"""


@query(
    "join_cross_configs",
    f"""WITH RECURSIVE {_OPT}, g AS (SELECT g, row_number() OVER (ORDER BY g) AS k FROM (SELECT DISTINCT g FROM o)),
        r AS (SELECT CAST(0 AS BIGINT) AS k, 0.0::DOUBLE AS cost, 0.0::DOUBLE AS gain UNION ALL
          SELECT g.k, r.cost + o.cost, r.gain + o.gain FROM r JOIN g ON g.k = r.k + 1 JOIN o ON o.g = g.g)
        SELECT round(max(gain), 2) AS gain, round(min_by(r.cost, (-gain, r.cost)), 2) AS cost FROM r, cap
        WHERE k = (SELECT max(k) FROM g) AND r.cost <= budget""",
)
def join_cross_configs(t):
    """One size class per part type: most parts within the budget."""
    o = t.part.groupBy("p_type", (F.col("p_size") % 4).alias("opt")).agg(
        F.round(F.sum("p_retailprice") / 1000.0, 2).alias("cost"), F.count(F.lit(1)).cast("double").alias("gain")
    )
    caps = o.groupBy("p_type").agg((F.min("cost") + 0.5 * (F.max("cost") - F.min("cost"))).alias("c"))
    budget = caps.agg((F.sum("c") * 0.9).alias("b")).first()["b"]
    best = joins.best_combination(o, "p_type", "opt", "cost", "gain", budget)
    return out(best.select("gain", "cost"), 2)


@query(
    "join_step_effects",
    f"""WITH d AS (SELECT h // 24 AS day, sum(n)::DOUBLE AS n FROM grid GROUP BY 1), e AS (SELECT day // 7 AS week, avg(n) AS effect FROM d GROUP BY 1)
        SELECT day, {rnd('n / effect')} AS relative FROM d JOIN e ON day // 7 = week""",
)
def join_step_effects(t):
    d = t.grid().groupBy(idiv("h", 24).alias("day")).agg(F.sum("n").cast("double").alias("n"))
    d = d.withColumn("week", idiv("day", 7))
    effects = d.groupBy("week").agg(F.avg("n").alias("effect"))
    return out(d.join(effects, "week").select("day", (F.col("n") / F.col("effect")).alias("relative")))


@query(
    "join_premium_flag",
    """WITH z AS (SELECT zone, avg(price) AS m FROM sales GROUP BY 1), c AS (SELECT quantile_cont(m, 0.65) AS cut FROM z)
       SELECT id, zone, CASE WHEN zone IN (SELECT zone FROM z, c WHERE m >= cut) THEN 1 ELSE 0 END::BIGINT AS premium FROM sales""",
)
def join_premium_flag(t):
    from ..operators.premium import premium_flag

    return premium_flag(t.sales(), "zone", "price", 0.65).select("id", "zone", "premium")


def _alarm(thr=200):
    return f"""al AS (SELECT t FROM signal WHERE signal >= {thr}),
      hit AS (SELECT pos, min(t) AS first FROM al JOIN windows ON t >= "begin" AND t < "end" GROUP BY 1)"""


_METRICS = f"""WITH {_alarm()}
  SELECT w.pos, first IS NOT NULL AS detected, CAST(label - first AS DOUBLE) AS advance, CAST(0 AS BIGINT) AS false_alarms FROM windows w LEFT JOIN hit ON w.pos = hit.pos
  UNION ALL SELECT -1, false, NULL, count(*) FROM al WHERE NOT EXISTS (SELECT 1 FROM windows WHERE t >= "begin" AND t < "end")"""


@query("eval_alarm_metrics", _METRICS)
def eval_alarm_metrics(t):
    return alarms.alarm_metrics(t.signal(), t.windows(), "t", "signal", 200.0, DAY)


@query(
    "eval_alarm_cost",
    f"""SELECT *, CAST(1.0 * false_alarms + 25.0 * missed + 10.0 * late AS DOUBLE) AS cost FROM (SELECT sum(false_alarms)::BIGINT AS false_alarms,
        sum(CASE WHEN pos >= 0 AND NOT detected THEN 1 ELSE 0 END)::BIGINT AS missed, sum(CASE WHEN detected AND advance <= 0 THEN 1 ELSE 0 END)::BIGINT AS late FROM ({_METRICS}))""",
)
def eval_alarm_cost(t):
    m = alarms.alarm_metrics(t.signal(), t.windows(), "t", "signal", 200.0, DAY)
    return alarms.alarm_cost(m, **COSTS)


_SWEEP = """WITH g AS (SELECT i, 50.0::DOUBLE + i * 4.0::DOUBLE AS thr FROM (SELECT unnest(range(100)) AS i)),
  al AS (SELECT i, t FROM signal, g WHERE signal >= thr),
  hit AS (SELECT i, pos, min(t) AS first FROM al JOIN windows ON t >= "begin" AND t < "end" GROUP BY 1, 2),
  w AS (SELECT g.i, sum(CASE WHEN first IS NULL THEN 1 ELSE 0 END)::BIGINT AS missed, sum(CASE WHEN label - first <= 0 THEN 1 ELSE 0 END)::BIGINT AS late
    FROM g CROSS JOIN windows LEFT JOIN hit ON hit.i = g.i AND hit.pos = windows.pos GROUP BY 1),
  f AS (SELECT i, count(*) AS fp FROM al WHERE NOT EXISTS (SELECT 1 FROM windows WHERE t >= "begin" AND t < "end") GROUP BY 1),
  c AS (SELECT g.i, thr, coalesce(fp, 0) AS false_alarms, missed, late, CAST(coalesce(fp, 0) * 1.0 + missed * 25.0 + late * 10.0 AS DOUBLE) AS cost
    FROM g JOIN w ON g.i = w.i LEFT JOIN f ON g.i = f.i)"""


@query("thr_sweep_windows", f"{_SWEEP} SELECT * FROM c")
def thr_sweep_windows(t):
    return alarms.sweep_windows(t.signal(), t.windows(), "t", "signal", THR, DAY, **COSTS)


@query("thr_best_windows", f"{_SWEEP} SELECT * FROM c ORDER BY cost, i LIMIT 1")
def thr_best_windows(t):
    return alarms.best_threshold(alarms.sweep_windows(t.signal(), t.windows(), "t", "signal", THR, DAY, **COSTS))


@query(
    "thr_sweep_tolerance",
    f"""WITH {_NEAR}, g AS (SELECT i, 50.0::DOUBLE + i * 4.0::DOUBLE AS thr FROM (SELECT unnest(range(100)) AS i))
        SELECT i, thr, count(*) FILTER (value > thr AND na = 0) AS false_alarms, count(*) FILTER (anom = 1 AND ns <= thr) AS missed,
          CAST(count(*) FILTER (value > thr AND na = 0) + 5.0 * count(*) FILTER (anom = 1 AND ns <= thr) AS DOUBLE) AS cost
        FROM g, n GROUP BY 1, 2""",
)
def thr_sweep_tolerance(t):
    return alarms.sweep_tolerance(anomalous(t), ["key"], "pos", "value", "anom", TOL, THR, 1.0, 5.0)


def _rowwise(op):
    return f"""WITH r AS (SELECT min(score) AS lo, (max(score) - min(score)) / 99.0 AS step FROM scored),
      g AS (SELECT i, lo + i * step AS thr FROM r, (SELECT unnest(range(100)) AS i))
      SELECT i, {rnd('thr')} AS thr, count(*) FILTER (score {op} thr AND y = 0) AS false_alarms, count(*) FILTER (NOT (score {op} thr) AND y = 1) AS missed,
        CAST(count(*) FILTER (score {op} thr AND y = 0) + 3.0 * count(*) FILTER (NOT (score {op} thr) AND y = 1) AS DOUBLE) AS cost
      FROM g, scored GROUP BY i, g.thr"""


@query("thr_sweep_rowwise", _rowwise(">"))
def thr_sweep_rowwise(t):
    return out(alarms.sweep_rows(t.scored(), "score", "y", 100, 1.0, 3.0))


@query("thr_sweep_rowwise_low", _rowwise("<"))
def thr_sweep_rowwise_low(t):
    return out(alarms.sweep_rows(t.scored(), "score", "y", 100, 1.0, 3.0, low_is_anomaly=True))


_POLICY = """SELECT {head} sum(CASE WHEN stop IS NULL THEN 800.0 ELSE -greatest(0, stop - 500) END)::DOUBLE AS cost,
  sum(CASE WHEN stop IS NULL THEN 1 ELSE 0 END)::BIGINT AS fails, sum(CASE WHEN stop IS NULL THEN 0 ELSE len - stop END)::BIGINT AS slack"""


@query(
    "policy_rul_cost",
    f"{_POLICY.replace('{head}', '')} FROM (SELECT machine, min(CASE WHEN pred < 12 THEN cycle - 1 END) AS stop, max(cycle) AS len FROM mach_scored GROUP BY 1)",
)
def policy_rul_cost(t):
    return alarms.rul_policy(t.mach_scored(), "machine", "cycle", "pred", 12.0, 800.0, 500.0)


@query(
    "thr_sweep_rul",
    f"""WITH g AS (SELECT i, i - 2.0::DOUBLE AS thr FROM (SELECT unnest(range(52)) AS i)),
        s AS (SELECT i, thr, machine, min(CASE WHEN pred < thr THEN cycle - 1 END) AS stop, max(cycle) AS len FROM mach_scored, g GROUP BY 1, 2, 3)
        {_POLICY.replace('{head}', 'i, thr,')} FROM s GROUP BY 1, 2""",
)
def thr_sweep_rul(t):
    return alarms.sweep_rul(t.mach_scored(), "machine", "cycle", "pred", alarms.Grid(-2.0, 1.0, 52), 800.0, 500.0)


@query(
    "eval_regression",
    f"""SELECT count(*) AS n, {rnd('sqrt(avg((actual - pred)^2))')} AS rmse, {rnd('avg(abs(actual - pred))')} AS mae,
        {rnd('1 - sum((actual - pred)^2) / (var_pop(actual) * count(*))')} AS r2, {rnd('stddev(actual - pred)')} AS residual_std FROM scored""",
)
def eval_regression(t):
    return out(alarms.regression_metrics(t.scored(), "actual", "pred"))


@query(
    "eval_confusion",
    f"""WITH c AS (SELECT count(*) FILTER (y = 0 AND score < 0.6) AS tn, count(*) FILTER (y = 0 AND score >= 0.6) AS fp,
          count(*) FILTER (y = 1 AND score < 0.6) AS fn, count(*) FILTER (y = 1 AND score >= 0.6) AS tp FROM scored)
        SELECT *, '0' AS cls, {rnd('tn / (tn + fn)')} AS precision, {rnd('tn / (tn + fp)')} AS recall, {rnd('2 * tn / (2 * tn + fn + fp)')} AS f1 FROM c
        UNION ALL SELECT *, '1', {rnd('tp / (tp + fp)')}, {rnd('tp / (tp + fn)')}, {rnd('2 * tp / (2 * tp + fp + fn)')} FROM c""",
)
def eval_confusion(t):
    return out(alarms.confusion(t.scored(), "y", F.col("score") >= 0.6))


@query(
    "eval_roc_auc",
    f"""WITH r AS (SELECT y, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS rk FROM scored),
        c AS (SELECT sum(y)::BIGINT AS p, (count(*) - sum(y))::BIGINT AS n, sum(CASE WHEN y = 1 THEN rk END) AS s FROM r)
        SELECT p AS positives, n AS negatives, {rnd('(s - p * (p + 1) / 2.0) / (p * n)')} AS auc FROM c""",
)
def eval_roc_auc(t):
    return out(alarms.roc_auc(t.scored(), "y", "score"))


@query(
    "eval_pred_spread",
    f"""SELECT CAST(floor(actual / 20) AS BIGINT) AS actual_value, count(*) AS n, {rnd('min(pred)')} AS lo, {rnd('max(pred)')} AS hi,
        {rnd('quantile_cont(pred, 0.25)')} AS q1, {rnd('quantile_cont(pred, 0.5)')} AS median, {rnd('quantile_cont(pred, 0.75)')} AS q3 FROM scored GROUP BY 1""",
)
def eval_pred_spread(t):
    return out(alarms.prediction_spread(t.scored(), F.floor(F.col("actual") / 20), "pred"))


@query(
    "eval_fairness_gap",
    f"""WITH a AS (SELECT avg(pred) AS m FROM scored)
        SELECT 'grp' AS attribute, grp AS level, count(*) AS n, {rnd('avg(pred)')} AS mean, {rnd('stddev(pred)')} AS std, {rnd('abs(avg(pred) - m)')} AS gap FROM scored, a GROUP BY grp, m
        UNION ALL SELECT 'y', CAST(y AS VARCHAR), count(*), {rnd('avg(pred)')}, {rnd('stddev(pred)')}, {rnd('abs(avg(pred) - m)')} FROM scored, a GROUP BY y, m""",
)
def eval_fairness_gap(t):
    return out(alarms.group_gaps(t.scored(), ["grp", "y"], "pred"))


@query(
    "eval_fairness_didi",
    f"""WITH a AS (SELECT avg(pred) AS m FROM scored), g AS (SELECT abs(avg(pred) - m) AS gap FROM scored, a GROUP BY grp, m
        UNION ALL SELECT abs(avg(pred) - m) FROM scored, a GROUP BY y, m) SELECT {rnd('sum(gap)')} AS didi FROM g""",
)
def eval_fairness_didi(t):
    return out(alarms.disparity(t.scored(), ["grp", "y"], "pred"))
