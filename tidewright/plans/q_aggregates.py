"""Queries: aggregates and resampling."""

from pyspark.sql import functions as F

from ..functions.exprs import DAY, HOUR, MINUTE, idiv, round_half_even, rounded
from ..operators import aggregates as agg
from ..operators import resample
from ..operators.joins import macro_join
from ..operators.quantiles import exact_quantiles
from ..operators.windows import diff
from .bindings import FEATURES, rnd
from .q_sources import features_long, out
from .registry import query

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
TYPES = ["click", "error", "purchase", "signup", "view"]


@query(
    "agg_describe",
    features_long(
        FEATURES,
        "SELECT '{c}' AS feature, count({c}) AS n, round(avg({c}), 3) AS mean, round(stddev({c}), 3) AS std, "
        "round(min({c}), 3) AS min, round(quantile_cont({c}, 0.25), 3) AS q25, round(quantile_cont({c}, 0.5), 3) AS q50, "
        "round(quantile_cont({c}, 0.75), 3) AS q75, round(max({c}), 3) AS max FROM feat_masked",
    ),
)
def agg_describe(t):
    return out(agg.describe(t.feat_table(masked=True), FEATURES), 3)


@query(
    "agg_value_counts",
    f"""SELECT o_orderpriority, count(*) AS n, {rnd('count(*) / (SELECT count(*) FROM orders)')} AS share
        FROM orders GROUP BY 1""",
)
def agg_value_counts(t):
    return out(agg.value_counts(t.orders, "o_orderpriority"))


@query(
    "agg_group_mean_topk",
    f"SELECT zone, {rnd('avg(price)', 3)} AS mean, count(*) AS n FROM sales GROUP BY 1 ORDER BY avg(price) DESC, zone LIMIT 10",
)
def agg_group_mean_topk(t):
    return out(agg.group_mean_top(t.sales(), "zone", "price", 10), 3)


_SKEW = """CASE WHEN n >= 3 THEN coalesce((m3_{c} / n) / nullif(power(m2_{c} / n, 1.5), 0), 0)
  * sqrt(n * (n - 1.0)) / (n - 2.0) END"""


@query(
    "agg_bin_features",
    f"""WITH b AS (SELECT *, (cycle - 1) // 32 AS bin FROM mach),
        m AS (SELECT *, avg(qty) OVER w AS mq, avg(price) OVER w AS mp FROM b WINDOW w AS (PARTITION BY machine, bin)),
        a AS (SELECT machine, bin, count(*) AS n, avg(qty) AS qm, stddev(qty) AS qs, sum((qty - mq)^2) AS m2_qty, sum((qty - mq)^3) AS m3_qty,
          avg(price) AS pm, stddev(price) AS ps, sum((price - mp)^2) AS m2_price, sum((price - mp)^3) AS m3_price,
          min_by(disc, cycle) AS disc_first, min_by(tax, cycle) AS tax_first FROM m GROUP BY 1, 2)
        SELECT machine, bin, n, {rnd('qm', 5)} AS qty_mean, {rnd('qs', 5)} AS qty_std, {rnd(_SKEW.replace('{c}', 'qty'), 5)} AS qty_skew,
          {rnd('pm', 7)} AS price_mean, {rnd('ps', 3)} AS price_std, {rnd(_SKEW.replace('{c}', 'price'), 5)} AS price_skew,
          disc_first, tax_first FROM a""",
)
def agg_bin_features(t):
    b = agg.bin_features(t.mach(), "machine", "cycle", 32, ["qty", "price"], ["disc", "tax"])
    return out(b, 5, price_mean=7, price_std=3)


@query(
    "agg_monthly_panel",
    f"""SELECT year(date) * 12 + month(date) - 1 AS month, round(quantile_cont(price, 0.5), 3) AS price,
        {rnd("avg(CASE WHEN type = '1-URGENT' THEN 1.0 ELSE 0.0 END)")} AS urgent_ratio,
        {rnd('avg(zone)')} AS avg_zone, count(price) AS sales_count FROM sales GROUP BY 1""",
)
def agg_monthly_panel(t):
    s = t.sales().withColumn("month", resample.month_number("date"))
    base = s.groupBy("month").agg(
        F.avg(F.when(F.col("type") == "1-URGENT", 1.0).otherwise(0.0)).alias("urgent_ratio"),
        F.avg("zone").alias("avg_zone"), F.count("price").alias("sales_count"),
    )
    middle = exact_quantiles(s, ["month"], "price", {"price": 0.5}).withColumnRenamed("month", "_m")
    return out(base.join(middle, F.col("month").eqNullSafe(F.col("_m")), "left").drop("_m"), price=3)


@query(
    "agg_pivot_share",
    "SELECT year(o_orderdate) AS year, "
    + ", ".join(f"count(*) FILTER (o_orderpriority = '{p}') AS n_{i}" for i, p in enumerate(PRIORITIES))
    + ", "
    + ", ".join(rnd(f"count(*) FILTER (o_orderpriority = '{p}') / count(*)") + f" AS share_{i}" for i, p in enumerate(PRIORITIES))
    + ", count(*) AS total FROM orders GROUP BY 1",
)
def agg_pivot_share(t):
    o = t.orders.select(F.year("o_orderdate").alias("year"), "o_orderpriority")
    return out(agg.pivot_counts(o, "year", "o_orderpriority", PRIORITIES))


@query(
    "agg_row_total",
    "SELECT t // 3600000000 AS h, "
    + ", ".join(f"count(*) FILTER (key = '{k}') AS n_{k}" for k in TYPES)
    + ", count(*) AS total FROM ser GROUP BY 1",
)
def agg_row_total(t):
    counts = t.ser().groupBy(idiv("t", HOUR).alias("h")).agg(
        *[F.count(F.when(F.col("key") == k, 1)).alias(f"n_{k}") for k in TYPES],
        F.count(F.lit(1)).alias("total"),
    )
    return counts


@query(
    "agg_target_rate",
    f"""WITH o AS (SELECT *, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y,
          (SELECT min(o_totalprice) FROM orders) AS lo, (SELECT max(o_totalprice) FROM orders) AS hi FROM orders)
        SELECT 'category' AS kind, o_orderpriority AS level, count(*) AS n, {rnd('avg(y)')} AS rate FROM o GROUP BY 1, 2
        UNION ALL SELECT 'bin', CAST(least(CAST(floor((o_totalprice - lo) / (hi - lo) * 10) AS BIGINT), 9) AS VARCHAR),
          count(*), {rnd('avg(y)')} FROM o GROUP BY 1, 2""",
)
def agg_target_rate(t):
    o = t.orders.withColumn("y", F.when(F.col("o_orderstatus") == "F", 1).otherwise(0))
    cat = agg.target_rate_by_category(o, "o_orderpriority", "y").withColumn("kind", F.lit("category"))
    bins = agg.target_rate_by_bin(o, "o_totalprice", "y", 10).withColumn("kind", F.lit("bin"))
    return out(cat.unionByName(bins))


@query(
    "agg_hist",
    f"""WITH r AS (SELECT min(value) AS lo, max(value) AS hi, count(*) AS c FROM ser)
        SELECT least(CAST(floor((value - lo) / (hi - lo) * 40) AS BIGINT), 39) AS bin,
          {rnd('lo + bin * ((hi - lo) / 40)')} AS "left", count(*) AS n, {rnd('count(*) / c / ((hi - lo) / 40)')} AS density
        FROM ser, r GROUP BY bin, lo, hi, c""",
)
def agg_hist(t):
    return out(agg.histogram(t.ser(), "value", 40))


@query(
    "agg_hist2d",
    """WITH x AS (SELECT value, (t // 1000000) % 86400 / 3600.0 AS hod FROM ser),
       r AS (SELECT min(value) AS vl, max(value) AS vh, min(hod) AS hl, max(hod) AS hh FROM x)
       SELECT least(CAST(floor((hod - hl) / (hh - hl) * 24) AS BIGINT), 23) AS xbin,
         least(CAST(floor((value - vl) / (vh - vl) * 20) AS BIGINT), 19) AS ybin, count(*) AS n FROM x, r GROUP BY 1, 2""",
)
def agg_hist2d(t):
    s = t.ser().withColumn("hod", (idiv("t", 1_000_000) % 86400) / 3600.0)
    return agg.histogram2d(s, "hod", "value", 24, 20)


@query(
    "agg_corr_matrix",
    " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, {rnd(f'corr({a}, {b})')} AS r FROM feat"
        for i, a in enumerate(FEATURES) for b in FEATURES[i + 1 :]
    ),
)
def agg_corr_matrix(t):
    return out(agg.correlation_long(t.feat(), FEATURES, complete=True))


@query(
    "agg_corr_pairwise",
    " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, {rnd(f'corr({a}, {b})')} AS r FROM feat_masked"
        for a, b in (("qty", "price"), ("qty", "total"), ("price", "total"))
    ),
)
def agg_corr_pairwise(t):
    return out(agg.correlation_long(t.feat(masked=True), ["qty", "price", "total"]))


_DOW = "(((h // 24) + 3) % 7)"


@query(
    "agg_calendar_profile",
    " UNION ALL ".join(
        f"SELECT '{u}' AS unit, {e} AS slot, count(n) AS n, {rnd('avg(n)')} AS mean, {rnd('stddev(n)')} AS std FROM grid_total GROUP BY 1, 2"
        for u, e in (("month", "month(to_timestamp(h * 3600))"), ("weekday", _DOW), ("hour", "h % 24"))
    ),
)
def agg_calendar_profile(t):
    g = t.grid(total=True)
    when = F.timestamp_micros(F.col("h") * HOUR)
    slots = {"month": F.month(when), "weekday": F.weekday(when), "hour": F.hour(when)}
    return out(agg.profile_by(g, slots, "n"))


@query(
    "agg_slot_std",
    " UNION ALL ".join(
        f"SELECT '{name}' AS unit, ((t // 1000000 + 3 * 86400) % 604800) // {sec} AS slot, count(value) AS n, "
        f"{rnd('avg(value)', 5)} AS mean, {rnd('stddev(value)', 5)} AS std FROM ser GROUP BY 1, 2"
        for name, sec in (("half", 1800), ("one", 3600), ("two", 7200))
    ),
)
def agg_slot_std(t):
    second = (idiv("t", 1_000_000) + 3 * 86400) % 604800
    slots = {n: idiv(second, s) for n, s in (("half", 1800), ("one", 3600), ("two", 7200))}
    return out(agg.profile_by(t.ser(), slots, "value"), 5)


_HE = "(CASE WHEN (t % {s}) * 2 > {s} OR ((t % {s}) * 2 = {s} AND (t // {s}) % 2 = 1) THEN t // {s} + 1 ELSE t // {s} END) * {s}"


@query(
    "agg_gap_profile",
    f"""WITH r AS (SELECT key, event_id, t, {_HE.replace('{s}', '120000000')} AS rt FROM ser),
        d AS (SELECT key, rt - lag(rt) OVER (PARTITION BY key ORDER BY t, event_id) AS gap FROM r)
        SELECT key, gap // 60000000 AS gap_minutes, count(*) AS n FROM d WHERE gap IS NOT NULL GROUP BY 1, 2""",
)
def agg_gap_profile(t):
    s = t.ser_pos().withColumn("rt", round_half_even("t", 2 * MINUTE))
    gaps = diff(s, ["key"], "pos", "rt").where("rt_diff IS NOT NULL")
    return gaps.groupBy("key", idiv("rt_diff", MINUTE).alias("gap_minutes")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "agg_fail_stats",
    f"""SELECT count(*) AS machines, min(f) AS safe_interval, max(f) AS maintenance_cost, {rnd('avg(f)')} AS mean_length
        FROM (SELECT machine, max(cycle) AS f FROM mach GROUP BY 1)""",
)
def agg_fail_stats(t):
    """Failure time per machine is its row count, so no ordering is needed."""
    per = t.lineitem.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("f"))
    return out(per.agg(
        F.count(F.lit(1)).alias("machines"), F.min("f").alias("safe_interval"),
        F.max("f").alias("maintenance_cost"), F.avg("f").alias("mean_length"),
    ))


@query(
    "agg_fold_mean",
    f"""WITH f AS (SELECT id % 5 AS fold, avg(abs(actual - pred)) AS mae, sqrt(avg((actual - pred)^2)) AS rmse FROM scored GROUP BY 1)
        SELECT 'mae' AS metric, {rnd('avg(mae)')} AS mean, {rnd('stddev(mae)')} AS std FROM f
        UNION ALL SELECT 'rmse', {rnd('avg(rmse)')}, {rnd('stddev(rmse)')} FROM f""",
)
def agg_fold_mean(t):
    err = F.col("actual") - F.col("pred")
    folds = t.scored().groupBy((F.col("id") % 5).alias("fold")).agg(
        F.avg(F.abs(err)).alias("mae"), F.sqrt(F.avg(err * err)).alias("rmse")
    )
    long = agg.melt(folds, ["fold"], ["mae", "rmse"])
    return out(long.groupBy(F.col("feature").alias("metric")).agg(
        F.avg("value").alias("mean"), F.stddev("value").alias("std")
    ))


@query(
    "agg_poisson_fit",
    f"""WITH c AS (SELECT h % 24 AS hour, n AS k, count(*) AS c FROM grid_total GROUP BY 1, 2),
        m AS (SELECT hour AS h2, sum(k * c) / sum(c) AS mu, sum(c) AS tot FROM c GROUP BY 1)
        SELECT hour, k, {rnd('mu')} AS mu, {rnd('c / tot')} AS observed, {rnd('exp(k * ln(mu) - mu - lgamma(k + 1))')} AS poisson
        FROM c JOIN m ON hour = h2""",
)
def agg_poisson_fit(t):
    g = t.grid(total=True).withColumn("hour", F.col("h") % 24)
    return out(agg.poisson_fit(g, "hour", "n"))


@query(
    "rs_month_median",
    "SELECT year(date) * 12 + month(date) - 1 AS month, round(quantile_cont(price, 0.5), 3) AS median FROM sales GROUP BY 1",
)
def rs_month_median(t):
    s = t.sales().withColumn("month", resample.month_number("date"))
    return out(exact_quantiles(s, ["month"], "price", {"median": 0.5}), 3)


@query(
    "rs_down_up",
    f"""WITH wk AS (SELECT epoch_us(date) // 604800000000 AS w, avg(price) AS v FROM sales GROUP BY 1),
        dn AS (SELECT year(d) * 12 + month(d) - 1 AS month, avg(v) AS weekly FROM
          (SELECT make_timestamp(w * 604800000000) AS d, v FROM wk) GROUP BY 1),
        yr AS (SELECT year(date) * 12 AS month, avg(price) AS v FROM sales GROUP BY 1),
        up AS (SELECT m AS month, last_value(yr.v IGNORE NULLS) OVER (ORDER BY m ROWS UNBOUNDED PRECEDING) AS yearly FROM
          (SELECT unnest(range(min(month), max(month) + 1)) AS m FROM yr) LEFT JOIN yr ON m = yr.month)
        SELECT month, {rnd('weekly', 3)} AS weekly, {rnd('yearly', 3)} AS yearly FROM dn FULL JOIN up USING (month)""",
)
def rs_down_up(t):
    """Weekly means averaged per month; yearly means carried forward to every month."""
    s = t.sales().select("date", "price")
    week = s.groupBy(idiv(F.unix_micros(F.col("date").cast("timestamp")), 7 * DAY).alias("w")).agg(F.avg("price").alias("v"))
    down = week.groupBy(resample.month_number(resample.cell_start("w", 7 * DAY)).alias("month")).agg(F.avg("v").alias("weekly"))
    year = s.groupBy((F.year("date") * 12).cast("bigint").alias("month")).agg(F.avg("price").alias("yearly"))
    up = resample.upsample_forward(year, [], "month", "yearly").select("month", "yearly")
    return out(down.join(up, "month", "full_outer"), 3)


@query(
    "rs_ohlc",
    """SELECT key, t // 864000000000 * 864000000000 AS cell, min_by(value, (t, event_id)) AS open, max(value) AS high,
       min(value) AS low, max_by(value, (t, event_id)) AS close FROM ser GROUP BY 1, 2""",
)
def rs_ohlc(t):
    return resample.ohlc(t.ser(), ["key"], "t", "event_id", "value", 10 * DAY)


@query(
    "rs_asfreq",
    f"""WITH m AS (SELECT zone, m, avg(price) AS v FROM (SELECT zone, price, year(date) * 12 + month(date) - 1 AS m FROM sales) GROUP BY 1, 2) SELECT zone, m, {rnd('v', 3)} AS v FROM m WHERE v IS NOT NULL""",
)
def rs_asfreq(t):
    """Sales per zone at monthly frequency; months without one are dropped again."""
    m = t.sales().groupBy("zone", resample.month_number("date").alias("m")).agg(F.avg("price").alias("v"))
    return out(resample.dense_grid(m, ["zone"], "m").where("v IS NOT NULL").select("zone", "m", "v"), 3)


@query(
    "join_macro_outer",
    f"""WITH s AS (SELECT year(date) * 12 + month(date) - 1 AS month, avg(price) AS price FROM sales GROUP BY 1),
        a AS (SELECT year(l_shipdate) * 12 + month(l_shipdate) - 1 AS month, avg(l_extendedprice) AS rate FROM lineitem GROUP BY 1),
        masked AS (SELECT month, CASE WHEN month % 5 <> 2 THEN rate END AS rate FROM a),
        b AS (SELECT year(l_shipdate) * 12 AS month, avg(l_quantity) AS income FROM lineitem GROUP BY 1),
        j AS (SELECT s.month, price, rate, income FROM s LEFT JOIN (SELECT coalesce(k.month, b.month) AS month, rate, income FROM masked k FULL JOIN b ON k.month = b.month) m ON s.month = m.month)
        SELECT month, {rnd('price', 3)} AS price, {rnd('last_value(rate IGNORE NULLS) OVER w', 3)} AS rate,
          {rnd('last_value(income IGNORE NULLS) OVER w', 4)} AS income FROM j WINDOW w AS (ORDER BY month ROWS UNBOUNDED PRECEDING)""",
)
def join_macro_outer(t):
    s = t.sales().groupBy(resample.month_number("date").alias("month")).agg(F.avg("price").alias("price"))
    line = t.lineitem
    rate = line.groupBy(resample.month_number("l_shipdate").alias("month")).agg(F.avg("l_extendedprice").alias("rate"))
    masked = rate.withColumn("rate", F.when(F.col("month") % 5 != 2, F.col("rate")))
    income = line.groupBy((F.year("l_shipdate") * 12).cast("bigint").alias("month")).agg(F.avg("l_quantity").alias("income"))
    return out(macro_join(s, masked, income, "month", ["rate", "income"]), 3, income=4)
