"""Queries: window and sequence operators."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.exprs import HOUR, MINUTE, hash31, rounded
from ..operators import resample, windows
from .bindings import h31, rnd
from .q_sources import out
from .registry import query


def sales_positions(t):
    """Zone-month table with a gap-free position; at most one row per zone and month, so the
    row number per zone is bounded by the calendar."""
    w = Window.partitionBy("zone").orderBy("m")
    return t.sales_month().withColumn("pos", F.row_number().over(w).cast("bigint"))


SM = "sm AS (SELECT *, row_number() OVER (PARTITION BY zone ORDER BY m) AS pos FROM sales_month)"


@query(
    "win_lag_features",
    f"WITH {SM} SELECT zone, m, "
    + ", ".join(rnd(f"lag(price, {k}) OVER (PARTITION BY zone ORDER BY m)", 3) + f" AS price_lag_{k}" for k in (1, 3, 12))
    + " FROM sm",
)
def win_lag_features(t):
    lagged = windows.lag_by_position(sales_positions(t), ["zone"], "pos", "price", [1, 3, 12])
    return out(lagged.select("zone", "m", "price_lag_1", "price_lag_3", "price_lag_12"), 3)


@query(
    "win_lag_series",
    "SELECT key, event_id, lag(value, 1) OVER w AS value_lag_1, lag(value, 7) OVER w AS value_lag_7 FROM ser_pos WINDOW w AS (PARTITION BY key ORDER BY pos)",
)
def win_lag_series(t):
    lagged = windows.lag_by_position(t.ser_pos(), ["key"], "pos", "value", [1, 7])
    return lagged.select("key", "event_id", "value_lag_1", "value_lag_7")


@query(
    "win_lead_target",
    """SELECT * FROM (SELECT zone, year, label, CAST(lead(label, 2) OVER (PARTITION BY zone ORDER BY year) AS BIGINT) AS target
       FROM (SELECT zone, year, CAST(label AS BIGINT) AS label FROM panel)) WHERE target IS NOT NULL""",
)
def win_lead_target(t):
    w = Window.partitionBy("zone").orderBy("year")
    p = t.panel().select(
        "zone", F.col("year").cast("bigint").alias("year"), F.col("label").cast("bigint").alias("label"),
        F.row_number().over(w).cast("bigint").alias("pos"),
    )
    return windows.lead_target(p, ["zone"], "pos", "label", 2, "target").drop("pos")


_HE = "(CASE WHEN (t % {s}) * 2 > {s} OR ((t % {s}) * 2 = {s} AND (t // {s}) % 2 = 1) THEN t // {s} + 1 ELSE t // {s} END) * {s}"


@query(
    "win_diff",
    f"""WITH r AS (SELECT *, {_HE.replace('{s}', '600000000')} AS t10 FROM ser_pos)
        SELECT key, event_id, CAST(t - lag(t) OVER w AS DOUBLE) AS t_diff, CAST(t10 - lag(t10) OVER w AS DOUBLE) AS t10_diff
        FROM r WINDOW w AS (PARTITION BY key ORDER BY pos)""",
)
def win_diff(t):
    from ..functions.exprs import round_half_even

    s = t.ser_pos().withColumn("t10", round_half_even("t", 10 * MINUTE))

    from ..operators.ordered import framed

    d = framed(
        s, ["key"], "pos", 1, 0,
        lambda w: {c: (F.col(a) - F.lag(a).over(w)).cast("double") for c, a in (("t_diff", "t"), ("t10_diff", "t10"))},
    )
    return d.select("key", "event_id", "t_diff", "t10_diff")


@query(
    "win_pct_change",
    f"SELECT key, h, {rnd('(v - lag(v) OVER w) / nullif(lag(v) OVER w, 0)')} AS v_ret FROM grid_total WINDOW w AS (PARTITION BY key ORDER BY h)",
)
def win_pct_change(t):
    return out(windows.pct_change(t.grid(total=True), ["key"], "pos", "v").select("key", "h", "v_ret"))


@query(
    "win_rolling_mean_std",
    f"""SELECT key, h, {rnd('CASE WHEN count(v) OVER w = 12 THEN avg(v) OVER w END')} AS roll_mean,
        {rnd('CASE WHEN count(v) OVER w = 12 THEN stddev(v) OVER w END')} AS roll_std
        FROM grid WINDOW w AS (PARTITION BY key ORDER BY h ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)""",
)
def win_rolling_mean_std(t):
    return out(windows.rolling(t.grid(), ["key"], "pos", "v", 11, 0).select("key", "h", "roll_mean", "roll_std"))


@query(
    "win_rolling_centered",
    f"""SELECT zone, m, {rnd('CASE WHEN count(price) OVER w = 3 THEN avg(price) OVER w END', 3)} AS roll_mean
        FROM sales_month WINDOW w AS (PARTITION BY zone ORDER BY m ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)""",
)
def win_rolling_centered(t):
    return out(windows.rolling(sales_positions(t), ["zone"], "pos", "price", 1, 1).select("zone", "m", "roll_mean"), 3)


@query(
    "win_sliding_array",
    """SELECT key, event_id, array_to_string(w, ',') AS win FROM (
         SELECT key, event_id, pos, list(CAST(round(value * 100) AS BIGINT)) OVER (PARTITION BY key ORDER BY pos ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS w
         FROM ser_pos) WHERE pos >= 8""",
)
def win_sliding_array(t):
    s = windows.sliding_arrays(t.ser_pos(), ["key"], "pos", ["value"], 8)
    cents = F.transform("window", lambda x: F.round(x * 100).cast("bigint").cast("string"))
    return s.select("key", "event_id", F.array_join(cents, ",").alias("win"))


@query(
    "win_sliding_panel",
    """SELECT machine, cycle, rul, array_to_string(w, ',') AS win FROM (
         SELECT machine, cycle, rul, list(CAST(CAST(qty AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(round(price * 100) AS BIGINT) AS VARCHAR))
           OVER (PARTITION BY machine ORDER BY cycle ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS w
         FROM mach) WHERE cycle >= 10 AND (cycle - 10) % 5 = 0""",
)
def win_sliding_panel(t):
    s = windows.sliding_arrays(t.mach(), ["machine"], "cycle", ["qty", "price"], 10, stride=5)
    text = F.transform(
        "window",
        lambda x: F.concat_ws(
            ":", x["qty"].cast("bigint").cast("string"), F.round(x["price"] * 100).cast("bigint").cast("string")
        ),
    )
    return s.select("machine", "cycle", "rul", F.array_join(text, ",").alias("win"))


@query(
    "win_seq_target",
    f"""WITH {SM}, r AS (SELECT zone, m, pos, CAST(round(price * 100) AS BIGINT) AS p FROM sm),
        w AS (SELECT zone, m, list(p) OVER (PARTITION BY zone ORDER BY m ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS past,
          list(p) OVER (PARTITION BY zone ORDER BY m ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING) AS future FROM r)
        SELECT zone, m, array_to_string(past, ',') AS past, array_to_string(future, ',') AS future FROM w
        WHERE len(past) = 6 AND len(future) = 3""",
)
def win_seq_target(t):
    s = sales_positions(t).withColumn("p", F.round(F.col("price") * 100).cast("bigint"))
    pairs = windows.sequence_targets(s, ["zone"], "pos", "p", 6, 3)
    return pairs.select(
        "zone", "m", F.array_join(F.col("past").cast("array<string>"), ",").alias("past"),
        F.array_join(F.col("future").cast("array<string>"), ",").alias("future"),
    )


@query("win_stride_sample", "SELECT key, event_id, value FROM ser_pos WHERE (pos - 1) % 48 = 0")
def win_stride_sample(t):
    return windows.stride_sample(t.ser_pos(), "pos", 48).select("key", "event_id", "value")


@query(
    "win_acf",
    "WITH c AS (SELECT key, h, n - avg(n) OVER (PARTITION BY key) AS d FROM grid), l AS (SELECT key, d, "
    + ", ".join(f"lag(d, {k}) OVER (PARTITION BY key ORDER BY h) AS l{k}" for k in range(1, 25))
    + " FROM c) "
    + " UNION ALL ".join(
        f"SELECT key, CAST({k} AS BIGINT) AS lag, {rnd(f'sum(d * l{k}) / sum(d * d)')} AS acf FROM l GROUP BY key" for k in range(1, 25)
    ),
)
def win_acf(t):
    return out(windows.autocorrelation(t.grid(), ["key"], "pos", "n", 24))


@query("win_pacf")
def win_pacf(t):
    acf = windows.autocorrelation(t.grid(), ["key"], "pos", "n", 24)
    return out(windows.partial_autocorrelation(acf, "key"))


@query(
    "win_ewm",
    f"""SELECT a.key, a.h, {rnd('sum(b.v * power(0.7, a.pos - b.pos)) / sum(CASE WHEN b.v IS NOT NULL THEN power(0.7, a.pos - b.pos) END)')} AS ewm
        FROM grid a JOIN grid b ON a.key = b.key AND b.pos <= a.pos GROUP BY 1, 2""",
)
def win_ewm(t):
    return out(windows.ewm_mean(t.grid(), ["key"], "pos", "v", 0.3, "ewm").select("key", "h", "ewm"))


def hazard():
    return (F.pmod(hash31("id", 9), F.lit(100)) + 1) / 401.0


@query(
    "win_cumprod_survival",
    f"""WITH s AS (SELECT o_custkey AS machine, o_orderkey AS id, (({h31('o_orderkey', 9)}) % 100 + 1) / 401.0 AS hz,
          row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS pos FROM orders)
        SELECT machine, id, {rnd('exp(sum(ln(1 - hz)) OVER (PARTITION BY machine, (pos - 1) // 8 ORDER BY pos))', 9)} AS survival FROM s""",
)
def win_cumprod_survival(t):
    """Survival along look-ahead runs of 8 scored rows per customer."""
    from ..functions.exprs import idiv
    from ..operators.ordered import positions

    o = t.orders.select(F.col("o_custkey").alias("machine"), F.col("o_orderkey").alias("id"))
    o = positions(o, ["machine"], ["id"], [idiv("id", 1 << 24)])
    o = o.withColumn("run", idiv(F.col("pos") - 1, 8))
    w = Window.partitionBy("machine", "run").orderBy("pos")
    return out(o.select("machine", "id", windows.survival_from_hazard(hazard(), w).alias("survival")), 9)


@query(
    "win_first_crossing",
    "SELECT machine, CAST(min(CASE WHEN pred < 20 THEN cycle END) AS DOUBLE) AS stop, max(cycle) AS length FROM mach_scored GROUP BY 1",
)
def win_first_crossing(t):
    return windows.first_crossing(t.mach_scored(), ["machine"], "cycle", "pred", 20).withColumn(
        "stop", F.col("stop").cast("double")
    )


@query(
    "win_chrono_split",
    f"""WITH {SM}, c AS (SELECT *, count(*) OVER (PARTITION BY zone) AS k FROM sm)
        SELECT zone, m, CASE WHEN pos <= floor(k * 0.7::DOUBLE) THEN 'train' WHEN pos <= floor(k * (0.7::DOUBLE + 0.15::DOUBLE)) THEN 'val' ELSE 'test' END AS part FROM c""",
)
def win_chrono_split(t):
    return windows.chronological_split(sales_positions(t), ["zone"], "pos", 0.7, 0.15).select("zone", "m", "part")


@query(
    "win_walk_forward",
    """WITH p AS (SELECT zone, year, label FROM panel), f AS (SELECT unnest(generate_series(1997, (SELECT max(year) FROM panel), 2)) AS fold),
       r AS (SELECT zone, year, label, fold, CASE WHEN year < fold THEN 'train' ELSE 'test' END AS part FROM p, f WHERE year < fold + 2),
       ok AS (SELECT fold FROM (SELECT fold, part, count(DISTINCT label) AS c FROM r GROUP BY 1, 2) GROUP BY 1 HAVING count(*) = 2 AND min(c) = 2)
       SELECT CAST(fold AS BIGINT) AS fold, part, zone, year FROM r WHERE fold IN (SELECT fold FROM ok)""",
)
def win_walk_forward(t):
    folds = windows.walk_forward(t.panel(), "year", "label", 1997, 2)
    return folds.select(F.col("fold").cast("bigint").alias("fold"), "part", "zone", F.col("year").cast("bigint").alias("year"))


@query("win_label_rul", "SELECT machine, cycle, rul, rul = 0 AS failed FROM mach")
def win_label_rul(t):
    return t.mach().select("machine", "cycle", "rul", (F.col("rul") == 0).alias("failed"))


@query("win_failure_flag", "SELECT machine, cycle, rul >= 25 AS healthy FROM mach")
def win_failure_flag(t):
    return t.mach().select("machine", "cycle", (F.col("rul") >= 25).alias("healthy"))
