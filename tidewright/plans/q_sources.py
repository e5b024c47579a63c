"""Queries: sources, sinks, projection, filtering, cleaning."""

from pyspark.sql import functions as F

from ..functions.exprs import DAY, HOUR, idiv, micros, rounded
from ..operators import clean, resample
from ..sources import readers, sinks
from ..session import scratch_dir
from .bindings import FEATURES, TRAIN_END, rnd
from .registry import query


def out(df, digits=6, **per_column):
    """Round the double columns so both engines print the same digits."""
    cols = []
    for name, kind in df.dtypes:
        if kind in ("double", "float") or kind.startswith("decimal"):
            cols.append(rounded(name, per_column.get(name, digits)).alias(name))
        elif kind in ("int", "smallint", "tinyint"):
            cols.append(F.col(name).cast("bigint").alias(name))
        else:
            cols.append(F.col(name))
    return df.select(*cols)


def features_long(columns, body):
    """DuckDB text: UNION ALL of ``body`` per column, ``{c}`` standing for the column."""
    return " UNION ALL ".join(body.replace("{c}", c) for c in columns)


@query("src_series", "SELECT key, t, event_id, value FROM ser")
def src_series(t):
    return out(t.ser())


@query(
    "src_labels_json",
    "SELECT event_id, event_type AS key, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
)
def src_labels_json(t):
    parsed = F.from_json("props", "k bigint")
    return t.events.select("event_id", F.col("event_type").alias("key"), parsed["k"].alias("k"))


@query(
    "src_windows_json",
    """SELECT key, row_number() OVER (PARTITION BY key ORDER BY d) - 1 AS pos,
         d * 86400000000 AS "begin", (d + 1) * 86400000000 AS "end" FROM (
       SELECT key, d, avg(value) AS v FROM (SELECT key, t // 86400000000 AS d, value FROM ser)
       GROUP BY 1, 2) x JOIN (SELECT key AS k2, avg(value) AS m FROM ser GROUP BY 1) ON key = k2
       WHERE v > m""",
)
def src_windows_json(t):
    """Days above a type's mean, written as a label-window JSON map and parsed again."""
    ser = t.ser()
    daily = ser.groupBy("key", idiv("t", DAY).alias("d")).agg(F.avg("value").alias("v"))
    mean = ser.groupBy("key").agg(F.avg("value").alias("m"))
    hot = daily.join(mean, "key").where("v > m")

    def text(day):
        return F.date_format(F.timestamp_micros(day * DAY), "yyyy-MM-dd HH:mm:ss")

    days = F.array_sort(F.collect_list("d"))
    pairs = F.transform(days, lambda d: F.array(text(d), text(d + 1)))
    maps = hot.groupBy("key").agg(pairs.alias("w")).select(F.to_json(F.create_map("key", "w")).alias("value"))
    return readers.window_rows(F.col("value"), maps)


@query(
    "src_multifile_tagged",
    """WITH ids AS (SELECT l_returnflag AS src, count(DISTINCT l_suppkey) AS k FROM lineitem GROUP BY 1),
       sh AS (SELECT src, coalesce(sum(k) OVER (ORDER BY src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM ids)
       SELECT l_returnflag AS src, CAST(l_suppkey + s AS BIGINT) AS machine, count(*) AS n,
         sum(l_quantity) AS qty FROM lineitem JOIN sh ON l_returnflag = src GROUP BY 1, 2""",
)
def src_multifile_tagged(t):
    tagged = t.lineitem.select(
        F.col("l_returnflag").alias("src"), F.col("l_suppkey").alias("machine"), F.col("l_quantity").alias("qty")
    )
    shifted = readers.shift_ids(tagged, "src", "machine")
    return out(shifted.groupBy("src", "machine").agg(F.count(F.lit(1)).alias("n"), F.sum("qty").alias("qty")))


@query(
    "src_delimited_na",
    """SELECT c_custkey AS id, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance,
       c_mktsegment AS segment FROM customer""",
)
def src_delimited_na(t):
    folder = scratch_dir(t.spark, "delimited")
    t.customer.select(
        F.col("c_custkey").alias("id"), F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance"),
        F.col("c_mktsegment").alias("segment"),
    ).write.csv(folder, header=True, sep=";", nullValue="?")
    return readers.read_delimited(t.spark, folder, "id bigint, balance double, segment string")


@query(
    "src_event_log",
    """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS triage, event_type AS code,
       row_number() OVER (PARTITION BY event_type ORDER BY date_trunc('second', ts), event_id) AS arrival FROM events""",
)
def src_event_log(t):
    """Text event times parsed and ordered per code by position instead of a global sort."""
    from ..operators.ordered import positions

    text = t.events.select(
        "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("triage"),
        F.col("event_type").alias("code"),
    )
    parsed = text.withColumn("us", micros(F.to_timestamp("triage")))
    return positions(parsed, ["code"], ["us", "event_id"], out="arrival").drop("us")


@query(
    "src_dayfirst_dates",
    """SELECT o_orderkey AS id, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders""",
)
def src_dayfirst_dates(t):
    text = t.orders.select(F.col("o_orderkey").alias("id"), F.date_format("o_orderdate", "dd/MM/yyyy").alias("text"))
    return text.select("id", readers.dayfirst("text").cast("string").alias("day"))


@query(
    "src_xy_align",
    """SELECT o_custkey AS id, o_orderkey, o_totalprice AS x0, c_acctbal AS y
       FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def src_xy_align(t):
    x = t.orders.select(F.col("o_custkey").alias("id"), "o_orderkey", F.col("o_totalprice").alias("x0"))
    y = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("y"))
    return readers.align_xy(x, y, "id", "y")


@query(
    "sink_artifacts",
    """SELECT o_orderpriority AS grp, count(*) AS n, round(avg(o_totalprice), 4) AS mean
       FROM orders GROUP BY 1""",
)
def sink_artifacts(t):
    folder = scratch_dir(t.spark, "artifacts")
    table = out(
        t.orders.groupBy(F.col("o_orderpriority").alias("grp"))
        .agg(F.count(F.lit(1)).alias("n"), F.avg("o_totalprice").alias("mean")), 4,
    )
    sinks.write_artifacts({"summary": table}, folder)
    return sinks.read_artifact(t.spark, folder, "summary")


@query(
    "sink_submission",
    f"SELECT id, {rnd('least(greatest(pred, 10.0), 100.0)')} AS y FROM scored",
)
def sink_submission(t):
    folder = scratch_dir(t.spark, "submission")
    sinks.write_artifacts({"submission": out(sinks.submission(t.scored(), "id", "pred"))}, folder)
    return sinks.read_artifact(t.spark, folder, "submission")


@query(
    "proj_drop_reorder",
    """SELECT l_suppkey AS machine, l_orderkey, l_partkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity AS qty,
       l_extendedprice, l_discount, l_returnflag, l_linestatus FROM lineitem""",
)
def proj_drop_reorder(t):
    return out(
        clean.reorder(
            t.lineitem, drop=["l_tax", "l_shipdate"],
            rename={"l_suppkey": "machine", "l_quantity": "qty"}, first=["machine"],
        )
    )


@query(
    "flt_time_split",
    f"""SELECT 'row' AS kind, CASE WHEN ts < TIMESTAMP '{TRAIN_END}' THEN 'train' ELSE 'rest' END AS part,
        count(*) AS n, {rnd('sum(value)', 2)} AS total FROM events GROUP BY 1, 2
        UNION ALL SELECT 'window', CASE WHEN "end" < epoch_us(TIMESTAMP '{TRAIN_END}') THEN 'train' ELSE 'rest' END,
        count(*), 0.0 FROM windows GROUP BY 1, 2""",
)
def flt_time_split(t):
    cut = F.lit(TRAIN_END).cast("timestamp_ntz")
    e = t.events.select("ts", "value")

    def part(df, name):
        return df.agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(
            F.lit("row").alias("kind"), F.lit(name).alias("part"), "n", "total"
        )

    rows = part(e.where(F.col("ts") < cut), "train").unionByName(part(e.where(F.col("ts") >= cut), "rest"))
    name = F.when(F.col("end") < micros(cut), "train").otherwise("rest")
    w = t.windows().groupBy(F.lit("window").alias("kind"), name.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    return out(rows.unionByName(w.withColumn("total", F.lit(0.0))), 2)


@query(
    "flt_time_range",
    """SELECT event_id, event_type AS key, value FROM events
       WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-15'""",
)
def flt_time_range(t):
    lo, hi = (F.lit(x).cast("timestamp_ntz") for x in ("2024-01-08 00:00:00", "2024-01-15 00:00:00"))
    rows = t.events.where((F.col("ts") >= lo) & (F.col("ts") < hi))
    return rows.select("event_id", F.col("event_type").alias("key"), "value")


@query(
    "flt_threshold",
    "SELECT id, score, score > 0.9 AS strict FROM scored WHERE score >= 0.9",
)
def flt_threshold(t):
    return t.scored().where("score >= 0.9").select("id", "score", (F.col("score") > 0.9).alias("strict"))


@query(
    "cln_drop_sparse_cols",
    "SELECT oid, ln, disc, tax, psize, retail, total FROM feat_masked",
)
def cln_drop_sparse_cols(t):
    f = t.feat(masked=True).select("oid", "ln", *FEATURES)
    return out(clean.drop_sparse_columns(f, 0.05, exempt=["oid", "ln"]))


@query(
    "cln_drop_null_rows",
    "SELECT oid, ln, qty, price, total FROM feat_masked WHERE qty IS NOT NULL AND price IS NOT NULL",
)
def cln_drop_null_rows(t):
    return out(t.feat(masked=True).select("oid", "ln", "qty", "price", "total").na.drop())


@query(
    "cln_null_profile",
    features_long(
        FEATURES, f"SELECT '{{c}}' AS feature, {rnd('avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END)')} AS null_share FROM feat_masked"
    ),
)
def cln_null_profile(t):
    return out(clean.null_shares(t.feat(masked=True), FEATURES))


@query("cln_sentinel_null", "SELECT p_partkey, CAST(nullif(p_size % 10, 0) AS DOUBLE) AS size FROM part")
def cln_sentinel_null(t):
    size = F.nullif(F.col("p_size") % 10, F.lit(0))
    return out(t.part.select("p_partkey", size.cast("double").alias("size")))


@query("cln_clip", "SELECT event_id, least(greatest(value, 5.0), 200.0) AS value FROM ser")
def cln_clip(t):
    return t.ser().select("event_id", clean.clip("value", 5.0, 200.0).alias("value"))


_BOUNDS = """(SELECT key AS k2, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM (
  SELECT key, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM ser GROUP BY 1))"""


@query(
    "cln_iqr_outlier",
    f"SELECT key, event_id, value FROM ser JOIN {_BOUNDS} ON key = k2 WHERE value BETWEEN lo AND hi",
)
def cln_iqr_outlier(t):
    return clean.iqr_split(t.ser(), ["key"], "value").select("key", "event_id", "value")


@query(
    "cln_iqr_removed",
    f"SELECT key, event_id, value FROM ser JOIN {_BOUNDS} ON key = k2 WHERE value < lo OR value > hi",
)
def cln_iqr_removed(t):
    return clean.iqr_split(t.ser(), ["key"], "value", removed=True).select("key", "event_id", "value")


@query(
    "cln_relative_values",
    f"""SELECT zone, pop, {rnd('pct / 100')} AS pctBuilding, {rnd('orders / (pop / 100000.0)', 4)} AS numUrgent FROM (
        SELECT CAST(c_nationkey AS BIGINT) AS zone, count(*) AS pop, 100.0 * avg(CASE WHEN c_mktsegment = 'BUILDING' THEN 1.0 ELSE 0.0 END) AS pct
        FROM customer GROUP BY 1) JOIN (SELECT c_nationkey AS z2, count(*) AS orders FROM orders JOIN customer
        ON o_custkey = c_custkey WHERE o_orderpriority = '1-URGENT' GROUP BY 1) ON zone = z2""",
)
def cln_relative_values(t):
    zones = t.customer.groupBy(F.col("c_nationkey").alias("zone")).agg(
        F.count(F.lit(1)).alias("pop"),
        (100.0 * F.avg(F.when(F.col("c_mktsegment") == "BUILDING", 1.0).otherwise(0.0))).alias("pctBuilding"),
    )
    urgent = t.sales().where("type = '1-URGENT'").groupBy("zone").agg(F.count(F.lit(1)).alias("numUrgent"))
    return out(clean.relative_values(zones.join(urgent, "zone"), "pop"), numUrgent=4)


@query(
    "cln_col_kinds",
    features_long(
        [*FEATURES, "y"],
        "SELECT '{c}' AS feature, CASE count(DISTINCT {c}) WHEN 1 THEN 'constant' WHEN 2 THEN 'binary' ELSE 'numeric' END AS kind FROM feat",
    ),
)
def cln_col_kinds(t):
    return clean.column_kinds(t.feat(), [*FEATURES, "y"])


@query(
    "cln_constant_cols",
    "WITH f AS (SELECT *, 0.0 * ln AS zero FROM feat) "
    + features_long(
        [*FEATURES, "zero"],
        f"SELECT '{{c}}' AS feature, {rnd('stddev({c})', 4)} AS std, "
        f"{rnd('CASE WHEN stddev({c}) = 0 THEN 1 ELSE stddev({c}) END', 4)} AS safe_std, stddev({{c}}) = 0 AS constant FROM f",
    ),
)
def cln_constant_cols(t):
    f = t.feat().withColumn("zero", F.lit(0.0) * F.col("ln"))
    return out(clean.safe_std(f, [*FEATURES, "zero"]), 4)


@query(
    "rs_grid_mean",
    """WITH c AS (SELECT key, t // 300000000 AS c, avg(value) AS v FROM ser GROUP BY 1, 2),
       g AS (SELECT key, unnest(range(lo, hi + 1)) AS c FROM (SELECT key, min(c) AS lo, max(c) AS hi FROM c GROUP BY 1))
       SELECT g.key, g.c * 300000000 AS cell, round(c.v, 6) AS value FROM g LEFT JOIN c ON g.key = c.key AND g.c = c.c""",
)
def rs_grid_mean(t):
    return out(resample.grid_mean(t.ser(), ["key"], "t", "value", 300_000_000).select("key", "cell", "value"))


@query("rs_grid_count", "SELECT key, h * 3600000000 AS cell, n FROM grid")
def rs_grid_count(t):
    return resample.grid_count(t.ser(), ["key"], "t", HOUR).select("key", "cell", "n")
