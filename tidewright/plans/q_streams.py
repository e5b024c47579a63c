"""Queries: streaming forms; each is checked against its batch definition."""

from pyspark.sql import functions as F

from ..functions.exprs import DAY, hash31, micros
from ..session import settle
from ..streaming import streams
from .bindings import MACH_ORDER, h31, rnd
from .q_sources import out
from .registry import query


BATCH = 256 << 30  # bytes of files in a micro-batch
YEAR = 365 * DAY


def events(t):
    e = streams.read_table_stream(t.spark, t.path("events"), bytes_per_trigger=BATCH)
    return e.withColumn("at", streams.event_time("ts")).withColumnRenamed("event_type", "key")


@query("st_tumbling_count", "SELECT key, h * 3600000000 AS start, n FROM grid WHERE n > 0")
def st_tumbling_count(t):
    s = streams.tumbling_count(events(t), "at", ["key"], "1 hour", "10 minutes")
    return streams.drain_latest(s, ["key", "start"], "tumbling")


@query(
    "st_sliding_mean",
    f"""WITH x AS (SELECT key, value, (t // 300000000 - unnest(range(0, 6))) * 300000000 AS start FROM ser)
        SELECT key, start, {rnd('avg(value)')} AS mean, count(*) AS n FROM x GROUP BY 1, 2""",
)
def st_sliding_mean(t):
    s = streams.sliding_mean(events(t), "at", ["key"], "value", "30 minutes", "5 minutes", "10 minutes")
    return out(streams.drain_latest(s, ["key", "start"], "sliding"))


@query(
    "st_threshold_alarm",
    "WITH b AS (SELECT key AS bk, avg(value) + 2 * stddev(value) AS thr FROM ser GROUP BY 1) SELECT key, event_id, value FROM ser JOIN b ON key = bk WHERE value >= thr",
)
def st_threshold_alarm(t):
    thr = t.ser().groupBy("key").agg((F.avg("value") + 2 * F.stddev("value")).alias("thr"))
    alarm = streams.threshold_alarm(events(t), settle(thr, "thresholds"), "key", "value", "thr")
    return streams.drain(alarm.select("key", "event_id", "value"), "alarm")


@query(
    "st_stateful_ewm_fill",
    f"""WITH a AS (SELECT a.key, a.event_id, sum(b.value * power(0.7, a.pos - b.pos)) / sum(CASE WHEN b.value IS NOT NULL THEN power(0.7, a.pos - b.pos) END) AS ewm
          FROM ser_pos_masked a JOIN ser_pos_masked b ON a.key = b.key AND b.pos <= a.pos AND b.pos > a.pos - 400 GROUP BY 1, 2),
        f AS (SELECT event_id, last_value(value IGNORE NULLS) OVER (PARTITION BY key ORDER BY pos ROWS UNBOUNDED PRECEDING) AS filled FROM ser_pos_masked)
        SELECT key, event_id, {rnd('filled')} AS filled, {rnd('ewm')} AS ewm FROM a JOIN f USING (event_id)""",
)
def st_stateful_ewm_fill(t):
    e = events(t).withColumn("value", F.when(F.col("event_id") % 10 != 3, F.col("value")))
    e = e.select("key", "event_id", micros("ts").alias("t"), "value")
    s = streams.ewm_fill(e, "key", ["t", "event_id"], "event_id", "value", 0.3, "t", YEAR)
    return out(streams.drain_carried(e, s, "ewm"))


@query(
    "st_first_stop",
    f"""WITH r AS (SELECT l_suppkey AS machine, {h31('l_orderkey * 64 + l_linenumber * 8 + l_suppkey', 61)} % 200 AS pred,
          row_number() OVER (PARTITION BY l_suppkey ORDER BY {", ".join(MACH_ORDER)}) AS pos FROM lineitem)
        SELECT machine, min(pos) AS stop FROM r WHERE pred < 2 GROUP BY 1""",
)
def st_first_stop(t):
    line = streams.read_table_stream(t.spark, t.path("lineitem"), bytes_per_trigger=BATCH)
    pred = F.pmod(hash31(F.expr("l_orderkey * 64 + l_linenumber * 8 + l_suppkey"), 61), F.lit(200))
    line = line.withColumn("pred", pred).withColumnRenamed("l_suppkey", "machine")
    return streams.drain_carried(line, streams.first_stop(line, "machine", MACH_ORDER, "pred", 2), "stop")


@query("st_window_hits", 'SELECT s.event_id, w.pos FROM ser s JOIN windows w ON s.t >= w."begin" AND s.t < w."end"')
def st_window_hits(t):
    e = events(t).select("event_id", micros("ts").alias("t"))
    return streams.drain(streams.window_hits(e, t.windows(), "t", DAY).select("event_id", "pos"), "hits")


@query("st_dedup_arrivals", "SELECT event_id, key, value FROM ser")
def st_dedup_arrivals(t):
    """The event stream arriving twice, deduplicated by id."""
    twice = events(t).unionByName(events(t))
    return streams.drain(streams.dedup(twice, "at", ["event_id"], "1 hour").select("event_id", "key", "value"), "dedup")
