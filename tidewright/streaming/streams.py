"""Structured Streaming forms of the windowed operators.

Every function takes a streaming DataFrame and returns one; ``drain`` runs a query over
what is available and returns the result as a table. State per key is a few numbers. Operators that
need the order of rows (``Carried``) work on a micro-batch with the batch operators and carry a state table
from batch to batch, so no task holds a key.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.exprs import scalar_row
from ..operators.joins import interval_join
from ..operators.ordered import neighbours, positions
from ..operators.windows import ewm_mean
from ..session import scratch_dir, settle


def read_table_stream(
    spark: SparkSession, path: str, files_per_trigger: int | None = None, bytes_per_trigger: int | None = None
) -> DataFrame:
    """Parquet folder or file as a stream; the schema is read once from the table."""
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", bytes_per_trigger)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    # A one-character class makes a single file a pattern, which the file source accepts.
    return reader.parquet(path[:-1] + f"[{path[-1]}]")


def drain(stream: DataFrame, tag: str) -> DataFrame:
    """Append-mode result of all available input, through the Parquet sink."""
    spark = stream.sparkSession
    folder = scratch_dir(spark, tag)
    q = (
        stream.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
        .option("checkpointLocation", f"{folder}/checkpoint").start(f"{folder}/out")
    )
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/out")


def drain_latest(stream: DataFrame, keys: Sequence[str], tag: str) -> DataFrame:
    """Update-mode result: every batch overwrites its own folder (safe on retry) and the
    newest row per key stands, so windows still open at the end are part of the result."""
    spark = stream.sparkSession
    folder = scratch_dir(spark, tag)
    values = [c for c in stream.columns if c not in keys]

    def keep(batch: DataFrame, number: int) -> None:
        batch.withColumn("_batch", F.lit(number)).write.mode("overwrite").parquet(f"{folder}/out/part{number}")

    q = (
        stream.writeStream.outputMode("update").trigger(availableNow=True)
        .option("checkpointLocation", f"{folder}/checkpoint").foreachBatch(keep).start()
    )
    q.awaitTermination()
    table = spark.read.schema(T.StructType([*stream.schema.fields, T.StructField("_batch", T.IntegerType())])).parquet(f"{folder}/out/*")
    newest = F.max_by(F.struct(*values), "_batch")
    return table.groupBy(*keys).agg(newest.alias("_v")).select(*keys, "_v.*")


def tumbling_count(
    events: DataFrame, time: str, key: Sequence[str], width: str, late: str
) -> DataFrame:
    counted = events.withWatermark(time, late).groupBy(F.window(time, width), *key).agg(
        F.count(F.lit(1)).alias("n")
    )
    return counted.select(*key, F.unix_micros("window.start").alias("start"), "n")


def sliding_mean(
    events: DataFrame, time: str, key: Sequence[str], value: str, width: str, slide: str, late: str
) -> DataFrame:
    mean = events.withWatermark(time, late).groupBy(F.window(time, width, slide), *key).agg(
        F.avg(value).alias("mean"), F.count(F.lit(1)).alias("n")
    )
    return mean.select(*key, F.unix_micros("window.start").alias("start"), "mean", "n")


def threshold_alarm(events: DataFrame, thresholds: DataFrame, key: str, signal: str, thr: str) -> DataFrame:
    """Stateless: rows whose signal reaches their key's threshold (static side)."""
    return events.join(thresholds, key).where(F.col(signal) >= F.col(thr))


def window_hits(events: DataFrame, windows: DataFrame, time: str, bucket: int) -> DataFrame:
    """Rows inside static label windows."""
    return interval_join(events, windows, time, "begin", "end", bucket)


def dedup(events: DataFrame, time: str, ident: Sequence[str], late: str) -> DataFrame:
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark(list(ident))


@dataclass(frozen=True)
class Carried:
    """A stateful operator: ``step(batch, before) -> (rows, after)``, all of them tables. ``before`` and ``after``
    hold a few numbers per key (``state``); rows of a batch are worked on by the batch operators, so a
    key that fills a micro-batch is spread over tasks like any other."""

    state: str
    rows: str
    step: Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]]


def start_carried(stream: DataFrame, op: Carried, folder: str) -> StreamingQuery:
    """Run ``op`` over all available input below ``folder``; called again on the same folder it goes on from the
    state it left. A batch reads the state of the one before and overwrites its own rows and state, so a
    batch that is run again gives the same tables."""
    stream.sparkSession.createDataFrame([], op.rows).write.mode("overwrite").parquet(f"{folder}/out/none")

    def advance(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if number:
            before = spark.read.schema(op.state).parquet(f"{folder}/state/part{number - 1}")
        else:
            before = spark.createDataFrame([], op.state)
        rows, after = op.step(settle(batch, "batch"), before)
        rows.write.mode("overwrite").parquet(f"{folder}/out/part{number}")
        after.write.mode("overwrite").parquet(f"{folder}/state/part{number}")

    return (
        stream.writeStream.trigger(availableNow=True).option("checkpointLocation", f"{folder}/checkpoint")
        .foreachBatch(advance).start()
    )


def drain_carried(stream: DataFrame, op: Carried, tag: str) -> DataFrame:
    """All rows of ``op`` over the available input."""
    folder = scratch_dir(stream.sparkSession, tag)
    start_carried(stream, op, folder).awaitTermination()
    return stream.sparkSession.read.schema(op.rows).parquet(f"{folder}/out/*")


def _merged(before: DataFrame, ends: DataFrame, key: str, idle: int | None) -> DataFrame:
    """States after a batch: those of its keys are new, the others stand until they are ``idle`` behind the
    newest clock. A key that comes back later starts anew."""
    state = F.struct(*[c for c in ends.columns if c != key])
    was = before.select(key, state.alias("_was"))
    both = was.join(ends.select(key, state.alias("_is")), key, "full").select(key, F.coalesce("_is", "_was").alias("_s"))
    if idle is not None:
        newest = scalar_row(both.agg(F.max("_s.clock").alias("c")))["c"]
        both = both.where(F.col("_s.clock").isNull() | (F.col("_s.clock") >= newest - idle))
    return both.select(key, "_s.*")


def ewm_fill(
    events: DataFrame, key: str, order: Sequence[str], ident: str, value: str, alpha: float,
    clock: str | None = None, idle: int | None = None,
) -> Carried:
    """Forward fill and adjusted exponentially weighted mean in arrival order: batches follow each other, rows of a
    batch go by ``order`` (total). State per key: the two decayed sums, the last value, the newest ``clock``.

    Sums of a batch start at zero and take the carried ones times the decay up to the row, so a batch is
    computed in chunks of bounded size. A null value decays the sums and takes the last one; nulls before
    the first value stay null. Rows with a null key are left out.
    """
    kinds = {f.name: f.dataType.simpleString() for f in events.schema.fields}

    def step(batch: DataFrame, before: DataFrame) -> tuple[DataFrame, DataFrame]:
        tick = F.col(clock).cast("bigint") if clock else F.lit(None).cast("bigint")
        x = F.nanvl(F.col(value).cast("double"), F.lit(None))
        rows = positions(batch.withColumns({"_x": x, "clock": tick}), [key], order, out="_pos")
        rows = settle(rows.select(key, ident, "_x", "clock", "_pos"), "ranked")
        smooth = ewm_mean(rows, [key], "_pos", "_x", alpha, "_mean", sums=("_sn", "_sd"))
        near = neighbours(smooth, [key], "_pos", "_x").join(before.drop("clock"), key, "left")
        decay = F.pow(F.lit(1.0 - alpha), F.col("_pos").cast("double"))
        done = settle(near.select(
            key, ident, "clock", "_pos",
            (F.col("_sn") + F.coalesce(F.col("num") * decay, F.lit(0.0))).alias("_num"),
            (F.col("_sd") + F.coalesce(F.col("den") * decay, F.lit(0.0))).alias("_den"),
            F.coalesce(F.col("prev")["_x"], F.col("last")).alias("_last"),
        ), "carried")
        ends = done.groupBy(key).agg(
            F.max_by(F.struct("_num", "_den", "_last"), "_pos").alias("_e"), F.max("clock").alias("clock")
        ).select(key, "_e._num", "_e._den", "_e._last", "clock").toDF(key, "num", "den", "last", "clock")
        return (
            done.select(key, ident, F.col("_last").alias("filled"), F.when(F.col("_den") > 0, F.col("_num") / F.col("_den")).alias("ewm")),
            _merged(before, ends, key, idle),
        )

    return Carried(
        f"{key} {kinds[key]}, num double, den double, last double, clock bigint",
        f"{key} {kinds[key]}, {ident} {kinds[ident]}, filled double, ewm double", step,
    )


def first_stop(
    events: DataFrame, key: str, order: Sequence[str], pred: str, thr: float,
    clock: str | None = None, idle: int | None = None,
) -> Carried:
    """One row per key at its first prediction below ``thr``, counted in arrival order. State per key: rows seen, the
    stop, the newest ``clock``.

    A batch needs no ordering: its first hit is a minimum, the rows up to it are a count. Null predictions
    count as rows and never stop; rows with a null key are left out.
    """
    kind = dict(events.dtypes)[key]

    def step(batch: DataFrame, before: DataFrame) -> tuple[DataFrame, DataFrame]:
        at = F.struct(*order)
        tick = F.col(clock).cast("bigint") if clock else F.lit(None).cast("bigint")
        low = (F.col(pred) < thr) & ~F.isnan(F.col(pred).cast("double"))
        rows = batch.where(F.col(key).isNotNull()).select(key, at.alias("_at"), F.when(low, at).alias("_low"), tick.alias("clock"))
        hits = settle(rows.groupBy(key).agg(F.min("_low").alias("_hit"), F.count(F.lit(1)).alias("_n"), F.max("clock").alias("clock")), "hits")
        open_hits = hits.where(F.col("_hit").isNotNull()).join(before.where(F.col("stop").isNotNull()), key, "left_anti")
        ranks = (
            rows.select(key, "_at").join(open_hits.select(key, "_hit"), key).where(F.col("_at") <= F.col("_hit"))
            .groupBy(key).agg(F.count(F.lit(1)).alias("_rank"))
        )
        seen = F.coalesce("seen", F.lit(0))
        ends = settle(
            hits.select(key, "_n", "clock").join(ranks, key, "left").join(before.select(key, "seen", F.col("stop").alias("_was")), key, "left")
            .select(key, (seen + F.col("_n")).alias("seen"), F.coalesce("_was", seen + F.col("_rank")).alias("stop"), "clock", F.col("_was").isNull().alias("_new")),
            "ends",
        )
        stops = ends.where(F.col("_new") & F.col("stop").isNotNull()).select(key, "stop")
        return stops, _merged(before, ends.drop("_new"), key, idle)

    return Carried(f"{key} {kind}, seen bigint, stop bigint, clock bigint", f"{key} {kind}, stop bigint", step)


def event_time(c: str) -> Column:
    """Watermarks need a timestamp with zone."""
    return F.col(c).cast("timestamp")
