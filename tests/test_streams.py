"""Streams over several micro-batches equal their batch results."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewright.functions.exprs import micros
from tidewright.streaming import streams


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Time-ordered events in six files."""
    rng = np.random.default_rng(0)
    n = 600
    t = pd.Timestamp("2024-01-01") + pd.to_timedelta(np.cumsum(rng.integers(20, 200, n)), unit="s")
    v = np.where(rng.random(n) < 0.2, np.nan, rng.normal(10, 2, n).round(2))
    pdf = pd.DataFrame({"id": np.arange(n), "at": t, "key": rng.choice(["a", "b"], n, p=[0.9, 0.1]), "v": v})
    path = str(tmp_path_factory.mktemp("events"))
    for i, part in enumerate(np.array_split(pdf, 6)):
        df = spark.createDataFrame(part).withColumn("v", F.nanvl("v", F.lit(None)))
        df.coalesce(1).write.mode("append").parquet(path)
    return path, pdf


def stream(spark, folder):
    schema = spark.read.parquet(folder[0]).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder[0])


def test_tumbling_count(spark, folder):
    s = streams.tumbling_count(stream(spark, folder), "at", ["key"], "1 hour", "10 minutes")
    got = streams.drain_latest(s, ["key", "start"], "t")
    batch = spark.read.parquet(folder[0]).groupBy("key", F.window("at", "1 hour").alias("w")).count()
    want = batch.select("key", F.unix_micros("w.start").alias("start"), F.col("count").alias("n"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_ewm_fill_over_batches(spark, folder):
    e = stream(spark, folder).withColumn("t", micros("at"))
    got = streams.drain_carried(e, streams.ewm_fill(e, "key", ["t", "id"], "id", "v", 0.3, "t", 1 << 60), "e").toPandas().set_index("id").sort_index()
    pdf = folder[1].set_index("id")
    ewm = pdf.groupby("key")["v"].transform(lambda x: x.ewm(alpha=0.3).mean())
    np.testing.assert_allclose(got["ewm"].to_numpy(float), ewm.to_numpy())
    np.testing.assert_array_equal(got["filled"].to_numpy(float), pdf.groupby("key")["v"].ffill().to_numpy())


def test_first_stop_and_dedup(spark, folder):
    e = stream(spark, folder).withColumn("t", micros("at")).withColumn("m", F.when(F.col("key") == "a", 1).otherwise(2).cast("bigint"))
    got = {r["m"]: r["stop"] for r in streams.drain_carried(e, streams.first_stop(e, "m", ["t", "id"], "v", 6.0), "s").collect()}
    pdf = folder[1].assign(m=np.where(folder[1]["key"] == "a", 1, 2))
    for m, g in pdf.groupby("m"):
        low = np.flatnonzero(g["v"].to_numpy() < 6.0)
        assert got.get(m) == (low[0] + 1 if len(low) else None)
    twice = stream(spark, folder).unionByName(stream(spark, folder))
    assert streams.drain(streams.dedup(twice, "at", ["id"], "30 days"), "d").count() == len(pdf)


def test_states_expire_and_odd_rows(spark):
    """States behind the newest clock by more than ``idle`` go; nulls, NaN and null keys have defined results."""
    kind = "key string, id bigint, t bigint, v double"
    first = spark.createDataFrame([("a", 1, 1, None), ("a", 2, 2, 4.0), ("b", 3, 1, 8.0), (None, 4, 1, 1.0)], kind)
    second = spark.createDataFrame([("a", 5, 100, float("nan")), ("a", 6, 101, 2.0)], kind)
    op = streams.ewm_fill(first, "key", ["t", "id"], "id", "v", 0.5, "t", 50)
    rows, state = op.step(first, spark.createDataFrame([], op.state))
    assert sorted(map(tuple, rows.collect())) == [("a", 1, None, None), ("a", 2, 4.0, 4.0), ("b", 3, 8.0, 8.0)]
    rows, after = op.step(second, state)
    assert sorted(map(tuple, rows.collect())) == [("a", 5, 4.0, 4.0), ("a", 6, 2.0, (4.0 / 4 + 2.0) / 1.25)]
    assert [(r["key"], r["clock"]) for r in after.collect()] == [("a", 101)]
    stop = streams.first_stop(first, "key", ["t", "id"], "v", 3.0, "t", 50)
    rows, state = stop.step(first, spark.createDataFrame([], stop.state))
    assert rows.count() == 0 and {r["key"]: r["seen"] for r in state.collect()} == {"a": 2, "b": 1}
    rows, after = stop.step(second, state)
    assert list(map(tuple, rows.collect())) == [("a", 4)]
    assert stop.step(second, after)[0].count() == 0
    empty = first.limit(0)
    assert op.step(empty, state.limit(0).sparkSession.createDataFrame([], op.state))[0].count() == 0


def test_hot_key_is_spread(spark):
    """A key with all rows of a batch is cut into chunks: no group of rows grows with the key."""
    n = 20000
    e = spark.range(n).select(F.lit("a").alias("key"), "id", F.col("id").alias("t"), (F.col("id") % 7).cast("double").alias("v"))
    op = streams.ewm_fill(e, "key", ["t"], "id", "v", 0.1, "t")
    got = op.step(e, spark.createDataFrame([], op.state))[0].toPandas().sort_values("id")
    want = pd.Series(np.arange(n) % 7, dtype=float).ewm(alpha=0.1).mean()
    np.testing.assert_allclose(got["ewm"].to_numpy(), want.to_numpy())
