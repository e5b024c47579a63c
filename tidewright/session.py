"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int = 8, memory: str = "16g") -> SparkSession:
    """Session for tests and the local benchmark; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tidewright")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


BATCH, _BATCH = 1 << 22, "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ``BATCH`` bytes (and a row): a task holds several copies of a batch on both
    sides of Python, and Spark's own bound makes that hundreds of megabytes of whole texts. A smaller setting stays."""
    if int(spark.conf.get(_BATCH).lower().rstrip("b")) > BATCH:
        spark.conf.set(_BATCH, str(BATCH))


def scratch_dir(spark: SparkSession, tag: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only a session in one process (a local test) without that setting gets a folder of its own;
    on a cluster a missing setting is an error, as executors don't share local folders.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tidewright-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{tag}-{uuid.uuid4().hex}"


_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Jobs started inside remove their shuffle files when they end (Spark 4.1 on; others keep them until the
    driver collects garbage). For results that are written: nothing reads those files again."""
    before = spark.conf.get(_RELEASE, None)
    spark.conf.set(_RELEASE, "true")
    try:
        yield
    finally:
        spark.conf.unset(_RELEASE) if before is None else spark.conf.set(_RELEASE, before)


def settle(df: DataFrame, tag: str) -> DataFrame:
    """Write an intermediate result to the shared folder and read it back: its lineage ends
    there, later uses do not compute it again, and it survives lost executors."""
    path = scratch_dir(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def collected(spark: SparkSession) -> None:
    """Let Spark's cleaner find what nothing refers to any more: shuffle files of jobs on RDDs (MLlib's fits), which
    ``released`` doesn't reach, go after the driver has collected garbage, in the background."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


@contextmanager
def settled(df: DataFrame, tag: str) -> Iterator[DataFrame]:
    """``settle`` for a step of a loop: the shuffle files go when it is written, the written rows at the end of the block."""
    spark, path = df.sparkSession, scratch_dir(df.sparkSession, tag)
    with released(spark):
        df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
