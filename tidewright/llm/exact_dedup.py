"""Exact deduplication by stateful streaming over digests, with a full comparison of the bytes.

Every arriving row goes to an arrival log (digest, id, content locator). A Structured Streaming
aggregation keyed by digest reads the log; its state lies on disk (RocksDB state store,
checkpointed to the shared folder), has no watermark and therefore never expires. For each digest
it retains the row that stays, the first holder's locator and the number of copies. Digests
that were hit more than once have the full bytes of their rows compared; rows whose bytes differ
under one digest are grouped by the bytes themselves.

Skew: copies of one text are combined before the shuffle in the stream and in the comparison, so a
text that makes up a third of all rows costs each task one row.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from .common import LOCATOR, located, whole_text

_STATE = "spark.sql.streaming.stateStore."
_DISK = {
    f"{_STATE}providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STATE}rocksdb.changelogCheckpointing.enabled": "true",
    f"{_STATE}rocksdb.allowFAllocate": "false",  # many small stores would reserve more than they hold
}


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def _drain(spark: SparkSession, store: str, schema, batch_bytes: int) -> None:
    """Feed what is new in the log to the keyed state; every batch leaves the digests it touched."""
    log = spark.readStream.schema(schema).option("maxBytesPerTrigger", batch_bytes).parquet(f"{store}/log")
    arrived = log.withColumn("arrived", F.unix_micros(F.current_timestamp()))
    state = arrived.groupBy("digest").agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.struct("id", *LOCATOR)).alias("stays"),
        F.min(F.struct("arrived", *LOCATOR)).alias("holder"),
    )

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{store}/state/batch{number}")

    with _settings(spark, _DISK):
        stream = (
            state.writeStream.outputMode("update").trigger(availableNow=True)
            .option("checkpointLocation", f"{store}/checkpoint").foreachBatch(keep).start()
        )
        stream.awaitTermination()


def _contents(spark: SparkSession, docs: DataFrame, rows: DataFrame, text_col: str) -> DataFrame:
    """(locator, text) of this call's documents and of the files of earlier ones that ``rows`` name."""
    own = docs.select(*LOCATOR, whole_text(text_col).alias("text"))
    earlier = [r[0] for r in rows.select(LOCATOR[0]).distinct().join(docs.select(LOCATOR[0]).distinct(), LOCATOR[0], "left_anti").collect()]
    if not earlier:
        return own
    return own.union(located(spark.read.parquet(*earlier)).select(*LOCATOR, whole_text(text_col)))


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest=sha256,
    store: str | None = None,
    batch_bytes: int = 256 << 20,
) -> DataFrame:
    """One row per document: locator, id, keep_id, stays (locator of the row that stays), n, kept, digest.

    Texts are equal when their characters are; null counts as the empty text. Of equal texts the
    row with the largest id stays; a null id is smaller than any other, ties fall to the larger
    locator. Repeated rows are copies like any other. An empty table gives an empty result.

    ``store`` names a folder in shared storage that keeps log and state: later calls with further
    documents continue from it, and report all documents so far. Without it a call stands
    alone. ``digest`` may be a weaker hash; the result stays exact.
    """
    spark = docs.sparkSession
    store = store or scratch_dir(spark, "dedup")
    docs = located(docs)
    rows = docs.select(*LOCATOR, F.col(id_col).cast("bigint").alias("id"), digest(whole_text(text_col)).alias("digest"))
    rows.write.mode("append").parquet(f"{store}/log")
    _drain(spark, store, rows.schema, batch_bytes)
    log = spark.read.schema(rows.schema).parquet(f"{store}/log")
    touched = spark.read.parquet(f"{store}/state/*")
    newest = F.max_by(F.struct("stays", "holder", "n"), "n").alias("s")
    state = touched.groupBy("digest").agg(newest).select("digest", "s.*")
    state.where("n > 1").write.parquet(hits := scratch_dir(spark, "hits"))
    hit = spark.read.schema(state.schema).parquet(hits)

    mixed = _mixed(spark, docs, log, hit, text_col, digest, store)
    same = log.join(hit.select("digest", "stays", "n"), "digest", "left").withColumn(
        "stays", F.coalesce("stays", F.struct("id", *LOCATOR))
    )
    same = same.select(*LOCATOR, "id", "digest", "stays", F.coalesce("n", F.lit(1).cast("bigint")).alias("n"))
    if mixed is not None:
        same = same.join(mixed.select(*LOCATOR), LOCATOR, "left_anti").union(mixed.select(*same.columns))
    place = [F.col(f"stays.{c}") for c in LOCATOR]
    kept = (F.col(LOCATOR[0]) == place[0]) & (F.col(LOCATOR[1]) == place[1])
    return same.select(*LOCATOR, "id", F.col("stays.id").alias("keep_id"), "stays", "n", kept.alias("kept"), "digest")


def _mixed(spark, docs, log, hit, text_col, digest, store) -> DataFrame | None:
    """Full bytes of every hit: None if all rows of a digest agree, else the rows of the digests
    that don't, grouped by their bytes."""
    holders = hit.select(*[F.col(f"holder.{c}").alias(c) for c in LOCATOR])
    texts = _contents(spark, docs, holders, text_col).withColumn("digest", digest(F.col("text")))
    compared = texts.join(hit.select("digest"), "digest").groupBy("digest").agg(
        F.min("text").alias("least"), F.max("text").alias("most")
    )
    compared.where("least != most").select("digest").write.parquet(folder := scratch_dir(spark, "mixed"))
    bad = spark.read.schema("digest string").parquet(folder)
    if bad.isEmpty():
        return None
    rows = log.join(bad, "digest", "left_semi")
    texts = _contents(spark, docs, rows, text_col)
    rows = rows.join(texts, LOCATOR)
    per_text = rows.groupBy("digest", "text").agg(
        F.max(F.struct("id", *LOCATOR)).alias("stays"), F.count(F.lit(1)).alias("n")
    )
    return rows.join(per_text, ["digest", "text"]).select(*LOCATOR, "id", "digest", "stays", "n")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of every group of equal texts: the one with the largest id."""
    docs = located(docs)
    keep = exact_groups(docs, id_col, text_col).where("kept").select(*LOCATOR)
    return docs.join(keep, LOCATOR, "left_semi").drop(*LOCATOR)
