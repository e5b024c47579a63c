"""What the training-data operators share: row locators, shared scratch tables, text defaults."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import settle, small_batches

FILE, ROW = "_at_file", "_at_row"
LOCATOR = [FILE, ROW]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(text: str = "text") -> Column:
    """The text column with null as the empty text."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def located(docs: DataFrame) -> DataFrame:
    """``docs`` with the place of every row (file and row number) as two more columns.

    A place names a row even where ids are null or repeated. A DataFrame that isn't read
    straight from Parquet is written to the shared folder first.
    """
    small_batches(docs.sparkSession)
    if FILE in docs.columns:
        return docs
    try:
        return _with_place(docs)
    except AnalysisException:
        return _with_place(settle(docs, "content"))


def _with_place(docs: DataFrame) -> DataFrame:
    meta = docs.metadataColumn("_metadata")
    return docs.select("*", meta["file_path"].alias(FILE), meta["row_index"].alias(ROW))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Arrow batches in small slices: what a task makes of whole texts stays a few megabytes."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)
