"""Typed readers. Every schema is declared; nothing is inferred."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.exprs import attach, micros
from ..operators.joins import with_group_size

SERIES_SCHEMA = "timestamp timestamp_ntz, value double"
LABEL_MAP = "map<string,array<string>>"
WINDOW_MAP = "map<string,array<array<string>>>"


def read_series(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """CSV series -> (key = file name, t, value)."""
    raw = spark.read.schema(SERIES_SCHEMA).csv(paths, header=True)
    return raw.select(
        F.element_at(F.split(F.input_file_name(), "/"), -1).alias("key"),
        micros("timestamp").alias("t"), "value",
    )


def label_rows(json_text: Column, df: DataFrame) -> DataFrame:
    """JSON map {series: [time, ...]} -> (key, pos, label), positions kept."""
    m = df.select(F.explode(F.from_json(json_text, LABEL_MAP)).alias("key", "_v"))
    return m.select("key", F.posexplode("_v").alias("pos", "_t")).select(
        "key", F.col("pos").cast("bigint").alias("pos"),
        micros(F.to_timestamp("_t")).alias("label"),
    )


def window_rows(json_text: Column, df: DataFrame) -> DataFrame:
    """JSON map {series: [[begin, end], ...]} -> (key, pos, begin, end)."""
    m = df.select(F.explode(F.from_json(json_text, WINDOW_MAP)).alias("key", "_v"))
    return m.select("key", F.posexplode("_v").alias("pos", "_w")).select(
        "key", F.col("pos").cast("bigint").alias("pos"),
        micros(F.to_timestamp(F.element_at("_w", 1))).alias("begin"),
        micros(F.to_timestamp(F.element_at("_w", 2))).alias("end"),
    )


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    return label_rows(F.col("value"), spark.read.text(path, wholetext=True))


def read_windows(spark: SparkSession, path: str) -> DataFrame:
    return window_rows(F.col("value"), spark.read.text(path, wholetext=True))


def read_runs(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Space-separated run-to-failure files -> src, machine (unique over files), cycle,
    p1..p3, s1..s21, rul. The two trailing blanks per line give no column here."""
    names = ["machine", "cycle", "p1", "p2", "p3", *[f"s{i}" for i in range(1, 22)]]
    types = ["int", "int", *["double"] * 24]
    schema = ", ".join(f"{n} {t}" for n, t in zip(names, types)) + ", _x1 string, _x2 string"
    raw = spark.read.schema(schema).csv(list(paths), sep=" ").drop("_x1", "_x2")
    stem = F.regexp_replace(F.element_at(F.split(F.input_file_name(), "/"), -1), r"\.[^.]*$", "")
    shifted = shift_ids(raw.withColumn("src", stem), "src", "machine")
    sized = with_group_size(shifted, ["machine"], "_n")
    return sized.select("src", *names, (F.col("_n") - F.col("cycle")).cast("int").alias("rul"))


def shift_ids(df: DataFrame, source: str, ident: str) -> DataFrame:
    """Make ids unique over sources: add the number of distinct ids of all earlier sources."""
    ids = df.select(source, ident).distinct().groupBy(source).agg(F.count(F.lit(1)).alias("_k"))
    earlier = Window.orderBy(source).rowsBetween(Window.unboundedPreceding, -1)
    shift = ids.select(source, F.coalesce(F.sum("_k").over(earlier), F.lit(0)).alias("_shift"))
    return attach(df, shift, [source]).withColumn(ident, F.col(ident) + F.col("_shift")).drop("_shift")


def read_delimited(
    spark: SparkSession, path: str, schema: str, sep: str = ";", null: str = "?"
) -> DataFrame:
    return spark.read.schema(schema).csv(path, header=True, sep=sep, nullValue=null)


def read_event_log(spark: SparkSession, path: str) -> DataFrame:
    """Arrival log: event times parsed, unused flow column dropped. No global sort is kept."""
    schema = "Triage string, TkCharge string, Code string, Outcome string, Flow string"
    raw = read_delimited(spark, path, schema, null="").drop("Flow")
    return raw.withColumns(
        {c: F.to_timestamp(c).cast("timestamp_ntz") for c in ("Triage", "TkCharge")}
    )


def dayfirst(text: str | Column) -> Column:
    """Strict dd/MM/yyyy date; a malformed text fails the query."""
    return F.to_date(text, "dd/MM/yyyy")


def dayfirst_or_null(text: str | Column) -> Column:
    """Malformed dates become null so they can be set aside."""
    return F.try_to_date(text, "dd/MM/yyyy")


def align_xy(features: DataFrame, targets: DataFrame, ident: str, target: str) -> DataFrame:
    """Features with their target by id, never by position; the target column must exist."""
    if target not in targets.columns:
        raise ValueError(f"target column {target!r} is missing")
    return features.join(targets.select(ident, target), ident, "inner")
