"""Writers: one folder per artifact."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.clean import clip


def write_artifacts(artifacts: dict[str, DataFrame], folder: str, fmt: str = "parquet") -> None:
    for name, df in artifacts.items():
        writer = df.write.mode("errorifexists")
        if fmt == "csv":
            writer.csv(f"{folder}/{name}", header=True)
        else:
            writer.parquet(f"{folder}/{name}")


def read_artifact(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}")


def submission(df: DataFrame, ident: str, pred: str, low: float = 10.0, high: float = 100.0) -> DataFrame:
    """Predictions clipped to the allowed range, keyed by id."""
    return df.select(ident, clip(pred, low, high).alias("y"))
