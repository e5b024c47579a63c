"""Cross products of wide tables: one matrix per partition, summed over partitions.

A table of d columns has d * d products. Up to ``FEW`` columns they are plain aggregates. More of them would have to
be planned one by one; there every partition multiplies its rows as a matrix and emits d rows, which are summed
in two steps. Columns are centred first, so no digits are lost to large means. d * d numbers reach the driver,
whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 64  # matrix rows that travel together
FEW = 10  # columns whose products are planned as aggregates


@dataclass(frozen=True)
class Products:
    """Per pair (i, j) over the rows in which both have values, centred by ``mean``: ``both`` counts them,
    ``sums`` and ``squares`` add up i, ``products`` i * j."""

    mean: np.ndarray
    both: np.ndarray
    sums: np.ndarray
    squares: np.ndarray
    products: np.ndarray

    def correlation(self) -> np.ndarray:
        """Pearson coefficients on pairwise complete rows; NaN where a column doesn't vary."""
        with np.errstate(divide="ignore", invalid="ignore"):
            cross = self.products - self.sums * self.sums.T / self.both
            spread = self.squares - self.sums**2 / self.both
            floor = 1e-14 * np.maximum(self.squares, np.finfo(float).tiny)
            spread = np.where(spread > floor, spread, np.nan)
            return np.clip(cross / np.sqrt(spread * spread.T), -1.0, 1.0)


def cross_products(df: DataFrame, columns: Sequence[str], complete: bool = False) -> Products:
    """``complete`` leaves out rows with any null first."""
    columns = list(columns)
    d = len(columns)
    rows = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    rows = rows.na.drop() if complete else rows
    if 0 < d <= FEW:
        return _few_products(rows)
    rows = rows.select(F.array(*rows.columns).alias("x"))

    def matrix(b: pa.RecordBatch) -> np.ndarray:
        return b.column(0).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, d)

    def column_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, d))
        for b in batches:
            x = matrix(b)
            total += np.stack([np.nansum(x, axis=0), (~np.isnan(x)).sum(axis=0)])
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["start", "m"])

    def added(parts: DataFrame) -> list[np.ndarray]:
        parts = parts.withColumn("part", F.spark_partition_id() % 64).groupBy("start", "part").applyInPandas(_add, _SCHEMA)
        done = parts.groupBy("start").applyInPandas(_add, _SCHEMA).toPandas().sort_values("start")
        return [np.frombuffer(m) for m in done["m"]]

    sums, counts = (added(rows.mapInArrow(column_sums, _SCHEMA)) or [np.zeros(2 * d)])[0].reshape(2, d)
    mean = np.divide(sums, counts, out=np.zeros(d), where=counts > 0)
    starts = list(range(0, d, BLOCK))

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((4, d, d))
        for b in batches:
            flat = matrix(b) - mean
            seen = ~np.isnan(flat)
            x, m = np.where(seen, flat, 0.0), seen.astype(float)
            total += np.stack([m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x])
        blocks = [total[:, s : s + BLOCK].tobytes() for s in starts]
        yield pa.RecordBatch.from_arrays([pa.array(starts, pa.int32()), pa.array(blocks, pa.binary())], ["start", "m"])

    matrices = [m.reshape(4, -1, d) for m in added(rows.mapInArrow(multiply, _SCHEMA))] or [np.zeros((4, d, d))]
    return Products(mean, *np.concatenate(matrices, axis=1))


def _few_products(rows: DataFrame) -> Products:
    """Two passes of aggregates: means, then centred sums. Pairs are counted one by one only where a value is missing."""
    names = rows.columns
    d = len(names)
    rows = rows.select(*[F.nanvl(c, F.lit(None)).alias(c) for c in names])
    first = rows.agg(F.count(F.lit(1)), *[f(c) for c in names for f in (F.count, F.avg)]).first()
    n, counts, mean = first[0], first[1::2], np.array([m or 0.0 for m in first[2::2]])
    x = [F.col(c) - F.lit(float(m)) for c, m in zip(names, mean)]
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    products = [F.sum(x[i] * x[j]) for i, j in pairs]

    def square(values, at) -> np.ndarray:
        out = np.zeros((d, d))
        for (i, j), v in zip(at, values):
            out[i, j] = v or 0.0
        return out

    def mirrored(values) -> np.ndarray:
        m = square(values, pairs)
        return np.triu(m) + np.triu(m, 1).T

    if all(c == n for c in counts):
        got = rows.agg(*products, *[F.sum(c) for c in x]).first()
        m = mirrored(got[: len(pairs)])
        sums = np.array([s or 0.0 for s in got[len(pairs) :]])
        return Products(mean, np.full((d, d), float(n)), np.tile(sums[:, None], d), np.tile(np.diag(m)[:, None], d), m)
    every = [(i, j) for i in range(d) for j in range(d)]
    seen = [F.col(c).isNotNull() for c in names]
    both = [F.count(F.when(seen[i] & seen[j], 1)) for i, j in pairs]
    sums = [F.sum(F.when(seen[j], x[i])) for i, j in every]
    squares = [F.sum(F.when(seen[j], x[i] * x[i])) for i, j in every]
    got = list(rows.agg(*both, *products, *sums, *squares).first())
    p, e = len(pairs), len(every)
    return Products(mean, mirrored(got[:p]), square(got[2 * p : 2 * p + e], every), square(got[2 * p + e :], every), mirrored(got[p : 2 * p]))


_SCHEMA = "start int, m binary"


def _add(pdf: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"start": pdf["start"].iloc[:1], "m": [sum(np.frombuffer(m) for m in pdf["m"]).tobytes()]})
