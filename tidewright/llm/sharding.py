"""A uniform shuffle into shards of exact size by a hypergeometric communication matrix.

The rows of a source cell (a run of ``CELL`` rows of one file) are permuted at their place, a matrix drawn
beforehand says how many of them go to each shard, and inside a shard the arrivals are permuted
again. With multivariate hypergeometric counts every order of all rows is as likely as any other,
although no row is compared with one outside its cell or its part of a shard.

The matrix is drawn in two steps, so that nobody holds all of it: the driver draws for ``BLOCKS``
groups of cells (the only counts it sees), a task then draws for the cells of a group. All draws
depend on ``seed`` and on file and row numbers alone; a task that runs again draws the same.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import positions
from ..session import settle
from .common import FILE, ROW, located

SHARDS, CELL, BLOCKS = 16, 1 << 16, 1024
NUMPY_LIMIT = 10**9


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int, limit: int = NUMPY_LIMIT) -> int:
    """How many of ``n`` rows drawn without replacement come from ``good``. Beyond numpy's limit the
    distribution is summed around its mode, where all but 1e-20 of it lies."""
    if good + bad < limit:
        return int(rng.hypergeometric(good, bad, n)) if good + bad else 0
    least, most = max(0, n - bad), min(n, good)
    mode = min(most, max(least, (n + 1) * (good + 1) // (good + bad + 2)))
    share = good / (good + bad)
    wide = 20 + int(12 * math.sqrt(n * share * (1 - share) + 1))
    x = np.arange(max(least, mode - wide), min(most, mode + wide) + 1, dtype=float)
    ratio = np.log(good - x[:-1]) + np.log(n - x[:-1]) - np.log(x[1:]) - np.log(bad - n + x[1:])
    p = np.concatenate([[0.0], np.cumsum(ratio)])
    p = np.exp(p - p.max())
    return int(x[min(len(x) - 1, np.searchsorted(np.cumsum(p), rng.random() * p.sum(), side="right"))])


def matrix(counts: list[int], room: list[int], rng: np.random.Generator, limit: int = NUMPY_LIMIT) -> np.ndarray:
    """Counts per source and shard with the given margins, distributed as in a uniform shuffle."""
    room = [int(r) for r in room]
    out = np.zeros((len(counts), len(room)), dtype=np.int64)
    for i, n in enumerate(counts):
        n, rest = int(n), sum(room)
        for j, r in enumerate(room):
            rest -= r
            out[i, j] = hypergeometric(rng, r, rest, n, limit) if n else 0
            n -= int(out[i, j])
        room = [r - int(x) for r, x in zip(room, out[i])]
    return out


def shard_sizes(rows: int, shards: int) -> list[int]:
    return [rows // shards + (j < rows % shards) for j in range(shards)]


def _communication(cells: DataFrame, shards: int, seed: int) -> DataFrame:
    """(file, cell, n) -> the same with ``ends``, the running counts per shard."""
    spark = cells.sparkSession
    block = F.pmod(F.xxhash64(FILE, "_cell"), F.lit(BLOCKS))
    cells = settle(cells.withColumn("_block", block), "cells")
    totals = sorted((r[0], r[1]) for r in cells.groupBy("_block").agg(F.sum("_n")).collect())
    drawn = matrix([n for _, n in totals], shard_sizes(sum(n for _, n in totals), shards), np.random.default_rng([seed, 0]))
    quotas = spark.createDataFrame(
        [(b, [int(x) for x in row]) for (b, _), row in zip(totals, drawn)], "_block bigint, _quota array<bigint>"
    )

    def draw(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([FILE, "_cell"])
        rng = np.random.default_rng([seed, 1, int(pdf["_block"].iloc[0])])
        ends = matrix(pdf["_n"].tolist(), list(pdf["_quota"].iloc[0]), rng).cumsum(axis=1)
        return pdf[[FILE, "_cell", "_n"]].assign(_ends=list(ends))

    kind = f"{FILE} string, _cell bigint, _n bigint, _ends array<bigint>"
    return settle(cells.join(quotas, "_block").groupBy("_block").applyInPandas(draw, kind), "matrix")


def _place_in_cell(seed: int, cell_rows: int):
    """A row's place after the permutation of its cell; permutations follow from (seed, file, cell)."""

    @F.pandas_udf("bigint")
    def place(key: pd.Series, n: pd.Series, row: pd.Series) -> pd.Series:
        out = np.empty(len(key), dtype=np.int64)
        key, n, at = key.to_numpy(), n.to_numpy(), row.to_numpy() % cell_rows
        for k in pd.unique(key):
            here = np.flatnonzero(key == k)
            order = np.random.default_rng([seed, 2, int(k) & (2**64 - 1)]).permutation(int(n[here[0]]))
            out[here] = order[at[here]]
        return pd.Series(out)

    return place


def shuffled(docs: DataFrame, shards: int = SHARDS, seed: int = 11, cell_rows: int = CELL) -> DataFrame:
    """``docs`` with ``shard`` (0 to shards - 1, sizes at most one apart) and ``slot`` (gapless from 0
    in each shard), a uniform shuffle of all rows.

    Every row is placed once, whatever its values: null and repeated ids, null or equal texts and repeated
    rows are rows like others, as a row is named by file and row number. An empty table stays empty.
    Columns of ``docs`` named shard or slot are replaced; names that begin with _cell, _block, _n, _ends,
    _at_ or _mix are the operator's own. Beyond the rows themselves, a task holds one cell's permutation,
    the driver ``BLOCKS`` counts.
    """
    rows = located(docs).drop("shard", "slot").withColumn("_cell", F.expr(f"{ROW} div {cell_rows}"))
    cells = rows.groupBy(FILE, "_cell").agg(F.count(F.lit(1)).alias("_n"))
    ends = _communication(cells, shards, seed)
    n = ends.agg(F.sum("_n")).first()[0] or 0
    place = _place_in_cell(seed, cell_rows)(F.xxhash64(FILE, "_cell"), "_n", ROW)
    sent = rows.join(ends, [FILE, "_cell"]).withColumn("_place", place)
    sent = sent.withColumn("shard", F.size(F.filter("_ends", lambda e: e <= F.col("_place"))))
    mix = F.xxhash64(F.lit(seed), F.lit("arrival"), FILE, ROW)
    sent = sent.withColumn("_mix", F.shiftrightunsigned(mix, 33)).drop("_cell", "_n", "_ends", "_place")
    parts = -(-n // (shards * cell_rows)) or 1
    part = F.expr(f"(_mix * {parts}) div {1 << 31}")
    done = positions(sent, ["shard"], ["_mix", FILE, ROW], [part], "slot")
    own = [f"`{c}`" for c in docs.columns if c not in ("shard", "slot", FILE, ROW)]
    return done.select(*own, "shard", (F.col("slot") - 1).alias("slot"))


def row_bytes(text: str) -> Column:
    """UTF-8 bytes of the text and one more; null has none."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint")


def write_shards(docs: DataFrame, path: str, rows_per_file: int = 1 << 20) -> None:
    """The shards as folders ``shard=j``; a file holds one run of slots, in slot order."""
    run = F.expr(f"slot div {rows_per_file}")
    dealt = docs.repartition(F.col("shard"), run).sortWithinPartitions("shard", "slot")
    dealt.write.option("maxRecordsPerFile", rows_per_file).partitionBy("shard").parquet(path)
