"""Kernel density scores.

Both sides are reduced to distinct points first (training points with weights). How the kernel is summed depends
on its reach:

* *Gaussian, one number*: training points become ``TERMS`` moments per cell of a quarter to half a bandwidth, an
  aggregate like any other. The moments of the cells within ``REACH`` bandwidths give one polynomial per cell of
  evaluation points (Hermite series of the kernel), and a point's sum is that polynomial's value. No pair of points is
  formed. Where the sum is so small that farther cells could matter, the point is summed by tiles instead.
* *Kernels of bounded reach*: tiles of neighbouring cells only.
* *Arrays*: all tiles.

A tile holds a bounded number of points of each side, so no point pairs become rows and no slot has to fit into one
task; the tiles of a point are combined in log space. Neglected terms are below 1e-10 of a sum.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import attach, hash31, scalar_row
from ..session import settle
from .quantiles import exact_quantiles

TILE = 4096
KERNELS = ("gaussian", "tophat", "linear")
TERMS, REACH, RUN = 24, 14.0, 64  # RUN cells cover the reach: a cell is at least a quarter of a bandwidth wide
LEAST = 1e-30  # of the total weight; cells beyond REACH hold at most exp(-13.75^2 / 2) = 9e-42 of it


def bandwidth_rule(df: DataFrame, key: Sequence[str], value: str, out: str = "h") -> DataFrame:
    """0.9 * min(std, IQR / 1.34) * n ** (-1/5) per key."""
    base = df.groupBy(*key).agg(F.stddev(value).alias("_sd"), F.count(value).alias("_n"))
    q = exact_quantiles(df, key, value, {"_q1": 0.25, "_q3": 0.75})
    if key:
        j = base.join(q, list(key))
    else:
        row = scalar_row(q)
        j = base.withColumns({"_q1": row["_q1"], "_q3": row["_q3"]})
    spread = F.least(F.col("_sd"), (F.col("_q3") - F.col("_q1")) / 1.34)
    return j.select(*key, (0.9 * spread * F.pow(F.col("_n").cast("double"), F.lit(-0.2))).alias(out))


def _kernel_sums(x: np.ndarray, h: np.ndarray, p: np.ndarray, w: np.ndarray, kernel: str):
    """Largest exponent and kernel sum of each evaluation point over the tile's points."""
    top, total = np.zeros(len(x)), np.zeros(len(x))
    step = max(1, (1 << 20) // max(1, p.size))
    for i in range(0, len(x), step):
        part = slice(i, i + step)
        d2 = ((x[part, None, :] - p[None, :, :]) ** 2).sum(axis=2) / (h[part, None] ** 2)
        if kernel == "gaussian":
            top[part] = -0.5 * d2.min(axis=1)
            total[part] = np.exp(-0.5 * d2 - top[part, None]) @ w
        elif kernel == "tophat":
            total[part] = (d2 < 1).astype(float) @ w
        else:
            total[part] = np.maximum(0.0, 1.0 - np.sqrt(d2)) @ w
    return top, total


def kde_scores(
    train: DataFrame, points: DataFrame, slot: Sequence[str], value: str, bandwidth: str | float,
    kernel: str = "gaussian", dims: int | None = None, out: str = "signal", tile: int = TILE,
) -> DataFrame:
    """Negative log density of the distinct points of each slot.

    ``train`` holds slot columns, ``value`` and weight ``w``; ``points`` slot columns,
    ``value`` and, when ``bandwidth`` names a column, the bandwidth. ``value`` is a number,
    or an array of ``dims`` numbers. A zero density gives a null signal.
    """
    if kernel not in KERNELS or (dims is not None and kernel != "gaussian"):
        raise ValueError(f"kernel {kernel!r} is not available for this input")
    slot = list(slot)
    h = F.col(bandwidth) if isinstance(bandwidth, str) else F.lit(float(bandwidth))
    # Distinct points feed several branches below; they are computed once.
    pts = settle(train.groupBy(*slot, value).agg(F.sum("w").cast("double").alias("w")), "kde-train")
    evals = points.select(*slot, value, h.cast("double").alias("_h")).distinct()
    totals = pts.groupBy(*slot).agg(F.sum("w").alias("_total"))
    keys = [*slot, value, "_h", "_total"]
    if dims is not None:
        evals = settle(attach(evals, totals, slot).where(F.col("_total").isNotNull()), "kde-points")
        merged = _tile_sums(evals, pts, slot, keys, value, kernel, dims, tile)
    else:
        level = F.when((F.col("_h") > 0) & (F.col("_h") < float("inf")), F.ceil(F.log2("_h")).cast("int"))
        evals = attach(evals, totals, slot).where(F.col("_total").isNotNull())
        evals = settle(evals.withColumn("_level", level), "kde-points")
        if kernel == "gaussian":
            near = settle(_moment_sums(evals, pts, slot, value), "kde-near")
            enough = F.coalesce(F.col("_s") > LEAST * F.col("_total"), F.lit(False))
            far = near.where(~enough).select(*keys)
            merged = near.where(enough).select(*keys, F.lit(0.0).alias("_m"), "_s")
            if not far.isEmpty():
                merged = merged.unionByName(_tile_sums(far, pts, slot, keys, value, kernel, None, tile))
        else:
            merged = _ring_sums(evals, pts, slot, keys, value, kernel, tile)
    d = dims or 1
    per_dim = {"gaussian": 0.5 * math.log(2 * math.pi), "tophat": math.log(2.0), "linear": 0.0}[kernel]
    log_density = F.col("_m") + F.log(F.nullif("_s", F.lit(0.0))) - F.log("_total")
    signal = -(log_density - d * F.log("_h") - F.lit(d * per_dim))
    named = [F.col("_h").alias(bandwidth)] if isinstance(bandwidth, str) else []
    return merged.select(*slot, value, *named, signal.alias(out))


def _matching(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi join with fresh names on the right: both sides may come from the same table."""
    fresh = right.select(*[F.col(c).alias(f"_r_{c}") for c in on], *[c for c in right.columns if c not in on])
    hit = [F.col(c) == F.col(f"_r_{c}") for c in on]
    return left.join(fresh, hit, how).drop(*[f"_r_{c}" for c in on])


def _hermite(u: np.ndarray, n: int) -> np.ndarray:
    """He_0..He_n-1 of u, each over its factorial's square root (no overflow), times exp(-u^2 / 2)."""
    out = np.empty((n, len(u)))
    out[0] = np.exp(-0.5 * u * u)
    for i in range(1, n):
        out[i] = u * out[i - 1] / math.sqrt(i) - (math.sqrt((i - 1) / i) * out[i - 2] if i > 1 else 0.0)
    return out


def _translation(ratio: float) -> np.ndarray:
    """(cell offset, moment, coefficient): what a moment of a cell adds to the polynomial of the cell
    ``offset`` places on; ``ratio`` is cell width over bandwidth. Polynomials and moments are in cell widths."""
    far = int(REACH / ratio)
    herm = _hermite(np.arange(-far, far + 1) * ratio, 2 * TERMS)
    j, k = np.arange(TERMS)[None, :], np.arange(TERMS)[:, None]
    log_f = np.array([math.lgamma(i + 1) for i in range(2 * TERMS)])
    size = (j + k) * math.log(ratio) + 0.5 * log_f[j + k] - log_f[j] - log_f[k]
    return herm[j + k].transpose(2, 0, 1) * (np.exp(size) * (-1.0) ** j)


def _moment_sums(evals: DataFrame, pts: DataFrame, slot: list[str], value: str) -> DataFrame:
    """``evals`` with ``_s``, the kernel sum over the cells within REACH (null where there are none)."""
    width = F.pow(F.lit(2.0), F.col("_level") - 2)

    def cell(df: DataFrame) -> DataFrame:
        at = F.floor(F.col(value) / width + 0.5)
        return df.withColumn("_cell", at).withColumn("_z", (F.col(value) - at * width) / width)

    spread = cell(_matching(pts, evals.where(F.col("_level").isNotNull()).select(*slot, "_level").distinct(), slot))
    sums = [F.sum(F.col("w") * F.pow("_z", F.lit(float(k)))).alias(f"_m{k}") for k in range(TERMS)]
    cells = spread.groupBy(*slot, "_level", "_cell").agg(*sums)
    moments = F.array(*[f"_m{k}" for k in range(TERMS)])
    cells = settle(cells.select(*slot, "_level", "_cell", moments.alias("_moments")), "kde-cells")

    own = cell(evals)
    asked = own.where(F.col("_level").isNotNull()).select(*slot, "_h", "_level", "_cell").distinct()
    run = F.floor(F.col("_cell") / RUN)
    left = asked.withColumn("_run", run)
    wanted = left.select(*slot, "_h", "_level", "_run").distinct()
    beside = F.explode(F.array(run - 1, run, run + 1))
    right = _matching(wanted, cells.withColumn("_run", beside), [*slot, "_level", "_run"])
    fresh = {c: f"_r{i}" for i, c in enumerate([*slot, "_h", "_level", "_run"])}
    right = right.select(*[F.col(c).alias(n) for c, n in fresh.items()], F.col("_cell").alias("_at"), "_moments")

    def polynomials(here: pd.DataFrame, there: pd.DataFrame) -> pd.DataFrame:
        if here.empty:
            return here[[*slot, "_h", "_cell"]].assign(_poly=[])
        ratio = 2.0 ** (int(here["_level"].iloc[0]) - 2) / float(here["_h"].iloc[0])
        table = _translation(ratio)
        far = len(table) // 2
        at = here["_cell"].to_numpy()
        low = int(at.min()) - far
        grid = np.zeros((int(at.max()) + far + 1 - low, TERMS))
        if len(there):
            place = there["_at"].to_numpy() - low
            inside = (place >= 0) & (place < len(grid))
            if inside.any():
                grid[place[inside]] = np.stack(there["_moments"].to_numpy()[inside])
        # The offset is the evaluation cell minus the training cell.
        windows = np.stack([grid[i : i + 2 * far + 1][::-1] for i in at - low - far])
        poly = np.einsum("eok,okj->ej", windows, table, optimize=True)
        return here[[*slot, "_h", "_cell"]].assign(_poly=list(poly))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in asked.select(*slot, "_h", "_cell").schema.fields)
    made = left.groupBy(*fresh).cogroup(right.groupBy(*fresh.values())).applyInPandas(polynomials, f"{schema}, _poly array<double>")
    found = _matching(own, settle(made, "kde-polynomials"), [*slot, "_h", "_cell"], "left")
    total = F.element_at("_poly", TERMS)
    for j in range(TERMS - 1, 0, -1):
        total = total * F.col("_z") + F.element_at("_poly", j)
    return found.select(*slot, value, "_h", "_total", total.alias("_s"))


def _ring_sums(
    evals: DataFrame, pts: DataFrame, slot: list[str], keys: list[str], value: str, kernel: str, tile: int
) -> DataFrame:
    """Kernels that end at one bandwidth: a point meets its cell and the two beside it."""
    at = F.floor(F.col(value) / F.pow(F.lit(2.0), F.col("_level")))
    own = evals.withColumn("_cell", at)
    levels = evals.where(F.col("_level").isNotNull()).select(*slot, "_level").distinct()
    beside = _matching(pts, levels, slot).withColumn("_cell", F.explode(F.array(at - 1, at, at + 1)))
    ring = [*slot, "_level", "_cell"]
    sums = _tile_sums(own, settle(beside, "kde-beside"), ring, [*keys, "_level", "_cell"], value, kernel, None, tile)
    return _matching(evals.drop("_level"), sums.drop("_total", "_level", "_cell"), [*slot, value, "_h"], "left")


def _tile_sums(
    evals: DataFrame, pts: DataFrame, slot: list[str], keys: list[str], value: str, kernel: str, dims: int | None, tile: int
) -> DataFrame:
    """``keys`` of ``evals`` with ``_m`` and ``_s``: the sum over the slot's points is _s * exp(_m)."""

    def tiles_needed(df: DataFrame, name: str):
        n = F.ceil(F.count(F.lit(1)) / tile).cast("bigint")
        return df.groupBy(*slot).agg(n.alias(name))

    # Each side is hashed into its slot's tiles and meets every tile of the other side.
    sizes = _matching(tiles_needed(evals, "_ne"), tiles_needed(pts, "_np"), slot)

    def tile_of(n: str):
        return F.pmod(F.xxhash64(value), F.col(n))

    def every(n: str):
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))

    evals = evals.join(sizes, slot).select(*keys, tile_of("_ne").alias("_te"), every("_np").alias("_tp"))
    # Fresh names on one side: both sides may come from the same table.
    slot_p = [f"_slot{i}" for i in range(len(slot))]
    pts = pts.join(sizes, slot).select(
        *[F.col(c).alias(n) for c, n in zip(slot, slot_p)], F.col(value).alias("_p"), F.col("w").alias("_w"),
        tile_of("_np").alias("_tp2"), every("_ne").alias("_te2"),
    )

    def as_matrix(c: pd.Series) -> np.ndarray:
        return np.stack(c.to_list()).astype(float) if dims else c.to_numpy(dtype=float)[:, None]

    def score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return left[keys].assign(_top=0.0, _s=0.0).iloc[:0]
        top, total = _kernel_sums(
            as_matrix(left[value]), left["_h"].to_numpy(), as_matrix(right["_p"]),
            right["_w"].to_numpy(), kernel,
        )
        return left[keys].assign(_top=top, _s=total)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in evals.select(*keys).schema.fields)
    sums = (
        evals.groupBy(*slot, "_te", "_tp").cogroup(pts.groupBy(*slot_p, "_te2", "_tp2"))
        .applyInPandas(score, f"{schema}, _top double, _s double")
    )
    top = F.max("_top")
    parts = F.collect_list(F.struct("_top", "_s"))
    merged = sums.groupBy(*keys).agg(top.alias("_m"), parts.alias("_parts"))
    total = F.aggregate(
        "_parts", F.lit(0.0), lambda s, q: s + q["_s"] * F.exp(q["_top"] - F.col("_m"))
    )
    return merged.select(*keys, "_m", total.alias("_s"))


def kde_signal(
    train: DataFrame, rows: DataFrame, slot: Sequence[str], value: str, bandwidth: str | float,
    kernel: str = "gaussian", dims: int | None = None, out: str = "signal",
) -> DataFrame:
    """Attach the density signal to every row (joined back on slot and value)."""
    scores = kde_scores(train, rows, slot, value, bandwidth, kernel, dims, out)
    keep = [c for c in scores.columns if c != bandwidth]
    return rows.join(settle(scores.select(*keep), "kde-scores"), [*slot, value], "left")


def bandwidth_cv(
    rows: DataFrame, value: str, ident: str, bandwidths: Sequence[float], folds: int, seed: int = 0
) -> DataFrame:
    """Mean held-out log density per bandwidth over hashed folds, all folds and bandwidths in
    one plan."""
    f = rows.select(value, F.pmod(hash31(ident, seed), F.lit(folds)).alias("fold"))
    counts = f.groupBy("fold", value).agg(F.count(F.lit(1)).cast("double").alias("w"))
    others = counts.withColumn("held", F.explode(F.array(*[F.lit(i).cast("bigint") for i in range(folds)])))
    train = others.where(F.col("held") != F.col("fold")).select(F.col("held").alias("fold"), value, "w")
    points = counts.select(
        "fold", value, "w", F.explode(F.array(*[F.lit(float(b)) for b in bandwidths])).alias("h")
    )
    scores = kde_scores(train, points, ["fold"], value, "h")
    scored = points.join(scores, ["fold", value, "h"])
    per_fold = scored.groupBy("h", "fold").agg(
        F.sum(-F.col("signal") * F.col("w")).alias("loglik"), F.sum("w").alias("n")
    )
    return per_fold.groupBy("h").agg(
        F.avg("loglik").alias("mean_loglik"), F.sum("n").cast("bigint").alias("n")
    )
