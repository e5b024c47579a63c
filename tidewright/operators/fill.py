"""Missing values: neighbour fills, column statistics, nearest donors, regression, GP."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import idiv, scalar_row
from ..session import scratch_dir, settle
from .gram import cross_products
from .ordered import CHUNK_ROWS, LEVELS, framed, neighbours, positions
from .quantiles import exact_quantiles, melt


def _between(value: str, axis: str) -> Column:
    """Linear value between ``prev`` and ``next`` along ``axis``; after the last valid row the
    last value stands, before the first one the result is null."""
    a, b = F.col("prev"), F.col("next")
    slope = (b[value] - a[value]) / F.nullif((b[axis] - a[axis]).cast("double"), F.lit(0.0))
    inner = a[value] + slope * (F.col(axis) - a[axis])
    return F.coalesce(F.col(value), F.when(b.isNull(), a[value]).otherwise(inner))


def _nearest(value: str, axis: str) -> Column:
    """Closest valid value inside the observed range; a tie takes the earlier one."""
    a, b = F.col("prev"), F.col("next")
    nearer = F.when(F.col(axis) - a[axis] <= b[axis] - F.col(axis), a[value]).otherwise(b[value])
    return F.coalesce(F.col(value), F.when(a.isNotNull() & b.isNotNull(), nearer))


def fill_neighbours(
    df: DataFrame, key: Sequence[str], pos: str, value: str, methods: Sequence[str],
    axis: str | None = None, rows: int = CHUNK_ROWS,
) -> DataFrame:
    """One ``{value}_{method}`` column per method: forward, backward, linear (by position),
    time (by ``axis``), nearest. All share one pass over the neighbours."""
    extra = [axis] if axis and axis != pos else []
    n = neighbours(df, key, pos, value, extra, rows)
    forms = {
        "forward": lambda: F.coalesce(F.col(value), F.col("prev")[value]),
        "backward": lambda: F.coalesce(F.col(value), F.col("next")[value]),
        "linear": lambda: _between(value, pos),
        "time": lambda: _between(value, axis),
        "nearest": lambda: _nearest(value, axis or pos),
    }
    return n.withColumns({f"{value}_{m}": forms[m]() for m in methods}).drop("prev", "next")


def fill_quadratic(
    df: DataFrame, key: Sequence[str], pos: str, value: str, out: str, rows: int = CHUNK_ROWS
) -> DataFrame:
    """Quadratic through the two valid neighbours and the nearer of the next ones out;
    linear when there is no third point, null outside the observed range."""
    key = list(key)
    valid = df.where(F.col(value).isNotNull())
    ranked = positions(valid, key, [pos], [idiv(F.col(pos) - 1, rows)], "_vp")
    here = F.struct(F.col(pos).alias("p"), F.col(value).alias("v"))
    ranked = framed(
        ranked, key, "_vp", 1, 1,
        lambda w: {"_before": F.lag(here).over(w), "_after": F.lead(here).over(w)}, rows,
    ).drop("_vp")
    both = ranked.unionByName(df.where(F.col(value).isNull()), allowMissingColumns=True)
    n = neighbours(both, key, pos, value, ["_before", "_after"], rows)
    x = F.col(pos)
    a, b = F.col("prev"), F.col("next")
    far_a, far_b = a["_before"], b["_after"]
    take_a = far_b.isNull() | (x - far_a["p"] <= far_b["p"] - x)
    third = F.when(far_a.isNotNull() & take_a, far_a).otherwise(far_b)

    def basis(xi, xj, xk):
        return (x - xj) * (x - xk) / ((xi - xj) * (xi - xk)).cast("double")

    quad = (
        a[value] * basis(a[pos], b[pos], F.col("_third.p"))
        + b[value] * basis(b[pos], a[pos], F.col("_third.p"))
        + F.col("_third.v") * basis(F.col("_third.p"), a[pos], b[pos])
    )
    line = a[value] + (b[value] - a[value]) * (x - a[pos]) / (b[pos] - a[pos]).cast("double")
    inside = a.isNotNull() & b.isNotNull()
    filled = F.when(
        F.col(value).isNull() & inside,
        F.when(F.col("_third").isNull(), line).otherwise(quad),
    )
    n = n.withColumn("_third", third)
    return n.withColumn(out, F.coalesce(F.col(value), filled)).drop(
        "prev", "next", "_before", "_after", "_third"
    )


def fill_column_stat(
    df: DataFrame, means: Sequence[str] = (), medians: Sequence[str] = ()
) -> DataFrame:
    """Column mean or exact column median for nulls."""
    if means:
        df = df.withColumn("_m", scalar_row(df.agg(*[F.avg(c).alias(c) for c in means])))
        df = df.withColumns({c: F.coalesce(F.col(c), F.col(f"_m.{c}")) for c in means}).drop("_m")
    for c in medians:
        med = scalar_row(exact_quantiles(df, [], c, {"q": 0.5}))["q"]
        df = df.withColumn(c, F.coalesce(F.col(c), med))
    return df


def fill_forward_then_median(
    df: DataFrame, key: Sequence[str], pos: str, value: str, out: str, rows: int = CHUNK_ROWS
) -> DataFrame:
    """Per-key forward fill; what is left (leading nulls) takes the overall median."""
    filled = fill_neighbours(df, key, pos, value, ["forward"], rows=rows)
    med = scalar_row(exact_quantiles(df, [], value, {"q": 0.5}))["q"]
    return filled.withColumn(out, F.coalesce(F.col(f"{value}_forward"), med)).drop(f"{value}_forward")


def fill_knn(
    df: DataFrame, target: str, coords: Sequence[str], k: int, out: str, radius: float | None = None,
    least: float | None = 0.0, digits: int | None = 0,
) -> DataFrame:
    """Mean of the k nearest donors on standardised coordinates, rounded half-even to ``digits`` (None:
    not rounded) and not below ``least`` (None: no bound). Rows with a missing coordinate stay null.

    Rows of equal coordinates are merged first (count and sum), so work depends on the
    distinct coordinates. Donors tied at the k-th distance share the places that are left.
    Candidates come from an equi join on grid cells of side ``radius``; a query is settled
    when its k-th distance fits in the radius, the others are searched again with the
    radius doubled. The first radius is a quarter of the mean donor spacing, so dense
    regions settle on few candidates and only sparse ones look further. No pair outside
    neighbouring cells is formed and none is cut off.
    """
    d = len(coords)
    stats = df.agg(*[F.stddev_pop(c).alias(c) for c in coords]).first()
    scaled = [f"_s{i}" for i in range(d)]
    base = df.withColumns({
        s: F.round(F.col(c) / F.lit((stats[c] or 0.0) or 1.0), 12) for s, c in zip(scaled, coords)
    })
    # Rows with a missing coordinate are neither donors nor filled.
    known = base.na.drop(subset=scaled)
    donors = settle(
        known.where(F.col(target).isNotNull()).groupBy(*scaled)
        .agg(F.count(F.lit(1)).alias("_n"), F.sum(target).alias("_sum")), "knn-donors",
    )
    queries = settle(known.where(F.col(target).isNull()).select(*scaled).distinct(), "knn-queries")
    ends = donors.agg(
        *[(F.max(s) - F.min(s)).alias(s) for s in scaled],
        F.sum("_n").alias("n"), F.count(F.lit(1)).alias("points"),
    ).first()
    need = min(k, ends["n"] or 0)
    if not need:
        return df.withColumn(out, F.col(target))
    widest = max([ends[s] or 0.0 for s in scaled] + [1e-6])
    r = radius or widest * (need / ends["points"]) ** (1.0 / d) / 4.0
    pending, settled = queries, []
    while True:
        found = _ring_search(pending, donors, scaled, need, r)
        done = found.where((F.col("_got") >= need) & (F.col("_kth") <= r * r))
        settled.append(settle(done.select(*scaled, "_est"), "knn-found"))
        pending = settle(pending.join(settled[-1], scaled, "left_anti"), "knn-pending")
        if pending.isEmpty():
            break
        r *= 2.0
    estimates = settled[0]
    for part in settled[1:]:
        estimates = estimates.unionByName(part)
    guess = F.col("_est") if digits is None else F.bround("_est", digits)
    if least is not None:
        guess = F.when(guess.isNotNull(), F.greatest(F.lit(least), guess))
    filled = F.coalesce(F.col(target), guess)
    return base.join(estimates, scaled, "left").withColumn(out, filled).drop(*scaled, "_est")


def _ring_search(
    queries: DataFrame, donors: DataFrame, coords: list[str], k: int, r: float
) -> DataFrame:
    cells = [f"_c{i}" for i in range(len(coords))]
    q = queries
    for c, s in zip(cells, coords):
        at = F.floor(F.col(s) / r)
        q = q.withColumn(c, F.explode(F.array(at - 1, at, at + 1)))
    dn = donors.select(
        *[F.floor(F.col(s) / r).alias(c) for c, s in zip(cells, coords)],
        *[F.col(s).alias(f"_d{s}") for s in coords], "_n", "_sum",
    )
    pairs = q.join(dn, cells)
    dist = sum(((F.col(s) - F.col(f"_d{s}")) ** 2 for s in coords), F.lit(0.0))
    levels = pairs.groupBy(*coords, F.round(dist, 9).alias("_dist")).agg(
        F.sum("_n").alias("_n"), F.sum("_sum").alias("_sum")
    )
    near = Window.partitionBy(*coords).orderBy("_dist").rowsBetween(Window.unboundedPreceding, -1)
    left = F.lit(k) - F.coalesce(F.sum("_n").over(near), F.lit(0))
    used = levels.withColumn("_use", F.least(F.col("_n"), left)).where(F.col("_use") > 0)
    return used.groupBy(*coords).agg(
        F.sum("_use").alias("_got"), F.max("_dist").alias("_kth"),
        (F.sum(F.col("_use") * F.col("_sum") / F.col("_n")) / F.sum("_use")).alias("_est"),
    )


def fill_knn_all(
    df: DataFrame, columns: Sequence[str], k: int, suffix: str = "_filled", grid: int = 3, crowd: int = 256
) -> DataFrame:
    """Every column filled from the k nearest rows that have it: ``{column}{suffix}`` for each.

    Distance runs over the columns that both rows have, in units of each column's standard deviation, and is scaled
    up by all columns / common columns. Values of rows that tie at the k-th distance share the places left. A row that
    has no column in common with any donor takes the column's mean; a column without any value stays null. NaN
    counts as missing. Values are filled from given ones only, never from filled ones.
    """
    columns = list(columns)
    df = df.withColumns({f"_x{i}": F.nanvl(F.col(c).cast("double"), F.lit(None)) for i, c in enumerate(columns)})
    values = [f"_x{i}" for i in range(len(columns))]
    stats = df.agg(*[F.stddev_pop(x).alias(x) for x in values], *[F.avg(x).alias(f"m{x}") for x in values]).first()
    scaled = {x: F.round(F.col(x) / F.lit((stats[x] or 0.0) or 1.0), 12) for x in values}
    for i, (c, x) in enumerate(zip(columns, values)):
        names = [f"_s{j}" for j in range(len(columns) - 1)]
        others = [scaled[v].alias(n) for v, n in zip((v for v in values if v != x), names)]
        text = [F.coalesce(s.cast("string"), F.lit("-")) for s in (scaled[v] for v in values if v != x)]
        df = df.withColumn(f"_q{i}", F.concat_ws(",", *text))
        points = df.select(*others, F.col(f"_q{i}").alias("_q"), F.col(x).alias("_y")).withColumn("_has", _pattern(names))
        donors = settle(points.where(F.col("_y").isNotNull()).groupBy(*names, "_has").agg(F.count(F.lit(1)).alias("_n"), F.sum("_y").alias("_sum")), "knn-donors")
        queries = settle(points.where(F.col("_y").isNull()).select(*names, "_has", "_q").distinct(), "knn-queries")
        found = _nearest_rows(queries, donors, names, k, grid, crowd)
        mean = F.lit(stats[f"m{x}"]).cast("double")
        if found is not None:
            df = df.join(found.select(F.col("_q").alias(f"_q{i}"), F.col("_est").alias(f"_e{i}")), f"_q{i}", "left")
            mean = F.coalesce(f"_e{i}", mean)
        df = df.withColumn(f"{c}{suffix}", F.coalesce(x, mean)).drop(f"_q{i}", f"_e{i}")
    return df.drop(*values)


def _pattern(names: Sequence[str]) -> Column:
    """The present coordinates as bits."""
    return sum((F.when(F.col(n).isNotNull(), F.lit(1 << i)).otherwise(0) for i, n in enumerate(names)), F.lit(0)).cast("int")


def _nearest_rows(queries: DataFrame, donors: DataFrame, names: list[str], k: int, grid: int, crowd: int) -> DataFrame | None:
    """(_q, _est) of every query that has a coordinate in common with a donor.

    Queries and donors meet per pair of patterns in cells over at most ``grid`` of their common coordinates: the distance
    over some coordinates is a lower bound, so nothing within the radius is missed whatever their number.
    The radius starts where no cell has more than ``crowd`` donors (as far as distinct donors allow) and
    doubles for the queries whose k-th distance lies beyond it.
    """
    d = len(names)
    theirs = {r["_has"]: r["n"] for r in donors.groupBy("_has").agg(F.sum("_n").alias("n")).collect()}
    ours = [r["_has"] for r in queries.select("_has").distinct().collect()]
    need = {q: min(k, sum(n for has, n in theirs.items() if has & q)) for q in ours}
    if not any(need.values()):
        return None
    ends = donors.agg(*[(F.max(s) - F.min(s)).alias(s) for s in names]).first()
    r = max([ends[s] or 0.0 for s in names] + [1e-6])

    def cells(common: Column, radius: Column) -> list[Column]:
        side = radius * F.sqrt(F.bit_count(common) / F.lit(float(d)))
        below = [F.bit_count(common.bitwiseAND((1 << i) - 1)) for i in range(d)]
        return [
            F.when((common.bitwiseAND(1 << i) != 0) & (below[i] < grid), F.floor(F.col(n) / side))
            for i, n in enumerate(names)
        ]

    # The largest of the radii, each half of the one before, whose heaviest cell is small.
    own, level = F.col("_has"), F.col("_level")
    sizes = donors.where(own != 0).withColumn("_level", F.explode(F.sequence(F.lit(0), F.lit(LEVELS))))
    sizes = sizes.groupBy("_level", "_has", *[c.alias(f"_c{i}") for i, c in enumerate(cells(own, F.lit(r) / F.pow(F.lit(2.0), level)))]).count()
    light = sizes.groupBy("_level").agg(F.max("count").alias("n")).where(F.col("n") <= crowd).agg(F.min("_level")).first()[0]
    r /= 2.0 ** (LEVELS if light is None else light)
    places = F.create_map(*[F.lit(x) for q, n in need.items() for x in (q, n)])
    asking = queries.where(places[F.col("_has")] > 0).withColumn("_need", places[F.col("_has")])
    folder, schema, pending, number = scratch_dir(donors.sparkSession, "knn-found"), "_q string, _est double", asking, 0
    met = donors.withColumnsRenamed({"_has": "_dhas"}).withColumn("_qhas", F.explode(F.array(*map(F.lit, ours))))
    met = met.withColumn("_common", F.col("_dhas").bitwiseAND(F.col("_qhas"))).where(F.col("_common") != 0)
    asked = F.explode(F.array(*map(F.lit, theirs)))
    at = [f"_c{i}" for i in range(d)]
    while True:
        right = met.select(
            "_qhas", "_dhas", *[F.coalesce(c, F.lit(0)).alias(n) for c, n in zip(cells(F.col("_common"), F.lit(r)), at)],
            *[F.col(s).alias(f"_d{s}") for s in names], "_n", "_sum",
        )
        left = pending.withColumnRenamed("_has", "_qhas").withColumn("_dhas", asked)
        left = left.withColumn("_common", F.col("_dhas").bitwiseAND(F.col("_qhas"))).where(F.col("_common") != 0)
        for c, n in zip(cells(F.col("_common"), F.lit(r)), at):
            left = left.withColumn(n, F.explode(F.when(c.isNull(), F.array(F.lit(0).cast("bigint"))).otherwise(F.array(c - 1, c, c + 1))))
        pairs = left.join(right, ["_qhas", "_dhas", *at])
        apart = sum((F.coalesce((F.col(s) - F.col(f"_d{s}")) ** 2, F.lit(0.0)) for s in names), F.lit(0.0))
        dist = F.round(apart * F.lit(float(d)) / F.bit_count("_common"), 9)
        levels = pairs.groupBy("_q", "_need", dist.alias("_dist")).agg(F.sum("_n").alias("_n"), F.sum("_sum").alias("_sum"))
        nearer = Window.partitionBy("_q").orderBy("_dist").rowsBetween(Window.unboundedPreceding, -1)
        left_over = F.col("_need") - F.coalesce(F.sum("_n").over(nearer), F.lit(0))
        used = levels.withColumn("_use", F.least(F.col("_n"), left_over)).where(F.col("_use") > 0)
        found = used.groupBy("_q", "_need").agg(
            F.sum("_use").alias("_got"), F.max("_dist").alias("_kth"),
            (F.sum(F.col("_use") * F.col("_sum") / F.col("_n")) / F.sum("_use")).alias("_est"),
        )
        done = found.where((F.col("_got") >= F.col("_need")) & (F.col("_kth") <= r * r))
        done.select("_q", "_est").write.mode("overwrite").parquet(f"{folder}/round{number}")
        estimates = donors.sparkSession.read.schema(schema).parquet(f"{folder}/*")
        pending = asking.join(estimates, "_q", "left_anti")
        if pending.isEmpty():
            return estimates
        r, number = r * 2.0, number + 1


def fill_regression(
    df: DataFrame, target: str, predictors: Sequence[str], top: int, out: str, ridge: float = 1e-3
) -> DataFrame:
    """Predict missing cells from the ``top`` predictors most correlated with the target;
    the median of the target stands in where a predictor is missing too."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    corr = df.agg(*[F.abs(F.corr(target, p)).alias(p) for p in predictors]).first()
    ranked = sorted(predictors, key=lambda p: (-(corr[p] if corr[p] == corr[p] and corr[p] is not None else -1.0), p))
    chosen = ranked[:top]
    with_x = VectorAssembler(inputCols=chosen, outputCol="_x", handleInvalid="keep").transform(df)
    usable = F.lit(True)
    for c in chosen:
        usable = usable & F.col(c).isNotNull()
    model = LinearRegression(
        featuresCol="_x", labelCol=target, predictionCol="_pred", regParam=ridge, solver="normal"
    ).fit(with_x.where(usable & F.col(target).isNotNull()))
    median = scalar_row(exact_quantiles(df, [], target, {"q": 0.5}))["q"]
    guess = F.when(usable, F.col("_pred")).otherwise(median)
    return model.transform(with_x).withColumn(out, F.coalesce(F.col(target), guess)).drop("_x", "_pred")


def chained_equations(
    df: DataFrame, columns: Sequence[str], top: int | None = None, ridge: float = 1e-3
) -> tuple[np.ndarray, np.ndarray]:
    """(means, coefficients[j, k] of column k in the equation of column j) from one pass of pairwise products.

    Every column is regressed on the ``top`` others most correlated with it (all, without ``top``). Covariances come
    from the rows that have both columns, so a pairwise matrix that isn't positive is brought to the nearest that is.
    """
    p = cross_products(df, columns)
    d = len(columns)
    with np.errstate(divide="ignore", invalid="ignore"):
        cov = np.nan_to_num(p.products / p.both)
    np.fill_diagonal(cov, np.nan_to_num(np.diag(p.squares) / np.maximum(np.diag(p.both), 1)))
    spread = np.sqrt(np.where(np.diag(cov) > 0, np.diag(cov), 1.0))
    corr = cov / np.outer(spread, spread)
    values, vectors = np.linalg.eigh(corr) if d else (np.zeros(0), np.zeros((0, 0)))
    if d and values.min() < 0:
        corr = (vectors * np.maximum(values, 0.0)) @ vectors.T
    coef = np.zeros((d, d))
    for j in range(d):
        others = [k for k in range(d) if k != j and corr[j, k] != 0 and corr[k, k] > 0]
        chosen = sorted(others, key=lambda k: (-abs(corr[j, k]), k))[:top]
        if chosen:
            own = corr[np.ix_(chosen, chosen)] + ridge * np.eye(len(chosen))
            coef[j, chosen] = np.linalg.solve(own, corr[chosen, j]) * spread[j] / spread[chosen]
    return p.mean, coef


def fill_chained(
    df: DataFrame, columns: Sequence[str], top: int | None = None, ridge: float = 1e-3,
    rounds: int = 200, tol: float = 1e-10, suffix: str = "_filled",
) -> DataFrame:
    """All columns filled by chained equations: ``{column}{suffix}`` for each.

    The equations are fitted once; the rounds run within a row. A missing value starts at the column's median and
    takes the value of its equation, column after column with the newest values of the others, until no value
    moves by ``tol`` standard deviations. A column without a predictor keeps its median; one without any value stays
    null. NaN counts as missing. d * d numbers reach the driver, whatever the number of rows.
    """
    columns = list(columns)
    mean, coef = chained_equations(df, columns, top, ridge)
    long = melt(df, [], columns).where(~F.isnan("value"))
    medians = {r["feature"]: r["q"] for r in exact_quantiles(long, ["feature"], "value", {"q": 0.5}).collect()}
    start = np.array([medians.get(c, np.nan) for c in columns], dtype=float)
    scale = np.maximum(np.abs(np.nan_to_num(start)), 1.0)
    equations = [j for j in range(len(columns)) if coef[j].any() and not np.isnan(start[j])]

    @F.pandas_udf("array<double>")
    def filled(rows: pd.Series) -> pd.Series:
        x = np.array([np.array(r, dtype=float) for r in rows]).reshape(len(rows), len(columns))
        missing = np.isnan(x)
        x = np.where(missing, start, x)
        for _ in range(rounds if missing.any() else 0):
            moved = 0.0
            for j in equations:
                at = np.flatnonzero(missing[:, j])
                if len(at):
                    value = mean[j] + (x[at] - mean) @ coef[j]
                    moved = max(moved, float(np.abs(value - x[at, j]).max()) / scale[j])
                    x[at, j] = value
            if moved <= tol:
                break
        return pd.Series(list(x))

    done = df.withColumn("_chained", filled(F.array(*[F.col(c).cast("double") for c in columns])))
    values = {f"{c}{suffix}": F.nanvl(F.get("_chained", F.lit(i)), F.lit(None)) for i, c in enumerate(columns)}
    return done.withColumns(values).drop("_chained")


def gp_posterior(
    df: DataFrame, key: Sequence[str], pos: str, value: str,
    amplitude: float, length: float, period: float, period_length: float,
    period_amplitude: float, noise: float,
) -> DataFrame:
    """Posterior mean and std of a GP with given kernel parameters, per key.

    Every key is an independent series and is solved as a whole, in one group and in the cube of its
    observed rows: the caller's key columns (a day, a week) must keep series small."""
    def kernel(a, b):
        gap = np.abs(a[:, None] - b[None, :])
        smooth = amplitude * np.exp(-0.5 * (gap / length) ** 2)
        wave = period_amplitude * np.exp(-2.0 * (np.sin(np.pi * gap / period) / period_length) ** 2)
        return smooth + wave

    def solve(pdf):
        x = pdf[pos].to_numpy(dtype=float)
        y = pdf[value].to_numpy(dtype=float)
        seen = ~np.isnan(y)
        prior = amplitude + period_amplitude
        if not seen.any():
            mean, var = np.zeros(len(x)), np.full(len(x), prior + noise)
        else:
            centre = y[seen].mean()
            k = kernel(x[seen], x[seen]) + noise * np.eye(seen.sum())
            ks = kernel(x, x[seen])
            low = np.linalg.cholesky(k)
            w = np.linalg.solve(low.T, np.linalg.solve(low, y[seen] - centre))
            mean = centre + ks @ w
            half = np.linalg.solve(low, ks.T)
            var = prior + noise - (half**2).sum(axis=0)
        return pdf.assign(gp_mean=mean, gp_std=np.sqrt(np.maximum(var, 1e-12)))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.groupBy(*key).applyInPandas(solve, f"{fields}, gp_mean double, gp_std double")


def fill_scaled_by_slot(
    df: DataFrame, key: Sequence[str], pos: str, value: str, slot: str, out: str, gp: dict
) -> DataFrame:
    """Divide by the slot's std, run the GP, multiply back, clip at 0, fill only nulls."""
    stds = df.groupBy(slot).agg(F.stddev(value).alias("_sd"))
    scaled = df.join(stds, slot, "left").withColumn(
        "_sd", F.when(F.col("_sd") > 0, F.col("_sd")).otherwise(1.0)
    )
    scaled = scaled.withColumn("_scaled", F.col(value) / F.col("_sd"))
    post = gp_posterior(scaled, key, pos, "_scaled", **gp)
    back = F.greatest(F.col("gp_mean") * F.col("_sd"), F.lit(0.0))
    return post.withColumn(out, F.coalesce(F.col(value), back)).drop("_sd", "_scaled")
