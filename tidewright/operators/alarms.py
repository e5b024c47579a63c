"""Alarm evaluation and threshold search.

The sweeps do not score every threshold separately. Each row is reduced to the index of
the threshold at which it changes sides; those indices are counted in one pass and the
costs of all thresholds follow from running sums over the small grid. Thresholds are
``lo + i * step`` for i in 0..n-1; the lowest one wins a tie.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import ALL, keyed, scalar_row
from .joins import interval_join, near_flags
from .ordered import CELL_ROWS, CHUNK_ROWS, running_sum


@dataclass(frozen=True)
class Grid:
    """Threshold grid; ``lo`` and ``step`` may be columns (for example from a scalar row)."""

    lo: float | Column
    step: float | Column
    n: int

    def at(self, i: Column) -> Column:
        return _lit(self.lo) + i * _lit(self.step)

    def reached(self, x: Column, strict: bool = False) -> Column:
        """Number of thresholds with ``thr <= x`` (``thr < x`` when strict); null x gives 0.

        The arithmetic guess is corrected against the thresholds themselves, so rounding in
        the division cannot put a row on the wrong side.
        """
        guess = F.floor((x - _lit(self.lo)) / _lit(self.step))
        guess = F.least(F.greatest(guess, F.lit(-1)), F.lit(self.n - 1)).cast("bigint")

        def below(i):
            t = self.at(i)
            return (t < x) if strict else (t <= x)

        last = (
            F.when((guess < self.n - 1) & below(guess + 1), guess + 1)
            .when((guess >= 0) & ~below(guess), guess - 1)
            .otherwise(guess)
        )
        return F.when(x.isNull(), F.lit(0)).otherwise(last + 1).cast("bigint")


def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(float(v))


def alarms_at(df: DataFrame, signal: str, thr: float, strict: bool = False) -> DataFrame:
    return df.where(F.col(signal) > thr if strict else F.col(signal) >= thr)


def alarm_metrics(
    df: DataFrame, windows: DataFrame, time: str, signal: str, thr: float, bucket: int
) -> DataFrame:
    """One row per window (detected, advance = label - earliest alarm) and one row with
    pos -1 holding the number of alarms outside all windows."""
    alarms = alarms_at(df, signal, thr).select(time)
    first = (
        interval_join(alarms, windows, time, "begin", "end", bucket)
        .groupBy("pos").agg(F.min(time).alias("_first"))
    )
    per = windows.join(first, "pos", "left").select(
        "pos", F.col("_first").isNotNull().alias("detected"),
        (F.col("label") - F.col("_first")).cast("double").alias("advance"),
        F.lit(0).cast("bigint").alias("false_alarms"),
    )
    outside = interval_join(alarms, windows, time, "begin", "end", bucket, how="left_anti")
    fp = outside.agg(F.count(F.lit(1)).alias("false_alarms")).select(
        F.lit(-1).cast("bigint").alias("pos"), F.lit(False).alias("detected"),
        F.lit(None).cast("double").alias("advance"), "false_alarms",
    )
    return per.unionByName(fp)


def alarm_cost(metrics: DataFrame, c_alarm: float, c_missed: float, c_late: float) -> DataFrame:
    is_window = F.col("pos") >= 0
    missed = F.sum(F.when(is_window & ~F.col("detected"), 1).otherwise(0))
    late = F.sum(F.when(F.col("detected") & (F.col("advance") <= 0), 1).otherwise(0))
    fp = F.sum("false_alarms")
    return metrics.agg(
        fp.alias("false_alarms"), missed.alias("missed"), late.alias("late"),
        (fp * c_alarm + missed * c_missed + late * c_late).alias("cost"),
    )


def window_maxima(
    df: DataFrame, windows: DataFrame, time: str, signal: str, bucket: int
) -> DataFrame:
    """Per window the maximum signal inside it and before its label; null without rows."""
    inside = interval_join(df.select(time, signal), windows, time, "begin", "end", bucket)
    maxima = inside.groupBy("pos").agg(
        F.max(signal).alias("m_all"),
        F.max(F.when(F.col(time) < F.col("label"), F.col(signal))).alias("m_pre"),
    )
    return windows.join(maxima, "pos", "left")


def sweep_windows(
    df: DataFrame, windows: DataFrame, time: str, signal: str, grid: Grid, bucket: int,
    c_alarm: float, c_missed: float, c_late: float,
) -> DataFrame:
    """Cost of every threshold against label windows, in one pass over the signal.

    With all / pre = number of thresholds a window's maxima reach: missed at i iff all <= i,
    late iff pre <= i < all; a row outside all windows is a false alarm at every i it reaches.
    """
    outside = interval_join(df.select(time, signal), windows, time, "begin", "end", bucket, how="left_anti")
    marks = _marks(outside, "fp", grid.reached(F.col(signal)))
    w = window_maxima(df, windows, time, signal, bucket)
    marks = marks.unionByName(_marks(w, "all", grid.reached(F.col("m_all"))))
    marks = marks.unionByName(_marks(w, "pre", grid.reached(F.col("m_pre"))))
    table = _grid_table(_grid_rows(df, grid.n), grid, marks, ["fp", "all", "pre"])
    # Counts above i: rows whose reached number is > i. Counts up to i: the rest.
    missed = F.col("all_upto")
    late = F.col("pre_upto") - F.col("all_upto")
    cost = F.col("fp_above") * c_alarm + missed * c_missed + late * c_late
    return table.select(
        "i", "thr", F.col("fp_above").alias("false_alarms"), missed.alias("missed"),
        late.alias("late"), cost.cast("double").alias("cost"),
    )


def _marks(df: DataFrame, kind: str, reached: Column) -> DataFrame:
    counts = df.select(reached.alias("reached")).groupBy("reached").agg(F.count(F.lit(1)).alias("c"))
    return counts.select(F.lit(kind).alias("kind"), "reached", "c")


def _grid_rows(df: DataFrame, n: int) -> DataFrame:
    """The n + 1 possible reached counts."""
    return df.sparkSession.range(n + 1).withColumnRenamed("id", "reached")


def _grid_table(rows: DataFrame, grid: Grid, marks: DataFrame, kinds: Sequence[str]) -> DataFrame:
    """Grid rows with the counts of each kind of mark at up to i and above i thresholds."""
    by = marks.groupBy("reached").agg(
        *[F.sum(F.when(F.col("kind") == k, F.col("c")).otherwise(0)).alias(k) for k in kinds]
    )
    # The grid is a fixed number of rows; its running sums need no partitioning.
    up = Window.orderBy("reached").rowsBetween(Window.unboundedPreceding, 0)
    every = Window.partitionBy()
    full = rows.join(by, "reached", "left").na.fill(0, list(kinds))
    for k in kinds:
        full = full.withColumn(f"{k}_upto", F.sum(k).over(up))
        full = full.withColumn(f"{k}_above", F.sum(k).over(every) - F.col(f"{k}_upto"))
    return full.where(F.col("reached") < grid.n).select(
        F.col("reached").alias("i"), grid.at(F.col("reached")).alias("thr"),
        *[f"{k}_{s}" for k in kinds for s in ("upto", "above")],
    )


def best_threshold(costs: DataFrame) -> DataFrame:
    """Row of the lowest cost; the lowest threshold wins a tie."""
    pick = F.min_by(F.struct(*costs.columns), F.struct("cost", "i"))
    return costs.agg(pick.alias("_b")).select("_b.*")


def sweep_tolerance(
    df: DataFrame, key: Sequence[str], pos: str, signal: str, anomaly: str, tolerance: int,
    grid: Grid, c_alarm: float, c_missed: float, rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Cost of every threshold when an alarm within +-tolerance rows of an anomaly counts.

    False alarm: signal > thr and no anomaly near. Miss: anomaly and no near signal > thr.
    """
    flag = F.when(F.col(anomaly) != 0, 1).otherwise(0)
    near = near_flags(df, key, pos, {"_anom": flag, "_sig": F.col(signal)}, tolerance, rows)
    fp = near.where(F.col("_anom") == 0)
    marks = _marks(fp, "fp", grid.reached(F.col(signal), strict=True))
    fn = near.where(flag == 1)
    marks = marks.unionByName(_marks(fn, "fn", grid.reached(F.col("_sig"), strict=True)))
    table = _grid_table(_grid_rows(df, grid.n), grid, marks, ["fp", "fn"])
    cost = F.col("fp_above") * c_alarm + F.col("fn_upto") * c_missed
    return table.select(
        "i", "thr", F.col("fp_above").alias("false_alarms"), F.col("fn_upto").alias("missed"),
        cost.cast("double").alias("cost"),
    )


def sweep_rows(
    df: DataFrame, score: str, label: str, n: int, c_alarm: float, c_missed: float,
    low_is_anomaly: bool = False,
) -> DataFrame:
    """Row-wise FP / FN cost at n thresholds between the lowest and highest score. A row is
    flagged when its score is above the threshold, or below it with ``low_is_anomaly``."""
    span = scalar_row(df.agg(F.min(score).cast("double").alias("lo"), F.max(score).cast("double").alias("hi")))
    step = (F.col("_s.hi") - F.col("_s.lo")) / F.lit(float(n - 1))
    rows = df.select(score, label).withColumn("_s", span)
    grid = Grid(F.col("_s.lo"), F.when(step > 0, step).otherwise(1.0), n)
    # above thr: the row is flagged at all i < reached(strict). below thr: at all i >= reached.
    reached = grid.reached(F.col(score).cast("double"), strict=not low_is_anomaly)
    pos = F.col(label) != 0
    marks = _marks(rows.where(~pos), "neg", reached).unionByName(_marks(rows.where(pos), "pos", reached))
    table = _grid_table(_grid_rows(df, n).withColumn("_s", span), grid, marks, ["neg", "pos"])
    if low_is_anomaly:
        fp, fn = F.col("neg_upto"), F.col("pos_above")
    else:
        fp, fn = F.col("neg_above"), F.col("pos_upto")
    return table.select(
        "i", "thr", fp.alias("false_alarms"), fn.alias("missed"),
        (fp * c_alarm + fn * c_missed).cast("double").alias("cost"),
    )


def rul_policy(
    df: DataFrame, key: str, pos: str, pred: str, thr: float, maintenance: float, safe: float
) -> DataFrame:
    """Cost, failures and slack of stopping each machine at its first prediction below thr.
    ``pos`` is 1-based; the stop index counts from 0."""
    per = df.groupBy(key).agg(
        F.min(F.when(F.col(pred) < thr, F.col(pos) - 1)).alias("_stop"), F.max(pos).alias("_len")
    )
    return _policy_total(per, [], maintenance, safe)


def _policy_total(per: DataFrame, by: list[str], maintenance: float, safe: float) -> DataFrame:
    never = F.col("_stop").isNull()
    gain = F.greatest(F.lit(0.0), F.col("_stop") - F.lit(float(safe)))
    return per.groupBy(*by).agg(
        F.sum(F.when(never, F.lit(float(maintenance))).otherwise(-gain)).alias("cost"),
        F.sum(F.when(never, 1).otherwise(0)).alias("fails"),
        F.sum(F.when(never, 0).otherwise(F.col("_len") - F.col("_stop"))).cast("bigint").alias("slack"),
    )


def sweep_rul(
    df: DataFrame, key: str, pos: str, pred: str, grid: Grid, maintenance: float, safe: float
) -> DataFrame:
    """``rul_policy`` for every threshold. Each row first counts at one threshold index; the
    earliest position per (machine, index) is combined map-side, so machines need no ordering."""
    # pred < thr_i holds exactly for i >= (number of thresholds <= pred).
    idx = grid.reached(F.col(pred))
    hits = df.groupBy(key, idx.alias("_i")).agg(F.min(F.col(pos) - 1).alias("_p"), F.max(pos).alias("_l"))
    per = hits.groupBy(key).agg(
        F.max("_l").alias("_len"),
        F.map_from_entries(F.collect_list(F.struct("_i", "_p"))).alias("_first"),
    )
    steps = per.select(
        key, "_len", "_first", F.explode(F.sequence(F.lit(0), F.lit(grid.n - 1))).alias("_j")
    ).withColumn("i", F.col("_j").cast("bigint"))
    entries = F.filter(F.map_entries("_first"), lambda e: e["key"] <= F.col("i"))
    steps = steps.select(
        key, "_len", "i", F.array_min(F.transform(entries, lambda e: e["value"])).alias("_stop")
    )
    total = _policy_total(steps, ["i"], maintenance, safe)
    return total.select("i", grid.at(F.col("i")).alias("thr"), "cost", "fails", "slack")


def regression_metrics(df: DataFrame, actual: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """RMSE, MAE, R2 and the residual's sample std from one aggregate over the complete pairs."""
    e = F.col(actual) - F.col(pred)
    seen = F.when(e.isNotNull(), F.col(actual))
    return df.groupBy(*by).agg(
        F.count(e).alias("n"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
        (1 - F.try_divide(F.sum(e * e), F.var_pop(seen) * F.count(seen))).alias("r2"),
        F.stddev(e).alias("residual_std"),
    )


def confusion(df: DataFrame, label: str, pred: Column) -> DataFrame:
    """Counts and per-class precision, recall, F1; a zero denominator gives 0."""
    y, p = F.col(label) != 0, pred

    def n(c):
        return F.sum(F.when(c, 1).otherwise(0))

    one = df.agg(n(~y & ~p).alias("tn"), n(~y & p).alias("fp"), n(y & ~p).alias("fn"), n(y & p).alias("tp"))

    def ratio(a, b):
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    def row(cls, hit, wrong, lost):
        prec = ratio(F.col(hit), F.col(hit) + F.col(wrong))
        rec = ratio(F.col(hit), F.col(hit) + F.col(lost))
        f1 = ratio(2 * F.col(hit), 2 * F.col(hit) + F.col(wrong) + F.col(lost))
        return F.struct(
            F.lit(cls).alias("cls"), prec.alias("precision"), rec.alias("recall"), f1.alias("f1")
        )

    both = F.array(row("0", "tn", "fn", "fp"), row("1", "tp", "fp", "fn"))
    return one.select("tn", "fp", "fn", "tp", F.explode(both).alias("_c")).select(
        "tn", "fp", "fn", "tp", "_c.*"
    )


def roc_auc(
    df: DataFrame, label: str, score: str, key: Sequence[str] = (), cells: int = CELL_ROWS
) -> DataFrame:
    """Rank AUC with ties at half. Rows collapse to (distinct score, negatives, positives);
    negatives below each score come from running sums over measured cells of about ``cells`` scores."""
    df, key = keyed(df, key)
    pos = F.sum(F.when(F.col(label) != 0, 1).otherwise(0))
    per = df.groupBy(*key, F.col(score).cast("double").alias("s")).agg(
        pos.alias("pos"), (F.count(F.lit(1)) - pos).alias("neg")
    )
    ranked = running_sum(per, key, ["s"], None, {"neg": "_below"}, exclusive=True, target=cells)
    wins = F.sum((F.col("_below") + F.col("neg") / 2.0) * F.col("pos"))
    return ranked.groupBy(*key).agg(
        F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"),
        F.try_divide(wins, (F.sum("pos") * F.sum("neg")).cast("double")).alias("auc"),
    ).drop(ALL)


def _chunks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """Label and scores of about ``rows`` rows at a time; NaN as infinity."""
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= rows:
            yield _decoded(held)
            held, n = [], 0
    if n:
        yield _decoded(held)


def _decoded(held: list[pa.RecordBatch]) -> tuple[np.ndarray, list[np.ndarray]]:
    t = pa.Table.from_batches(held)
    scores = [np.nan_to_num(c.to_numpy(), nan=np.inf, posinf=np.inf, neginf=-np.inf) for c in t.columns[1:]]
    return t.column(0).to_numpy(), scores


def _thinned(points: np.ndarray, weights: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """At most ``most`` of the points at even distances of their summed weights, ascending."""
    order = np.argsort(points, kind="stable")
    points, upto = points[order], np.cumsum(weights[order])
    k = min(most, len(points))
    at = np.searchsorted(upto, (np.arange(k) + 0.5) * upto[-1] / k) if k else np.empty(0, int)
    return points[at], np.full(k, upto[-1] / k if k else 0.0)


def _counted(parts: list[tuple[bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted scores and their counts from packed parts; a part without counts has one row per score."""
    v = [np.frombuffer(x) for x, _ in parts]
    if not any(len(c) for _, c in parts):
        v = np.sort(np.concatenate([*v, np.empty(0)]))
        return v, np.ones(len(v), np.int64)
    n = np.concatenate([np.frombuffer(c, np.int64) if len(c) else np.ones(len(x), np.int64) for x, (_, c) in zip(v, parts)])
    v = np.concatenate(v)
    order = np.argsort(v, kind="stable")
    return v[order], n[order]


def roc_aucs(
    df: DataFrame, label: str, scores: dict[str, Column], rows: int = 1 << 21, chunk: int = 1 << 18, points: int = 256
) -> DataFrame:
    """``roc_auc`` of several scores of the same rows; their names are in ``config``.

    Rows are not repeated per score. Quantiles of every task's rows cut each score's range into buckets of about ``rows``
    rows; equal scores share a bucket. Tasks sort and pack scores per class and bucket, a bucket counts its
    own pairs, and pairs across buckets follow from the rows per bucket. A null score ranks below all others, a null label
    is negative; an empty table has no result.
    """
    names = list(scores)
    table = df.select(
        F.coalesce(F.col(label) != 0, F.lit(False)).alias("y"),
        *[F.coalesce(c.cast("double"), F.lit(float("-inf"))).alias(f"s{i}") for i, c in enumerate(scores.values())],
    )

    def quantiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(np.empty(0), np.empty(0)) for _ in names]
        for _, columns in _chunks(batches, chunk):
            for i, s in enumerate(columns):
                p, w = _thinned(np.sort(s), np.ones(len(s)), points)
                held[i] = _thinned(np.r_[held[i][0], p], np.r_[held[i][1], w], 4 * points)
        arrays = [pa.array(range(len(names)), pa.int32()), *(pa.array([x.tobytes() for x in side], pa.binary()) for side in zip(*held))]
        yield pa.RecordBatch.from_arrays(arrays, ["i", "p", "w"])

    found = table.mapInArrow(quantiles, "i int, p binary, w binary").toPandas()
    edges = []
    for i in range(len(names)):
        own = found[found["i"] == i]
        p, w = (np.concatenate([np.frombuffer(x) for x in own[c]] or [np.empty(0)]) for c in ("p", "w"))
        p, w = _thinned(p, w, max(1, math.ceil(w.sum() / rows)) * 2)
        edges.append(np.unique(p[1::2]))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for y, columns in _chunks(batches, chunk):
            for i, s in enumerate(columns):
                out = []
                for side in (False, True):
                    v = np.sort(s[y == side])
                    cut = np.r_[0, np.searchsorted(v, edges[i]), len(v)]
                    for b in np.flatnonzero(cut[1:] > cut[:-1]):
                        x, n = v[cut[b] : cut[b + 1]], b""
                        first = np.flatnonzero(np.r_[True, x[1:] != x[:-1]])
                        if len(first) * 2 < len(x):
                            x, n = x[first], np.diff(np.r_[first, len(x)]).tobytes()
                        out.append((i, int(b), side, x.tobytes(), n))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["i", "b", "y", "v", "n"])

    kinds = [pa.int32(), pa.int32(), pa.bool_(), pa.binary(), pa.binary()]

    def pairs(t: pa.Table) -> pa.Table:
        sides = ([], [])
        for y, v, n in zip(*(t.column(c).to_pylist() for c in ("y", "v", "n"))):
            sides[y].append((v, n))
        (neg, negs), (pos, own) = map(_counted, sides)
        below = np.r_[0, np.cumsum(negs)]
        twice = int((own * (below[np.searchsorted(neg, pos)] + below[np.searchsorted(neg, pos, side="right")])).sum())
        row = {"i": t.column("i")[0].as_py(), "b": t.column("b")[0].as_py(), "pos": int(own.sum()), "neg": int(negs.sum()), "twice": twice}
        return pa.Table.from_pylist([row], pa.schema([("i", pa.int32()), ("b", pa.int32()), *((c, pa.int64()) for c in ("pos", "neg", "twice"))]))

    packed = table.mapInArrow(dealt, "i int, b int, y boolean, v binary, n binary").groupBy("i", "b")
    per = packed.applyInArrow(pairs, "i int, b int, pos bigint, neg bigint, twice bigint").collect()
    done = []
    for i, name in enumerate(names):
        wins = positives = negatives = 0
        for r in sorted((r for r in per if r["i"] == i), key=lambda r: r["b"]):
            wins += r["twice"] + 2 * r["pos"] * negatives
            positives, negatives = positives + r["pos"], negatives + r["neg"]
        if positives + negatives:
            done.append((name, positives, negatives, wins / 2 / (positives * negatives) if positives and negatives else None))
    return df.sparkSession.createDataFrame(done, "config string, positives bigint, negatives bigint, auc double")


def prediction_spread(df: DataFrame, actual: Column, pred: str) -> DataFrame:
    """Box statistics of the predictions per actual value."""
    from .quantiles import exact_quantiles

    d = df.withColumn("actual_value", actual)
    base = d.groupBy("actual_value").agg(
        F.count(F.lit(1)).alias("n"), F.min(pred).alias("lo"), F.max(pred).alias("hi")
    )
    q = exact_quantiles(d, ["actual_value"], pred, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    q = q.withColumnRenamed("actual_value", "_q")
    return base.join(q, F.col("actual_value").eqNullSafe(F.col("_q")), "left").drop("_q")


def group_gaps(df: DataFrame, groups: Sequence[str], pred: str) -> DataFrame:
    """Prediction statistics per protected group and its distance to the overall mean."""
    long = df.select(
        pred,
        F.explode(F.array(*[
            F.struct(F.lit(g).alias("attribute"), F.col(g).cast("string").alias("level")) for g in groups
        ])).alias("_g"),
    )
    overall = scalar_row(df.agg(F.avg(pred).alias("mean")))["mean"]
    return long.groupBy("_g.attribute", "_g.level").agg(
        F.count(F.lit(1)).alias("n"), F.avg(pred).alias("mean"), F.stddev(pred).alias("std")
    ).withColumn("gap", F.abs(F.col("mean") - overall))


def disparity(df: DataFrame, groups: Sequence[str], pred: str) -> DataFrame:
    """Sum over all protected groups of |overall mean - group mean|."""
    return group_gaps(df, groups, pred).agg(F.sum("gap").alias("didi"))
