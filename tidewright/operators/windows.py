"""Window and sequence operators on positioned rows (see ``ordered``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import attach, idiv, scalar_row
from ..session import settle
from .ordered import CHUNK_ROWS, framed


def lag_by_position(
    df: DataFrame, key: Sequence[str], pos: str, value: str, lags: Sequence[int],
    rows: int = CHUNK_ROWS,
) -> DataFrame:
    """``{value}_lag_{k}`` per lag; null where the key has no such row."""
    return framed(
        df, key, pos, max(lags), 0,
        lambda w: {f"{value}_lag_{k}": F.lag(value, k).over(w) for k in lags}, rows,
    )


def lead_target(
    df: DataFrame, key: Sequence[str], pos: str, value: str, horizon: int, out: str,
    rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Value ``horizon`` rows ahead within the key; rows without one are dropped."""
    led = framed(
        df, key, pos, 0, horizon, lambda w: {out: F.lead(value, horizon).over(w)}, rows
    )
    return led.where(F.col(out).isNotNull())


def diff(df: DataFrame, key: Sequence[str], pos: str, value: str, rows: int = CHUNK_ROWS) -> DataFrame:
    return framed(
        df, key, pos, 1, 0,
        lambda w: {f"{value}_diff": F.col(value) - F.lag(value).over(w)}, rows,
    )


def pct_change(df: DataFrame, key: Sequence[str], pos: str, value: str, rows: int = CHUNK_ROWS) -> DataFrame:
    def cols(w):
        before = F.lag(value).over(w)
        return {f"{value}_ret": F.try_divide(F.col(value) - before, before)}

    return framed(df, key, pos, 1, 0, cols, rows)


def rolling(
    df: DataFrame, key: Sequence[str], pos: str, value: str, before: int, after: int,
    rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Mean and sample std over the frame, null until the frame is full of valid values."""

    def cols(w):
        f = w.rowsBetween(-before, after)
        full = F.count(value).over(f) == before + after + 1
        return {
            "roll_mean": F.when(full, F.avg(value).over(f)),
            "roll_std": F.when(full, F.stddev(value).over(f)),
        }

    return framed(df, key, pos, before, after, cols, rows)


def sliding_arrays(
    df: DataFrame, key: Sequence[str], pos: str, values: Sequence[str], length: int,
    stride: int = 1, out: str = "window", rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Each row with the array of the last ``length`` values (structs for several columns);
    the first ``length - 1`` rows of a key are dropped, then every ``stride``-th is kept."""
    item = F.col(values[0]) if len(values) == 1 else F.struct(*values)

    def cols(w):
        return {out: F.collect_list(item).over(w.rowsBetween(1 - length, 0))}

    full = framed(df, key, pos, length - 1, 0, cols, rows).where(F.col(pos) >= length)
    return full.where((F.col(pos) - length) % stride == 0) if stride > 1 else full


def sequence_targets(
    df: DataFrame, key: Sequence[str], pos: str, value: str, length: int, horizon: int = 1,
    rows: int = CHUNK_ROWS,
) -> DataFrame:
    """(past ``length`` values, next ``horizon`` values) pairs, complete ones only."""

    def cols(w):
        return {
            "past": F.collect_list(value).over(w.rowsBetween(1 - length, 0)),
            "future": F.collect_list(value).over(w.rowsBetween(1, horizon)),
        }

    pairs = framed(df, key, pos, length - 1, horizon, cols, rows)
    return pairs.where((F.size("past") == length) & (F.size("future") == horizon))


def stride_sample(df: DataFrame, pos: str, stride: int) -> DataFrame:
    return df.where((F.col(pos) - 1) % stride == 0)


def autocorrelation(
    df: DataFrame, key: Sequence[str], pos: str, value: str, lags: int, rows: int = CHUNK_ROWS
) -> DataFrame:
    """Standard estimator: lagged products around the full-series mean over the full-series
    sum of squares. Null cells take no part."""
    stats = df.groupBy(*key).agg(F.avg(value).alias("_mean"))
    centred = df.join(stats, list(key)).withColumn("_d", F.col(value) - F.col("_mean"))

    def cols(w):
        return {f"_p{k}": F.col("_d") * F.lag("_d", k).over(w) for k in range(1, lags + 1)}

    prods = framed(centred.select(*key, pos, "_d"), key, pos, lags, 0, cols, rows)
    sums = prods.groupBy(*key).agg(
        F.sum(F.col("_d") * F.col("_d")).alias("_c0"),
        *[F.sum(f"_p{k}").alias(f"_s{k}") for k in range(1, lags + 1)],
    )
    rows_ = F.array(*[
        F.struct(F.lit(k).cast("bigint").alias("lag"), F.try_divide(F.col(f"_s{k}"), F.col("_c0")).alias("acf"))
        for k in range(1, lags + 1)
    ])
    return sums.select(*key, F.explode(rows_).alias("_r")).select(*key, "_r.*")


PACF_SCHEMA_SUFFIX = "lag bigint, acf double, pacf double"


def partial_autocorrelation(acf: DataFrame, key: str) -> DataFrame:
    """Durbin-Levinson recursion per key over its few autocorrelations (one row per lag)."""
    import numpy as np

    def solve(pdf):
        pdf = pdf.sort_values("lag").reset_index(drop=True)
        r = pdf["acf"].to_numpy()
        phi = np.zeros(0)
        out = []
        for k in range(len(r)):
            num = r[k] - phi @ r[:k][::-1]
            den = 1.0 - phi @ r[:k]
            last = num / den
            phi = np.append(phi - last * phi[::-1], last)
            out.append(last)
        return pdf.assign(pacf=out)[[key, "lag", "acf", "pacf"]]

    return acf.select(key, "lag", "acf").groupBy(key).applyInPandas(
        solve, f"{key} string, {PACF_SCHEMA_SUFFIX}"
    )


FAN = 64


def ewm_mean(
    df: DataFrame, key: Sequence[str], pos: str, value: str, alpha: float, out: str,
    chunk: int = FAN, sums: tuple[str, str] | None = None,
) -> DataFrame:
    """Adjusted exponentially weighted mean; weights also decay across null rows. ``sums`` names columns for
    its numerator and denominator.

    (numerator, denominator) is a linear recurrence. A chunk of rows is summarised by its decayed
    sums, ``FAN`` chunks by theirs, and so on until a key has ``FAN`` summaries or fewer; the state
    at each start is then handed down level by level, and every chunk is folded once. No group
    exceeds ``chunk`` or ``FAN`` rows and nothing is forgotten, whatever the key's length.
    """
    key, keep = list(key), 1.0 - alpha
    valid = F.col(value).isNotNull()
    base = df.withColumn("_chunk", idiv(F.col(pos) - 1, chunk))
    left = F.pow(F.lit(keep), (F.lit(chunk - 1) - (F.col(pos) - 1) % chunk).cast("double"))
    ends = base.groupBy(*key, "_chunk").agg(
        F.sum(F.when(valid, F.col(value) * left).otherwise(0.0)).alias("_num"),
        F.sum(F.when(valid, left).otherwise(0.0)).alias("_den"),
    )
    carried = _carry_decay(ends, key, keep**chunk)
    row = F.struct(F.col(pos).alias("_p"), F.col(value).cast("double").alias("_x"), F.struct(*df.columns).alias("_row"))
    rows = base.groupBy(*key, "_chunk").agg(F.collect_list(row).alias("_rows"))
    rows = rows.withColumn("_rows", F.array_sort("_rows", lambda a, b: F.signum(a["_p"] - b["_p"]).cast("int")))
    state = F.struct(F.col("_num0").alias("n"), F.col("_den0").alias("d"))

    def step(acc: Column, r: Column) -> Column:
        gap = F.pow(F.lit(keep), (r["_p"] - acc["p"]).cast("double"))
        n = acc["s"]["n"] * gap + F.coalesce(r["_x"], F.lit(0.0))
        d = acc["s"]["d"] * gap + F.when(r["_x"].isNotNull(), 1.0).otherwise(0.0)
        now = F.struct(n.alias("n"), d.alias("d"))
        mean = F.struct(r["_row"].alias("row"), now.alias("sums"), F.try_divide(n, d).alias("mean"))
        return F.struct(r["_p"].alias("p"), now.alias("s"), F.concat(acc["out"], F.array(mean)).alias("out"))

    kind = f"array<struct<row:{df.schema.simpleString()},sums:struct<n:double,d:double>,mean:double>>"
    before = (F.col("_chunk") * chunk).cast(dict(df.dtypes)[pos])
    start = F.struct(before.alias("p"), state.alias("s"), F.array().cast(kind).alias("out"))
    done = rows.join(carried, [*key, "_chunk"]).select(
        F.explode(F.aggregate("_rows", start, step, lambda acc: acc["out"])).alias("_r")
    )
    parts = [F.col(f"_r.sums.{f}").alias(c) for f, c in zip("nd", sums or ())]
    return done.select("_r.row.*", F.col("_r.mean").alias(out), *parts)


def _carry_decay(ends: DataFrame, key: list[str], factor: float) -> DataFrame:
    """State before each chunk: sum over earlier chunks of end state * factor ** distance."""
    ends = settle(ends, "ewm")
    last = ends.agg(F.max("_chunk")).first()[0]
    upper = ends.withColumns({"_upper": idiv("_chunk", FAN), "_at": F.col("_chunk") % FAN})
    if last is None or last < FAN:
        upper = upper.withColumns({"_n0": F.lit(0.0), "_d0": F.lit(0.0)})
    else:
        rest = F.pow(F.lit(factor), (F.lit(FAN - 1) - F.col("_at")).cast("double"))
        sums = upper.groupBy(*key, F.col("_upper").alias("_chunk")).agg(
            F.sum(F.col("_num") * rest).alias("_num"), F.sum(F.col("_den") * rest).alias("_den")
        )
        above = _carry_decay(sums, key, factor**FAN)
        upper = upper.join(above.toDF(*key, "_upper", "_n0", "_d0"), [*key, "_upper"])
    w = Window.partitionBy(*key, "_upper").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    past = F.collect_list(F.struct("_at", "_num", "_den")).over(w)

    def total(field: str, start: str) -> Column:
        from_above = F.col(start) * F.pow(F.lit(factor), F.col("_at").cast("double"))
        return F.aggregate(
            "_past", from_above,
            lambda a, s: a + s[field] * F.pow(F.lit(factor), (F.col("_at") - s["_at"] - 1).cast("double")),
        )

    return upper.withColumn("_past", past).select(
        *key, "_chunk", total("_num", "_n0").alias("_num0"), total("_den", "_d0").alias("_den0")
    )


def survival_from_hazard(hazard: Column, w: Window) -> Column:
    """Cumulative product of (1 - hazard) along a bounded frame; 0 from the first hazard of 1."""
    f = w.rowsBetween(Window.unboundedPreceding, 0)
    dead = F.max(F.when(hazard >= 1, 1).otherwise(0)).over(f)
    logs = F.sum(F.when(hazard < 1, F.log1p(-hazard)).otherwise(0.0)).over(f)
    return F.when(dead == 1, 0.0).otherwise(F.exp(logs))


def first_crossing(df: DataFrame, key: Sequence[str], pos: str, pred: str, thr: float) -> DataFrame:
    """First position with ``pred < thr`` per key, null when there is none."""
    return df.groupBy(*key).agg(
        F.min(F.when(F.col(pred) < thr, F.col(pos))).alias("stop"), F.max(pos).alias("length")
    )


def chronological_split(
    df: DataFrame, key: Sequence[str], pos: str, train: float, val: float
) -> DataFrame:
    """First share of a key's rows train, next val, rest test. ``pos`` is gap-free, so its
    maximum is the group size."""
    sizes = df.groupBy(*key).agg(F.max(pos).alias("_n"))
    a = F.floor(F.col("_n") * train)
    b = F.floor(F.col("_n") * (train + val))
    part = F.when(F.col(pos) <= a, "train").when(F.col(pos) <= b, "val").otherwise("test")
    return attach(df, sizes, key).withColumn("part", part).drop("_n")


def walk_forward(
    df: DataFrame, year: str, label: str, first_test: int, span: int
) -> DataFrame:
    """Expanding training years against the next ``span`` test years, one row copy per fold
    it takes part in. Folds reach to the newest year, so the last may be short; folds whose train or
    test part has one class only are skipped."""
    newest = scalar_row(df.agg(F.max(year).alias("y")))["y"]
    folds = F.when(newest >= first_test, F.sequence(F.lit(first_test), newest, F.lit(span)))
    rows = df.withColumn("fold", F.explode(folds)).where(F.col(year) < F.col("fold") + span)
    rows = rows.withColumn("part", F.when(F.col(year) < F.col("fold"), "train").otherwise("test"))
    ok = (
        rows.groupBy("fold", "part")
        .agg((F.min(label) < F.max(label)).alias("both"))
        .groupBy("fold")
        .agg((F.min("both") & (F.count(F.lit(1)) == 2)).alias("ok"))
        .where("ok")
    )
    return rows.join(ok.select("fold"), "fold")
