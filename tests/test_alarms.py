"""One-pass sweeps against their definitions."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewright.operators import alarms


def window_cost(t, s, wins, thr, ca, cm, cl):
    alarm = [a for a, v in zip(t, s) if v >= thr]
    used, missed, late = set(), 0, 0
    for b, e, lab in wins:
        inside = [a for a in alarm if b <= a < e]
        used.update(inside)
        if not inside:
            missed += 1
        elif lab - min(inside) <= 0:
            late += 1
    fp = sum(a not in used for a in alarm)
    return fp, missed, late, ca * fp + cm * missed + cl * late


@pytest.mark.parametrize("seed", range(6))
def test_sweep_windows(spark, seed):
    rng = np.random.default_rng(seed)
    n = 120
    t = rng.choice(600, n, replace=False)
    s = rng.integers(0, 12, n) / 2.0
    wins = [(0, 50, 20), (30, 90, 95), (200, 260, 200), (700, 800, 750), (400, 400, 400)]
    df = spark.createDataFrame(pd.DataFrame({"t": t, "s": s}))
    w = spark.createDataFrame([(i, *x) for i, x in enumerate(wins)], "pos bigint, begin bigint, end bigint, label bigint")
    grid = alarms.Grid(0.0, 0.5, 14)
    table = alarms.sweep_windows(df, w, "t", "s", grid, 37, 1.0, 7.0, 3.0)
    got = table.orderBy("i").collect()
    costs = []
    for i, row in enumerate(got):
        fp, missed, late, cost = window_cost(t, s, wins, 0.5 * i, 1.0, 7.0, 3.0)
        assert (row["false_alarms"], row["missed"], row["late"], row["cost"]) == (fp, missed, late, cost)
        costs.append(cost)
    best = alarms.best_threshold(table).first()
    assert best["i"] == int(np.argmin(costs)) and best["cost"] == min(costs)


def test_sweep_windows_without_signal(spark):
    df = spark.createDataFrame([], "t bigint, s double")
    w = spark.createDataFrame([(0, 0, 5, 3)], "pos bigint, begin bigint, end bigint, label bigint")
    rows = alarms.sweep_windows(df, w, "t", "s", alarms.Grid(0.0, 1.0, 3), 10, 1.0, 2.0, 3.0).collect()
    assert [(r["false_alarms"], r["missed"], r["late"]) for r in rows] == [(0, 1, 0)] * 3


@pytest.mark.parametrize("seed", range(4))
def test_sweep_tolerance(spark, seed):
    rng = np.random.default_rng(seed)
    n, tol = 150, 3
    s = rng.integers(0, 8, n).astype(float)
    a = (rng.random(n) < 0.08).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"key": "k", "pos": np.arange(1, n + 1), "s": s, "a": a}))
    got = alarms.sweep_tolerance(df, ["key"], "pos", "s", "a", tol, alarms.Grid(-1.0, 1.0, 10), 1.0, 5.0, rows=11)
    for row in got.collect():
        flagged, anomalies = np.flatnonzero(s > row["thr"]), np.flatnonzero(a)
        alone = [not any(abs(p - q) <= tol for q in anomalies) for p in flagged]
        unseen = [not any(abs(q - p) <= tol for p in flagged) for q in anomalies]
        assert (row["false_alarms"], row["missed"]) == (sum(alone), sum(unseen))


@pytest.mark.parametrize("low", [True, False])
def test_sweep_rows(spark, low):
    rng = np.random.default_rng(9)
    score, y = rng.integers(0, 40, 300) / 7.0, (rng.random(300) < 0.3).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"s": score, "y": y}))
    got = alarms.sweep_rows(df, "s", "y", 40, 1.0, 3.0, low_is_anomaly=low).orderBy("i").collect()
    for row in got:
        flag = score < row["thr"] if low else score > row["thr"]
        assert row["false_alarms"] == int((flag & (y == 0)).sum())
        assert row["missed"] == int((~flag & (y == 1)).sum())


#: Machine -> predictions; below, threshold -> (cost, machines that fail, cycles given up) worked out by
#: hand: stopping before cycle i (from 0) earns max(0, i - 2), running to the end costs 10.
RUNS = {"a": [5.0, 4.0, 3.0, 2.0, 1.0], "b": [9.0, 8.0, 7.0], "c": [0.0, 6.0, 6.0, 6.0]}
BY_HAND = {
    0.0: (30.0, 3, 0),  # nobody stops
    1.0: (20.0, 2, 4),  # c at 0, gives up 4
    2.0: (8.0, 1, 5),  # a at 4 earns 2
    4.0: (10.0, 1, 7),  # a at 2
    5.0: (10.0, 1, 8),  # a at 1
    8.0: (0.0, 0, 10),  # a at 0, b at 2
    9.0: (0.0, 0, 11),  # b at 1
}


def test_sweep_rul_and_policy(spark):
    rows = [(m, i + 1, p) for m, run in RUNS.items() for i, p in enumerate(run)]
    df = spark.createDataFrame(rows, "m string, pos bigint, pred double")
    swept = alarms.sweep_rul(df, "m", "pos", "pred", alarms.Grid(0.0, 1.0, 10), 10.0, 2.0).collect()
    by_threshold = {r["thr"]: (r["cost"], r["fails"], r["slack"]) for r in swept}
    for thr, want in BY_HAND.items():
        assert by_threshold[thr] == want
        one = alarms.rul_policy(df, "m", "pos", "pred", thr, 10.0, 2.0).first()
        assert (one["cost"], one["fails"], one["slack"]) == want


def test_grid_edges_are_exact(spark):
    grid = alarms.Grid(0.1, 0.1, 50)
    xs = [0.1 + i * 0.1 for i in range(50)] + [-5.0, 9.9, None]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    out = df.select("x", grid.reached(F.col("x")).alias("a"), grid.reached(F.col("x"), strict=True).alias("b")).collect()
    thr = [0.1 + i * 0.1 for i in range(50)]
    for r in out:
        x = r["x"]
        assert r["a"] == (0 if x is None else sum(v <= x for v in thr))
        assert r["b"] == (0 if x is None else sum(v < x for v in thr))


def test_roc_auc_with_ties(spark):
    rng = np.random.default_rng(5)
    s, y = rng.integers(0, 15, 200).astype(float), (rng.random(200) < 0.4).astype(int)
    pos, neg = s[y == 1], s[y == 0]
    want = np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])
    df = spark.createDataFrame(pd.DataFrame({"s": s, "y": y}))
    assert alarms.roc_auc(df, "y", "s", cells=4).first()["auc"] == pytest.approx(want)


def test_metrics_use_complete_pairs(spark):
    rows = [(1.0, 1.5), (2.0, 1.0), (3.0, 3.5), (50.0, None), (None, 7.0)]
    r = alarms.regression_metrics(spark.createDataFrame(rows, "y double, p double"), "y", "p").first()
    y, p = np.array([1.0, 2.0, 3.0]), np.array([1.5, 1.0, 3.5])
    assert r["n"] == 3
    assert r["r2"] == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())


def test_aucs_of_several_scores_do_not_repeat_rows(spark):
    """Against the single form, with ties, nulls, NaN and a burst, in one bucket and in many."""
    rng = np.random.default_rng(6)
    n = 3000
    pdf = pd.DataFrame({"y": rng.integers(0, 2, n), "a": rng.normal(size=n), "b": rng.integers(0, 4, n) * 1.0, "c": np.where(rng.random(n) < 0.9, 5.0, rng.normal(size=n) * 1e6)})
    df = spark.createDataFrame(pdf).repartition(5)
    df = df.withColumn("d", F.when(F.col("b") > 0, F.col("a"))).withColumn("e", F.when(F.col("b") == 1, F.lit(float("nan"))).otherwise(F.col("a")))
    df = df.withColumn("y", F.when(F.abs("a") < 2.5, F.col("y")))
    scores = {c: F.col(c) for c in "abcde"}
    want = {c: alarms.roc_auc(df, "y", c).first() for c in scores}
    for more in ({}, {"rows": 100, "chunk": 64, "points": 16}):
        got = alarms.roc_aucs(df, "y", scores, **more).collect()
        assert [r["config"] for r in got] == list(scores)
        for r in got:
            w = want[r["config"]]
            assert (r["positives"], r["negatives"], r["auc"]) == (w["positives"], w["negatives"], pytest.approx(w["auc"], abs=1e-12))
    assert alarms.roc_aucs(df.limit(0), "y", scores).count() == 0
    assert [r["auc"] for r in alarms.roc_aucs(df.where("y = 1"), "y", scores).collect()] == [None] * 5


def test_ablation_packs_its_scores(spark, monkeypatch):
    """Every config goes through one pass of packed scores, none through the rows of another."""
    from tidewright.operators import relevance

    seen = []
    monkeypatch.setattr(relevance, "roc_aucs", lambda df, label, scores: seen.append(scores) or alarms.roc_aucs(df, label, scores))
    rng = np.random.default_rng(7)
    pdf = pd.DataFrame(rng.normal(size=(400, 3)), columns=list("abc")).assign(y=lambda d: (d["a"] > 0).astype(int))
    got = {r["config"]: r["auc"] for r in relevance.ablation(spark.createDataFrame(pdf), list("abc"), "y").collect()}
    assert len(seen) == 1 and set(seen[0]) == set(got) and len(got) == 7
    assert got["only a"] == 1.0 and got["without a"] < 0.7
