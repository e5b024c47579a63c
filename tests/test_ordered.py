"""Layouts against pandas, with cells and chunks small enough to have many edges."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewright.functions.exprs import idiv
from tidewright.operators import ordered, windows
from tidewright.operators.quantiles import exact_quantiles


@pytest.fixture(scope="module")
def series():
    rng = np.random.default_rng(0)
    key = np.where(rng.random(900) < 0.6, "hot", rng.choice(["a", "b"], 900))
    t = rng.integers(-200, 500, 900)
    value = np.where(rng.random(900) < 0.3, np.nan, rng.normal(size=900).round(3))
    return pd.DataFrame({"key": key, "t": t, "id": np.arange(900), "value": value})


@pytest.fixture(scope="module")
def placed(spark, series):
    df = spark.createDataFrame(series).withColumn("value", F.nanvl("value", F.lit(None)))
    return ordered.positions(df, ["key"], ["t", "id"], [idiv("t", 37)], total="n").cache()


def reference(series):
    s = series.sort_values(["key", "t", "id"])
    return s.assign(pos=s.groupby("key").cumcount() + 1).set_index("id").sort_index()


def test_positions(placed, series):
    got = placed.toPandas().set_index("id").sort_index()
    want = reference(series)
    assert (got["pos"] == want["pos"]).all()
    assert (got["n"] == want.groupby("key")["t"].transform("size")).all()


def test_framed_lag_and_rolling(placed, series):
    got = windows.lag_by_position(placed, ["key"], "pos", "value", [1, 9], rows=7)
    got = got.toPandas().set_index("id").sort_index()
    ref = reference(series).sort_values(["key", "pos"])
    for k in (1, 9):
        want = ref.groupby("key")["value"].shift(k).sort_index()
        np.testing.assert_array_equal(got[f"value_lag_{k}"].to_numpy(float), want.to_numpy())
    roll = windows.rolling(placed, ["key"], "pos", "t", 4, 0, rows=7).toPandas().set_index("id").sort_index()
    want = ref.groupby("key")["t"].transform(lambda s: s.rolling(5).mean()).sort_index()
    np.testing.assert_allclose(roll["roll_mean"].to_numpy(float), want.to_numpy())


def test_neighbours_and_running_sum(placed, series):
    ref = reference(series).sort_values(["key", "pos"])
    n = ordered.neighbours(placed, ["key"], "pos", "value", rows=5)
    n = n.select("id", F.col("prev.value").alias("p"), F.col("next.value").alias("q"))
    n = n.toPandas().set_index("id").sort_index()
    np.testing.assert_array_equal(n["p"].to_numpy(float), ref.groupby("key")["value"].ffill().sort_index().to_numpy())
    np.testing.assert_array_equal(n["q"].to_numpy(float), ref.groupby("key")["value"].bfill().sort_index().to_numpy())
    r = ordered.running_sum(placed, ["key"], ["t", "id"], [idiv("t", 37)], {"id": "run"})
    r = r.toPandas().set_index("id").sort_index()
    want = ref.reset_index().assign(run=lambda d: d.groupby("key")["id"].cumsum()).set_index("id").sort_index()
    assert (r["run"] == want["run"]).all()


def test_sliding_arrays(placed, series):
    got = windows.sliding_arrays(placed, ["key"], "pos", ["t"], 6, stride=4, rows=5).toPandas()
    ref = reference(series).sort_values(["key", "pos"])
    for _, row in got.iterrows():
        group = ref[ref["key"] == row["key"]]["t"].to_numpy()
        assert list(row["window"]) == list(group[row["pos"] - 6 : row["pos"]])
        assert (row["pos"] - 6) % 4 == 0
    assert len(got) == sum((len(g) - 6) // 4 + 1 for _, g in ref.groupby("key"))


def test_ewm_matches_pandas(placed, series):
    got = windows.ewm_mean(placed, ["key"], "pos", "value", 0.2, "e", chunk=4).toPandas().set_index("id").sort_index()
    ref = reference(series).sort_values(["key", "pos"])
    want = ref.groupby("key")["value"].transform(lambda s: s.ewm(alpha=0.2).mean()).sort_index()
    np.testing.assert_allclose(got["e"].to_numpy(float), want.to_numpy())


@pytest.mark.parametrize("heavy", [60, 1 << 22])
def test_exact_quantiles_long_tail(spark, heavy):
    rng = np.random.default_rng(1)
    x = np.exp(rng.normal(0, 6, 3000))
    x[:700] = 2.5
    pdf = pd.DataFrame({"key": np.where(np.arange(3000) % 3 > 0, "a", "b"), "x": x})
    probs = {"p0": 0.0, "p1": 0.1, "p5": 0.5, "p9": 0.987, "p10": 1.0}
    got = exact_quantiles(spark.createDataFrame(pdf), ["key"], "x", probs, buckets=256, heavy=heavy).toPandas().set_index("key")
    for key, group in pdf.groupby("key"):
        for name, p in probs.items():
            assert got.loc[key, name] == pytest.approx(group["x"].quantile(p), rel=1e-12)


def test_quantiles_without_key_and_constant(spark):
    df = spark.createDataFrame(pd.DataFrame({"x": [4.0] * 20}))
    assert exact_quantiles(df, [], "x", {"m": 0.3}, heavy=1).collect()[0]["m"] == 4.0


def shaped(kind):
    """Times of 4 000 rows of one key, whose even cells would all be one cell or nearly so."""
    rng = np.random.default_rng(1)
    even = np.arange(0, 4_000_000, 1000, dtype=np.int64)
    if kind == "burst":
        even[:3000] = 5_000 + rng.integers(0, 40, 3000)
    if kind == "one bad time":
        even[7] = 10**16
    if kind == "equal times":
        even[:3500] = 77
    if kind == "shrinking":
        even = (4e15 * 0.99 ** np.arange(4000)).astype(np.int64)
    return even


@pytest.mark.parametrize("kind", ["even", "burst", "one bad time", "equal times", "shrinking"])
def test_measured_cells_bound_rows(spark, kind):
    t = shaped(kind)
    pdf = pd.DataFrame({"k": "a", "t": t, "id": np.random.default_rng(2).permutation(len(t))})
    df = spark.createDataFrame(pdf)
    cut, names, counts = ordered.measured_cells(df, ["k"], ["t", "id"], target=100)
    assert counts.agg(F.max("_n")).first()[0] <= 100 and counts.agg(F.sum("_n")).first()[0] == len(t)
    got = cut.toPandas().sort_values(["t", "id"])
    cells = list(map(tuple, got[names].to_numpy()))
    assert cells == sorted(cells)


def test_measured_cells_with_nulls_and_no_order(spark):
    rows = [(None, 5, i) for i in range(30)] + [("a", None, i) for i in range(50)] + [("a", 9, i) for i in range(50)]
    df = spark.createDataFrame([*rows, *[("b", 1, 1)] * 40], "k string, t int, id int")
    cut, names, counts = ordered.measured_cells(df, ["k"], ["t", "id"], target=20)
    most = {r["k"]: r["n"] for r in counts.groupBy("k").agg(F.max("_n").alias("n")).collect()}
    assert most[None] <= 20 and most["a"] <= 20 and most["b"] == 40  # equal rows can't be told apart
    got = {(r["t"], r["id"]): r["pos"] for r in ordered.positions(df.where("k = 'a'"), ["k"], ["t", "id"]).collect()}
    assert [got[k] for k in [(None, i) for i in range(50)] + [(9, i) for i in range(50)]] == list(range(1, 101))


def test_running_sums_without_a_key_on_a_skewed_score(spark):
    """AUC over one key whose scores lie in a thousandth of their range, in cells of 50 scores."""
    from tidewright.operators import alarms

    rng = np.random.default_rng(3)
    s = np.r_[rng.random(3000) / 1000, 1e6]
    y = (rng.random(3001) < 0.3).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"s": s, "y": y}))
    order = np.argsort(s)
    below = np.cumsum(1 - y[order]) - (1 - y[order])
    want = below[y[order] == 1].sum() / (y.sum() * (1 - y).sum())
    assert alarms.roc_auc(df, "y", "s", cells=50).first()["auc"] == pytest.approx(want)
    assert alarms.roc_auc(df, "y", "s").first()["auc"] == pytest.approx(want)


@pytest.mark.parametrize("kind", ["burst", "one bad time", "shrinking"])
def test_positions_and_asof_on_measured_cells(spark, kind, monkeypatch):
    from tidewright.operators import joins

    monkeypatch.setattr(ordered.measured_cells, "__defaults__", (100,))
    t = shaped(kind)
    pdf = pd.DataFrame({"k": "a", "t": t, "id": np.arange(len(t)), "v": np.arange(len(t)) * 0.5})
    df = spark.createDataFrame(pdf)
    want = pdf.sort_values(["t", "id"])
    got = ordered.positions(df, ["k"], ["t", "id"]).toPandas().sort_values("pos")
    assert got["id"].tolist() == want["id"].tolist() and got["pos"].tolist() == list(range(1, len(t) + 1))
    left = pd.DataFrame({"k": "a", "at": np.r_[t[::7] + 3, 0, 10**17].astype(np.int64)}).rename_axis("n").reset_index()
    found = joins.asof(spark.createDataFrame(left), df, ["k"], "at", "t", "id", "v", 100).toPandas().set_index("n")["asof_v"].sort_index()
    stamps, values = want["t"].to_numpy(), want["v"].to_numpy()
    place = np.searchsorted(stamps, left["at"].to_numpy(), side="right") - 1
    np.testing.assert_array_equal(found.to_numpy(float), np.where(place < 0, np.nan, values[place]))


def test_null_times_keep_their_place(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", 50, 2), ("a", -9, 3), ("a", None, 4)], "key string, t bigint, id bigint")
    got = {r["id"]: r["pos"] for r in ordered.positions(df, ["key"], ["t", "id"], [idiv("t", 10)]).collect()}
    assert got == {1: 1, 4: 2, 3: 3, 2: 4}


def test_group_size_keeps_null_keys(spark):
    from tidewright.operators.joins import with_group_size

    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "key string, id bigint")
    assert {r["id"]: r["n"] for r in with_group_size(df, ["key"], "n").collect()} == {1: 2, 2: 2, 3: None}
