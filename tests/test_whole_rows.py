"""Nothing is lost: null keys, null values, missing features, late years, unlisted levels, long memories."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewright.operators import aggregates, clean, fill, models, splits, windows


def nulls(df, *columns):
    return df.withColumns({c: F.nanvl(c, F.lit(None)) for c in columns})


@pytest.fixture(scope="module")
def gappy(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"id": np.arange(120), "a": rng.normal(size=120), "b": rng.normal(size=120)})
    pdf["y"] = 2 * pdf["a"] - pdf["b"] + 1
    pdf["c"] = (pdf["a"] > 0).astype(float)
    pdf.loc[::10, "a"] = np.nan
    return nulls(spark.createDataFrame(pdf), "a")


@pytest.mark.parametrize("name", ["linear", "forest", "boosted", "hybrid"])
def test_scoring_keeps_rows_with_missing_features(gappy, name):
    fits = {
        "linear": lambda: models.linear(gappy, gappy, ["a", "b"], "y"),
        "forest": lambda: models.forest(gappy, gappy, ["a", "b"], "y", 3, 3, 1),
        "boosted": lambda: models.boosted(gappy, gappy, ["a", "b"], "y", 2, 2, 1),
        "hybrid": lambda: models.residual_hybrid(gappy, gappy, ["a", "b"], "y", 0.0, 2, 2, 1),
    }
    rows = fits[name]().select("id", "a", "pred").collect()
    assert len(rows) == 120
    assert all((r["pred"] is None) == (r["a"] is None) for r in rows)


@pytest.mark.parametrize("fit", [models.logistic_balanced, None])
def test_classifiers_keep_rows_with_missing_features(gappy, fit):
    if fit:
        scored = fit(gappy, gappy, ["a", "b"], "c")
    else:
        scored = models.forest(gappy, gappy, ["a", "b"], "c", 3, 3, 1, classify=True)
    rows = scored.select("a", "score").collect()
    assert len(rows) == 120 and all((r["score"] is None) == (r["a"] is None) for r in rows)


def test_iqr_parts_add_up_with_nulls_and_without_a_key(spark):
    values = [float(i) for i in range(20)] + [900.0, None, None]
    df = spark.createDataFrame([("k" if i % 2 else None, v) for i, v in enumerate(values)], "k string, a double")
    for key in ([], ["k"]):
        kept, removed = clean.iqr_split(df, key, "a"), clean.iqr_split(df, key, "a", removed=True)
        assert kept.count() + removed.count() == len(values)
        assert kept.where("a is null").count() == 2
    assert [r["a"] for r in clean.iqr_split(df, [], "a", removed=True).collect()] == [900.0]


def test_stratified_split_keeps_null_labels(spark):
    df = spark.createDataFrame([(i, [0, 1, None][i % 3]) for i in range(30)], "id bigint, y int")
    out = splits.stratified_split(df, "y", "id", 0.3, 5)
    assert out.columns == ["id", "y", "part"]
    counts = {(r["y"], r["part"]): r["count"] for r in out.groupBy("y", "part").count().collect()}
    assert counts == {(y, p): n for y in (0, 1, None) for p, n in (("test", 3), ("train", 7))}


def test_walk_forward_reaches_the_newest_year(spark):
    rows = [(z, y, (z + y) % 2) for z in range(6) for y in range(1995, 2002)]
    df = spark.createDataFrame(rows, "zone int, year int, label int")
    out = windows.walk_forward(df, "year", "label", 1997, 2)
    tests = {r["fold"]: r["years"] for r in out.where("part = 'test'").groupBy("fold").agg(F.sort_array(F.collect_set("year")).alias("years")).collect()}
    assert tests == {1997: [1997, 1998], 1999: [1999, 2000], 2001: [2001]}


def test_pivot_total_counts_unlisted_levels(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (1, "z"), (1, None)], "r int, c string")
    row = aggregates.pivot_counts(df, "r", "c", ["a", "b"]).first()
    assert row["total"] == 4 and row["share_0"] == 0.25


def test_knn_leaves_rows_without_coordinates(spark):
    rows = [(0, None, None), (1, 1.0, -4.0), (2, 2.0, -7.0), (3, 1.5, None)]
    df = spark.createDataFrame(rows, "id int, a double, y double")
    got = {r["id"]: r["f"] for r in fill.fill_knn(df, "y", ["a"], 2, "f", least=None).collect()}
    assert got == {0: None, 1: -4.0, 2: -7.0, 3: -6.0}  # -5.5 to even
    assert {r["id"]: r["f"] for r in fill.fill_knn(df, "y", ["a"], 2, "f").collect()}[3] == 0.0


def test_gaussian_process_takes_each_key_as_one_series(spark):
    pars = dict(amplitude=1.0, length=2.0, period=5.0, period_length=1.0, period_amplitude=0.5, noise=0.1)
    rows = [(k, i, float(i % 5) if i % 3 else None) for k in "ab" for i in range(1, 21)]
    got = fill.gp_posterior(spark.createDataFrame(rows, "k string, pos int, v double"), ["k"], "pos", "v", **pars)
    both = {k: [r["gp_mean"] for r in got.where(F.col("k") == k).orderBy("pos").collect()] for k in "ab"}
    assert both["a"] == both["b"] and len(both["a"]) == 20


@pytest.mark.parametrize("alpha, n, chunk", [(0.3, 500, 4), (0.9, 70, 1), (1e-6, 9000, 1), (1e-4, 20000, 2)])
def test_ewm_forgets_nothing(spark, alpha, n, chunk):
    rng = np.random.default_rng(1)
    v = np.where(rng.random(n) < 0.2, np.nan, rng.normal(size=n) + 5)
    v[0] = 1000.0
    pdf = pd.DataFrame({"k": "x", "pos": np.arange(1, n + 1), "v": v})
    got = windows.ewm_mean(nulls(spark.createDataFrame(pdf), "v"), ["k"], "pos", "v", alpha, "e", chunk=chunk)
    got = got.toPandas().sort_values("pos")["e"].to_numpy(float)
    np.testing.assert_allclose(got, pd.Series(v).ewm(alpha=alpha, ignore_na=False).mean().to_numpy(), rtol=1e-9)
