"""Fills against pandas and brute force."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewright.operators import density, fill


@pytest.fixture(scope="module")
def grid(spark):
    rng = np.random.default_rng(2)
    frames = []
    for key in ("a", "b"):
        v = rng.normal(10, 3, 60).round(2)
        v[rng.random(60) < 0.35] = np.nan
        v[:2] = np.nan
        v[-3:] = np.nan
        frames.append(pd.DataFrame({"key": key, "pos": np.arange(1, 61), "t": np.cumsum(rng.integers(1, 9, 60)), "v": v}))
    pdf = pd.concat(frames, ignore_index=True)
    return pdf, spark.createDataFrame(pdf).withColumn("v", F.nanvl("v", F.lit(None)))


def by_key(pdf, fn):
    return np.concatenate([fn(g).to_numpy() for _, g in pdf.groupby("key")])


def test_neighbour_fills(grid):
    pdf, df = grid
    got = fill.fill_neighbours(df, ["key"], "pos", "v", ["forward", "backward", "linear", "time"], axis="t", rows=7)
    got = got.toPandas().sort_values(["key", "pos"])
    np.testing.assert_allclose(got["v_forward"], by_key(pdf, lambda g: g["v"].ffill()))
    np.testing.assert_allclose(got["v_backward"], by_key(pdf, lambda g: g["v"].bfill()))
    np.testing.assert_allclose(got["v_linear"], by_key(pdf, lambda g: g["v"].interpolate("linear")))
    want = by_key(pdf, lambda g: g.set_index("t")["v"].interpolate("index"))
    np.testing.assert_allclose(got["v_time"], want)
    seen = got["v"].notna()
    assert (got.loc[seen, "v_linear"] == got.loc[seen, "v"]).all()


def test_nearest(grid):
    pdf, df = grid
    got = fill.fill_neighbours(df, ["key"], "pos", "v", ["nearest"], rows=7).toPandas().sort_values(["key", "pos"])
    for _, g in got.groupby("key"):
        ok = g[g["v"].notna()]
        for r in g.itertuples():
            if r.pos < ok["pos"].min() or r.pos > ok["pos"].max():
                assert np.isnan(r.v_nearest)
            else:
                gap = (ok["pos"] - r.pos).abs()
                assert r.v_nearest == ok.loc[gap == gap.min(), "v"].iloc[0]


def test_quadratic(grid):
    pdf, df = grid
    got = fill.fill_quadratic(df, ["key"], "pos", "v", "q", rows=9).toPandas().sort_values(["key", "pos"])
    for _, g in got.groupby("key"):
        ok = g[g["v"].notna()]
        for r in g[g["v"].isna()].itertuples():
            left, right = ok[ok["pos"] < r.pos], ok[ok["pos"] > r.pos]
            if left.empty or right.empty:
                assert np.isnan(r.q)
                continue
            pts = [left.iloc[-1], right.iloc[0]]
            a = left.iloc[-2] if len(left) > 1 else None
            b = right.iloc[1] if len(right) > 1 else None
            if a is not None and (b is None or r.pos - a["pos"] <= b["pos"] - r.pos):
                pts.append(a)
            elif b is not None:
                pts.append(b)
            x, y = [p["pos"] for p in pts], [p["v"] for p in pts]
            assert r.q == pytest.approx(np.polyval(np.polyfit(x, y, len(x) - 1), r.pos), rel=1e-6, abs=1e-6)


@pytest.mark.parametrize("lattice", [True, False])
def test_knn_matches_brute_force(spark, lattice):
    rng = np.random.default_rng(4)
    n, k = 160, 4
    x = rng.integers(0, 6, (n, 2)).astype(float) if lattice else rng.exponential(3.0, (n, 2)).round(3)
    target = rng.integers(1, 60, n).astype(float)
    target[rng.random(n) < 0.25] = np.nan
    pdf = pd.DataFrame({"id": np.arange(n), "a": x[:, 0], "b": x[:, 1], "y": target})
    df = spark.createDataFrame(pdf).withColumn("y", F.nanvl("y", F.lit(None)))
    got = fill.fill_knn(df, "y", ["a", "b"], k, "f", digits=None).toPandas().set_index("id")["f"]
    z = x / x.std(axis=0)
    donors = ~np.isnan(target)
    for i in np.flatnonzero(~donors):
        d2 = np.round(((z[donors] - z[i]) ** 2).sum(axis=1), 9)
        order = np.sort(np.unique(d2))
        left, total = k, 0.0
        for d in order:
            members = target[donors][d2 == d]
            use = min(left, len(members))
            total += use * members.mean()
            left -= use
            if not left:
                break
        want = total / k
        assert abs(got[i] - want) <= 1e-9
    assert (got[donors] == target[donors]).all()


@pytest.mark.parametrize("grid, crowd", [(3, 256), (1, 8)])
def test_knn_over_common_coordinates(spark, grid, crowd):
    """Columns with gaps everywhere, a dense cluster and ties, against all distances."""
    rng = np.random.default_rng(9)
    n, k, d = 90, 3, 3
    x = np.concatenate([rng.exponential(2.0, (n // 2, d)).round(2), rng.integers(0, 4, (n // 2, d)) * 0.2])
    x[rng.random((n, d)) < 0.3] = np.nan
    x[0] = np.nan
    columns = list("abc")
    df = spark.createDataFrame(pd.DataFrame(x, columns=columns).assign(id=np.arange(n)))
    got = fill.fill_knn_all(df, columns, k, grid=grid, crowd=crowd).toPandas().set_index("id").sort_index()
    assert len(got) == n
    z = np.round(x / np.nanstd(x, axis=0), 12)
    for j, c in enumerate(columns):
        rest = [i for i in range(d) if i != j]
        donors = ~np.isnan(x[:, j])
        for i in range(n):
            gap = (z[donors][:, rest] - z[i, rest]) ** 2
            common = (~np.isnan(gap)).sum(axis=1)
            with np.errstate(divide="ignore", invalid="ignore"):
                dist = np.round(np.nansum(gap, axis=1) * (d - 1) / common, 9)
            y, dist = x[donors, j][common > 0], dist[common > 0]
            if donors[i]:
                want = x[i, j]
            elif not len(y):
                want = np.nanmean(x[:, j])
            else:
                left, want = min(k, len(y)), 0.0
                for level in np.unique(dist):
                    use = min(left, (dist == level).sum())
                    want, left = want + use * y[dist == level].mean(), left - use
                want /= min(k, len(y))
            assert abs(got[f"{c}_filled"][i] - want) < 1e-9


def test_knn_all_of_odd_tables(spark):
    df = spark.createDataFrame([(1, None, None), (2, 3.0, None), (3, None, None)], "id bigint, a double, b double")
    got = {r["id"]: (r["a_filled"], r["b_filled"]) for r in fill.fill_knn_all(df, ["a", "b"], 2).collect()}
    assert got == {1: (3.0, None), 2: (3.0, None), 3: (3.0, None)}
    assert fill.fill_knn_all(df.limit(0), ["a", "b"], 2).count() == 0


def test_gp_matches_closed_form(spark):
    rng = np.random.default_rng(6)
    y = np.sin(np.arange(30) / 3.0)
    y[rng.random(30) < 0.3] = np.nan
    df = spark.createDataFrame(pd.DataFrame({"key": "a", "pos": np.arange(1, 31), "v": y})).withColumn("v", F.nanvl("v", F.lit(None)))
    pars = dict(amplitude=1.0, length=2.0, period=19.0, period_length=1.0, period_amplitude=0.5, noise=0.01)
    got = fill.gp_posterior(df, ["key"], "pos", "v", **pars).toPandas().sort_values("pos")
    x = np.arange(1.0, 31.0)
    gap = np.abs(x[:, None] - x[None])
    k = np.exp(-0.5 * (gap / 2.0) ** 2) + 0.5 * np.exp(-2 * np.sin(np.pi * gap / 19.0) ** 2)
    s = ~np.isnan(y)
    inv = np.linalg.inv(k[np.ix_(s, s)] + 0.01 * np.eye(s.sum()))
    mean = y[s].mean() + k[:, s] @ inv @ (y[s] - y[s].mean())
    var = 1.51 - np.einsum("ij,jk,ik->i", k[:, s], inv, k[:, s])
    np.testing.assert_allclose(got["gp_mean"], mean, atol=1e-8)
    np.testing.assert_allclose(got["gp_std"], np.sqrt(var), atol=1e-6)


def test_regression_fill_uses_planted_signal(spark):
    rng = np.random.default_rng(8)
    a, b = rng.normal(size=400), rng.normal(size=400)
    y = 3 * a - 2 * b + 1
    hide = rng.random(400) < 0.2
    pdf = pd.DataFrame({"id": np.arange(400), "a": a, "b": b, "c": rng.normal(size=400), "y": np.where(hide, np.nan, y)})
    df = spark.createDataFrame(pdf).withColumn("y", F.nanvl("y", F.lit(None)))
    got = fill.fill_regression(df, "y", ["a", "b", "c"], 2, "f").toPandas().sort_values("id")
    assert np.abs(got["f"].to_numpy() - y).max() < 0.05


@pytest.mark.parametrize("tile", [3, 50, 4096])
@pytest.mark.parametrize("kernel", ["gaussian", "tophat", "linear"])
def test_kde_tiles_are_exact(spark, tile, kernel):
    rng = np.random.default_rng(7)
    train = pd.DataFrame({"slot": rng.integers(0, 2, 80), "v": rng.normal(0, 4, 80).round(1), "w": 1})
    points = pd.DataFrame({"slot": rng.integers(0, 2, 60), "v": np.r_[rng.normal(0, 4, 59), 900.0].round(1)})
    got = density.kde_scores(spark.createDataFrame(train), spark.createDataFrame(points), ["slot"], "v", 1.5, kernel, tile=tile)
    got = {(r["slot"], r["v"]): r["signal"] for r in got.collect()}
    for slot, v in {(r.slot, r.v) for r in points.itertuples()}:
        z = np.abs(v - train.loc[train["slot"] == slot, "v"].to_numpy()) / 1.5
        if kernel == "gaussian":
            e = -0.5 * z**2
            want = -(e.max() + np.log(np.exp(e - e.max()).sum()) - np.log(len(z)) - np.log(1.5 * np.sqrt(2 * np.pi)))
        else:
            s = (z < 1).sum() if kernel == "tophat" else np.maximum(0, 1 - z).sum()
            norm = len(z) * 1.5 * (2 if kernel == "tophat" else 1)
            want = -np.log(s / norm) if s > 0 else None
        if want is None:
            assert got[(slot, v)] is None
        else:
            assert got[(slot, v)] == pytest.approx(want, rel=1e-9)


def chained_by_hand(x, ridge):
    """Equations from pairwise covariances, Gauss-Seidel rounds row by row."""
    n, d = x.shape
    mean = np.nanmean(x, axis=0)
    c = x - mean
    cov = np.array([[np.nanmean(c[:, i] * c[:, j]) for j in range(d)] for i in range(d)])
    s = np.sqrt(np.diag(cov))
    corr = cov / np.outer(s, s)
    out = np.where(np.isnan(x), np.nanmedian(x, axis=0), x)
    for i in range(n):
        for _ in range(300):
            for j in np.flatnonzero(np.isnan(x[i])):
                o = [k for k in range(d) if k != j]
                b = np.linalg.solve(corr[np.ix_(o, o)] + ridge * np.eye(d - 1), corr[o, j]) * s[j] / s[o]
                out[i, j] = mean[j] + (out[i, o] - mean[o]) @ b
    return out


def test_chained_equations_reach_the_fixed_point(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(120, 4)) @ rng.normal(size=(4, 4)) + [5, -3, 100, 0]
    x[rng.random(x.shape) < 0.25] = np.nan
    pdf = pd.DataFrame(x, columns=list("abcd")).assign(id=np.arange(120), e=np.nan, g="x")
    df = spark.createDataFrame(pdf).repartition(3)
    got = fill.fill_chained(df, list("abcd"), ridge=0.01).toPandas().sort_values("id")
    want = chained_by_hand(x, 0.01)
    np.testing.assert_allclose(got[[f"{c}_filled" for c in "abcd"]].to_numpy(), want, rtol=1e-6, atol=1e-6)
    with_empty = fill.fill_chained(df, ["a", "e"]).toPandas()
    assert with_empty["e_filled"].isna().all()
    assert np.allclose(with_empty["a_filled"], with_empty["a"].fillna(with_empty["a"].median()))


def test_chained_equations_use_the_best_predictors(spark):
    rng = np.random.default_rng(10)
    a = rng.normal(size=2000)
    y = 2 * a + 0.01 * rng.normal(size=2000)
    pdf = pd.DataFrame({"y": np.where(rng.random(2000) < 0.3, np.nan, y), "a": a, "z": rng.normal(size=2000), "truth": y})
    got = fill.fill_chained(spark.createDataFrame(pdf), ["y", "a", "z"], top=1, ridge=0.0).toPandas()
    # The slope comes from a covariance and a variance over different rows, so it is right to a few per cent only.
    assert np.abs(got["y_filled"] - got["truth"]).mean() < 0.05 and np.corrcoef(got["y_filled"], got["truth"])[0, 1] > 0.999
    assert fill.chained_equations(spark.createDataFrame(pdf), ["y", "a", "z"], top=1)[1][0, 2] == 0
    nothing = spark.createDataFrame([], "y double, a double")
    assert fill.fill_chained(nothing, ["y", "a"]).count() == 0
