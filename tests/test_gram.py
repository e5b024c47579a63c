"""Cross products by partition against numpy, on wide tables and with nulls."""

import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewright.operators.aggregates import correlation_long
from tidewright.operators.gram import cross_products
from tidewright.operators.relevance import gram, rfe


@pytest.fixture(scope="module")
def gappy(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 5)) @ rng.normal(size=(5, 5)) + 1e6
    x[rng.random(x.shape) < 0.1] = np.nan
    pdf = pd.DataFrame(x, columns=list("abcde"))
    pdf["f"] = 7.0
    df = spark.createDataFrame(pdf).repartition(4)
    return df.select(*[F.nanvl(c, F.lit(None)).alias(c) for c in df.columns]), pdf


@pytest.mark.parametrize("complete", [True, False])
def test_correlations(gappy, complete):
    df, pdf = gappy
    want = (pdf.dropna() if complete else pdf).corr()
    for r in correlation_long(df, list("abcdef"), complete).collect():
        if "f" in (r["a"], r["b"]):
            assert r["r"] is None
        else:
            assert r["r"] == pytest.approx(want.loc[r["a"], r["b"]], rel=1e-8)


def test_gram_of_complete_rows(gappy):
    df, pdf = gappy
    x, xy, yy, n = gram(df, list("abcd"), "e")
    whole = pdf.dropna()
    full = np.column_stack([np.ones(len(whole)), whole[list("abcd")]])
    assert n == len(whole)
    np.testing.assert_allclose(x, full.T @ full, rtol=1e-12)
    np.testing.assert_allclose(xy, full.T @ whole["e"], rtol=1e-12)
    assert yy == pytest.approx((whole["e"] ** 2).sum(), rel=1e-12)


def test_empty_table(spark):
    df = spark.createDataFrame([], "a double, b double")
    assert cross_products(df, ["a", "b"]).both.sum() == 0
    assert correlation_long(df, ["a", "b"]).first()["r"] is None


def test_wide_table(spark):
    rng = np.random.default_rng(3)
    d = 832
    x = rng.normal(size=(1200, d))
    df = spark.createDataFrame([(row.tolist(),) for row in x], "x array<double>")
    df = df.select(*[F.get("x", F.lit(i)).alias(f"c{i}") for i in range(d)])
    start = time.time()
    p = cross_products(df, df.columns)
    assert time.time() - start < 60
    np.testing.assert_allclose(p.correlation(), np.corrcoef(x.T), atol=1e-9)


def test_rfe_keeps_the_planted_features(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 12))
    y = 3 * x[:, 2] - 2 * x[:, 7] + 0.01 * rng.normal(size=400)
    df = spark.createDataFrame(pd.DataFrame(x, columns=[f"c{i}" for i in range(12)]).assign(y=y))
    kept = {r["feature"] for r in rfe(df, [f"c{i}" for i in range(12)], "y", 2).where("rank = 1").collect()}
    assert kept == {"c2", "c7"}
