import itertools
import zlib

import numpy as np
import pytest
from conftest_llm import ODD, plain

from tidewright.llm import quality

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_sum_of_squares_identity():
    rng = np.random.default_rng(0)
    model = quality.Model(0.3, rng.normal(size=50), rng.normal(size=(50, 4)))
    index, value = np.array([3, 7, 11, 40]), rng.normal(size=4)
    pairs = sum(
        float(model.factor[i] @ model.factor[j]) * x * y
        for (i, x), (j, y) in itertools.combinations(zip(index, value), 2)
    )
    assert np.isclose(quality.margin(model, index, value), 0.3 + model.weight[index] @ value + pairs)


def test_interactions_are_learnt():
    """Labels that are the product of two signs need the pairwise part."""
    rng = np.random.default_rng(1)
    rows, labels = [], []
    for _ in range(2000):
        x = rng.choice([-1.0, 1.0], 2)
        rows.append((np.array([20, 21]), x))
        labels.append(float(x[0] * x[1] > 0))
    model = quality.fit(rows, np.array(labels))
    right = [(quality.margin(model, *r) > 0) == bool(y) for r, y in zip(rows, labels)]
    assert np.mean(right) > 0.95


def test_held_out_accuracy(tables):
    docs, labels = tables
    model = quality.train(docs, labels, "doc_id", "text")
    rows = quality.scored(docs.withColumn("held", quality.held_out()), model).join(labels, "doc_id").collect()
    assert all(r["held"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r["held"]]
    assert len(held) > 80
    assert np.mean([(r[quality.SCORE] >= 0.5) == bool(r["quality"]) for r in held]) >= 0.97


def test_training_ignores_held_out_labels_and_repeats_itself(spark, tables):
    docs, labels = tables
    flipped = labels.withColumn("quality", (1 - labels["quality"])).where(quality.held_out())
    rest = labels.where(~quality.held_out())
    a = quality.train(docs, rest.union(flipped.select(*rest.columns)), "doc_id", "text")
    b = quality.train(docs.repartition(7), labels, "doc_id", "text")
    assert a.bias == b.bias and np.array_equal(a.weight, b.weight) and np.array_equal(a.factor, b.factor)


def test_sample_is_bounded(tables, monkeypatch):
    docs, labels = tables
    seen = []
    monkeypatch.setattr(quality, "fit", lambda rows, y: seen.append(len(rows)))
    quality.train(docs, labels, "doc_id", "text", sample=50)
    assert 0 < seen[0] < 120


def test_odd_rows(spark, odd, nothing, tables):
    docs, labels = tables
    model = quality.train(docs, labels, "doc_id", "text")
    rows = quality.scored(odd, model).collect()
    assert len(rows) == len(ODD) and all(0 <= r[quality.SCORE] <= 1 for r in rows)
    assert quality.scored(nothing, model).count() == 0
    none = spark.createDataFrame([(None, 1), (5, None)], "doc_id bigint, quality int")
    assert quality.keep_good(odd, none).columns == odd.columns
    assert quality.keep_good(odd, none).count() == len(ODD)
    twice = spark.createDataFrame([(5, 0), (5, 0), (4, 1), (4, 1), (2, 1), (1, 1)], "doc_id bigint, quality int")
    assert quality.keep_good(odd, twice).count() <= len(ODD)
    assert quality.keep_good(plain(spark, ["text"]), labels.limit(0)).count() == 1
