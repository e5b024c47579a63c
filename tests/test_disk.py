"""Queries that run over the rows several times leave no shuffle files of earlier steps behind."""

import os
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewright.operators import relevance
from tidewright.plans import q_models, q_runs
from tidewright.plans.bindings import Tables
from tidewright.session import settled


def shuffle_files(spark):
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in dirs for _, _, files in os.walk(d) for f in files if f.startswith("shuffle_")}


def left_over(spark, before):
    for _ in range(50):  # files go in the background
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.2)
    return left


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(2)
    return spark.createDataFrame(pd.DataFrame(rng.normal(size=(500, 3)), columns=list("aby")).assign(id=np.arange(500))).cache()


def test_settled_rows_go_with_their_block(spark, rows):
    before = shuffle_files(spark)
    with settled(rows.repartition(4, "id"), "step") as step:
        (path,) = {os.path.dirname(f) for f in step.inputFiles()}
        assert not left_over(spark, before)
        assert step.count() == 500
    assert not os.path.exists(path.removeprefix("file:").replace("///", "/"))


def test_a_repeat_goes_before_the_next(spark, rows, monkeypatch):
    """Every repeat is a job that is released; after a round of forests the cleaner has its shuffles."""
    seen = []
    monkeypatch.setattr(relevance, "settled", lambda df, tag: seen.append(tag) or settled(df, tag))
    assert relevance.permutation_importance(rows, "id", ["a", "b"], "y", 0.0, {"a": 1.0, "b": 2.0}, 3, 5).count() == 2
    assert seen == ["rise"] * 3
    before = shuffle_files(spark)
    relevance.boruta(rows, "id", ["a", "b"], "y", 2, 3, 3, 1)
    assert not left_over(spark, before)


def test_hazards_read_written_rows(spark, sf):
    """The order of the cycles is made once, not for the fit and again for the scores."""
    got = q_runs.surv_hazard_model(Tables(spark, sf))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange" not in plan and got.count() > 0


def test_features_are_written_without_what_is_not_used(spark, sf):
    before = shuffle_files(spark)
    f = q_models.feat(Tables(spark, sf), "id", "qty")
    assert f.columns == ["id", "qty"] and not left_over(spark, before)
    every = q_models.feat(Tables(spark, sf))
    assert f.agg(F.sum(F.col("id").cast("decimal(38,0)"))).first() == every.agg(F.sum(F.col("id").cast("decimal(38,0)"))).first()
