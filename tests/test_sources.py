"""Readers and writers on self-written files."""

import json

import pandas as pd
from pyspark.sql import functions as F

from tidewright.sources import readers, sinks


def test_series_labels_windows(spark, tmp_path):
    (tmp_path / "s.csv").write_text("timestamp,value\n2024-01-01 00:05:00,1.5\n2024-01-01 00:10:00,2\n")
    rows = readers.read_series(spark, str(tmp_path / "s.csv")).collect()
    assert [(r["key"], r["t"] % 86_400_000_000, r["value"]) for r in rows] == [("s.csv", 300_000_000, 1.5), ("s.csv", 600_000_000, 2.0)]
    (tmp_path / "l.json").write_text(json.dumps({"a": ["2024-01-01 00:00:01"], "b": ["2024-01-02 00:00:00", "2024-01-03 00:00:00"]}, indent=1))
    labels = {(r["key"], r["pos"]): r["label"] for r in readers.read_labels(spark, str(tmp_path / "l.json")).collect()}
    assert len(labels) == 3 and labels["b", 1] - labels["b", 0] == 86_400_000_000
    (tmp_path / "w.json").write_text(json.dumps({"a": [["2024-01-01 00:00:00.000000", "2024-01-01 01:00:00.000000"]]}))
    w = readers.read_windows(spark, str(tmp_path / "w.json")).first()
    assert w["pos"] == 0 and w["end"] - w["begin"] == 3_600_000_000


def test_runs_shift_ids_and_rul(spark, tmp_path):
    paths = []
    for stem, machines in (("fd1", {1: 3, 2: 2}), ("fd2", {1: 4})):
        lines = [" ".join([str(m), str(c), *["0.5"] * 24]) + "  " for m, n in machines.items() for c in range(1, n + 1)]
        p = tmp_path / f"{stem}.txt"
        p.write_text("\n".join(lines) + "\n")
        paths.append(str(p))
    got = readers.read_runs(spark, paths).select("src", "machine", "cycle", "rul").toPandas()
    assert sorted(set(zip(got["src"], got["machine"]))) == [("fd1", 1), ("fd1", 2), ("fd2", 3)]
    assert (got["rul"] + got["cycle"] == got.groupby("machine")["cycle"].transform("max")).all()


def test_delimited_and_event_log(spark, tmp_path):
    (tmp_path / "d.csv").write_text("a;b\n1;?\n2;3.5\n")
    rows = readers.read_delimited(spark, str(tmp_path / "d.csv"), "a int, b double").collect()
    assert [(r["a"], r["b"]) for r in rows] == [(1, None), (2, 3.5)]
    (tmp_path / "e.csv").write_text("Triage;TkCharge;Code;Outcome;Flow\n2018-01-01 00:17:33;;green;admitted;x\n")
    r = readers.read_event_log(spark, str(tmp_path / "e.csv")).first()
    assert str(r["Triage"]) == "2018-01-01 00:17:33" and r["TkCharge"] is None and "Flow" not in r.asDict()


def test_dayfirst(spark):
    df = spark.createDataFrame([("31/01/2020",), ("2020-01-31",)], "d string")
    days = [r[0] for r in df.select(readers.dayfirst_or_null("d").cast("string")).collect()]
    assert days == ["2020-01-31", None]


def test_submission_round_trip(spark, tmp_path):
    df = spark.createDataFrame(pd.DataFrame({"id": [1, 2, 3], "p": [5.0, 50.0, 500.0]}))
    sinks.write_artifacts({"s": sinks.submission(df, "id", "p")}, str(tmp_path / "out"))
    back = sinks.read_artifact(spark, str(tmp_path / "out"), "s").orderBy("id")
    assert [r["y"] for r in back.collect()] == [10.0, 50.0, 100.0]
    sinks.write_artifacts({"c": df.select("id")}, str(tmp_path / "out"), fmt="csv")
    assert spark.read.csv(str(tmp_path / "out" / "c"), header=True).count() == 3


def test_align_needs_target(spark):
    x = spark.range(3).withColumn("f", F.lit(1.0))
    try:
        readers.align_xy(x, x, "id", "y")
    except ValueError:
        return
    raise AssertionError("missing target accepted")
