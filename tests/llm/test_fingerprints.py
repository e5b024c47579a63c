import hashlib
import random
from collections import Counter

import numpy as np
from conftest_llm import ODD, plain

from tidewright.llm import fingerprints, iblt


def alike(a, b):
    x, y = (Counter(iblt._PARAGRAPH.findall(t)) for t in (a, b))
    either = sum((x | y).values())
    return sum((x & y).values()) / either if either else 1.0


def test_peeling_recovers_the_difference():
    rng = random.Random(2)
    lefts, rights = [], []
    for n in (0, 1, 5, 40, 400):
        lines = [f"line {rng.random()}\n" for _ in range(n)] + ["again\n"] * 3
        lefts.append("".join(lines))
        rng.shuffle(lines)
        rights.append("".join(lines[: len(lines) // 2] + ["new\n", "again\n"]))
    left, right = iblt.Paragraphs(lefts), iblt.Paragraphs(rights)
    for cells in (3, 24, 96):
        for i, (gone, came) in enumerate(iblt.differing(left, right, cells)):
            a, b = (set(p.key[p.own == i].tolist()) for p in (left, right))
            assert set(gone.tolist()) == a - b and set(came.tolist()) == b - a
    want = [alike(a, b) for a, b in zip(lefts, rights)]
    assert np.allclose(iblt.likeness(left, right), want, atol=0, rtol=1e-12)


def brute(rows):
    """Rows by descending id (null last); ids here are distinct but for equal texts."""
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for (i, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), alike(text, edited), alike(text, after)))
    return out


def values(df):
    return sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"], r["near_edited"], r["near_next"]) for r in df.collect()), key=str)


def test_versions(spark, some_texts):
    texts = some_texts[:120]
    rng = random.Random(1)
    ids = rng.sample(range(10_000), len(texts))
    df = plain(spark, texts).drop("doc_id").withColumnRenamed("n_chars", "doc_id")
    df = spark.createDataFrame(list(zip(ids, texts)), "doc_id bigint, text string").repartition(5)
    got = values(fingerprints.versions(df))
    assert got == sorted(brute(list(zip(ids, texts))), key=str)


def test_odd_rows(spark, odd, nothing):
    rows = [r for r in ODD if r[0] is not None]
    df = odd.where("doc_id is not null")
    assert values(fingerprints.versions(df)) == sorted(brute([(r[0], r[1] or "") for r in rows]), key=str)
    assert fingerprints.versions(odd).count() == len(ODD)
    assert fingerprints.versions(nothing).count() == 0
    one = fingerprints.versions(plain(spark, ["alone in the world. yes."])).first()
    assert one["near_next"] == 1.0


def test_equal_texts_have_equal_fingerprints(odd):
    by_text = {}
    for r in fingerprints.versions(odd.where("doc_id in (5, 6)")).collect():
        by_text.setdefault(r["n_chars"], set()).add(r["fingerprint"])
    assert all(len(v) == 1 for v in by_text.values())


def test_differences(spark):
    df = spark.createDataFrame([("a. b. c.", "a. c. d."), (None, None)], "x string, y string")
    rows = fingerprints.differences(df, "x", "y").collect()
    assert [(len(r["gone"]), len(r["came"])) for r in rows] == [(1, 1), (0, 0)]
