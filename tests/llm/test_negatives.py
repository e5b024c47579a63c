import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewright.llm import negatives, queries

SCHEMA = "id bigint, label int, q array<bigint>, score string, slot string, pos string, chunk string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA)


def brute(rows, anchor, n_pos=5, k=10):
    rows = [(n, *r) for n, r in enumerate(rows) if r[1] is not None and r[2] is not None]
    out = []
    for n, i, label, q in rows:
        if not anchor(i):
            continue
        others = [(sum(x * y for x, y in zip(q, v)), j, lb) for m, j, lb, v in rows if m != n]
        others.sort(key=lambda o: (-o[0], o[1] is None, o[1] or 0))
        for p, pid, _ in [o for o in others if o[2] == label][:n_pos]:
            hard = [o for o in others if o[2] != label and 30 * p <= 100 * o[0] <= 90 * p][:k]
            out += [(i, pid, rank, o[1], p, o[0]) for rank, o in enumerate(hard, 1)]
    return sorted(out, key=repr)


def mined(spark, rows, anchor="id % 3 = 0"):
    df = negatives.mine(frame(spark, rows).coalesce(2), F.coalesce(F.expr(anchor), F.lit(False)))
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("reach", [2, 40])
def test_against_brute_force(spark, monkeypatch, reach):
    """Small blocks and chunks; a small reach gives ties at every limit."""
    for name, n in (("BLOCK", 7), ("CHUNK", 11), ("SMALL_CHUNK", 5), ("SLICE", 3)):
        monkeypatch.setattr(negatives, name, n)
    rng = random.Random(reach)
    rows = [(i, rng.choice([1, 1, 1, 2, 3]), [rng.randint(-reach // 2, reach) for _ in range(4)]) for i in range(90)]
    got = mined(spark, rows)
    assert got == brute(rows, lambda i: i % 3 == 0) and got


def test_odd_rows(spark):
    rows = [
        (0, 1, [3, 1]), (0, 1, [3, 1]), (3, 1, [2, 2, 9]), (5, None, [9, 9]), (6, 2, None), (None, 2, [2, 1]), (7, 2, [2, 1]),
        (7, 2, [2, 1]), (8, 2, []), (9, 3, [-4, 1]), (12, 4, [5, 5]), (13, 2, [1, 1]),
    ]
    got = mined(spark, rows)
    assert got == brute(rows, lambda i: i is not None and i % 3 == 0) and any(r[3] is None for r in got)


def test_large_products_are_exact(spark):
    big = 2**40
    rows = [(0, 1, [big, 3]), (1, 1, [big, 5]), (2, 2, [big // 2, 1]), (4, 2, [big // 2, 2]), (5, 2, [big // 2, 0])]
    with pytest.MonkeyPatch.context() as m:
        m.setattr(negatives, "LOW", negatives.LOW)
        got = mined(spark, [(i, lb, [v[0] // 2**10, v[1]]) for i, lb, v in rows])
    assert [r[3] for r in sorted(got, key=lambda r: r[2])] == [4, 2, 5]
    a = np.array([[2**35, 3], [2**62, 1]])
    want = [[sum(int(x) * int(y) for x, y in zip(u, v)) for v in a] for u in a]
    assert negatives.products(a, a).tolist() == [[min(x, 2**63 - 1) for x in row] for row in want]


def test_nothing(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(0, 1, [1]), (1, 2, [1])]) == []


def test_ties_keep_the_smaller_column():
    s = np.array([[3, 5, 5, 5, 1], [negatives.LOW, 2, negatives.LOW, 2, 2]])
    r, c = negatives.best(s, 2)
    assert list(zip(r, c)) == [(0, 1), (0, 2), (1, 1), (1, 3)]


def test_unusable_vectors(spark):
    rows = spark.createDataFrame(
        [(1, [1.0, None]), (2, None), (3, [float("nan")]), (4, [float("inf")]), (5, []), (6, [0.5, -0.001])], "id int, v array<double>"
    )
    assert [r[0] for r in rows.where(negatives.usable("v")).orderBy("id").collect()] == [5, 6]
    assert rows.where("id = 6").select(negatives.whole_steps("v")).first()[0] == [128, -1]


def test_query(spark, sf, duck):
    got = sorted(tuple(r) for r in queries.op12_negatives(spark, sf).collect())
    assert got == sorted(duck.execute(queries.OP12_SQL).fetchall()) and got
