"""Every registered query next to its DuckDB text on the smallest tables."""

import math

import pytest

import __spark_entry__ as entry

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


def canon(v):
    if v is None or type(v).__name__ in ("NAType", "NaTType"):
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9) + 0.0
    return v


def rows(pdf):
    columns = sorted(pdf.columns)
    data = [tuple(canon(x) for x in r) for r in pdf[columns].itertuples(index=False, name=None)]
    return columns, sorted(data, key=lambda r: tuple((x is not None, str(x)) for x in r))


def same(a, b):
    if isinstance(a, float) or isinstance(b, float):
        if a is None or b is None:
            return a is b
        # One unit of the last rounded digit: both engines round sums of differing order.
        return math.isclose(a, b, rel_tol=1e-6, abs_tol=2e-6)
    return a == b


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, duck, sf, name):
    got_cols, got = rows(QUERIES[name](spark, sf).toPandas())
    want_cols, want = rows(duck.execute(ORACLES[name]).df())
    assert got_cols == want_cols
    assert len(got) == len(want)
    exact = sum(g == w for g, w in zip(got, want))
    if exact != len(got):
        near = sum(all(same(a, b) for a, b in zip(g, w)) for g, w in zip(got, want))
        assert near == len(got)


def test_oracle_names_are_queries():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() == 120
