import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])

LONG = "".join(f"word{i % 977} " for i in range(40_000)) + "x" * 30_000

#: Null and repeated ids, null, empty and blank texts, a very long one, ties and repeated rows.
ODD = [
    (1, None, "en", "a", None), (2, "", None, "a", 0), (3, " \n\t ", "en", None, 4), (4, LONG, "en", "a", len(LONG)),
    (5, "same text here", "en", "a", 14), (6, "same text here", "en", "a", 14), (6, "same text here", "en", "a", 14),
    (None, "without id", "en", "a", 10), (None, None, None, None, None), (7, "ÄÖ é 中文   \x00 ok 👍🏽", "de", "b", 3),
]


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows with further columns that carry names the operators use themselves."""
    return table(spark, ODD)


def table(spark, rows):
    made = spark.createDataFrame([(i, t, la, s, n) for i, t, la, s, n in rows], SCHEMA)
    for name in ("id", "h", "fp", "digest", "spans", "part", "route", "score", "rank", "n", "left", "words"):
        made = made.selectExpr("*", f"'extra' as `{name}`")
    return made


def plain(spark, texts, first=0):
    return table(spark, [(i, t, "en", "s", len(t)) for i, t in enumerate(texts, first)])


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def some_texts():
    import pyarrow.parquet as pq

    return pq.read_table("/root/testdata/sf0.001/documents.parquet")["text"].to_pylist()
