import glob

import numpy as np
import pytest
from conftest_llm import ODD, plain

from tidewright.llm import queries, sharding


def placed(df):
    """{shard: slots} after checking that slots are gapless from 0."""
    shards = {}
    for r in df.collect():
        shards.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in shards.values())
    return {k: len(v) for k, v in shards.items()}


def test_matrix_has_the_margins():
    rng = np.random.default_rng(1)
    counts, room = [7, 0, 31, 100, 2], sharding.shard_sizes(140, 16)
    for limit in (10**9, 1):  # numpy's draws and the summed distribution
        m = sharding.matrix(counts, room, rng, limit)
        assert m.sum(axis=1).tolist() == counts and m.sum(axis=0).tolist() == room and (m >= 0).all()
    assert sharding.matrix([], [0, 0], rng).shape == (0, 2)
    big = 10**12
    m = sharding.matrix([big, big], [big, big], rng)
    assert m.sum() == 2 * big and abs(int(m[0, 0]) - big // 2) < 10**7


@pytest.mark.parametrize("limit", [10**9, 1])
def test_draws_follow_the_distribution(limit):
    from math import comb

    rng = np.random.default_rng(3)
    good, bad, n, times = 6, 9, 7, 20_000
    seen = np.bincount([sharding.hypergeometric(rng, good, bad, n, limit) for _ in range(times)], minlength=7)
    want = np.array([comb(good, k) * comb(bad, n - k) / comb(good + bad, n) for k in range(7)])
    assert np.abs(seen / times - want).max() < 0.015


def test_odd_rows(odd, nothing):
    done = sharding.shuffled(odd, 4, cell_rows=3)
    assert placed(done) == {0: 3, 1: 3, 2: 2, 3: 2}
    assert done.columns == [*odd.columns, "shard", "slot"]
    assert sorted(map(repr, done.drop("shard", "slot").collect())) == sorted(map(repr, odd.collect()))
    assert len(ODD) == done.count()
    assert sharding.shuffled(nothing).count() == 0


def test_own_columns_are_replaced(odd):
    done = sharding.shuffled(odd.withColumnsRenamed({"h": "shard", "fp": "slot"}), 4)
    assert done.columns.count("shard") == 1 and placed(done) == {0: 3, 1: 3, 2: 2, 3: 2}


def test_same_again_and_other_seed(spark, tmp_path):
    plain(spark, [str(i) for i in range(500)]).repartition(3).write.parquet(f"{tmp_path}/in")
    docs = spark.read.parquet(f"{tmp_path}/in")
    first, again, other = [
        {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.shuffled(docs, 5, seed, 64).collect()} for seed in (1, 1, 2)
    ]
    assert first == again != other


def test_uniform_over_seeds(spark, tmp_path):
    """Every row lands in every shard and slot about equally often, neighbours of a cell independently."""
    n, shards, times = 12, 3, 20
    plain(spark, [str(i) for i in range(n)]).coalesce(1).write.parquet(f"{tmp_path}/in")
    docs = spark.read.parquet(f"{tmp_path}/in")
    every = None
    for seed in range(times):
        one = sharding.shuffled(docs, shards, seed, 5).selectExpr("doc_id", "shard * 4 + slot as at", f"{seed} as seed")
        every = one if every is None else every.unionAll(one)
        if seed % 10 == 9:
            rows = every.collect()
            every = None
            got = np.concatenate([got, rows]) if seed > 9 else np.array(rows)
    at = np.zeros((n, n))
    np.add.at(at, (got[:, 0], got[:, 1]), 1)
    assert at.sum() == n * times and (at.sum(axis=0) == times).all()
    chi = ((at - times / n) ** 2 / (times / n)).sum()
    assert chi < (n - 1) ** 2 + 5 * (2 * (n - 1) ** 2) ** 0.5


def test_written_shards(spark, tmp_path):
    done = sharding.shuffled(plain(spark, [str(i) for i in range(300)]), 4)
    sharding.write_shards(done, f"{tmp_path}/out", 50)
    for j in range(4):
        slots = [r["slot"] for f in sorted(glob.glob(f"{tmp_path}/out/shard={j}/*.parquet")) for r in spark.read.parquet(f).collect()]
        assert sorted(slots) == list(range(75))
    assert len(glob.glob(f"{tmp_path}/out/shard=0/*.parquet")) >= 2


def test_query(spark, sf):
    import zlib

    rows = queries.op11_sharding(spark, sf).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        raw = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "rows", None)
    sizes = placed(queries.op11_sharding(spark, sf))
    assert set(sizes) == set(range(16)) and max(sizes.values()) - min(sizes.values()) <= 1
