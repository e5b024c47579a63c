import random

import numpy as np
import pytest
from conftest_llm import ODD, plain

from tidewright.llm import prefix_free, repeats


def brute(texts, length=100):
    """Texts in corpus order -> (removed ranges, rest)."""
    seen, out = set(), []
    for t in texts:
        raw, gone = (t or "").encode(), set()
        for i in range(len(raw) - length + 1):
            w = raw[i : i + length]
            if w in seen:
                gone.update(range(i, i + length))
            seen.add(w)
        starts = sorted(g for g in gone if g - 1 not in gone)
        ends = sorted(g + 1 for g in gone if g + 1 not in gone)
        out.append((list(zip(starts, ends)), bytes(c for i, c in enumerate(raw) if i not in gone)))
    return out


def got(df, **kw):
    rows = repeats.remove_repeats(df, **kw).collect()
    assert all(r["n_bytes"] == len(r["kept"]) + sum(s["end"] - s["start"] for s in r["spans"]) for r in rows)
    return sorted(((r["id"], [(s["start"], s["end"]) for s in r["spans"]], bytes(r["kept"])) for r in rows), key=str)


def want(texts):
    return sorted(((i, *x) for i, x in enumerate(brute(texts))), key=str)


def corpus(seed):
    rng = random.Random(seed)

    def fresh(n, letters="abcdefgh \n"):
        return "".join(rng.choices(letters, k=n))

    passage, texts = fresh(180), [fresh(rng.randrange(600)) for _ in range(15)]
    texts += [fresh(rng.randrange(150)) + passage[rng.randrange(60) :][: rng.randrange(90, 130)] + fresh(50) for _ in range(40)]
    texts += ["ab" * 300, "x" * 500, "xyz" * 100, fresh(99), fresh(100), "é" * 120, fresh(700, "ab")]
    texts += [texts[k] for k in rng.sample(range(40), 15)] + [t[:150] + fresh(9) + t[150:] for t in texts[:8]]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed, crowd", [(1, 2000), (2, 0), (3, 3)])
def test_equals_brute_force(spark, seed, crowd):
    texts = corpus(seed)
    assert got(plain(spark, texts).repartition(4), crowd=crowd) == want(texts)


def test_tasks_flush_and_cut_segments(spark, monkeypatch):
    texts = corpus(4)
    monkeypatch.setattr(prefix_free, "SEGMENT", 64)
    prefix_free._rolling.cache_clear()
    for t in texts:
        raw = np.frombuffer(t.encode(), np.uint8)
        _, _, lo, n = prefix_free.phrases(raw, 100)
        assert sum(n) == max(0, len(raw) - 99) and all(lo[1:] == (lo + n)[:-1])
    prefix_free._rolling.cache_clear()


def test_table_of_documents(spark, some_texts):
    assert got(plain(spark, some_texts)) == want(some_texts)


def test_odd_rows(spark, odd, nothing):
    """Null ids come last; equal ids follow their places, which here hold equal texts."""
    long = "0123456789" * 9 + "abcdefghij" * 5
    order = sorted((r[:2] for r in ODD), key=lambda r: (r[0] is None, r[0] or 0))
    texts = brute([t for _, t in order])
    rows = sorted(((i, *x) for (i, _), x in zip(order, texts)), key=str)
    assert got(odd) == rows
    twice = [(3, long, "", "", 0), (3, long, "", "", 0), (None, long, "", "", 0), (1, "z" + long, "", "", 0)]
    df = spark.createDataFrame(twice, "doc_id bigint, text string, a string, b string, c int")
    kept = sorted(len(k) for _, _, k in got(df))
    assert kept == [0, 0, 0, len(long) + 1]
    assert got(nothing) == []
