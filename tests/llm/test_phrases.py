import random
import re
from collections import Counter

import numpy as np
import pytest
from conftest_llm import ODD, nothing, plain, table  # noqa: F401

from tidewright.llm import phrases, queries


def brute(rows, threshold, longest=3, cover=50, top=2000):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f, out = {}, []
    for lang, text in rows:
        own = f.setdefault(lang if lang is not None else "und", Counter())
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(lower)):
            w = re.findall("[^ \t]+", piece)
            own.update(tuple(w[i : i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    for lang, c in f.items():
        n = sum(v for k, v in c.items() if len(k) == 1)
        often = {p: a for p, a in c.items() if len(p) > 1 and a >= threshold}
        found = []
        for p, a in often.items():
            def inside(q, p=p):
                return len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))

            if any(inside(q) and 100 * b >= cover * a for q, b in often.items()):
                continue
            s, _, left, right = min((10**6 * a * a // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            found.append((-s, -a, " ".join(p).encode(), left, right))
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -s))
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.collect())


def made(rng, n, kinds=12):
    """Texts of few words, so that ties, coverage and late activation occur; words of the second half
    only become frequent in the last rows."""
    rows = []
    for i in range(n):
        words = [f"w{rng.randint(0, kinds if i > 0.8 * n else kinds // 2)}" for _ in range(rng.randint(0, 30))]
        text = "".join(w + rng.choice([" ", " ", " ", "\t ", ". ", "\n", ", "]) for w in words)
        rows.append((i, text, rng.choice(["en", "de", None]), "s", len(text)))
    return rows


@pytest.mark.parametrize("shards, threshold, longest", [(1, 3, 3), (4, 5, 3), (3, 4, 4)])
def test_against_brute_force(spark, shards, threshold, longest):
    rows = made(random.Random(shards), 150)
    got = phrases.collocations(table(spark, rows), threshold=threshold, longest=longest, shards=shards, top=40)
    want = brute([(r[2], r[1]) for r in rows], threshold, longest, top=40)
    assert found(got) == want and want


@pytest.mark.parametrize("slots", [1, 64])
def test_false_hits_change_nothing(spark, slots):
    """With a table so small that nearly all phrases seem active the counts stay exact."""
    rows = made(random.Random(5), 80)
    got = phrases.collocations(table(spark, rows), threshold=4, slots=slots)
    assert found(got) == brute([(r[2], r[1]) for r in rows], 4)


def test_every_occurrence_is_counted_once_in_a_cycle():
    """Activation late in the cycle, and slots marked by others before a phrase's parts were active."""
    rng = np.random.default_rng(2)
    shards, cycle, threshold = [], 3, 6
    for s in range(cycle):
        shards.append([" ".join(f"v{x}" for x in rng.integers(0, 3 + 2 * s, 60)) for _ in range(3)])
    for slots in (1 << 16, 97):
        marks = [np.full(slots, phrases.NEVER, np.uint8) for _ in range(2)]
        total = Counter()
        for scan in range(4 * cycle):
            for _, names, n in phrases.count_slice("en", shards[scan % cycle], scan, cycle, marks):
                total.update(dict(zip(names, n.tolist())))
            for name, n in total.items():
                w = name.split(b" ")
                if n >= threshold and len(w) < 3:
                    at = phrases._slots(phrases._phrase_hashes("en", [w]), slots).astype(int)
                    for x in at.ravel():
                        marks[len(w) - 1][x] = min(marks[len(w) - 1][x], scan)
        want = Counter()
        for t in (t for texts in shards for t in texts):
            w = t.encode().split()
            want.update(b" ".join(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
        assert all(total[p] == n for p, n in want.items() if n >= threshold)
        assert all(total[p] <= n for p, n in want.items())


def test_long_texts_are_cut_between_words(monkeypatch):
    monkeypatch.setattr(phrases, "CUT", 16)
    text = "aa bb.cc " * 20 + "x" * 50 + " end. more"
    ids = phrases.Ids()
    whole = np.concatenate(ids.of(text))
    words = list(ids.number)
    assert [words[i] for i in whole] == text.replace(".", " . ").encode().split() + [b"."]


def test_odd_rows(spark, odd, nothing):  # noqa: F811
    got = phrases.collocations(odd, threshold=2)
    assert found(got) == brute([(r[2], r[1]) for r in ODD], 2)
    assert found(phrases.collocations(nothing)) == []
    assert found(phrases.collocations(plain(spark, [" . \t", "", "one"]))) == []


def test_query(spark, sf, duck):
    got = found(queries.op13_phrases(spark, sf))
    assert got == sorted(duck.execute(queries.OP13_SQL).fetchall()) and got


def test_what_has_had_its_cycle_is_not_carried_on(spark, monkeypatch):
    carried = []

    def kept(df, tag, settle=phrases.settle):
        out = settle(df, tag)
        if tag == "counts":
            carried.append({r["len"] for r in out.collect()})
        return out

    monkeypatch.setattr(phrases, "settle", kept)
    docs = spark.createDataFrame([("en", "a b c d", k % 2) for k in range(8)], "lang string, text string, shard int")
    often, words = phrases.frequent(docs, threshold=3, shards=2)
    assert sorted((r["phrase"], r["n"]) for r in often.collect() if r["len"] == 3) == [("a b c", 8), ("b c d", 8)]
    assert [tuple(r) for r in words.collect()] == [("en", 32)]
    assert len(carried) > 3 and carried[0] == {1} and 1 not in carried[3] and carried[-1] == {3}
