import random

import xxhash
from conftest_llm import ODD, plain

from tidewright.llm import simhash


def brute_print(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in low + " ":
        if c in " \t\n\v\f\r":
            words += [word] if word else []
            word = ""
        else:
            word += c
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """Id -> smallest id of its component, by comparing all pairs."""
    ids = [i for i, _ in prints]
    root = {k: k for k in range(len(ids))}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(ids)):
        for b in range(a):
            if (prints[a][1] ^ prints[b][1]).bit_count() <= 4:
                root[find(a)] = find(b)
    smallest = {}
    for k, i in enumerate(ids):
        if i is not None:
            smallest[find(k)] = min(i, smallest.get(find(k), i))
    return sorted(((i, smallest.get(find(k))) for k, i in enumerate(ids)), key=str)


def components(rows):
    return sorted(((r["id"], r["component"]) for r in rows.collect()), key=str)


def test_fingerprints_of_whole_texts(some_texts):
    for t in [*some_texts[:60], *(r[1] for r in ODD[:3]), "A b", "a a a a a a", "É É x y z"]:
        assert simhash.fingerprint(t or "") & (2**64 - 1) == brute_print(t)


def test_odd_rows(spark, odd):
    rows = simhash.near_duplicates(odd)
    want = brute_components([(r[0], brute_print(r[1])) for r in ODD])
    assert components(rows) == want
    kept = simhash.one_of_each(odd)
    assert kept.columns == odd.columns
    assert kept.count() == len({simhash.fingerprint(r[1] or "") for r in ODD})


def test_empty_table(nothing):
    assert simhash.near_duplicates(nothing).count() == 0
    assert simhash.one_of_each(nothing).count() == 0


def _dense(n, seed):
    """Fingerprints around a few centres, many in the same bucket."""
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(4)]
    out = {0}
    while len(out) < n:
        p = rng.choice(centres)
        for _ in range(rng.randrange(7)):
            p ^= 1 << rng.randrange(64)
        out.add(p)
    return [p - (1 << 64) if p >> 63 else p for p in sorted(out)]


def test_links_lose_no_pair(spark):
    from tidewright.llm.components import components as joined

    prints = _dense(700, 1)
    df = spark.createDataFrame([(p,) for p in prints], "fp bigint")
    pairs = [(p, p & (2**64 - 1)) for p in prints]
    want = dict(brute_components(pairs))
    for block in (4096, 16, 3):
        root = {r["node"]: r["root"] for r in joined(simhash.links(df, block=block)).collect()}
        groups = {}
        for p in prints:
            groups.setdefault(root.get(p, p), []).append(p)
        assert sorted(min(g) for g in groups.values()) == sorted(set(want.values()))
        assert all(want[p] == min(g) for g in groups.values() for p in g)


def test_near_copies(spark, some_texts):
    rng = random.Random(3)
    texts = list(some_texts[:40])
    for t in some_texts[:15]:
        words = t.split(" ")
        for _ in range(3):
            w = list(words)
            w[rng.randrange(len(w))] = "changed"
            texts.append(" ".join(w))
    got = components(simhash.near_duplicates(plain(spark, texts)))
    assert got == brute_components([(i, brute_print(t)) for i, t in enumerate(texts)])
