import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from conftest_llm import ODD, plain
from tokenizers import Tokenizer

from tidewright.llm import packing, tokens

VOCAB = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    made = Tokenizer.from_file(VOCAB)
    made.encode_special_tokens = True
    return made


def test_ids_equal_the_library(library, some_texts):
    cache = tokens.WordCache(VOCAB)
    rng = random.Random(4)
    alphabet = "abcXYZéÉßğİıŁñÑ'’.,-_09²½ \t\n\x85\xa0 ̱́中日Σςσ👍ﬁ\x00\x1c"
    texts = some_texts + ["".join(rng.choices(alphabet, k=rng.randrange(1, 30))) for _ in range(4000)]
    texts += ["It's we'll I'D don't 'Ve", "H̱ é É", "<|endoftext|> a", "thethethethe" * 50, "aaaa" * 30]
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(cache.encode(text), "<u4").tolist() == want.ids, text


def check(rows, texts, library, capacity):
    """Every document whole, every sequence gapless and within the capacity."""
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    want = Counter()
    for i, text in texts:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        for n, at in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[at : at + capacity], "<u4")
            want[i, n, at, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    for s in sequences.values():
        at = 0
        for r in sorted(s, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    return len(sequences), -(-sum(r["length"] for r in rows) // capacity)


def test_table(spark, some_texts, library):
    rows = packing.pack(packing.pieces(plain(spark, some_texts), VOCAB)).collect()
    n, least = check(rows, list(enumerate(some_texts)), library, 2048)
    assert n <= least * 1.02 + 1


@pytest.mark.parametrize("capacity, groups, large", [(64, 8, 0.25), (50, 3, 0.1), (16, 1, 0.5), (2048, 512, 0.25)])
def test_capacities(spark, some_texts, library, capacity, groups, large):
    texts = [t[: 40 + 9 * k] for k, t in enumerate(some_texts[:80])] + ["", "a b"] * 20
    df = plain(spark, texts).repartition(3)
    rows = packing.pack(packing.pieces(df, VOCAB, capacity=capacity), capacity, groups, large).collect()
    n, least = check(rows, list(enumerate(texts)), library, capacity)
    assert n <= least * 1.25 + 1


def test_odd_rows(spark, odd, nothing, library):
    rows = packing.pack(packing.pieces(odd, VOCAB)).collect()
    check(rows, [r[:2] for r in ODD], library, 2048)
    assert packing.pack(packing.pieces(nothing, VOCAB)).count() == 0


def test_configurations_use_every_item():
    rng = random.Random(0)
    sizes = sorted((rng.randrange(300, 2000) for _ in range(20)), reverse=True)
    counts = [rng.randrange(1, 50) for _ in sizes]
    used = Counter()
    for members, times in packing.configurations(sizes, counts, 2048):
        assert times > 0 and sum(sizes[g] for g in members) <= 2048
        for g in members:
            used[g] += times
    assert used == Counter(dict(enumerate(counts)))


def test_best_fit_places_every_item_once():
    rng = random.Random(1)
    room = {rng.randrange(0, 900): rng.randrange(1, 9) for _ in range(30)}
    small = {rng.randrange(1, 400): rng.randrange(1, 40) for _ in range(60)}
    slots, opened = packing.best_fit(room, small, 2048, 9999)
    placed, load = Counter(), Counter()
    for length, lo, hi, cls, first, _ in slots:
        placed[length] += hi - lo
        for k in range(hi - lo):
            assert first + k < (opened if cls == 9999 else room[cls])
            load[cls, first + k] += length
    assert placed == Counter(small)
    assert all(n <= (2048 if cls == 9999 else cls) for (cls, _), n in load.items())


def test_batches_of_long_texts_stay_small(spark):
    import pyarrow as pa
    from conftest_llm import plain

    from tidewright.llm.common import located
    from tidewright.session import BATCH

    docs = located(plain(spark, ["x" * 100_000] * 200)).select("text").coalesce(1)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"])

    assert max(r["n"] for r in docs.mapInArrow(sizes, "n bigint").collect()) <= BATCH + 200_000
