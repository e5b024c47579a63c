import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from conftest_llm import ODD

from tidewright.llm import bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def own():
    return bpe.Encoder(bpe.read_ranks(PATH), PATTERN)


@pytest.fixture(scope="module")
def library(own):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=own.ranks, special_tokens={})


def check(own, library, text):
    ids = own.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)
    assert own.decode(ids) == text.encode()


def test_equals_the_library(own, library, some_texts):
    for text in some_texts:
        check(own, library, text)


def test_odd_pieces(own, library):
    rng = random.Random(5)
    parts = ["the", "ing", "a", "ab", "é", "中", "\x00", " ", "\n", "0", "'s", "!", "👍🏽", "tion", "q", "zz"]
    for _ in range(3000):
        check(own, library, "".join(rng.choices(parts, k=rng.randrange(1, 40))))
    for text in ["a" * 50_000, "ab" * 9_000, "!" * 5_000, " " * 5_000, "é" * 3_000, "<|endoftext|>"]:
        check(own, library, text)


def test_table(odd, nothing, library):
    rows = bpe.digests(bpe.decoded(bpe.encoded(odd, PATH, PATTERN), PATH, PATTERN)).collect()
    got = sorted((str(r["doc_id"]), r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows)
    want = []
    for i, text, *_ in ODD:
        ids = np.array(library.encode_ordinary(text or ""), dtype="<u4")
        want.append((str(i), len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want)
    assert bpe.encoded(nothing, PATH, PATTERN).count() == 0
