"""The whole pipeline against a plain version of every stage on small tables."""

import random

import pytest
from conftest_llm import SCHEMA
from test_near_copies import brute_groups
from test_packing import check
from test_pii import PATTERN, valid

import re

import corpus_pipeline
from tidewright.llm import quality


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents of sf0.001 with copies, near copies, nulls and junk, and their labels."""
    import pyarrow.parquet as pq

    base = pq.read_table("/root/testdata/sf0.001/documents.parquet").to_pylist()
    rng, rows = random.Random(0), [tuple(r[c] for c in SCHEMA.names) for r in base]
    for r in base[:40]:
        words = r["text"].split(" ")
        words[rng.randrange(len(words))] = "edited"
        rows.append((1000 + r["doc_id"], " ".join(words), r["lang"], r["source"], None))
        rows.append((2000 + r["doc_id"], r["text"], None, None, r["n_chars"]))
    rows += [(5000, None, None, None, None), (5001, "", "en", "s", 0), (None, "no id " * 30, "en", "s", 180)]
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.read.parquet("/root/testdata/sf0.001/labels.parquet").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages(spark, folder, tmp_path):
    from tokenizers import Tokenizer

    import public_tokenizers

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        out.write.parquet(f"{tmp_path}/{name}")
        kept.append((name, docs, spark.read.parquet(f"{tmp_path}/{name}")))
        docs = kept[-1][2]
    for name, before, after in kept[:-1]:
        assert after.columns == before.columns or sorted(after.columns) == sorted(before.columns)

    (_, all_docs, good), (_, _, unique), (_, _, distinct), (_, _, clean), (_, _, packed) = kept
    model = quality.train(all_docs, spark.read.parquet(f"{folder}/labels.parquet"), "doc_id", "text")
    want = [(r["doc_id"], r["text"]) for r in all_docs.collect() if quality.margin(model, *quality.features(r["text"] or "", r["n_chars"])) >= 0]
    assert sorted(map(str, want)) == sorted(str((r["doc_id"], r["text"])) for r in good.collect())

    last = {}
    for i, t in want:
        last[t or ""] = max(last.get(t or "", -1), -1 if i is None else i)
    want = [(i, t) for i, t in want if last[t or ""] == (-1 if i is None else i)]
    assert sorted(map(str, want)) == sorted(str((r["doc_id"], r["text"])) for r in unique.collect())

    want.sort(key=lambda r: (r[0] is None, r[0]))
    want = [r for k, (r, g) in enumerate(zip(want, brute_groups([t for _, t in want]))) if g == k]
    assert sorted(map(str, want)) == sorted(str((r["doc_id"], r["text"])) for r in distinct.collect())
    assert len(want) < len(last)

    texts = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert set(texts) == {i for i, _ in want}
    for text in texts.values():
        for kind, pattern in PATTERN.items():
            assert not any(valid(kind, m[0]) for m in re.finditer(pattern, text or ""))

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.encode_special_tokens = True
    check(packed.collect(), list(texts.items()), library, 2048)


def test_run(spark, folder):
    rows = corpus_pipeline.run(spark, folder)
    assert rows.count() > 0 and "sequence_id" in rows.columns


def test_empty_documents(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    assert docs.count() == 0
