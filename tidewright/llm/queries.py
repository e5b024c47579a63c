"""The registered queries of the training-data operators and, where SQL can express them, their DuckDB text."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, exact_dedup, fingerprints, html_text, licenses, negatives, packing, phrases, pii, quality, repeats, sharding, simhash
from .common import table


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pii.find(table(spark, sf_dir, "documents"))

    def n(kind: str) -> F.Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    every = F.array_sort(F.concat("spans", "term_spans"))
    return rows.select(
        F.col("id").alias("doc_id"),
        *[n(kind) for kind in pii.KINDS],
        F.sha2(pii.labelled(F.col("spans")), 256).alias("base_sha256"),
        pii.labelled(every).alias("spans"),
    )


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.versions(table(spark, sf_dir, "documents"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return bpe.digests(bpe.decoded(bpe.encoded(table(spark, sf_dir, "documents"), *rule), *rule))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    fp = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return rows.select(F.col("id").alias("doc_id"), fp.alias("fingerprint"), F.col("component").alias("component_id"))


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = html_text.main_texts(table(spark, sf_dir, "pages"))
    return rows.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return rows.select(
        F.col("id").alias("doc_id"), "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = licenses.scan(table(spark, sf_dir, "documents"), ["doc_id"])
    starts = F.transform("base", lambda b: b["start"])
    base = F.transform("base", lambda b: b["label"])
    every = F.concat(base, F.transform("found", lambda f: f["label"]))

    def listed(labels: F.Column) -> F.Column:
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    return rows.select(
        "doc_id", "n_words", F.size("base").cast("bigint").alias("n_base"),
        F.array_min(starts).cast("bigint").alias("first_word"), F.array_max(starts).cast("bigint").alias("last_word"),
        listed(base).alias("base_labels"), listed(every).alias("labels"), "score",
    )


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    model = quality.train(docs, table(spark, sf_dir, "labels"), "doc_id", "text")
    score = F.col(quality.SCORE)
    return quality.scored(docs, model).select(
        "doc_id", quality.held_out().alias("held_out"), score.alias("score"), (score >= 0.5).cast("int").alias("predicted")
    )


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = public_tokenizers.path("word_bpe_49k.json")
    packed = packing.pack(packing.pieces(table(spark, sf_dir, "documents"), vocab))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_dedup.exact_groups(table(spark, sf_dir, "documents"))
    return rows.select(
        F.col("id").alias("doc_id"), "keep_id", F.col("n").alias("group_size"), "kept", F.col("digest").alias("text_sha256")
    )


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", sharding.row_bytes("text").alias("size"), F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32")
    )
    rows = sharding.shuffled(docs)
    return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "embeddings").where(negatives.usable("embedding"))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = raw.select(F.col("vec_id").alias("id"), label.alias("label"), negatives.whole_steps("embedding").alias("q"))
    return negatives.mine(rows, F.coalesce(F.col("id") % 100 == 0, F.lit(False)))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


OP10_SQL = """
SELECT doc_id,
       max(doc_id) OVER g AS keep_id,
       count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""

OP12_SQL = """
WITH v AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.id AS anchor_id, b.id AS id, a.label = b.label AS same,
         list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v a JOIN v b ON a.id <> b.id WHERE a.id % 100 = 0),
pos AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.id)::INT AS rank,
       n.id AS negative_id, p.positive_score, n.score AS negative_score
FROM pos p JOIN pairs n ON p.anchor_id = n.anchor_id AND NOT n.same
 AND 30 * p.positive_score <= 100 * n.score AND 100 * n.score <= 90 * p.positive_score
QUALIFY rank <= 10
"""

OP13_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
lists AS (SELECT lang, row_number() OVER () AS p, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
words AS (SELECT lang, p, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM lists),
runs AS (SELECT lang, x, lead(x) OVER o AS y, lead(x, 2) OVER o AS z FROM words WINDOW o AS (PARTITION BY p ORDER BY i)),
grams AS (
  SELECT 1 AS k, lang, x AS phrase FROM runs
  UNION ALL SELECT 2, lang, x || ' ' || y FROM runs WHERE y IS NOT NULL
  UNION ALL SELECT 3, lang, x || ' ' || y || ' ' || z FROM runs WHERE z IS NOT NULL),
f AS (SELECT k, lang, phrase, count(*) AS n FROM grams GROUP BY ALL),
total AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT k, lang, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND n >= 10),
cuts AS (
  SELECT c.k, c.lang, c.phrase, c.a, j AS cut, x.n AS l, y.n AS r,
         (1000000::HUGEINT * c.a * c.a // (x.n::HUGEINT * y.n))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM cand) c
  JOIN f x ON x.lang = c.lang AND x.k = j AND x.phrase = array_to_string(c.w[1:j], ' ')
  JOIN f y ON y.lang = c.lang AND y.k = c.k - j AND y.phrase = array_to_string(c.w[j + 1:], ' ')),
scored AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
covered AS (
  SELECT lang, sub AS phrase, max(a) AS within
  FROM (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS sub FROM cand WHERE k = 3)
  GROUP BY ALL)
SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY s.score DESC, s.a DESC, s.phrase)::INT AS rank,
       s.phrase, s.a, s.l, s.r, t.n, s.score
FROM scored s JOIN total t USING (lang) LEFT JOIN covered c ON c.lang = s.lang AND c.phrase = s.phrase
WHERE c.within IS NULL OR 100 * c.within < 50 * s.a
QUALIFY rank <= 2000
"""

QUERIES = {
    "op1_pii": op1_pii,
    "op2_fingerprints": op2_fingerprints,
    "op3_bpe": op3_bpe,
    "op4_simhash": op4_simhash,
    "op5_html": op5_html,
    "op6_repeats": op6_repeats,
    "op7_licenses": op7_licenses,
    "op8_quality": op8_quality,
    "op9_packing": op9_packing,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_sharding": op11_sharding,
    "op12_negatives": op12_negatives,
    "op13_phrases": op13_phrases,
}

ORACLES = {"op10_exact_dedup": OP10_SQL, "op12_negatives": OP12_SQL, "op13_phrases": OP13_SQL}
