"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

score = sigmoid(w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j). The pairwise part costs linear time by
sum_{i<j} <v_i, v_j> x_i x_j = 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2].

The model is fitted on at most ``SAMPLE`` labelled training rows (chosen by a hash of the id, so a
retried job draws the same ones) and scores every whole text inside Spark tasks.
"""

from __future__ import annotations

import math
import string
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import small_batches
from .common import slices, whole_text

SAMPLE = 10_000
BUCKETS = 1 << 14
FACTORS = 8
SCORE = "_fm_score"

_UPPER, _DIGIT = string.ascii_uppercase.encode(), string.digits.encode()
_PUNCT = string.punctuation.encode()
_STRUCTURE = 18
_FIRST = np.arange(_STRUCTURE)


@dataclass(frozen=True)
class Model:
    bias: float
    weight: np.ndarray
    factor: np.ndarray


def features(text: str, n_chars: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sparse features (index, value) of a whole text: first ``_STRUCTURE`` slots for structure and
    the stated length (metadata), then hashed words with damped counts of unit length."""
    raw = text.encode()
    tokens = raw.split()
    counts = Counter(tokens)
    n, size = len(tokens), len(raw)
    lines = raw.split(b"\n")
    upper, digits, punct = (size - len(raw.translate(None, kind)) for kind in (_UPPER, _DIGIT, _PUNCT))
    plain = raw.count(b".") + raw.count(b",")
    value = [
        1.0,
        math.log1p(len(text)) / 10,
        math.log1p(len(text) if n_chars is None else max(0, n_chars)) / 10,
        math.log1p(n) / 10,
        min(1.0, size / (n or 1) / 20),
        len(counts) / (n or 1),
        max(counts.values(), default=0) / (n or 1),
        upper / (size or 1),
        (punct - plain) / (size or 1) * 4,
        plain / (size or 1) * 4,
        digits / (size or 1) * 4,
        raw.count(b"|") / (n or 1),
        raw.count(b"!") / (n or 1),
        len(set(lines)) / len(lines),
        min(1.0, n / len(lines) / 100),
        float(n == 0),
        sum(map(eq, tokens, tokens[1:])) / (n or 1),
        raw.count(b". ") / (n or 1),
    ]
    words: dict[int, int] = {}
    for token, c in counts.items():
        at = crc32(token.lower().strip(b".,")) % BUCKETS + _STRUCTURE
        words[at] = words.get(at, 0) + c
    index = np.fromiter(words, dtype=np.int64, count=len(words))
    damped = np.log1p(np.fromiter(words.values(), dtype=np.float64, count=len(words)))
    if len(damped):
        damped /= np.sqrt((damped**2).sum())
    return np.concatenate([_FIRST, index]), np.concatenate([value, damped])


def margin(model: Model, index: np.ndarray, value: np.ndarray) -> float:
    rows = model.factor[index] * value[:, None]
    pairs = (rows.sum(axis=0) ** 2 - (rows**2).sum(axis=0)).sum() / 2
    return float(model.bias + model.weight[index] @ value + pairs)


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-x)) if x >= 0 else math.exp(x) / (1 + math.exp(x))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = 6, rate: float = 0.1, decay: float = 1e-5, seed: int = 7) -> Model:
    """Logistic loss by AdaGrad in mini-batches. Rows of one class only (or none) give the constant share."""
    size = _STRUCTURE + BUCKETS
    rng = np.random.default_rng(seed)
    weight, factor = np.zeros(size), rng.normal(0, 0.05, (size, FACTORS))
    share = float(labels.mean()) if len(labels) else 0.5
    if share in (0.0, 1.0) or not len(labels):
        far = {0.0: -20.0, 1.0: 20.0}.get(share, 0.0)
        return Model(far, weight, np.zeros((size, FACTORS)))
    bias = math.log(share / (1 - share))
    g_weight, g_factor, g_bias = np.full(size, 1e-6), np.full((size, FACTORS), 1e-6), 1e-6
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), 64):
            batch = order[at : at + 64]
            sizes = [len(rows[i][0]) for i in batch]
            index = np.concatenate([rows[i][0] for i in batch])
            value = np.concatenate([rows[i][1] for i in batch])
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            own = np.repeat(np.arange(len(batch)), sizes)
            vx = factor[index] * value[:, None]
            total = np.add.reduceat(vx, starts)
            pairs = ((total**2) - np.add.reduceat(vx**2, starts)).sum(axis=1) / 2
            z = bias + np.add.reduceat(weight[index] * value, starts) + pairs
            error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[batch]) / len(batch)
            used, slot = np.unique(index, return_inverse=True)
            gw = np.bincount(slot, error[own] * value, len(used)) + decay * weight[used]
            part = (error[own] * value)[:, None] * (total[own] - vx)
            gv = np.stack([np.bincount(slot, part[:, f], len(used)) for f in range(FACTORS)], axis=1) + decay * factor[used]
            gb = error.sum()
            g_weight[used] += gw**2
            g_factor[used] += gv**2
            g_bias += gb**2
            weight[used] -= rate * gw / np.sqrt(g_weight[used])
            factor[used] -= rate / 2 * gv / np.sqrt(g_factor[used])
            bias -= rate * gb / math.sqrt(g_bias)
    return Model(float(bias), weight, factor)


def held_out(id_col: str = "doc_id") -> Column:
    """True for the third of the ids that training never sees; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, sample: int = SAMPLE, label_col: str = "quality") -> Model:
    """Fit on labelled rows that are not held out, at most about ``sample`` of them (so their ids
    may be broadcast).

    Ids with several labels count once, with their mean rounded up from one half; null labels and
    ids without a document are ignored.
    """
    small_batches(docs.sparkSession)
    known = (
        labels.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_label"))
        .where("_label is not null and _id is not null")
        .groupBy("_id").agg((F.avg("_label") >= 0.5).cast("int").alias("_label"))
    )
    known = known.where(~held_out("_id"))
    n = known.count()
    if n > sample:
        share = int(sample / n * (1 << 31))
        known = known.where(F.pmod(F.xxhash64("_id"), F.lit(1 << 31)) < share)
    stated = F.col("n_chars").cast("bigint") if "n_chars" in docs.columns else F.lit(None).cast("bigint")
    texts = docs.select(F.col(id_col).alias("_id"), whole_text(text_col).alias("_text"), stated.alias("_stated"))
    rows = texts.join(F.broadcast(known), "_id").select("_id", "_text", "_stated", "_label")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            made = [features(t.as_py(), s.as_py()) for t, s in zip(b.column("_text"), b.column("_stated"))]
            cols = [
                b.column("_id").cast(pa.string()),
                pa.array([i.tolist() for i, _ in made], pa.list_(pa.int32())),
                pa.array([v.tolist() for _, v in made], pa.list_(pa.float32())),
                b.column("_label"),
            ]
            yield pa.RecordBatch.from_arrays(cols, ["id", "index", "value", "label"])

    got = rows.mapInArrow(vectors, "id string, index array<int>, value array<float>, label int").toArrow()
    made = sorted(zip(got["id"].to_pylist(), range(got.num_rows)))
    index, value, label = got["index"].combine_chunks(), got["value"].combine_chunks(), got["label"].to_numpy()
    order = [i for _, i in made]
    vectors_ = [(index[i].values.to_numpy(zero_copy_only=False).astype(np.int64), value[i].values.to_numpy(zero_copy_only=False).astype(np.float64)) for i in order]
    return fit(vectors_, label[order].astype(np.float64) if len(order) else np.zeros(0))


def scored(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with a column ``SCORE``. Every row and the whole of every text is scored; null
    counts as empty. Without labels every score is one half."""
    small_batches(docs.sparkSession)
    has_length = "n_chars" in docs.columns
    schema = T.StructType([*docs.schema.fields, T.StructField(SCORE, T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(
        Model(model.bias, model.weight.astype(np.float32), model.factor.astype(np.float32))
    )  # a fixed 0.6 MB

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fm = shared.value
        for b in slices(batches):
            stated = b.column("n_chars").cast(pa.int64()) if has_length else pa.nulls(b.num_rows)
            pairs = zip(b.column(text_col).cast(pa.string()), stated)
            made = [_sigmoid(margin(fm, *features(t.as_py() or "", s.as_py()))) for t, s in pairs]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(made, pa.float64())], schema.names)

    return docs.mapInArrow(score, schema)


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that score below one half."""
    model = train(docs, labels, id_col, text_col)
    return scored(docs, model, text_col).where(F.col(SCORE) >= 0.5).drop(SCORE)
