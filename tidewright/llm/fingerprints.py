"""Document fingerprints in Spark: sketches of whole texts, compared with an edited version and with the
next document.

The next document in descending order of id comes from a range partition whose bounds are ids of the
table: each part is sorted, and the first document of a part is also sent to the part before it. Texts
are shuffled once, compressed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import partitions, slices, whole_text
from .iblt import CELLS, Paragraphs, differing, likeness, sketch

AT_ONCE = 1000
_NO_ID = -(2**63)
_DEALT = ["part", "guest", "ordered", "h", "id", "z"]


def edited_text(text: str, following: str) -> str:
    """The last third (rounded down) replaced by as many first characters of the next text."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


def differences(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """``pairs`` with ``gone`` and ``came``: digests of the paragraphs that only the left or only the
    right text has, peeled from subtracted sketches. Null texts count as empty."""
    names = [*pairs.columns, "gone", "came"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sides = [Paragraphs([t.as_py() or "" for t in b.column(c)]) for c in (left, right)]
            found = differing(*sides)
            lists = [pa.array([f[i].view(np.int64).tolist() for f in found], pa.list_(pa.int64())) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*b.columns, *lists], names)

    digests = T.ArrayType(T.LongType())
    schema = T.StructType([*pairs.schema.fields, T.StructField("gone", digests), T.StructField("came", digests)])
    return pairs.mapInArrow(run, schema)


def versions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", cells: int = CELLS) -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Null texts count as empty. Null ids come last in the order; rows of the same id are ordered
    by a hash of their text. The next document of the last one is the first; a single document is its own
    next. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    ordered = F.coalesce(F.col(id_col).cast("bigint"), F.lit(_NO_ID))
    rows = docs.select(ordered.alias("ordered"), F.col(id_col).cast("bigint").alias("id"), whole_text(text_col).alias("text"))
    n = partitions(spark)
    shares = [i / (4 * n) for i in range(1, 4 * n)]
    at = rows.agg(F.percentile_approx("ordered", shares, 40 * n).alias("q"), F.max("ordered").alias("top")).first()
    starts = np.unique(np.array([*(at["q"] or []), *([at["top"]] if at["top"] is not None else [])], dtype=np.int64))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for b in slices(batches):
            ids = b.column("ordered").to_numpy()
            part = np.searchsorted(starts, ids)
            first = np.flatnonzero(starts[part] == ids)
            taken = pa.array(np.r_[np.arange(len(ids)), first])
            raw = [t.as_py().encode() for t in b.column("text")]
            h = np.array([int.from_bytes(hashlib.blake2b(t, digest_size=7).digest()) for t in raw], dtype=np.int64)
            z = pa.array([pack(t) for t in raw], pa.binary())
            to = np.r_[part, (part[first] + 1) % len(starts)].astype(np.int32)
            guest = np.r_[np.zeros(len(ids), bool), np.ones(len(first), bool)]
            cols = [b.column("ordered").take(taken), pa.array(h).take(taken), b.column("id").take(taken), z.take(taken)]
            yield pa.RecordBatch.from_arrays([pa.array(to), pa.array(guest), *cols], _DEALT)

    dealt = rows.mapInArrow(deal, "part int, guest boolean, ordered bigint, h bigint, id bigint, z binary")
    inside = dealt.repartition(n, "part").sortWithinPartitions("part", "guest", F.col("ordered").desc(), "h")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            for at in range(0, b.num_rows, AT_ONCE):
                block = b.slice(at, AT_ONCE)
                if held is not None:
                    block = pa.Table.from_batches([held, block]).combine_chunks().to_batches()[0]
                held = block.slice(block.num_rows - 1)
                yield _compared(block, cells)

    return inside.mapInArrow(
        compare,
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )


_OUT = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def _compared(block: pa.RecordBatch, cells: int) -> pa.RecordBatch:
    """Every row of the block but the last, guests left out, held against the row after it."""
    part, guest = block.column("part").to_numpy(), block.column("guest").to_numpy(zero_copy_only=False)
    here = np.flatnonzero((part[:-1] == part[1:]) & ~guest[:-1])
    unpack = zstandard.ZstdDecompressor().decompress
    texts = [unpack(z.as_py()).decode() for z in block.column("z")]
    own, following = [texts[i] for i in here], [texts[i + 1] for i in here]
    edited = [edited_text(a, b) for a, b in zip(own, following)]
    a, b, c = Paragraphs(own), Paragraphs(edited), Paragraphs(following)
    columns = [
        block.column("id").take(pa.array(here)),
        pa.array([len(t) for t in own], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
        pa.array(sketch(a, cells).encoded(), pa.string()),
        pa.array(sketch(b, cells).encoded(), pa.string()),
        pa.array(likeness(a, b, cells), pa.float64()),
        pa.array(likeness(a, c, cells), pa.float64()),
    ]
    return pa.RecordBatch.from_arrays(columns, _OUT)
