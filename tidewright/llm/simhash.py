"""SimHash near-duplicates by a byte-position inverted index with count filtering.

A fingerprint is eight bytes. Two fingerprints at ``distance`` (4) differing bits or fewer
agree in at least 8 - 4 = 4 byte positions, so among any seven positions they agree in at least
three. The index therefore holds each distinct fingerprint under every three of the first seven
(position, byte) entries: 35 keys of 24 bits. In a bucket the shared positional bytes of each
pair are tallied, pairs with fewer than four are dropped, and the rest is verified by its
differing bits. A bucket leaves its task as a spanning star, never as all pairs; buckets over
``BLOCK`` fingerprints are dealt out as pairs of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settle
from .common import LOCATOR, located, slices, whole_text
from .components import components, stars

BYTES, INDEXED, SHARED_KEY = 8, 7, 3
BLOCK = 4096
ROWS_AT_ONCE = 1 << 19


def fingerprint(text: str, words: int = 4) -> int:
    """64-bit SimHash as a signed integer; 0 for a text without words."""
    tokens = text.encode().lower().split()  # bytes: only A-Z, only the six ASCII white spaces
    if not tokens:
        return 0
    line = b" ".join(tokens)
    if len(tokens) <= words:
        hashes = [xxhash.xxh64_intdigest(line, 42)]
    else:
        ends = np.cumsum([len(t) + 1 for t in tokens]) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        digest = xxhash.xxh64_intdigest
        spans = zip(starts[: len(tokens) - words + 1].tolist(), ends[words - 1 :].tolist())
        hashes = [digest(line[s:e], 42) for s, e in spans]
    return _majority(np.array(hashes, dtype=np.uint64))


def _majority(hashes: np.ndarray) -> int:
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):  # bounded memory for very long texts
        block = hashes[at : at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(hashes))
    return int(bits.view(">i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(file, row, id, fp) of every document; a null text counts as empty."""
    rows = located(docs).select(*LOCATOR, F.col(id_col).cast("bigint").alias("id"), whole_text(text_col).alias("text"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            fps = pa.array([fingerprint(t.as_py()) for t in batch.column("text")], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], fps], [*LOCATOR, "id", "fp"])

    return rows.mapInArrow(hashed, f"{LOCATOR[0]} string, {LOCATOR[1]} bigint, id bigint, fp bigint")


def _keys() -> F.Column:
    """35 index keys of a fingerprint: number of the position triple, then its three bytes."""
    part = [F.shiftrightunsigned("fp", 8 * i).bitwiseAND(255) for i in range(BYTES)]
    triples = list(combinations(range(INDEXED), SHARED_KEY))
    return F.array(*[
        (F.lit(n << 24) + part[i] * 65536 + part[j] * 256 + part[k]).cast("int")
        for n, (i, j, k) in enumerate(triples)
    ])


def _close(x: np.ndarray, distance: int) -> np.ndarray:
    """Count filter on shared positional bytes, then the verification by differing bits."""
    shared = np.zeros(len(x), dtype=np.int8)
    for i in range(BYTES):
        shared += (x >> np.uint64(8 * i)) & np.uint64(255) == 0
    near = shared >= BYTES - distance
    near[near] = np.bitwise_count(x[near]) <= distance
    return near


class _Links:
    """Links found so far in a task, kept as spanning stars."""

    def __init__(self) -> None:
        self.a: list[np.ndarray] = []
        self.b: list[np.ndarray] = []
        self.n = 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        if len(a):
            self.a.append(a), self.b.append(b)
            self.n += len(a)
            if self.n > 1 << 21:
                self.reduce()

    def reduce(self) -> None:
        if self.a:
            a, b = stars(np.concatenate(self.a), np.concatenate(self.b))
            self.a, self.b, self.n = [a], [b], len(a)


def _pairs_in_runs(key: np.ndarray, fp: np.ndarray, distance: int, links: _Links) -> None:
    """Compare rows of equal key with each other, lag by lag, over all runs at once."""
    at, lag = np.arange(len(key)), 0
    while len(at):
        lag += 1
        at = at[at < len(key) - lag]
        at = at[key[at] == key[at + lag]]
        near = at[_close((fp[at] ^ fp[at + lag]).view(np.uint64), distance)]
        links.add(fp[near], fp[near + lag])


_LINK = "a bigint, b bigint, bucket int, block bigint"


def _emit(links: _Links) -> Iterator[pa.RecordBatch]:
    links.reduce()
    for a, b in zip(links.a, links.b):
        none = pa.nulls(len(a))
        yield _batch(a, b, none.cast(pa.int32()), none.cast(pa.int64()))
    links.__init__()


def _batch(a, b, bucket, block) -> pa.RecordBatch:
    arrays = [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(bucket, pa.int32()), pa.array(block, pa.int64())]
    return pa.RecordBatch.from_arrays(arrays, ["a", "b", "bucket", "block"])


def _bucket_links(distance: int, limit: int):
    """Rows sorted by (key, fp) -> links, and the rows of buckets over ``limit`` with a block number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links, key, fp, done = _Links(), np.empty(0, np.int32), np.empty(0, np.int64), 0
        open_key = None  # a bucket already known to be over the limit, with `done` rows passed on
        for batch in batches:
            key = np.concatenate([key, batch.column(0).to_numpy()])
            fp = np.concatenate([fp, batch.column(1).to_numpy()])
            if len(key) < ROWS_AT_ONCE:
                continue
            cut = int(np.searchsorted(key, key[-1]))
            if len(key) - cut > limit:
                cut = len(key)
            out, open_key, done = _split_runs(key[:cut], fp[:cut], distance, limit, links, open_key, done)
            yield from out
            key, fp = key[cut:], fp[cut:]
        out, _, _ = _split_runs(key, fp, distance, limit, links, open_key, done)
        yield from out
        yield from _emit(links)

    return run


def _split_runs(key, fp, distance, limit, links, open_key, done):
    if not len(key):
        return [], open_key, done
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    size = np.diff(np.r_[first, len(key)])
    before = np.zeros(len(first), dtype=np.int64)
    if open_key is not None and key[0] == open_key:
        before[0] = done
    heavy = (size > limit) | (before > 0)
    out = []
    for i in np.flatnonzero(heavy):
        rows = slice(first[i], first[i] + size[i])
        block = (before[i] + np.arange(size[i])) // limit
        out.append(_batch(fp[rows], fp[rows], key[rows], block))
    if heavy[-1]:
        open_key, done = int(key[-1]), int(before[-1] + size[-1])
    light = ~np.repeat(heavy, size)
    _pairs_in_runs(key[light], fp[light], distance, links)
    return out, open_key, done


def _block_links(distance: int):
    """Rows sorted by (bucket, i, j) -> links between the two blocks of each group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links, group, held = _Links(), None, []
        for batch in batches:
            bucket, i, j, block, fp = (c.to_numpy() for c in batch.columns)
            edge = np.flatnonzero((bucket[1:] != bucket[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
            for lo, hi in zip(np.r_[0, edge], np.r_[edge, len(fp)]):
                name = (bucket[lo], i[lo], j[lo])
                if name != group:
                    _cross(group, held, distance, links)
                    group, held = name, []
                held.append((block[lo:hi], fp[lo:hi]))
        _cross(group, held, distance, links)
        yield from _emit(links)

    return run


def _cross(group, held, distance: int, links: _Links) -> None:
    if not held:
        return
    block, fp = (np.concatenate(x) for x in zip(*held))
    left, right = fp[block == group[1]], fp[block == group[2]]
    for n, one in enumerate(left):
        other = right[n + 1 :] if group[1] == group[2] else right
        near = other[_close((other ^ one).view(np.uint64), distance)]
        links.add(np.full(len(near), one), near)


def links(prints: DataFrame, distance: int = 4, block: int = BLOCK) -> DataFrame:
    """Distinct fingerprints (fp) -> links (a, b) that span every group of fingerprints joined by
    ``distance`` differing bits or fewer."""
    if not 0 <= distance <= BYTES - 1 - SHARED_KEY:
        raise ValueError("three shared bytes among seven are only guaranteed up to distance 4")
    rows = prints.select(F.explode(_keys()).alias("key"), "fp")
    found = settle(
        rows.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(_bucket_links(distance, block), _LINK),
        "links",
    )
    heavy = found.where(F.col("bucket").isNotNull())
    last = heavy.groupBy("bucket").agg(F.max("block").alias("last"))
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), "last")).alias("other")
    dealt = heavy.join(last, "bucket").select("bucket", "block", F.col("a").alias("fp"), other)
    pairs = dealt.select("bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "fp")
    ordered = pairs.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "block", "fp")
    more = ordered.mapInArrow(_block_links(distance), _LINK)
    return found.where(F.col("bucket").isNull()).union(more).select("a", "b")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = 4, block: int = BLOCK
) -> DataFrame:
    """One row per document: locator, id, fp, root (the component's smallest fingerprint) and
    component (smallest id reachable).

    Null texts count as empty; documents without words share fingerprint 0. A component whose
    ids are all null has a null component. Repeated rows are all returned. An empty table gives
    an empty result.
    """
    rows = settle(fingerprints(docs, id_col, text_col), "simhash")
    prints = settle(rows.groupBy("fp").agg(F.min("id").alias("id")), "prints")
    joined = components(links(prints, distance, block))
    rooted = prints.join(joined, prints["fp"] == joined["node"], "left").select(
        "fp", "id", F.coalesce("root", "fp").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("id").alias("component"))
    named = rooted.join(smallest, "root").select("fp", "root", "component")
    return rows.join(named, "fp").select(*LOCATOR, "id", "fp", "root", "component")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of every near-duplicate component: the one with the smallest id
    (null ids last, then by place)."""
    docs = located(docs)
    rows = near_duplicates(docs, id_col, text_col)
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", *LOCATOR)).alias("first")
    keep = rows.groupBy("root").agg(first).select(*[F.col(f"first.{c}").alias(c) for c in LOCATOR])
    return docs.join(keep, LOCATOR, "left_semi").drop(*LOCATOR)
