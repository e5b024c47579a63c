"""Removal of repeated byte strings (suffix-array deduplication by prefix-free parsing).

1. Parse: each text is cut into phrases (``prefix_free``). Phrases equal to an earlier one of their task
   are repeats already; the others go to the task of their trigger.
2. Dictionary: per trigger, the first phrase of each digest in corpus order is a dictionary
   entry, later ones are repeats as a whole. A trigger with one entry is done.
3. Triggers with several entries have windows in common in part: the bytes of these entries are fetched and
   their suffix array, cut at ``length``, orders all windows; equal neighbours repeat.
4. Marked windows are united to byte ranges and cut out of the texts.

Copies are combined before each shuffle. The entries of a trigger that very many different phrases share
(the edge of a passage in a third of all texts) are dealt out window by window, by content.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import positions
from ..session import settle
from .common import LOCATOR, located, slices, whole_text
from .prefix_free import GRAM, phrases, repeated_windows

LENGTH = 100
AT_ONCE = 2_000_000  # phrases held by a parsing task
WINDOWS = 400_000  # windows sorted together
CROWD = 2_000  # entries of a trigger beyond which they are dealt out by content
_MARK = "doc bigint, lo bigint, n bigint, trigger bigint"


def numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, id, text) with ``doc`` an integer in corpus order: the id itself where ids are unique, else the
    rank by id (null ids last) and place."""
    rows = located(docs).select(*LOCATOR, F.col(id_col).cast("bigint").alias("id"), whole_text(text_col).alias("text"))
    ids = rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or id is null")
    if ids.isEmpty():
        return rows.select(F.col("id").alias("doc"), "id", "text")
    low = F.coalesce("id", F.lit(2**63 - 1))
    order = rows.select(*LOCATOR, low.alias("by"), F.lit(0).alias("all"))
    ranked = positions(order, ["all"], ["by", *LOCATOR], [F.shiftright("by", 12)], "doc")
    return settle(rows.join(ranked.select(*LOCATOR, "doc"), LOCATOR).select("doc", "id", "text"), "numbered")


def _parsed(docs: DataFrame, length: int) -> DataFrame:
    """(route, repeat, digest, doc, lo, n): distinct phrases of the task under their trigger, and
    repeats within the task under their document."""
    names = ["route", "repeat", "digest", "doc", "lo", "n"]

    def flush(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        if not held:
            return
        trigger, digest, doc, lo, n = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((lo, doc, digest, trigger))
        trigger, digest, doc, lo, n = (x[order] for x in (trigger, digest, doc, lo, n))
        again = np.r_[False, (trigger[1:] == trigger[:-1]) & (digest[1:] == digest[:-1])]
        route = np.where(again, doc, trigger.view(np.int64))
        columns = [pa.array(route), pa.array(again), pa.array(digest.view(np.int64)), pa.array(doc), pa.array(lo), pa.array(n)]
        whole = pa.RecordBatch.from_arrays(columns, names)
        for at in range(0, whole.num_rows, 1 << 16):
            yield whole.slice(at, 1 << 16)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            for doc, text in zip(b.column("doc").to_pylist(), b.column("text")):
                trigger, digest, lo, n = phrases(np.frombuffer(text.as_py().encode(), dtype=np.uint8), length)
                if len(lo):
                    held.append((trigger, digest, np.full(len(lo), doc), lo, n))
                    size += len(lo)
                if size >= AT_ONCE:
                    yield from flush(held)
                    held, size = [], 0
        yield from flush(held)

    return docs.select("doc", "text").mapInArrow(run, "route bigint, repeat boolean, digest bigint, doc bigint, lo bigint, n bigint")


def _mark(doc, lo, n, trigger=None) -> pa.RecordBatch:
    trigger = pa.nulls(len(doc), pa.int64()) if trigger is None else pa.array(trigger, pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(lo, pa.int64()), pa.array(n, pa.int64()), trigger], ["doc", "lo", "n", "trigger"])


def _dictionary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by (trigger, digest, doc, lo) -> repeats (trigger null), and the entries of triggers that
    have several. Only the last entry is held back."""
    last = None  # the entry so far last: (trigger, digest, doc, lo, n, whether it shares its trigger)
    for b in batches:
        columns = {c: b.column(c).to_numpy(zero_copy_only=False) for c in b.schema.names}
        again = columns["repeat"].astype(bool)
        if again.any():
            yield _mark(*(columns[c][again] for c in ("doc", "lo", "n")))
        trigger, digest, doc, lo, n = (columns[c][~again] for c in ("route", "digest", "doc", "lo", "n"))
        if not len(doc):
            continue
        if last is not None:
            trigger, digest, doc, lo, n = (np.r_[v, x] for v, x in zip(last, (trigger, digest, doc, lo, n)))
        entry = np.r_[True, (trigger[1:] != trigger[:-1]) | (digest[1:] != digest[:-1])]
        if not entry.all():
            yield _mark(doc[~entry], lo[~entry], n[~entry])
        trigger, digest, doc, lo, n = (x[entry] for x in (trigger, digest, doc, lo, n))
        next_same = np.r_[trigger[1:] == trigger[:-1], False]
        shares = next_same | np.r_[last is not None and last[5], next_same[:-1]]
        done = shares.copy()
        done[-1] = False
        if done.any():
            yield _mark(doc[done], lo[done], n[done], trigger[done])
        last = (trigger[-1], digest[-1], doc[-1], lo[-1], n[-1], bool(shares[-1]))
    if last is not None and last[5]:
        yield _mark(*(np.array([x]) for x in (last[2], last[3], last[4], last[0])))


def _packed(docs: DataFrame) -> DataFrame:
    """(doc, z): the texts, compressed for the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for b in slices(batches):
            z = pa.array([pack(t.as_py().encode()) for t in b.column("text")], pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], z], [*b.schema.names[:-1], "z"])

    return docs.select("doc", "id", "text").mapInArrow(run, "doc bigint, id bigint, z binary")


def _entries(length: int):
    """Documents with their ambiguous entries -> (route, doc, lo, bytes); entries of crowded triggers window
    by window, each distinct window of the batch once, its repeats marked (bytes null)."""
    names = ["route", "doc", "lo", "raw"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for b in batches:
            out: list[tuple] = []
            alone: list[tuple] = []
            for doc, z, entries in zip(b.column("doc").to_pylist(), b.column("z"), b.column("entries").to_pylist()):
                raw = unpack(z.as_py())
                for e in entries:
                    lo, n = e["lo"], e["n"]
                    if e["crowded"]:
                        alone += [(raw[i : i + length], doc, i) for i in range(lo, lo + n)]
                    else:
                        out.append((e["trigger"], doc, lo, raw[lo : lo + n + length - 1]))
            alone.sort()
            before = None
            for window, doc, lo in alone:
                route = xxhash.xxh64_intdigest(window) - (1 << 63)
                out.append((route, doc, lo, None if window == before else window))
                before = window
            for at in range(0, len(out), 1 << 14):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out[at : at + (1 << 14)]), (pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                    names,
                )

    return run


def _resolved(length: int):
    """Entries by (route, doc, lo) -> marks of the windows that repeat an earlier one of their route."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        route, doc, lo, raw, size = [], [], [], [], 0
        for b in batches:
            for r, d, at, t in zip(*(b.column(c).to_pylist() for c in ("route", "doc", "lo", "raw"))):
                if t is None:
                    yield _mark([d], [at], [1])
                    continue
                if size >= WINDOWS and r != route[-1]:
                    yield from _sorted_windows(route, doc, lo, raw, length)
                    route, doc, lo, raw, size = [], [], [], [], 0
                route.append(r), doc.append(d), lo.append(at), raw.append(t)
                size += len(t) - length + 1
        yield from _sorted_windows(route, doc, lo, raw, length)

    return run


def _sorted_windows(route, doc, lo, raw, length) -> Iterator[pa.RecordBatch]:
    if not raw:
        return
    docs, starts, sizes = [], [], []
    for i, at in enumerate(repeated_windows(raw, np.array(route), length)):
        if len(at):
            first = np.flatnonzero(np.r_[True, at[1:] != at[:-1] + 1])
            docs += [doc[i]] * len(first)
            starts += (at[first] + lo[i]).tolist()
            sizes += np.diff(np.r_[first, len(at)]).tolist()
    if docs:
        yield _mark(docs, starts, sizes)


def marks(docs: DataFrame, length: int = LENGTH, crowd: int = CROWD) -> tuple[DataFrame, DataFrame]:
    """(packed texts, marks): marked window starts lo..lo+n-1 repeat an earlier window."""
    parsed = _parsed(docs, length)
    ordered = parsed.repartition("route").sortWithinPartitions("route", "digest", "doc", "lo")
    found = settle(ordered.mapInArrow(_dictionary, _MARK), "marks")
    ambiguous = found.where(F.col("trigger").isNotNull())
    crowds = ambiguous.groupBy("trigger").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > crowd)
    crowds = settle(crowds.select("trigger", F.lit(True).alias("crowded")), "crowds")
    entry = F.struct("lo", "n", "trigger", F.coalesce("crowded", F.lit(False)).alias("crowded"))
    per_doc = ambiguous.join(crowds, "trigger", "left").groupBy("doc").agg(F.collect_list(entry).alias("entries"))
    packed = _packed(docs)
    dealt = packed.join(per_doc, "doc").select("doc", "z", "entries").mapInArrow(
        _entries(length), "route bigint, doc bigint, lo bigint, raw binary"
    )
    sorted_ = dealt.repartition("route").sortWithinPartitions("route", "doc", "lo")
    more = settle(sorted_.mapInArrow(_resolved(length), _MARK), "windows")
    return packed, found.where(F.col("trigger").isNull()).union(more).select("doc", "lo", "n")


def covered(lo: np.ndarray, n: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Maximal byte ranges under marked windows; ranges that touch are one."""
    order = np.argsort(lo, kind="stable")
    out: list[list[int]] = []
    for s, e in zip(lo[order].tolist(), (lo + n + length - 1)[order].tolist()):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, crowd: int = CROWD) -> DataFrame:
    """One row per document: id, n_bytes, spans (start, end of the removed byte ranges), kept (the rest).

    A byte goes if a string of ``length`` bytes over it also starts earlier, in a document of smaller id or
    earlier in its own; strings are judged on the input. Null texts count as empty; texts shorter than
    ``length`` stay. Equal ids are ordered by their rows' places, null ids come last. Phrases are told
    apart by 128 bits of hash (trigger and content), windows in part equal by their bytes.
    """
    if length <= 2 * GRAM:
        raise ValueError("length must exceed twice the trigger's gram")
    rows = numbered(docs, id_col, text_col)
    packed, marked = marks(rows, length, crowd)
    per_doc = marked.groupBy("doc").agg(F.collect_list(F.struct("lo", "n")).alias("marks"))
    names = ["id", "n_bytes", "spans", "kept"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for b in slices(batches):
            sizes, spans, kept = [], [], []
            for z, found in zip(b.column("z"), b.column("marks")):
                raw, ranges = unpack(z.as_py()), []
                if found.is_valid:
                    inner = found.values
                    ranges = covered(inner.field("lo").to_numpy(), inner.field("n").to_numpy(), length)
                at, rest = 0, []
                for s, e in ranges:
                    rest.append(raw[at:s])
                    at = e
                sizes.append(len(raw)), spans.append([{"start": s, "end": e} for s, e in ranges]), kept.append(b"".join([*rest, raw[at:]]))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(sizes, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())], names)

    both = packed.join(per_doc, "doc", "left").select("id", "z", "marks")
    return both.mapInArrow(cut, "id bigint, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept binary")
