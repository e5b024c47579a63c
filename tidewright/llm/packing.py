"""Best-fit packing of token sequences by linear grouping.

Lengths above ``LARGE`` of the capacity are cut, in descending order, into ``GROUPS`` groups of equal
cardinality and rounded up to their group's largest. Configurations over these few sizes are built
largest size first, each filled as full as a bounded knapsack allows and used as often as the counts
permit. Actual documents then take the places of their groups, and the small ones go best-fit, longest
first, into what is really left.

The driver sees histograms only (at most ``capacity`` counts) and the plan made from them, whose size
depends on capacity and group count, not on the documents. Documents find their places by their rank
within a length or a group.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.ordered import positions
from ..session import settle
from .common import FILE, LOCATOR, located, slices, whole_text
from .tokens import word_cache

CAPACITY, GROUPS, LARGE = 2048, 512, 1 / 4


def pieces(docs: DataFrame, vocab: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Every document's ids, closed by id 0, cut into pieces of at most ``capacity``."""
    rows = located(docs).select(*LOCATOR, F.col(id_col).cast("bigint").alias("doc_id"), whole_text(text_col).alias("text"))
    names = [*LOCATOR, "doc_id", "piece", "start", "length", "ids_crc32"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_cache(vocab)
        encode = words.encode
        for b in slices(batches):
            own, number, length, crc = [], [], [], []
            for i, text in enumerate(b.column("text")):
                ids = encode(text.as_py()) + b"\0\0\0\0"
                for n, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    own.append(i), number.append(n), length.append(len(part) // 4), crc.append(zlib.crc32(part))
            number = np.array(number, dtype=np.int64)
            taken = pa.array(own, pa.int64())
            columns = [b.column(c).take(taken) for c in range(3)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(number.astype(np.int32)), pa.array(number * capacity), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names,
            )
        words.clear()  # the worker lives on for other tasks

    kinds = ["string", "bigint", "bigint", "int", "bigint", "bigint", "bigint"]
    return rows.mapInArrow(cut, ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))


def _fullest(room: int, sizes: list[int], counts: list[int]) -> dict[int, int]:
    """Bounded knapsack: how many of each size fill ``room`` best. Larger sizes are tried first."""
    last = np.full(room + 1, -1)  # the size that first reached a sum
    reached = np.zeros(room + 1, dtype=bool)
    reached[0] = True
    for g, size in enumerate(sizes):
        for _ in range(min(counts[g], room // size)):
            new = np.flatnonzero(reached[: room + 1 - size] & ~reached[size:]) + size
            if not len(new):
                break
            reached[new], last[new] = True, g
        if reached[room]:
            break
    at, used = int(np.flatnonzero(reached)[-1]), {}
    while at:
        g = int(last[at])
        used[g] = used.get(g, 0) + 1
        at -= sizes[g]
    return used


def configurations(sizes: list[int], counts: list[int], capacity: int) -> list[tuple[list[int], int]]:
    """(groups in a sequence, number of such sequences); sizes descend."""
    counts, out = list(counts), []
    for g in range(len(sizes)):
        while counts[g]:
            counts[g] -= 1
            used = _fullest(capacity - sizes[g], sizes, counts)
            counts[g] += 1
            used[g] = used.get(g, 0) + 1
            times = min(counts[k] // c for k, c in used.items())
            for k, c in used.items():
                counts[k] -= c * times
            out.append(([k for k in sorted(used) for _ in range(used[k])], times))
    return out


def rounded_sizes(histogram: dict[int, int], step: int) -> list[tuple[int, int]]:
    """Linear grouping: descending lengths in groups of ``step``, each with its largest length and
    its cardinality."""
    out, at, total = [], 0, sum(histogram.values())
    for length in sorted(histogram, reverse=True):
        end = at + histogram[length]
        while len(out) * step < end:
            out.append((length, min(step, total - len(out) * step)))
        at = end
    return out


def best_fit(room: dict[int, int], small: dict[int, int], capacity: int, new_from: int) -> tuple[list[tuple], int]:
    """Best-fit decreasing on histograms: ``room`` (left -> sequences), ``small`` (length -> documents).

    Returns slots (length, first document, end, class, first sequence of the class, order) and the
    number of new sequences, which form the class ``new_from``.
    """
    parts = sorted((left, left, 0, n, 0) for left, n in room.items() if n)
    slots, opened = [], 0
    for length in sorted(small, reverse=True):
        first, n = 0, small[length]
        while n:
            k = bisect_left(parts, (length,))
            if k == len(parts):
                more = -(-n // (capacity // length))
                insort(parts, (capacity, new_from, opened, opened + more, 0))
                opened += more
                continue
            left, cls, lo, hi, order = parts.pop(k)
            each = left // length  # the sequence that an item fits best still fits best afterwards
            full = min(hi - lo, n // each)
            for times, wide in ((each, full), (n - each * full, int(full < hi - lo and n > each * full))):
                if wide:
                    for i in range(times):
                        slots.append((length, first, first + wide, cls, lo, order + i))
                        first, n = first + wide, n - wide
                    insort(parts, (left - times * length, cls, lo, lo + wide, order + times))
                    lo += wide
            if lo < hi:
                insort(parts, (left, cls, lo, hi, order))
    return slots, opened


def _ranked(df: DataFrame, key: str, out: str) -> DataFrame:
    """0-based rank within ``key``; counts per file carry the ranks over files."""
    done = positions(df, [key], [*LOCATOR, "piece"], [F.col(FILE)], out)
    return done.withColumn(out, F.col(out) - 1)


def _histogram(df: DataFrame, column: str) -> dict[int, int]:
    return {r[0]: r[1] for r in df.groupBy(column).agg(F.count(F.lit(1))).collect()}


def pack(cut: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS, large: float = LARGE) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; every sequence is gapless from 0."""
    spark = cut.sparkSession
    cut = settle(cut, "pieces")
    histogram = _histogram(cut, "length")
    limit = int(capacity * large)
    big = {n: c for n, c in histogram.items() if n > limit}
    small = {n: c for n, c in histogram.items() if n <= limit}
    ranked = settle(_ranked(cut, "length", "rank"), "ranked")

    step = max(1, -(-sum(big.values()) // groups))
    sizes = rounded_sizes(big, step)
    places, taken, base = [], [0] * len(sizes), 0
    for members, times in configurations([n for n, _ in sizes], [c for _, c in sizes], capacity):
        for order, g in enumerate(members):
            places.append((g, taken[g], taken[g] + times, base, order))
            taken[g] += times
        base += times
    longer = [(n, sum(c for m, c in big.items() if m > n)) for n in big]
    first = F.broadcast(spark.createDataFrame(longer, "length bigint, longer bigint"))
    place = F.broadcast(spark.createDataFrame(places, "g bigint, lo bigint, hi bigint, base bigint, slot int"))
    nth = F.col("longer") + F.col("rank")
    grouped = ranked.join(first, "length").withColumns({"g": F.expr(f"(longer + rank) div {step}"), "i": nth % step})
    here = (grouped["g"] == place["g"]) & (F.col("i") >= F.col("lo")) & (F.col("i") < F.col("hi"))
    placed = grouped.join(place, here).select(*cut.columns, (F.col("base") + F.col("i") - F.col("lo")).alias("sequence_id"), "slot")
    placed = settle(placed, "placed")

    filled = placed.groupBy("sequence_id").agg((F.lit(capacity) - F.sum("length")).alias("left"))
    filled = settle(filled, "filled")
    room = _histogram(filled, "left")
    by_id = Window.partitionBy("left", "cell").orderBy("sequence_id")
    cells = filled.withColumn("cell", F.shiftright("sequence_id", 16))
    count = cells.groupBy("left", "cell").agg(F.count(F.lit(1)).alias("n"))
    ahead = F.coalesce(F.sum("n").over(Window.partitionBy("left").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bins = cells.withColumn("nth", F.row_number().over(by_id)).join(count.select("left", "cell", ahead.alias("ahead")), ["left", "cell"])
    bins = bins.select("sequence_id", "left", (F.col("nth") - 1 + F.col("ahead")).alias("nth"))

    fits, opened = best_fit(room, small, capacity, capacity + 1)
    fit = spark.createDataFrame(fits, "length bigint, lo bigint, hi bigint, left bigint, first bigint, slot int")
    match = (F.col("r.length") == F.col("f.length")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi"))
    rest = ranked.where(F.col("length") <= limit).alias("r").join(F.broadcast(fit.alias("f")), match).select(
        *[F.col(f"r.{c}") for c in cut.columns], "left", (F.col("first") + F.col("rank") - F.col("lo")).alias("nth"), (F.col("slot") + capacity).alias("slot")
    )
    fresh = rest.where(F.col("left") > capacity).select(*cut.columns, (F.col("nth") + base).alias("sequence_id"), "slot")
    added = rest.where(F.col("left") <= capacity).join(bins, ["left", "nth"]).select(*cut.columns, "sequence_id", "slot")
    everything = placed.union(added).union(fresh)
    inside = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    return everything.withColumn("offset", F.coalesce(F.sum("length").over(inside), F.lit(0))).drop("slot")

