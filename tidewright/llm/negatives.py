"""Hard negatives by slots of scores.

A positive with score p asks for negatives between two shares of p. The upper limits of an anchor's
positives split the scores into disjoint slots; each negative belongs to one slot, and only the best k of a slot
can appear in any answer. Tasks keep the best k per slot of what they saw, their results are
combined per slot, and merging the slots from the lowest upwards gives for every positive the best k below
its upper limit, from which its lower limit cuts the tail.

Anchors meet all rows in a grid: anchors in blocks, rows in chunks, both of bounded size; a task
holds one of each and one slice of their scores. Positives are searched within their label only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import attach, scalar_row
from ..session import settle
from .common import FILE, LOCATOR, ROW, located, partitions

BLOCK = CHUNK = 1 << 14  # anchors and rows of a task's group
SMALL_CHUNK = 1 << 12  # chunks aren't cut smaller to give every task some
SLICE = 256  # anchors scored at a time
LOW, NO_ID = -(2**63), 2**63 - 1

ANCHOR = ["_a_file", "_a_row"]
HIT = "score bigint, id bigint, _at_file string, _at_row bigint"


def whole_steps(vec: str, scale: int = 256) -> Column:
    """floor(scale * x) of every component, saturating at the 64-bit range."""
    return F.transform(vec, lambda x: F.floor(x.cast("double") * scale))


def usable(vec: str) -> Column:
    """True where the vector and all its components are there and finite."""
    return F.coalesce(F.forall(vec, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf"))), F.lit(False))


def _stacked(vectors: pd.Series) -> np.ndarray:
    """Vectors as a matrix; shorter ones count as ended by zeros."""
    wide = max(map(len, vectors), default=0)
    out = np.zeros((len(vectors), wide), dtype=np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows; beyond 64 bits they saturate (above the lowest value, which
    marks what is left out)."""
    d = min(a.shape[1], b.shape[1])
    a, b = a[:, :d], b[:, :d]
    reach = d * float(np.abs(a.astype(float)).max(initial=0)) * float(np.abs(b.astype(float)).max(initial=0))
    if reach < 2.0**52:
        return (a.astype(float) @ b.T.astype(float)).astype(np.int64)
    if reach < 2.0**62:
        return a @ b.T
    return np.clip(a.astype(object) @ b.T.astype(object), LOW + 1, 2**63 - 1).astype(np.int64)


def best(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k highest scores of each row; ties go to the smaller column, LOW is out."""
    keep = scores > LOW
    if scores.shape[1] > k:
        kth = np.partition(scores, scores.shape[1] - k, axis=1)[:, -k]
        keep &= scores >= kth[:, None]
    r, c = np.nonzero(keep)
    order = np.lexsort((c, -scores[r, c], r))
    r, c = r[order], c[order]
    nth = np.arange(len(r)) - np.searchsorted(r, r)
    return r[nth < k], c[nth < k]


def _pieces(n: Column, size: int) -> Column:
    return F.greatest(F.lit(1), F.ceil(n / F.lit(size))).cast("bigint")


def _grid(anchors: DataFrame, rows: DataFrame, by: list[str], score: Callable, schema: str) -> DataFrame:
    """``score`` (an anchor block, a row chunk) for all pairs of both that agree in ``by``."""
    spare = partitions(rows.sparkSession)
    n, m = F.count(F.lit(1)), F.col("_n_rows")
    sizes = rows.groupBy(*by).agg(n.alias("_n_rows"))
    asked = anchors.groupBy(*by).agg(n.alias("_n_anchors"))
    sizes = sizes.join(asked, by) if by else sizes.withColumn("_n_anchors", scalar_row(asked)["_n_anchors"])
    chunks = F.greatest(_pieces(m, CHUNK), F.least(F.lit(spare).cast("bigint"), _pieces(m, SMALL_CHUNK)))
    sizes = settle(sizes.select(*by, _pieces(F.col("_n_anchors"), BLOCK).alias("_blocks"), chunks.alias("_chunks")), "sizes")

    def dealt(df: DataFrame, file: str, row: str, own: str, other: str) -> DataFrame:
        """Each row in its own piece, once for every piece of the other side; labels without anchors go."""
        here = F.pmod(F.xxhash64(file, row), F.col(f"_{own}s"))
        every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(f"_{other}s") - 1))
        sized = attach(df, sizes, by).where(F.col("_blocks").isNotNull())
        return sized.withColumns({f"_{own}": here, f"_{other}": every}).drop("_blocks", "_chunks")

    keys = [*by, "_block", "_chunk"]
    left = dealt(anchors, *ANCHOR, "block", "chunk").groupBy(*keys)
    right = dealt(rows, FILE, ROW, "chunk", "block").groupBy(*keys)
    return left.cogroup(right).applyInPandas(score, schema)


def _scored(left: pd.DataFrame, right: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, pd.DataFrame, np.ndarray]]:
    """Slices of anchors, the chunk in the order that decides ties, and their scores."""
    right = right.sort_values(["id", FILE, ROW])
    b = _stacked(right["q"])
    for at in range(0, len(left) if len(right) else 0, SLICE):
        some = left.iloc[at : at + SLICE]
        yield some, right, products(_stacked(some["q"]), b)


def _hits(some: pd.DataFrame, right: pd.DataFrame, s: np.ndarray, k: int) -> pd.DataFrame:
    r, c = best(s, k)
    found = right.iloc[c]
    out = {a: some[a].to_numpy()[r] for a in ANCHOR} | {"score": s[r, c]}
    return pd.DataFrame(out | {x: found[x].array for x in ("id", FILE, ROW)})


def _together(parts: list[pd.DataFrame], names: list[str]) -> pd.DataFrame:
    return pd.concat(parts)[names] if parts else pd.DataFrame(columns=names)


def _first(hits: DataFrame, by: list[str], k: int) -> DataFrame:
    """The best k of each group; the limit acts before the shuffle as well."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "id", FILE, ROW)
    return hits.withColumn("_nth", F.row_number().over(order)).where(F.col("_nth") <= k)


def positives(anchors: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """The k best other rows of the anchor's label, in order, as array ``pos`` of (nth, id, score)."""

    def score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for some, chunk, s in _scored(left, right):
            own = (some["_a_row"].to_numpy()[:, None] == chunk[ROW].to_numpy()) & (
                some["_a_file"].to_numpy()[:, None] == chunk[FILE].to_numpy()
            )
            parts.append(_hits(some, chunk, np.where(own, LOW, s), k))
        return _together(parts, [*ANCHOR, "score", "id", FILE, ROW])

    hits = _grid(anchors, rows, ["label"], score, f"_a_file string, _a_row bigint, {HIT}")
    found = F.sort_array(F.collect_list(F.struct(F.col("_nth").alias("nth"), "id", "score")))
    return _first(hits, ANCHOR, k).groupBy(*ANCHOR).agg(found.alias("pos"))


def mine(
    rows: DataFrame, anchor: Column, n_positives: int = 5, k: int = 10, low: int = 30, high: int = 90,
) -> DataFrame:
    """Hard negatives of the rows where ``anchor`` holds.

    ``rows``: id (bigint), label, q (array of bigint). Returned per anchor and positive: the best ``k``
    rows of another label with low * positive_score <= 100 * score <= high * positive_score, as
    anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    A row is named by file and row number, so repeated ids and repeated rows are rows of their own; null
    ids (as which 2^63 - 1 counts) come last among ties. Rows with a null label or null q take no part. Vectors of unequal length are
    compared over the shorter one. Anchors without a positive or negative, and empty tables, give no row.
    Other columns of any name are ignored. Products beyond 64 bits saturate.
    """
    rows = located(rows).where(F.col("label").isNotNull() & F.col("q").isNotNull())
    ident = F.coalesce(F.col("id").cast("bigint"), F.lit(NO_ID))
    rows = rows.select(*LOCATOR, ident.alias("id"), "label", "q", anchor.alias("_anchor"))
    rows = settle(rows, "vectors")
    place = [F.col(FILE).alias("_a_file"), F.col(ROW).alias("_a_row")]
    anchors = settle(rows.where("_anchor").select(*place, "id", "label", "q"), "anchors")
    rows = rows.drop("_anchor")
    near = positives(anchors, rows, n_positives)
    # Half-open slots (upper of the next, upper]; a slot's scores below its own positive's lower limit serve nobody.
    upper = F.transform("pos", lambda p: F.floor(p["score"].cast("decimal(38,0)") * high / 100).cast("bigint"))
    lower = F.transform("pos", lambda p: F.ceil(p["score"].cast("decimal(38,0)") * low / 100).cast("bigint"))
    asked = settle(anchors.join(near, ANCHOR).select("*", upper.alias("upper"), lower.alias("lower")), "anchors")

    def score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        parts = []
        label = None
        for some, chunk, s in _scored(left, right):
            label = chunk["label"].to_numpy() if label is None else label
            other = some["label"].to_numpy()[:, None] != label
            up = np.full((len(some), n_positives + 1), LOW)
            least = np.full((len(some), n_positives), 2**63 - 1)
            for i, (u, lo) in enumerate(zip(some["upper"], some["lower"])):
                up[i, : len(u)], least[i, : len(lo)] = u, lo
            for slot in range(n_positives):
                inside = other & (s <= up[:, slot, None]) & (s > up[:, slot + 1, None]) & (s >= least[:, slot, None])
                if inside.any():
                    parts.append(_hits(some, chunk, np.where(inside, s, LOW), k).assign(slot=slot))
        return _together(parts, [*ANCHOR, "slot", "score", "id", FILE, ROW])

    hits = _grid(asked.drop("id", "pos"), rows, [], score, f"_a_file string, _a_row bigint, slot int, {HIT}")
    kept = _first(hits, [*ANCHOR, "slot"], k)
    entry = F.struct("slot", F.col("_nth").alias("nth"), "score", F.nullif("id", F.lit(NO_ID)).alias("id"))
    slots = kept.groupBy(*ANCHOR).agg(F.sort_array(F.collect_list(entry)).alias("slots"))  # at most k a slot
    both = asked.select(*ANCHOR, F.col("id").alias("anchor_id"), "pos", "lower").join(slots, ANCHOR)

    def merged(below: Column, slot: Column) -> Column:
        """A slot's entries come before all those of the slots below it."""
        own = F.filter("slots", lambda e: e["slot"] == slot)
        return F.concat(below, F.array(F.slice(F.concat(own, F.element_at(below, -1)), 1, k)))

    nothing = F.array(F.filter("slots", lambda e: F.lit(False)))
    suffixes = F.aggregate(F.sequence(F.size("pos") - 1, F.lit(0)), nothing, merged)  # of the last slot first
    each = both.withColumn("suffixes", suffixes).select("anchor_id", "lower", "suffixes", F.posexplode("pos").alias("j", "p"))
    least = F.element_at("lower", F.col("j") + 1)
    own = F.filter(F.element_at("suffixes", -F.col("j") - 1), lambda e: e["score"] >= least)
    return each.select("anchor_id", "p", F.posexplode(own).alias("i", "e")).select(
        "anchor_id", F.nullif(F.col("p.id"), F.lit(NO_ID)).alias("positive_id"), (F.col("i") + 1).alias("rank"),
        F.col("e.id").alias("negative_id"), F.col("p.score").alias("positive_score"), F.col("e.score").alias("negative_score"),
    )
