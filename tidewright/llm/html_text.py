"""Main text of web pages with removal of site templates.

Subtrees of every page are hashed and counted per host in Spark by the number of different articles
around them. A subtree that recurs around many articles of its host is template and is deleted; then
what remains of menus, headers, footers, sidebars, notices, adverts, forms and reader comments goes
by its elements and class words, and the rest is the text.

Copies of an article count once: pages are told apart by the text runs that don't recur on their host. Where
less than ``OWN_WORDS`` words and a tenth of the page are left (a date, a counter) the page counts as a
copy, told apart by its longest text. The count that makes a template doesn't grow with the host.
Inside an article paragraphs and headings are template only if they recur around ``SHARE`` of the different
articles of their host or of their section (the first folder of the address), by the lower end of the
share's Wilson interval: a passage that is repeated here and there stays, as does one on few pages.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import zip_longest

import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import settle
from .common import LOCATOR, located, slices, whole_text
from .html_tree import Element, containers, digest_subtrees, parse, text_of
from .pii import Z, wilson

PAGES, OWN_WORDS, SHARE = 5, 12, 0.8
_FRAME = frozenset("#page html head body br hr meta link title".split())
_NO_TEXT = frozenset("script style title".split())
_INLINE = frozenset("b i em strong span a code".split())
_PROSE = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre td th dd dt b i em strong span a br code".split())


def candidates(root: Element) -> tuple[int, int, dict[int, int], dict[int, bool]]:
    """Hashes of the text and of the longest text run of the article (of the page if it has none), the
    runs' hashes with their numbers of words, and the subtrees that may be template (true: prose of an article)."""
    inside = {id(c) for c in containers(root)}
    found: dict[int, bool] = {}
    runs: dict[int, int] = {}
    whole = xxhash.xxh64()
    longest, key = 0, 0
    todo = [(root, False, False)]
    while todo:
        e, article, sentence = todo.pop()
        article = article or id(e) in inside
        words = "".join(c for c in e.children if isinstance(c, str)).split()
        if words and e.tag not in _NO_TEXT and (article or not inside):
            own = " ".join(words)
            whole.update(own.encode() + b"\0")
            run = xxhash.xxh64_intdigest(own)
            runs[run] = len(words)
            if len(own) > longest:
                longest, key = len(own), run
        within = bool(words) and e.tag in _PROSE or sentence and e.tag in _INLINE
        todo.extend((c, article, within) for c in e.children if not isinstance(c, str))
        part = sentence and e.tag in _INLINE  # a word of a sentence is no template
        if e.tag not in _FRAME and not part and id(e) not in inside:
            prose = article and e.tag in _PROSE
            if e.size or not prose:
                found[e.digest] = found.get(e.digest, True) and prose
    return whole.intdigest(), key, runs, found


def main_text(page: str, dropped: set[int]) -> str:
    root = parse(page)
    digest_subtrees(root)
    parts = containers(root)
    return text_of(parts or [root], dropped, bool(parts))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def subtrees(pages: DataFrame) -> DataFrame:
    """(locator, host, section, page, longest, run, words, digest, prose): side by side, the distinct text runs of each page and
    its distinct subtrees that may be template; the shorter list ends in nulls."""
    names = [*LOCATOR, "host", "section", "page", "longest", "run", "words", "digest", "prose"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            at, rows = [], []
            for i, page in enumerate(b.column("html")):
                root = parse(page.as_py())
                digest_subtrees(root)
                whole, longest, runs, found = candidates(root)
                texts = sorted((_signed(r), n) for r, n in runs.items())
                trees = sorted((_signed(d), prose) for d, prose in found.items())
                for text, tree in zip_longest(texts, trees, fillvalue=(None, None)):
                    rows.append((_signed(whole), _signed(longest), *text, *tree))
                at += [i] * (len(rows) - len(at))
            taken = pa.array(at, pa.int64())
            cols = [b.column(c).take(taken) for c in names[:4]]
            made = [pa.array([r[k] for r in rows], pa.bool_() if k == 5 else pa.int64()) for k in range(6)]
            yield pa.RecordBatch.from_arrays([*cols, *made], names)

    kinds = ["string", "bigint", "string", "string", *["bigint"] * 5, "boolean"]
    return pages.select(*LOCATOR, "host", "section", "html").mapInArrow(run, ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))


def articles(found: DataFrame, pages_least: int = PAGES) -> DataFrame:
    """(locator, host, section, article): what tells the article of each page from others of its host."""
    runs = found.where("run is not null").select(*LOCATOR, "host", "section", "page", "longest", "run", "words")
    often = runs.select("host", "run", "page").distinct().groupBy("host", "run").agg(F.count(F.lit(1)).alias("n"))
    often = often.where(F.col("n") >= pages_least).select("host", "run", F.lit(True).alias("often"))
    own = F.col("often").isNull()
    left = F.sum(F.when(own, F.col("words")).otherwise(0))
    key = F.when((left >= OWN_WORDS) | (left * 10 >= F.sum("words")), F.bit_xor(F.when(own, F.col("run"))))
    both = runs.join(settle(often, "runs"), ["host", "run"], "left")
    return both.groupBy(*LOCATOR, "host", "section").agg(F.coalesce(key, F.max("longest")).alias("article"))


def _scopes(prose: Column) -> Column:
    """Where a subtree is counted: on its host, as prose in its section too."""
    section = F.concat("host", F.lit("/"), "section")
    return F.explode(F.when(prose, F.array("host", section)).otherwise(F.array("host")))


def templates(found: DataFrame, keys: DataFrame, pages_least: int = PAGES, share: float = SHARE) -> DataFrame:
    """(scope, digest, prose) of the subtrees that recur around at least ``pages_least`` different articles
    of their host; of prose, those around ``share`` of the articles of their host or section."""
    held = keys.select(_scopes(F.lit(True)).alias("scope"), "article").distinct().groupBy("scope").agg(F.count(F.lit(1)).alias("articles"))
    seen = found.where("digest is not null").select(*LOCATOR, "host", "section", "digest", "prose")
    seen = seen.join(keys.drop("host", "section"), LOCATOR).select(_scopes(F.col("prose")).alias("scope"), "digest", "prose", "article")
    counts = seen.distinct().groupBy("scope", "digest", "prose").agg(F.count(F.lit(1)).alias("n"))
    least = F.when(F.col("prose"), Z * Z * share / (1 - share) * (1 - 1e-9)).otherwise(0)  # fewer can't reach the share
    counts = settle(counts.where((F.col("n") >= pages_least) & (F.col("n") >= least)), "counts")
    often = counts.where("prose").join(held, "scope")
    often = often.where(wilson(F.col("n") / F.col("articles"), F.col("articles").cast("double")) >= share)
    return counts.where("not prose").drop("n").unionByName(often.select("scope", "digest", "prose"))


def host_of(url: Column) -> Column:
    """Lower-case host of an address; addresses without one share the empty host."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def section_of(url: Column) -> Column:
    """The first folder of an address, empty if the page lies in none."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]+)/", 1)


def main_texts(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    pages_least: int = PAGES, share: float = SHARE,
) -> DataFrame:
    """One row per page: locator, page_id, url, text (empty if there is none).

    Null html counts as empty; a null or malformed address belongs to the host without a name.
    Repeated rows are all returned; an empty table gives an empty result.
    """
    rows = located(pages).select(
        *LOCATOR, F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
        host_of(F.col(url_col)).alias("host"), section_of(F.col(url_col)).alias("section"), whole_text(html_col).alias("html"),
    )
    found = settle(subtrees(rows), "subtrees")
    keys = settle(articles(found, pages_least), "articles")
    template = settle(templates(found, keys, pages_least, share), "templates")
    placed = found.where("digest is not null").select(*LOCATOR, _scopes(F.col("prose")).alias("scope"), "digest", "prose")
    dropped = placed.join(template, ["scope", "digest", "prose"]).groupBy(*LOCATOR).agg(F.collect_set("digest").alias("dropped"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for b in slices(batches):
            z = pa.array([pack(h.as_py().encode()) for h in b.column("html")], pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns[:4], z], [*LOCATOR, "page_id", "url", "z"])

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for b in slices(batches):
            texts = []
            for z, gone in zip(b.column("z"), b.column("dropped")):
                digests = {d & (2**64 - 1) for d in gone.as_py() or ()}
                texts.append(main_text(unpack(z.as_py()).decode(), digests))
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(texts, pa.string())], [*LOCATOR, "page_id", "url", "text"])

    page_id, url = (rows.schema[c].dataType.simpleString() for c in ("page_id", "url"))
    place = f"{LOCATOR[0]} string, {LOCATOR[1]} bigint, page_id {page_id}, url {url}"
    small = rows.select(*LOCATOR, "page_id", "url", "html").mapInArrow(packed, f"{place}, z binary")
    both = small.join(dropped, LOCATOR, "left").select(*LOCATOR, "page_id", "url", "z", "dropped")
    return both.mapInArrow(extract, f"{place}, text string")
