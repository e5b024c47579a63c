"""Personal data: patterns for protected entities, and information-theoretic sanitisation of the terms
that reveal them.

Protected entities are the matches of four fixed patterns, each by its value and by the classes it belongs
to: its kind, its mail domain or its number's prefix. A value seen once tells nothing about a term, its
classes recur. How strongly a term t reveals e is estimated from their co-occurrence in whole documents:

    PMI(e, t) = log(N P(e | t) / df(e)),   IC(e) = log(N / df(e)),   disclosure = PMI / IC

For values P(e | t) is df(e, t) / df(t), for pairs seen in at least ``SUPPORT`` different texts. For classes
it is the lower end of the share's Wilson interval (``Z``) with different texts as trials, so that a
few chance meetings reveal nothing. A disclosure of 1 means that t never occurs without e. Terms at
``THRESHOLD`` or more are generalised to ``[TERM]`` wherever they occur; those that never occur without
what they reveal are removed. Entities are generalised to their kind.

Everything is built from DataFrame functions. Words meet their counts and the entities of their document by
equi-joins, counts are combined before each shuffle, so neither a frequent word nor a frequent entity
gathers rows. A pair whose counts alone keep it below the threshold is not formed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import settle
from .common import LOCATOR, located, whole_text

THRESHOLD, SUPPORT, Z = 0.9, 2, 3.09
KINDS = ("email", "ip", "card", "phone")

# A match can only begin where a run of its characters begins or the last match ended, so the
# look-behinds change no match; with possessive repeats they keep the search linear.
_PATTERN = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    back = F.reverse(_digits(value))

    def add(total: Column, i: Column) -> Column:
        digit = F.substr(back, i, F.lit(1)).cast("int")
        twice = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 0, twice).otherwise(digit)

    total = F.aggregate(F.sequence(F.lit(1), F.length(back)), F.lit(0), add)
    return F.when(F.length(back).between(12, 19), total % 10 == 0).otherwise(False)


_VALID = {
    "email": lambda v: F.lit(True),
    "ip": lambda v: v.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"),
    "card": _luhn,
    "phone": lambda v: F.length(_digits(v)).between(9, 15),
}
_VALUE = {"email": F.lower, "ip": lambda v: v, "card": _digits, "phone": _digits}
_PREFIX = {
    "email": lambda v: F.substring_index(v, "@", -1),
    "ip": lambda v: F.substring_index(v, ".", 2),
    "card": lambda v: F.substring(v, 1, 6),
    "phone": lambda v: F.substring(v, 1, 4),
}
_SPAN = "array<struct<start:int,rank:int,kind:string,end:int,value:string>>"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once (a lambda would repeat an expression per element)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running(values: Column, zero: Column, op) -> Column:
    """Running totals of an array, by blocks, so that long arrays don't cost the square of their size."""
    wide = 64

    def joined(blocks: Column) -> Column:
        def after(totals: Column) -> Column:
            def block(b: Column, j: Column) -> Column:
                base = F.aggregate(F.slice(totals, F.lit(1), j), zero, op)
                return _let(base, lambda x: F.transform(b, lambda _, i: op(x, F.aggregate(F.slice(b, F.lit(1), i + 1), zero, op))))

            return F.flatten(F.transform(blocks, block))

        return _let(F.transform(blocks, lambda b: F.aggregate(b, zero, op)), after)

    last = F.floor((F.size(values) - 1) / wide).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), last), lambda j: F.slice(values, j * wide + 1, F.lit(wide)))
    return F.when(F.size(values) > 0, _let(blocks, joined)).otherwise(F.array().cast("array<int>"))


def _cut(text: Column, pattern: Column | str, body) -> Column:
    """``body`` of a pattern's matches in a text and of the pieces around them, which add up to the text."""
    found = F.regexp_extract_all(text, F.lit(pattern) if isinstance(pattern, str) else pattern, F.lit(0))
    both = F.struct(found.alias("found"), F.split(text, pattern, -1).alias("around"))
    return _let(both, lambda p: body(p["found"], p["around"]))


def _matches(text: Column, pattern: Column | str, rank: int, kind: str) -> Column:
    """All matches with their places in code points."""

    def placed(found: Column, around: Column) -> Column:
        sizes = F.zip_with(F.slice(around, F.lit(1), F.size(found)), found, lambda a, m: F.length(a) + F.length(m))
        return F.zip_with(
            _let(sizes, lambda v: _running(v, F.lit(0), lambda x, y: x + y)), found,
            lambda end, m: F.struct(
                (end - F.length(m)).alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), end.alias("end"), m.alias("value")
            ),
        )

    return F.coalesce(_cut(text, pattern, placed), F.array().cast(_SPAN)).cast(_SPAN)


def _guard(text: Column, kind: str) -> Column:
    """A cheap condition that every text with a match meets."""
    if kind == "email":
        return F.contains(text, F.lit("@"))
    digit = text.rlike("[0-9]")
    return digit & F.contains(text, F.lit("+")) if kind == "phone" else digit


def base_spans(text: Column) -> Column:
    """Entities of all kinds in one array ordered by start, then kind."""
    parts = []
    for rank, kind in enumerate(KINDS):
        valid = _VALID[kind]
        spans = F.filter(_matches(text, _PATTERN[kind], rank, kind), lambda s: valid(s["value"]))  # noqa: B023
        parts.append(F.when(_guard(text, kind), spans).otherwise(F.array().cast(_SPAN)))
    return F.array_sort(F.concat(*parts))


def _replaced(text: Column, spans: Column, by) -> Column:
    """``text`` with each span replaced; spans that overlap are replaced as one, by the first."""

    def joined(spans: Column, reach: Column) -> Column:
        def part(s: Column, i: Column) -> Column:
            done = F.coalesce(F.get(reach, i - 1), F.lit(0))
            copied = F.substr(text, done + 1, F.greatest(s["start"] - done, F.lit(0)))
            return F.when(s["start"] >= done, F.concat(copied, by(s))).otherwise("")

        rest = F.substr(text, F.get(reach, F.size(reach) - 1) + 1, F.length(text))
        return F.concat(F.array_join(F.transform(spans, part), ""), rest)

    ends = F.transform(spans, lambda s: s["end"])
    both = F.struct(spans.alias("s"), _let(ends, lambda v: _running(v, F.lit(0), lambda x, y: F.greatest(x, y))).alias("r"))
    return F.when(F.size(spans) > 0, _let(both, lambda p: joined(p["s"], p["r"]))).otherwise(text)


def _words(text: Column) -> Column:
    """Distinct lower-case runs of at least three letters."""
    return F.filter(F.array_distinct(F.split(F.lower(text), r"[^\p{L}]+")), lambda w: F.length(w) >= 3)


def _plain_words(text: Column) -> Column:
    """The words outside e-mail addresses."""
    return _words(F.when(_guard(text, "email"), F.regexp_replace(text, _PATTERN["email"], " ")).otherwise(text))


def _entities(docs: DataFrame) -> DataFrame:
    """(doc, entity, single): the values (``single``) and classes in each document, once."""
    seen = docs.select("doc", F.explode("spans").alias("s")).select("doc", "s.kind", "s.value")
    normal = prefix = F.lit(None).cast("string")
    for kind in KINDS:
        this, value = F.col("kind") == kind, _VALUE[kind](F.col("value"))
        normal = F.when(this, value).otherwise(normal)
        prefix = F.when(this, _PREFIX[kind](value)).otherwise(prefix)

    def held(entity: Column, single: bool) -> Column:
        return F.struct(entity.alias("entity"), F.lit(single).alias("single"))

    named = [held(F.concat("kind", F.lit(":"), normal), True), held(F.concat("kind", F.lit("^"), prefix), False), held(F.col("kind"), False)]
    return seen.select("doc", F.explode(F.array(*named)).alias("e")).select("doc", "e.*").distinct()


def wilson(share: Column, trials: Column) -> Column:
    """Lower end of the Wilson interval of a share."""
    z2 = Z * Z
    half = Z * F.sqrt(share * (1 - share) / trials + z2 / (4 * trials * trials))
    return (share + z2 / (2 * trials) - half) / (1 + z2 / trials)


def disclosing_terms(docs: DataFrame, threshold: float = THRESHOLD, support: int = SUPPORT) -> DataFrame:
    """(term, full): terms that reveal some entity of the corpus; ``docs`` has locator, text, spans."""
    total = float(docs.count())
    holding = docs.where(F.size("spans") > 0).withColumn("doc", F.xxhash64(*LOCATOR))
    # one document stands for all copies of its text
    texts = holding.select("doc", F.xxhash64("text").alias("h")).groupBy("h")
    texts = texts.agg(F.min("doc").alias("doc"), F.count(F.lit(1)).alias("copies")).select("doc", "copies")
    entities = settle(_entities(holding).join(texts, "doc"), "entities")
    of_entity = entities.groupBy("entity", "single").agg(F.sum("copies").alias("n_e"), F.count(F.lit(1)).alias("texts"))
    # P(e | t) has to reach (n_e / N)^(1 - threshold); n_et <= n_e, and for classes the interval ends below n_t / (n_t + Z^2)
    reach = F.pow(F.col("n_e") / total, F.lit(1 - threshold))
    least = F.when(F.col("single"), F.lit(float(support))).otherwise(F.greatest(F.lit(float(support)), Z * Z * reach / (1 - reach) * (1 - 1e-9)))
    of_entity = of_entity.where(F.col("n_e") < total).select("entity", "n_e", "texts", least.alias("least"), (F.col("n_e") / reach * (1 + 1e-9)).alias("most"))
    of_entity = settle(of_entity.where(F.col("texts") >= F.col("least")).drop("texts"), "of_entity")
    lowest, widest = of_entity.agg(F.min("least"), F.max("most")).first()
    words = docs.select(F.explode(_plain_words(F.col("text"))).alias("term"))
    of_term = words.groupBy("term").agg(F.count(F.lit(1)).alias("n_t")).where(F.col("n_t").between(lowest or 0.0, widest or 0.0))
    near = holding.select("doc", F.explode(_plain_words(F.col("text"))).alias("term")).join(of_term, "term")
    held = entities.join(of_entity, "entity")
    pairs = near.join(held, "doc").where(F.col("n_t").between(F.col("least"), F.col("most")))
    counts = pairs.groupBy("entity", "single", "term", "n_e", "n_t").agg(
        F.sum("copies").cast("double").alias("n_et"), F.count(F.lit(1)).alias("texts")
    )
    share = F.col("n_et") / F.col("n_t")
    share = F.when(F.col("single"), share).otherwise(wilson(share, F.col("texts") / share))
    pmi = F.log(F.lit(total) * share / F.col("n_e"))
    rated = counts.where(F.col("texts") >= support).withColumn("disclosure", pmi / F.log(F.lit(total) / F.col("n_e")))
    full = F.max((F.col("n_et") == F.col("n_t")).cast("int")) == 1
    return rated.where(F.col("disclosure") >= threshold).groupBy("term").agg(full.alias("full"))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, support: int = SUPPORT) -> DataFrame:
    """One row per document: locator, id, text, ``spans`` (entities) and ``term_spans`` (terms that
    reveal one), each (start, rank, kind, end, value) in order, code points, end exclusive.

    Null texts count as empty. Repeated rows are all returned; copies count as documents, but a
    pair must be seen in ``support`` different texts. An entity that every document holds
    carries no information and reveals nothing. An empty table gives an empty result.
    """
    rows = located(docs).select(*LOCATOR, F.col(id_col).alias("id"), whole_text(text_col).alias("text"))
    rows = rows.withColumn("spans", base_spans(F.col("text")))
    terms = settle(disclosing_terms(rows, threshold, support), "disclosing")
    words = rows.select(*LOCATOR, F.explode(_words(F.col("text"))).alias("term"))
    marked = words.join(terms, "term").groupBy(*LOCATOR).agg(
        F.sort_array(F.collect_list("term")).alias("terms"),
        F.sort_array(F.collect_list(F.when(F.col("full"), F.col("term")))).alias("full"),
    )
    rows = rows.join(marked, LOCATOR, "left")
    pattern = F.concat(F.lit(r"(?iu)(?<!\p{L})(?:"), F.array_join("terms", "|"), F.lit(r")(?!\p{L})"))
    found = F.filter(
        _matches(F.col("text"), pattern, len(KINDS), "term"),
        lambda t: ~F.exists("spans", lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"])),
    )
    return rows.withColumn(
        "term_spans", F.when(F.col("terms").isNotNull(), found).otherwise(F.array().cast(_SPAN))
    )


def labelled(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with entities and revealing terms in the texts generalised or removed; null texts stay
    null, and ``n_chars``, where there is one, follows the new text."""
    docs = located(docs)
    found = find(docs, id_col, text_col).select(*LOCATOR, "text", "spans", "term_spans", "full")
    spans = F.array_sort(F.concat("spans", "term_spans"))
    full = F.coalesce("full", F.array().cast("array<string>"))

    def by(s: Column) -> Column:
        term = F.when(F.array_contains(full, F.lower(s["value"])), "").otherwise("[TERM]")
        return F.when(s["kind"] == "term", term).otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))

    clean = found.select(*LOCATOR, _replaced(F.col("text"), spans, by).alias("_pii_clean"))
    joined = docs.join(clean, LOCATOR)
    new = F.when(F.col(text_col).isNotNull(), F.col("_pii_clean"))
    columns = {text_col: new}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.length(new).cast(docs.schema["n_chars"].dataType)
    return joined.withColumns(columns).drop("_pii_clean", *LOCATOR)
