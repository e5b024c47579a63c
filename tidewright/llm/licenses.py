"""License scan by a positional index of rare words.

Notices of known licenses are word sequences. The corpus tells how rare each of their words is; each
template is indexed under the rarest words of its mandatory phrase, with their positions. The rarest ones are
looked up in a text, each place proposes a start (place of the word minus its position in the
template), the other postings must agree on the start, and what is left is verified: the whole mandatory
phrase must stand at its place. A text that holds the phrase holds its index words, so none is missed.

The driver holds the templates and one count per template word, a fixed number. The scan itself is one
projection without a shuffle, all in DataFrame functions.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import whole_text

INDEXED = 3

# Notices of well-known licenses and the phrase that each must show.
TEMPLATES = [
    ("agpl", "GNU Affero General Public License", "affero general public license"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0", "apache license version 2 0"),
    ("artistic-2.0", "The Artistic License 2.0", "artistic license 2 0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted", "redistribution and use in source and binary forms"),
    ("bsd", "Released under the BSD License", "bsd license"),
    ("bsl-1.0", "Distributed under the Boost Software License, Version 1.0", "boost software license"),
    ("cc-by-4.0", "Licensed under CC BY 4.0", "cc by 4 0"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0", "cc by nc 4 0"),
    ("cc-by-nd-4.0", "Licensed under CC BY-ND 4.0", "cc by nd 4 0"),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0", "cc by sa 4 0"),
    ("cc0-1.0", "CC0 1.0 Universal Public Domain Dedication", "cc0 1 0 universal"),
    ("creative-commons", "This work is licensed under a Creative Commons Attribution License", "creative commons attribution"),
    ("epl-2.0", "Eclipse Public License Version 2.0", "eclipse public license"),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2", "gnu general public license version 2"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3", "gnu general public license version 3"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee", "permission to use copy modify and or distribute this software"),
    ("lgpl", "GNU Lesser General Public License", "lesser general public license"),
    ("mit", "Released under the MIT License", "mit license"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "permission is hereby granted free of charge"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "mozilla public license v 2 0"),
    ("reserved", "All rights reserved", "all rights reserved"),
    ("unlicense", "This is free and unencumbered software released into the public domain", "free and unencumbered software released into the public domain"),
]
BASE = [("cc-by", "cc by"), ("gpl", "general public license"), ("reserved", "all rights reserved")]

_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lowered(text: Column) -> Column:
    """A-Z in lower case, nothing else. ``lower`` does the same, faster, where all is ASCII."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def words_of(text: Column) -> Column:
    return F.filter(F.split(lowered(text), _BETWEEN), lambda w: w != "")


def _split(notice: str) -> list[str]:
    return [w for w in re.split(_BETWEEN, notice.lower()) if w]


def document_counts(words: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """Number of documents that hold each template word; at most one row per template word."""
    held = words.select(F.explode(F.array_intersect("words", F.array(*map(F.lit, vocabulary)))).alias("w"))
    return {r[0]: r[1] for r in held.groupBy("w").agg(F.count(F.lit(1))).collect()}


def index(counts: dict[str, int], total: int) -> list[list[tuple[str, int]]]:
    """Per template the ``INDEXED`` words of highest IDF in its mandatory phrase, rarest first, with
    their positions in the template."""
    postings = []
    for _, notice, phrase in TEMPLATES:
        words, must = _split(notice), _split(phrase)
        at = _place(words, must)
        idf = {w: math.log((1 + total) / (1 + counts.get(w, 0))) for w in must}
        rare = sorted(idf, key=lambda w: (-idf[w], must.index(w)))[:INDEXED]
        postings.append([(w, at + must.index(w)) for w in rare])
    return postings


def _place(words: list[str], phrase: list[str]) -> int:
    return next(i for i in range(len(words)) if words[i : i + len(phrase)] == phrase)


def _phrase_at(words: Column, start: Column, phrase: list[str]) -> Column:
    hit = F.lit(True)
    for k, w in enumerate(phrase):
        hit = hit & F.coalesce(F.get(words, start + k) == w, F.lit(False))
    return hit


def _phrase_places(words: Column, phrase: list[str]) -> Column:
    """Starts of a phrase's consecutive words."""
    at = F.sequence(F.lit(0), F.size(words) - 1)
    held = F.array_contains(words, phrase[0]) & F.array_contains(words, phrase[-1])
    none = F.array().cast("array<int>")
    return F.when(held, F.filter(at, lambda i: _phrase_at(words, i, phrase))).otherwise(none)


def scan(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """The ``keep`` columns, ``n_words``, ``base`` (start, label) of the base phrases by start, ``found``
    (label, start, end, cover) of verified templates (words from 0, end exclusive), and ``score``:
    the best share of a template's words at their places, 1 where a base phrase stands whole.

    Null texts count as empty; repeated rows and equal places of several templates are all
    returned. An empty table gives an empty result.
    """
    rows = docs.select(*keep, words_of(whole_text(text_col)).alias("words"))
    vocabulary = sorted({w for _, notice, _ in TEMPLATES for w in _split(notice)})
    counts = document_counts(rows, vocabulary)
    postings = index(counts, docs.count())
    words = F.col("words")
    rows = rows.withColumns({"n_words": F.size(words).cast("bigint"), "base": _base(words), "starts": _starts(words, postings)})
    rows = rows.withColumn("found", F.when(F.size("starts") > 0, _verified(words, F.col("starts"), postings)).otherwise(F.array().cast(_FOUND)))
    best = F.coalesce(F.array_max(F.transform("found", lambda f: f["cover"])), F.lit(0.0))
    score = F.when(F.size("base") > 0, 1.0).otherwise(best)
    return rows.select(*keep, "n_words", "base", "found", score.alias("score"))


_FOUND = "array<struct<start:int,label:string,end:int,cover:double>>"


def _base(words: Column) -> Column:
    def named(label: str, phrase: str) -> Column:
        return F.transform(_phrase_places(words, _split(phrase)), lambda i: F.struct(i.alias("start"), F.lit(label).alias("label")))

    return F.array_sort(F.concat(*[named(label, phrase) for label, phrase in BASE]))


def _starts(words: Column, postings: list[list[tuple[str, int]]]) -> Column:
    """Distinct (template, start) that the places of each template's rarest word propose."""
    kind = "array<struct<t:int,start:int>>"
    keys = sorted({own[0][0] for own in postings})

    def proposed(place: Column) -> Column:
        out = F.array().cast(kind)
        for w in keys:
            posts = [(t, own[0][1]) for t, own in enumerate(postings) if own[0][0] == w]
            made = F.array(*[F.struct(F.lit(t).alias("t"), (place["i"] - q).alias("start")) for t, q in posts])
            out = F.when(place["w"] == w, made).otherwise(out)
        return out

    rare = F.array(*map(F.lit, keys))
    places = F.filter(
        F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda p: F.array_contains(rare, p["w"])
    )
    return F.when(F.arrays_overlap(words, rare), F.array_distinct(F.flatten(F.transform(places, proposed)))).otherwise(
        F.array().cast(kind)
    )


def _verified(words: Column, starts: Column, postings: list[list[tuple[str, int]]]) -> Column:
    """Proposed starts on which the template's other index words agree by their relative places and at which
    the mandatory phrase stands, with the share of words at their places."""

    def cover(place: Column) -> Column:
        out = F.lit(None).cast("double")
        for t, (_, notice, phrase) in enumerate(TEMPLATES):
            own, must = _split(notice), _split(phrase)
            hits = sum((F.coalesce(F.get(words, place["start"] + k) == w, F.lit(False)).cast("int") for k, w in enumerate(own)), F.lit(0))
            agreed = F.lit(True)
            for w, q in postings[t][1:]:
                agreed = agreed & F.coalesce(F.get(words, place["start"] + q) == w, F.lit(False))
            whole = _phrase_at(words, place["start"] + _place(own, must), must)
            out = F.when((place["t"] == t) & agreed & whole, hits / float(len(own))).otherwise(out)
        return out

    labels = F.array(*[F.lit(label) for label, _, _ in TEMPLATES])
    sizes = F.array(*[F.lit(len(_split(notice))) for _, notice, _ in TEMPLATES])
    rated = F.transform(
        starts,
        lambda p: F.struct(
            p["start"].alias("start"), F.get(labels, p["t"]).alias("label"),
            (p["start"] + F.get(sizes, p["t"])).alias("end"), cover(p).alias("cover"),
        ),
    )
    return F.array_sort(F.filter(rated, lambda f: f["cover"].isNotNull()))
