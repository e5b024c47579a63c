import re

from conftest_llm import ODD, plain

from tidewright.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = {"cc-by": "cc by", "gpl": "general public license", "reserved": "all rights reserved"}


def brute(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    places = [
        (i, label) for label, phrase in PHRASES.items() for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    return len(words), sorted(places)


def scanned(df):
    return licenses.scan(df, ["doc_id"]).collect()


TEXTS = [
    "Licensed under CC BY-NC 4.0.", "cc by cc by cc-by CC  BY", "All rights  reserved. ALL RIGHTS RESERVED all rights",
    "This work is licensed under the GNU General Public License, version 3.", "GNU General Public License, version 2 only",
    "Licensed under the Apache License, Version 2.0. Released under the MIT License.", "the apache way of a license",
    "É K ccé by İ general public licenseé", "general public general public license license", "mit", "MIT License", "",
    "x\x00y\x7fz Apache License Version 2 0",
]


def test_base_places(spark, some_texts):
    texts = TEXTS + some_texts
    for r in scanned(plain(spark, texts)):
        n, places = brute(texts[r["doc_id"]])
        assert r["n_words"] == n
        assert [(b["start"], b["label"]) for b in r["base"]] == places


def test_templates(spark):
    found = {r["doc_id"]: ({f["label"] for f in r["found"]}, r["score"]) for r in scanned(plain(spark, TEXTS))}
    assert found[0][0] == {"cc-by-nc-4.0"} and found[3][0] == {"gpl-3.0"} and found[4][0] == {"gpl-2.0"}
    assert found[5][0] == {"apache-2.0", "mit"} and found[5][1] == 1.0
    assert found[6] == (set(), 0.0) and found[9] == (set(), 0.0)
    assert found[10][0] == {"mit"} and 0 < found[10][1] < 1
    assert found[12][0] == {"apache-2.0"}


def test_postings_hold_the_rarest_words():
    counts = {"license": 90, "apache": 2, "version": 60, "0": 10, "2": 10, "licensed": 0}
    number = next(t for t, (label, _, _) in enumerate(licenses.TEMPLATES) if label == "apache-2.0")
    assert licenses.index(counts, 100)[number] == [("apache", 3), ("2", 6), ("0", 7)]


def test_odd_rows(spark, odd, nothing):
    rows = scanned(odd)
    assert sorted(r["n_words"] for r in rows) == sorted(brute(r[1])[0] for r in ODD)
    assert all(r["score"] == 0 and not r["found"] for r in rows)
    assert scanned(nothing) == []
    many = "all rights reserved " * 20_000
    r = scanned(plain(spark, [many]))[0]
    assert len(r["base"]) == 20_000 and r["score"] == 1.0
