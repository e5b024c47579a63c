import hashlib
import re

from conftest_llm import ODD, plain
from pyspark.sql import functions as F

from tidewright.llm import pii

PATTERN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    found = []
    for rank, (kind, pattern) in enumerate(PATTERN.items()):
        if kind == "email" and "@" not in text:
            continue  # the plain search would take the square of a long run
        found += [(m.start(), rank, kind, m.end()) for m in re.finditer(pattern, text) if valid(kind, m[0])]
    return ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(found))


TEXTS = [
    "mail a.b_c%d@x-y.example.com, or a@b c@d. e@f.g_h@i.jk and @no.where x@y..z",
    "a@b.c_d@e.f.g@h.i +1 (555) 010-4477 x +1.2 +49 30 123456-78 +12345678901234567",
    "1.2.3.4 256.1.1.1 001.002.003.0004 1.2.3 1.2.3.4.5.6.7.8 9.9.9.9999 1.2.3.255.",
    "card 4111 1111 1111 1111 and 4111-1111-1111-1112 or 4207051279108084 4111111111111111 0",
    "é 👍🏽 x@y.zz é +33 1 23 45 67 89 — 10.0.0.1",
    "+4111111111111111 4111111111111111@card.example 10.0.0.1@host.example",
    "no data here", "", "+", "@", "1", "1 2 3 4 5 6 7 8 9 0 1 2",
]


def test_base_spans(spark, some_texts):
    texts = TEXTS + some_texts
    rows = pii.find(plain(spark, texts)).select("id", pii.labelled(F.col("spans")).alias("s")).collect()
    assert {r["id"]: r["s"] for r in rows} == {i: brute(t) for i, t in enumerate(texts)}


def test_very_long_runs(spark):
    texts = ["7" * 100_000, "a" * 100_000, "1." * 20_000, "a@" * 20_000, "x@y.z " * 3_000, "+1" * 20_000, "1 " * 30_000]
    rows = pii.find(plain(spark, texts)).select("id", pii.labelled(F.col("spans")).alias("s")).collect()
    assert {r["id"]: r["s"] for r in rows} == {i: brute(t) for i, t in enumerate(texts)}


def test_terms_that_reveal_an_entity(spark):
    common = "some words that many of the letters hold"
    texts = [f"letter {i} {common}" for i in range(200)]
    texts += [f"{common} Zephyrine writes from zed@mail.example.com today number{i}" for i in range(6)]
    texts += [f"{common} and many words near bob{i}@mail.example.com today" for i in range(6)]
    texts += ["only ZEPHYRINE here"]
    found = pii.find(plain(spark, texts))
    terms = {r["v"] for r in found.select(F.explode("term_spans.value").alias("v")).collect()}
    assert {t.lower() for t in terms} == {"zephyrine", "writes", "from", "number"}
    last = found.where(F.col("id") == len(texts) - 1).first()
    assert [(s["start"], s["end"]) for s in last["term_spans"]] == [(5, 14)]
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(plain(spark, texts)).collect()}
    assert clean[0] == texts[0]
    assert "zed@" not in clean[200] and "ephyrin" not in clean[200] and "[EMAIL]" in clean[200]
    assert clean[206] == f"{common} and many words near [EMAIL] today"


def test_copies_alone_reveal_nothing(spark):
    texts = [f"other words {i}" for i in range(50)] + ["rareword at x@y.example.com"] * 9
    assert pii.find(plain(spark, texts)).where(F.size("term_spans") > 0).count() == 0


def test_once_seen_entities_are_revealed_by_their_classes(spark):
    """No address or number recurs, and the words lie far from them: the kind, a mail domain and a prefix do."""
    far = " and so the plain words go on" * 12
    texts = [f"letter {a}{b}{far}" for a in "abcdefghij" for b in range(100)]
    texts += [f"Mailbox{far} u{i}@host{i}.example.com" for i in range(60)]
    texts += [f"Guild{far} u{i}@guild.example.org" for i in range(40)]
    texts += [f"Subnet{far} 10.77.{i}.9" for i in range(60)] + [f"letter{far} 11.{i}.3.9" for i in range(60)]
    texts += [f"chance{far} v{i}@other{i}.example.com" for i in range(4)]
    texts += [f"mixed{far} w{i}@more{i}.example.com" for i in range(20)] + [f"mixed{far} {i}" for i in range(20)]
    found = pii.find(plain(spark, texts))
    rows = found.select("id", F.explode("term_spans.value").alias("v")).collect()
    assert {r["v"] for r in rows} == {"Mailbox", "Guild", "Subnet"}
    assert len(rows) == 160
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(plain(spark, texts)).collect()}
    assert clean[1000] == f"{far} [EMAIL]"


def test_odd_rows(odd, nothing):
    rows = pii.find(odd).collect()
    assert len(rows) == len(ODD) and all(not r["spans"] for r in rows)
    clean = pii.sanitise(odd)
    assert sorted(clean.columns) == sorted(odd.columns)
    assert sorted(str((r["doc_id"], r["text"])) for r in clean.collect()) == sorted(str((r[0], r[1])) for r in ODD)
    assert pii.find(nothing).count() == 0
    assert pii.sanitise(nothing).count() == 0


def test_digest_of_no_spans(spark):
    r = pii.find(plain(spark, [""])).select(F.sha2(pii.labelled(F.col("spans")), 256).alias("h")).first()
    assert r["h"] == hashlib.sha256(b"").hexdigest()
