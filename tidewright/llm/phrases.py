"""Phrase collocations by dynamic counting of phrases over cyclic shard scans.

The corpus is dealt into shards, scanned in turn and again from the first one. Words are counted from the
first scan on. A longer phrase becomes active as soon as both its parts (without the last word, without the
first) have reached the threshold in what was scanned so far; it is counted from the next scan on, for one full
cycle, so every shard is counted once for it. Lengths are thus interleaved in the same scans, and a
phrase that reaches the threshold is always counted in full.

What is active is told to the scans by a table of fixed size (``SLOTS`` bytes per length): every phrase that has
reached the threshold marks its hashed slots with the scan in which it did so, and the scan that all its
slots allow is its start. A false hit only activates a phrase whose parts are too rare: it is counted
over a full cycle like others and left out for its count. The driver holds these tables and nothing else. The sums of
what is still counted are written to the shared folder after each scan and go through the exchange of the next one;
phrases that have had their cycle are left there.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_dir, settle
from .common import LOCATOR, located, whole_text

SHARDS, WORDS, SLOTS = 2, 3, 1 << 23
CUT = 1 << 22  # bytes of text whose words a task holds as objects
NEVER = 255
SALT = 64
_BOUND = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", b".........." )


def _spans(text: bytes) -> Iterator[bytes]:
    """Long texts in parts that end with a space or a boundary."""
    while len(text) > CUT:
        at = max(text.rfind(b" ", 0, CUT), text.rfind(b".", 0, CUT)) + 1
        if not at:
            ends = [e for e in (text.find(b" ", CUT), text.find(b".", CUT)) if e >= 0]
            at = min(ends) + 1 if ends else len(text)
        yield text[:at]
        text = text[at:]
    yield text


class Ids:
    """Word numbers of one language within a task's slice; number 0 bounds the pieces."""

    def __init__(self) -> None:
        self.number: defaultdict[bytes, int] = defaultdict()
        self.number.default_factory = self.number.__len__
        self.number[b"."]

    def of(self, text: str | None) -> list[np.ndarray]:
        """The words of a text as numbers, closed by a bound."""
        whole = (text or "").encode().lower().translate(_BOUND).replace(b"\t", b" ")
        out = []
        for part in _spans(whole):
            words = part.replace(b".", b" . ").split()
            out.append(np.fromiter(map(self.number.__getitem__, words), np.int32, len(words)))
        return [*out, np.zeros(1, np.int32)]


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of a phrase from those of its first words and its last one."""
    with np.errstate(over="ignore"):
        h = (a ^ (a >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + b
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(32))


def _word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(lang.encode())
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))


def _phrase_hashes(lang: str, phrases: list[list[bytes]]) -> np.ndarray:
    """Hashes of split phrases of one length."""
    first, *more = [_word_hashes(lang, list(column)) for column in zip(*phrases)]
    for words in more:
        first = _mixed(first, words)
    return first


def _slots(h: np.ndarray, slots: int) -> np.ndarray:
    """Three slots of each hash."""
    with np.errstate(over="ignore"):
        step = _mixed(h, h) | np.uint64(1)
        return np.stack([((h + np.uint64(i) * step) >> np.uint64(20)) % np.uint64(slots) for i in range(3)])


def _reached(h: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """The scan in which each phrase (or others, in all its slots) had reached the threshold, or NEVER."""
    return marks[_slots(h, len(marks)).astype(np.int64)].max(axis=0).astype(np.int16)


class _Named:
    """Phrases by the numbers of their first words (of ``names``, the phrases one shorter, or of words) and last one,
    spelled when asked for."""

    def __init__(self, names, words: pa.Array, first: np.ndarray, word: np.ndarray) -> None:
        self.names, self.words, self.first, self.word = names, words, first, word

    def take(self, at) -> pa.Array:
        first, word = self.first[at], pa.array(self.word[at])
        head = self.names.take(first if isinstance(self.names, _Named) else pa.array(first))
        return pc.binary_join_element_wise(head, self.words.take(word), b" ")

    def __len__(self) -> int:
        return len(self.first)

    def __iter__(self) -> Iterator[bytes]:
        return iter(self.take(slice(None)).to_pylist())


def count_slice(
    lang: str, texts: list, scan: int, cycle: int, marks: list[np.ndarray]
) -> Iterator[tuple[int, list[bytes] | _Named, np.ndarray]]:
    """(length, phrases, counts) of what this scan has to count in the texts."""
    ids = Ids()
    at = np.concatenate([a for t in texts for a in ids.of(t)])
    words, wide = list(ids.number), len(ids.number)
    if scan < cycle:
        yield 1, words[1:], np.bincount(at, minlength=wide)[1:]
    if not scan:
        return
    hashes = _word_hashes(lang, words)
    own = _reached(hashes, marks[0])
    own[0] = NEVER
    # Per position, of the phrase that starts there: its number and the scan in which it reached the threshold.
    number, reached = at, own[at]
    spelled = pa.array(words, pa.binary())
    names, hashed = spelled, hashes
    for length in range(2, len(marks) + 2):
        start = np.maximum(reached[:-1], reached[1:]) + 1
        here = np.flatnonzero(start <= scan)
        if not len(here):
            return
        back, kinds = pd.factorize(number[here].astype(np.int64) * wide + at[here + length - 1])
        first, word = kinds // wide, kinds % wide
        begin = np.empty(len(kinds), np.int16)
        begin[back] = start[here]
        due = np.flatnonzero(scan < begin + cycle)
        yield length, _Named(names, spelled, first[due], word[due]), np.bincount(back, minlength=len(kinds))[due]
        if length > len(marks):
            return
        names, hashed = _Named(names, spelled, first, word), _mixed(hashed[first], hashes[word])
        number, reached = np.zeros(len(start), np.int32), np.full(len(start), NEVER, np.int16)
        number[here], reached[here] = back, np.maximum(_reached(hashed, marks[length - 1]), begin)[back]


def _counts(docs: DataFrame, scan: int, cycle: int, marks, slice_bytes: int) -> DataFrame:
    """What scan number ``scan`` counts in the documents of its shard, slice by slice, and since which scan."""

    def batch(lang: str, texts: list, known: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        for length, phrases, n in count_slice(lang, texts, scan, cycle, known):
            for i in range(0, len(phrases), 1 << 16):
                part = slice(i, i + (1 << 16))
                some = phrases.take(part) if isinstance(phrases, _Named) else pa.array(phrases[part], pa.binary())
                some = some.cast(pa.string())
                k = len(some)
                columns = [pa.repeat(pa.scalar(length, pa.int32()), k), pa.repeat(lang, k), some, pa.array(n[i : i + k], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["len", "lang", "phrase", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [np.frombuffer(zlib.decompress(m), np.uint8) for m in marks.value]
        held, size = defaultdict(list), defaultdict(int)
        for b in batches:
            for lang, text in zip(b.column("lang"), b.column("text")):
                lang = lang.as_py()
                held[lang].append(text.as_py())
                size[lang] += len(held[lang][-1])
                if sum(size.values()) >= slice_bytes:
                    most = max(size, key=size.get)
                    yield from batch(most, held.pop(most), known)
                    del size[most]
        for lang, texts in held.items():
            yield from batch(lang, texts, known)

    found = docs.mapInArrow(count, "len int, lang string, phrase string, n bigint")
    return found.withColumn("since", F.when(F.col("len") == 1, 0).otherwise(scan))


def _mark(often: DataFrame, scan: int, marks: np.ndarray) -> bool:
    """Mark the slots of the phrases that have reached the threshold; True if there were new ones.
    Of the slots, at most all numbers come to the driver (four bytes each)."""
    slots, block = len(marks), 1 << 16

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            by_lang = defaultdict(list)
            for lang, phrase in zip(b.column("lang").to_pylist(), b.column("phrase").to_pylist()):
                by_lang[lang].append(phrase.encode().split(b" "))
            h = np.concatenate([_phrase_hashes(lang, split) for lang, split in by_lang.items()])
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(_slots(h, slots)).astype(np.int64))], ["slot"])

    hit = often.select("lang", "phrase").mapInArrow(places, "slot bigint").distinct().withColumn("block", F.shiftright("slot", 16))
    sets = hit.groupBy("block").agg(F.collect_set((F.col("slot") % block).cast("int")).alias("low")).toArrow()
    found = False
    for b, low in zip(sets["block"], sets["low"]):
        at = b.as_py() * block + low.values.to_numpy(zero_copy_only=False)
        new = at[marks[at] == NEVER]
        marks[new] = scan
        found |= bool(len(new))
    return found


def frequent(
    docs: DataFrame, threshold: int, longest: int = WORDS, shards: int = SHARDS, slots: int = SLOTS, slice_bytes: int = 1 << 23
) -> tuple[DataFrame, DataFrame]:
    """(len, lang, phrase, n): exact counts of all phrases of 1 to ``longest`` words with n >= ``threshold``;
    and (lang, n): all words. ``docs``: lang, text, shard."""
    spark = docs.sparkSession
    path = scratch_dir(spark, "shards")
    docs.write.partitionBy("shard").parquet(path)
    dealt = spark.read.schema(docs.schema).parquet(path)
    marks = [np.full(slots, NEVER, np.uint8) for _ in range(longest - 1)]
    sums: DataFrame | None = None
    done: list[DataFrame] = []

    scan, last = 0, shards - 1  # the last scan with anything to count
    while scan <= last:
        told = spark.sparkContext.broadcast([zlib.compress(m, 1) for m in marks])
        shard = dealt.where(F.col("shard") == scan % shards).select("lang", "text")
        found = _counts(shard, scan, shards, told, slice_bytes)
        if sums is not None:  # what is counted on goes through the same exchange
            found = found.unionByName(sums.where(F.col("since") + shards > scan))
        found = found.repartition("len", "lang", "phrase")  # adding up before it spares few rows
        sums = settle(found.groupBy("len", "lang", "phrase").agg(F.sum("n").alias("n"), F.min("since").alias("since")), "counts")
        told.destroy()
        often = sums.where(F.col("n") >= threshold)
        if scan < (longest - 1) * shards:
            reached = settle(often.where(F.col("len") < longest), "often")
            for length in range(1, longest):
                if scan < length * shards and _mark(reached.where(F.col("len") == length), scan, marks[length - 1]):
                    last = scan + shards
        ended = often if scan == last else often.where(F.col("since") + shards <= scan + 1)
        done.append(ended.select("len", "lang", "phrase", "n"))
        if scan == shards - 1:
            words = settle(sums.where("len = 1").groupBy("lang").agg(F.sum("n").alias("n")), "words")
        scan += 1
    return settle(_all(done), "phrases"), words


def _all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


def _subphrases(longest: int) -> F.Column:
    """Contiguous runs of 2 or more words of the array ``w``, without the whole."""
    runs = [(i, n) for n in range(2, longest) for i in range(longest - n + 1)]
    each = [F.when(F.size("w") >= i + n + (i == 0), F.array_join(F.slice("w", i + 1, n), " ")) for i, n in runs]
    return F.array_distinct(F.array_compact(F.array(*each)))


def collocations(
    docs: DataFrame, lang: str = "lang", text: str = "text", threshold: int = 10, longest: int = WORDS,
    cover: int = 50, top: int = 2000, shards: int = SHARDS, slots: int = SLOTS,
) -> DataFrame:
    """The best ``top`` phrases of 2 to ``longest`` words per language: lang, rank, phrase, a (occurrences), l and r
    (those of the parts at the worst cut), n (words of the language), score = floor(10^6 a a / (l r)).

    A phrase is left out if a longer one that contains it has at least ``cover`` percent of its occurrences. Null
    texts are empty, a null language is "und"; texts of blanks and boundaries have no words; repeated rows
    count as often as they occur; an empty table gives no row. Other columns are ignored, whatever their
    names. Equal scores are ordered by occurrences and then by the phrase's bytes. Exact below 10^10 occurrences. A
    task holds the words of a few megabytes of text, or of its longest text, as numbers.
    """
    rows = located(docs).select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), whole_text(text).alias("text"),
        F.pmod(F.xxhash64(*LOCATOR), F.lit(shards)).cast("int").alias("shard"),
    )
    often, n = frequent(rows, threshold, longest, shards, slots)
    phrases = often.where("len > 1").select("lang", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))
    cuts = phrases.withColumn("cut", F.explode(F.sequence(F.lit(1), F.size("w") - 1))).select(
        "lang", "phrase", "a", "cut",
        F.array_join(F.slice("w", F.lit(1), F.col("cut")), " ").alias("left"),
        F.array_join(F.slice("w", F.col("cut") + 1, F.size("w")), " ").alias("right"),
    )
    part = often.select("lang", F.col("phrase").alias("part"), "n")
    cuts = cuts.join(part.select("lang", F.col("part").alias("left"), F.col("n").alias("l")), ["lang", "left"])
    cuts = cuts.join(part.select("lang", F.col("part").alias("right"), F.col("n").alias("r")), ["lang", "right"])
    a, both = F.col("a").cast("decimal(12,0)"), F.col("l").cast("decimal(12,0)") * F.col("r").cast("decimal(12,0)")
    score = F.call_function("div", a * a * F.lit(1_000_000).cast("decimal(7,0)"), both).cast("bigint")
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("worst"))

    inner = phrases.select("lang", F.explode(_subphrases(longest)).alias("phrase"), "a")
    covered = inner.groupBy("lang", "phrase").agg(F.max("a").alias("within"))
    kept = scored.join(covered, ["lang", "phrase"], "left")
    kept = kept.where(F.col("within").isNull() | (100 * F.col("within") < cover * F.col("a")))

    best = [F.desc("worst.score"), F.desc("a"), F.asc("phrase")]
    salt = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALT))).orderBy(*best)
    some = kept.withColumn("nth", F.row_number().over(salt)).where(F.col("nth") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).where(F.col("rank") <= top)
    return ranked.join(n, "lang").select("lang", "rank", "phrase", "a", "worst.l", "worst.r", "n", "worst.score")
