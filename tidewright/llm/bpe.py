"""Byte-level BPE by longest matches with backtracking.

Bytes are mapped to Latin-1 characters for an Aho-Corasick automaton over the vocabulary. Two facts
give the exact merges without merging: a token sequence is the BPE encoding of its bytes iff
each adjacent pair is compatible (the pair's own bytes encode to just this pair), and an encoding of a
prefix that cannot go on can be abandoned for good. So the encoder extends by the longest match,
falls back to the next shorter one, and steps back at dead ends, marking each position it has given
up; a piece costs time in proportion to its length. Compatibility of adjacent tokens is memoised.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOCATOR, located, slices, whole_text

PIECES = 400_000
PAIRS = 500_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class _Pieces(dict):
    """Piece -> ids as bytes; a new piece is encoded, and kept while there is room."""

    def __init__(self, encode_piece):
        self.encode_piece = encode_piece

    def __missing__(self, piece: str) -> bytes:
        made = np.array(self.encode_piece(piece.encode()), dtype="<u4").tobytes()
        if len(piece) <= 64:
            if len(self) >= PIECES:
                self.clear()
            self[piece] = made
        return made


class Encoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.token = [b""] * (max(ranks.values()) + 1)
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.token[rank] = token
            self.automaton.add_word(token.decode("latin-1"), (rank, len(token) - 1))
        self.automaton.make_automaton()
        self.split = regex.compile(pattern).findall
        self.fits: dict[tuple[int, int], bool] = {}
        self.whole: dict[int, bool] = {}
        self.shorter: dict[int, int] = {}
        self.pieces = _Pieces(self.encode_piece)

    def merged(self, raw: bytes) -> list[int]:
        """BPE by its definition, for the few bytes of a token or of a pair: the first pair of lowest
        rank merges."""
        parts = [raw[i : i + 1] for i in range(len(raw))]
        while len(parts) > 1:
            joined = [self.ranks.get(a + b) for a, b in zip(parts, parts[1:])]
            known = [r for r in joined if r is not None]
            if not known:
                break
            at = joined.index(min(known))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def _starts(self, rank: int) -> bool:
        """Whether merges ever form this token."""
        known = self.whole.get(rank)
        if known is None:
            known = self.whole[rank] = self.merged(self.token[rank]) == [rank]
        return known

    def _compatible(self, left: int, right: int) -> bool:
        known = self.fits.get((left, right))
        if known is None:
            if len(self.fits) >= PAIRS:
                self.fits.clear()
            known = self.merged(self.token[left] + self.token[right]) == [left, right]
            self.fits[left, right] = known
        return known

    def _next_shorter(self, rank: int) -> int:
        """The longest token that is a proper prefix of this one; -1 if there is none."""
        known = self.shorter.get(rank)
        if known is None:
            token = self.token[rank]
            prefixes = (self.ranks.get(token[:n]) for n in range(len(token) - 1, 0, -1))
            known = self.shorter[rank] = next((r for r in prefixes if r is not None), -1)
        return known

    def encode_piece(self, raw: bytes) -> list[int]:
        known = self.ranks.get(raw)
        if known is not None:
            return [known]
        longest = [-1] * len(raw)
        for end, (rank, back) in self.automaton.iter(raw.decode("latin-1")):
            longest[end - back] = rank  # ends ascend, so the longest match at a start comes last
        token, dead, path = self.token, bytearray(len(raw) + 1), []
        at, rank = 0, longest[0]
        while at < len(raw):
            while rank >= 0:
                end = at + len(token[rank])
                if not dead[end] and (self._compatible(path[-1], rank) if path else self._starts(rank)):
                    path.append(rank)
                    at = end
                    rank = longest[at] if at < len(raw) else -1
                    break
                rank = self._next_shorter(rank)
            else:
                dead[at] = 1
                rank = path.pop()
                at -= len(token[rank])
                rank = self._next_shorter(rank)
        return path

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.pieces.__getitem__, self.split(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


@lru_cache(maxsize=1)
def encoder(path: str, pattern: str) -> Encoder:
    return Encoder(read_ranks(path), pattern)


def encoded(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(locator, id, ids) with ``ids`` as little-endian 32-bit integers in one binary; null texts count
    as empty, the empty text has no ids. No special tokens. One pass, no shuffle."""
    rows = located(docs).select(*LOCATOR, F.col(id_col).cast("bigint").alias("id"), whole_text(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = encoder(ranks, pattern).encode
        for b in slices(batches):
            ids = pa.array([make(t.as_py()) for t in b.column("text")], pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns[:3], ids], [*LOCATOR, "id", "ids"])

    return rows.mapInArrow(run, f"{LOCATOR[0]} string, {LOCATOR[1]} bigint, id bigint, ids binary")


def decoded(rows: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """``encoded`` rows with their bytes: (locator, id, ids, raw)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        back = encoder(ranks, pattern).decode
        for b in slices(batches):
            raw = pa.array([back(i.as_py()) for i in b.column("ids")], pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns, raw], [*LOCATOR, "id", "ids", "raw"])

    return rows.mapInArrow(run, f"{LOCATOR[0]} string, {LOCATOR[1]} bigint, id bigint, ids binary, raw binary")


def digests(rows: DataFrame) -> DataFrame:
    """Token counts and digests of ids and decoded bytes."""
    return rows.select(
        F.col("id").alias("doc_id"),
        F.expr("octet_length(ids) div 4").cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("raw", 256).alias("decoded_sha256"),
    )


