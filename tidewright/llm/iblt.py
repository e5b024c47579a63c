"""Document fingerprints: invertible Bloom lookup sketches over paragraph digests.

A text is a set of paragraphs: lines, cut after sentence ends and into runs of at most ``RUN``
characters, so that a text of one line has several too; the k-th copy of a paragraph counts as a
paragraph of its own. Each paragraph's 64-bit digest is added to ``HASHES`` cells (count, sum of
digests, sum of checks) of a sketch. Sketches of two versions subtract cell by cell; peeling cells
that hold one digest recovers the digests on either side. Where peeling stops early, both
sketches are made again with twice the cells until it succeeds.

All sketches of an Arrow batch are built, subtracted and peeled together in numpy.
"""

from __future__ import annotations

import base64
import re

import numpy as np
import xxhash

RUN, HASHES, CELLS = 48, 3, 24
_PARAGRAPH = re.compile(r"[^\n.!?]{1,%d}[\n.!?]*|[\n.!?]+" % RUN)
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers (multiply and shift)."""
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


class Paragraphs:
    """Digests of many texts: ``key`` (uint64) and ``own``, the number of the text."""

    def __init__(self, texts: list[str]):
        digest = xxhash.xxh64_intdigest
        lists = [[digest(p) for p in _PARAGRAPH.findall(t)] for t in texts]
        self.n = np.array([len(x) for x in lists], dtype=np.int64)
        raw = np.array([d for x in lists for d in x], dtype=np.uint64)
        own = np.repeat(np.arange(len(texts)), self.n)
        order = np.lexsort((raw, own))
        raw, self.own = raw[order], own[order]
        fresh = np.ones(len(raw), dtype=bool)
        fresh[1:] = (raw[1:] != raw[:-1]) | (self.own[1:] != self.own[:-1])
        at = np.arange(len(raw))
        copy = at - np.maximum.accumulate(np.where(fresh, at, 0))
        self.key = _mix(raw + copy.astype(np.uint64) * _U(0x9E3779B97F4A7C15))

    def of(self, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys of the given texts (a mask), with the texts renumbered in order."""
        number = np.cumsum(texts) - 1
        mine = texts[self.own]
        return self.key[mine], number[self.own[mine]]


def _cells(key: np.ndarray, own: np.ndarray, cells: int) -> np.ndarray:
    """(HASHES, n) cell numbers; each hash has its own part of a sketch, so they differ."""
    part = cells // HASHES
    return np.stack([
        own * cells + h * part + (_mix(key + _U(h + 1)) % _U(part)).astype(np.int64) for h in range(HASHES)
    ])


def _check(key: np.ndarray) -> np.ndarray:
    return _mix(key ^ _U(0xA5A5A5A5A5A5A5A5)) >> _U(32)


class Sketches:
    """One sketch per text, side by side."""

    def __init__(self, texts: int, cells: int):
        self.texts, self.cells = texts, cells
        self.count = np.zeros(texts * cells, dtype=np.int64)
        self.keys = np.zeros(texts * cells, dtype=np.uint64)
        self.checks = np.zeros(texts * cells, dtype=np.uint64)

    def add(self, key: np.ndarray, own: np.ndarray, sign: int | np.ndarray = 1) -> Sketches:
        sign = np.broadcast_to(np.asarray(sign, dtype=np.int64), key.shape)
        check = _check(key)
        for at in _cells(key, own, self.cells):
            np.add.at(self.count, at, sign)
            np.add.at(self.keys, at, key * sign.astype(np.uint64))  # wraps around, as does taking away
            np.add.at(self.checks, at, check * sign.astype(np.uint64))
        return self

    def minus(self, other: Sketches) -> Sketches:
        out = Sketches(self.texts, self.cells)
        out.count, out.keys, out.checks = self.count - other.count, self.keys - other.keys, self.checks - other.checks
        return out

    def encoded(self) -> list[str]:
        """Base64 text of (counts, digests, checks) per sketch; counts above 65 535 wrap."""
        parts = [
            self.count.astype("<u2").view(np.uint8).reshape(self.texts, -1),
            self.keys.astype("<u8").view(np.uint8).reshape(self.texts, -1),
            self.checks.astype("<u4").view(np.uint8).reshape(self.texts, -1),
        ]
        return [base64.b64encode(row.tobytes()).decode() for row in np.concatenate(parts, axis=1)]

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(key, text, side) of the recovered digests, side +1 or -1, and which texts came out whole.
        The sketches are used up."""
        found: list[tuple] = []
        look = np.flatnonzero(self.count)
        while True:
            sign = self.count[look]
            one = np.abs(sign) == 1
            at, sign = look[one], sign[one]
            key = self.keys[at] * sign.astype(np.uint64)
            pure = self.checks[at] * sign.astype(np.uint64) == _check(key)
            own = at // self.cells
            pure &= (_cells(key, own, self.cells) == at).any(axis=0)
            key, own, sign = key[pure], own[pure], sign[pure]
            if not len(key):
                break
            order = np.lexsort((key, own))
            key, own, sign = key[order], own[order], sign[order]
            first = np.r_[True, (key[1:] != key[:-1]) | (own[1:] != own[:-1])]
            key, own, sign = key[first], own[first], sign[first]
            self.add(key, own, -sign)
            found.append((key, own, sign))
            look = np.unique(_cells(key, own, self.cells))
        rest = (self.count != 0) | (self.keys != 0) | (self.checks != 0)
        whole = ~rest.reshape(self.texts, -1).any(axis=1)
        if not found:
            none = np.zeros(0, dtype=np.int64)
            return none.astype(np.uint64), none, none, whole
        key, own, sign = (np.concatenate(x) for x in zip(*found))
        return key, own, sign, whole


def sketch(paragraphs: Paragraphs, cells: int = CELLS) -> Sketches:
    return Sketches(len(paragraphs.n), cells).add(paragraphs.key, paragraphs.own)


def differing(left: Paragraphs, right: Paragraphs, cells: int = CELLS) -> list[tuple[np.ndarray, np.ndarray]]:
    """Digests only the left and only the right version of each text has."""
    out: list[tuple] = [(np.zeros(0, np.uint64),) * 2] * len(left.n)
    pending = np.arange(len(left.n))
    while len(pending):
        mask = np.zeros(len(left.n), dtype=bool)
        mask[pending] = True
        a = Sketches(len(pending), cells).add(*left.of(mask))
        b = Sketches(len(pending), cells).add(*right.of(mask))
        key, own, side, whole = a.minus(b).peel()
        order = np.argsort(own, kind="stable")
        key, side = key[order], side[order]
        ends = np.cumsum(np.bincount(own, minlength=len(pending)))
        for i in np.flatnonzero(whole):
            k, s = key[ends[i - 1] if i else 0 : ends[i]], side[ends[i - 1] if i else 0 : ends[i]]
            out[pending[i]] = (k[s > 0], k[s < 0])
        pending, cells = pending[~whole], cells * 2
    return out


def likeness(left: Paragraphs, right: Paragraphs, cells: int = CELLS) -> np.ndarray:
    """Shared paragraphs over all paragraphs of two versions, from the digests peeled out of their
    subtracted sketches; two empty texts are alike."""
    alike = np.ones(len(left.n))
    for i, (gone, came) in enumerate(differing(left, right, cells)):
        shared = left.n[i] - len(gone)
        total = shared + len(gone) + len(came)
        if total:
            alike[i] = shared / total
    return alike
