"""Prefix-free parsing of byte strings for the repeated-substring search (numpy, one task's share).

A trigger is a gram of ``GRAM`` bytes whose rolling hash is the smallest (leftmost if tied) in some window
of ``length`` bytes: every window holds a trigger, equal windows hold the same one at the same place,
and consecutive triggers cut the text into phrases. A *phrase* here is the string under all windows that
share a trigger: window starts lo..lo+n-1, bytes lo..lo+n+length-2. Consecutive phrases overlap, so no
phrase is a proper prefix of the next start, and a text is fully described by its parse, the sequence of its
phrases' digests.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

GRAM = 20
SEGMENT = 1 << 19  # windows parsed at once; ends of segments cut phrases, not windows
_PLACE = np.uint64((1 << 20) - 1)
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


class _Rolling:
    """Polynomial hashes modulo 2^64 over scrambled bytes: prefix sums, and powers to take them off."""

    def __init__(self, base: int, seed: int, size: int):
        inverse = pow(base, -1, 1 << 64)
        self.byte = mix(np.arange(1, 257, dtype=np.uint64) * _U(seed)) | _U(1)
        self.power, self.back = (
            np.multiply.accumulate(np.r_[_U(1), np.full(size, b, dtype=np.uint64)]) for b in (base, inverse)
        )

    def prefix(self, raw: np.ndarray) -> np.ndarray:
        out = np.zeros(len(raw) + 1, dtype=np.uint64)
        np.cumsum(self.byte[raw] * self.power[: len(raw)], out=out[1:])
        return out

    def spans(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (prefix[end] - prefix[start]) * self.back[start]


@lru_cache(maxsize=2)
def _rolling(length: int) -> tuple[_Rolling, _Rolling]:
    size = SEGMENT + length
    return _Rolling(0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, size), _Rolling(0xD1342543DE82EF95, 0x94D049BB133111EB, size)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, by block prefixes and suffixes."""
    n = len(values) - width + 1
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(values)] = values
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def phrases(raw: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(trigger hash, phrase digest, lo, n) of a text's phrases, in order; empty below ``length`` bytes."""
    parts = [_segment(raw[at : at + SEGMENT + length - 1], at, length) for at in range(0, len(raw) - length + 1, SEGMENT)]
    if not parts:
        none = np.zeros(0, dtype=np.int64)
        return none.astype(np.uint64), none.astype(np.uint64), none, none
    return tuple(np.concatenate(p) for p in zip(*parts))


def _segment(raw: np.ndarray, at: int, length: int):
    first, second = _rolling(length)
    windows = len(raw) - length + 1
    grams = len(raw) - GRAM + 1
    sums = first.prefix(raw)
    gram = mix((sums[GRAM:] - sums[:-GRAM]) * first.back[:grams])
    ranked = (gram & ~_PLACE) | np.arange(grams, dtype=np.uint64)
    trigger = (sliding_min(ranked, length - GRAM + 1)[:windows] & _PLACE).astype(np.int64)
    lo = np.flatnonzero(np.r_[True, trigger[1:] != trigger[:-1]])
    n = np.diff(np.r_[lo, windows])
    trigger = trigger[lo]
    content = second.spans(second.prefix(raw), lo, lo + n + length - 1)
    shape = (trigger - lo).astype(np.uint64) | n.astype(np.uint64) << _U(32)
    return gram[trigger], mix(content ^ mix(shape + _U(1))), lo + at, n


def repeated_windows(texts: list[bytes], run: np.ndarray, length: int) -> list[np.ndarray]:
    """For dictionary phrases in corpus order, the window starts of each that repeat an earlier
    window of the same run: the suffix array of the phrases' windows, compared to ``length`` bytes,
    in which equal neighbours repeat and the first of them in the order stays."""
    joined = np.frombuffer(b"".join(texts), dtype=np.uint8)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    n = sizes - length + 1
    starts = np.repeat(np.cumsum(sizes) - sizes - (np.cumsum(n) - n), n) + np.arange(n.sum())
    own = np.repeat(np.arange(len(texts)), n)
    view = np.lib.stride_tricks.sliding_window_view(joined, length)[starts]
    suffix = np.ascontiguousarray(view).view(f"S{length}").ravel()
    order = np.argsort(suffix, kind="stable")
    same = np.r_[False, suffix[order[1:]] == suffix[order[:-1]]] & np.r_[False, run[own[order[1:]]] == run[own[order[:-1]]]]
    repeats = np.zeros(len(order), dtype=bool)
    repeats[order[same]] = True
    ends = np.cumsum(n)
    return [np.flatnonzero(repeats[e - m : e]) for e, m in zip(ends, n)]
