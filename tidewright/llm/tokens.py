"""Ids of the public word-level BPE (lower case, word ends) for whole texts.

Words are cached by their bytes; texts repeat words far more often than they bring new ones. A new
word of plain letters runs the same merges in tiktoken's engine (the word end becomes one byte
that UTF-8 never uses); anything else goes through the tokenizers library. Both give the
library's ids, which the tests hold against it.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np
import regex

CACHE = 500_000  # words of a task, about 200 bytes each
_END = b"\xff"
_WIDE = re.compile("[^\x00-ɏ]")
_PLAIN = re.compile("[!-~¡-ɏ]+")


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: a byte's own character where it is
    printable, else the next free character from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class WordCache(dict):
    """Bytes of a word (no white space) -> its ids as little-endian 32-bit bytes."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True  # their strings in a text are ordinary text
        model = json.load(open(path, encoding="utf-8"))
        split = model["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pieces = regex.compile(split).findall
        self.merge, self.id_bytes = self._engine(model["model"], tiktoken)

    @staticmethod
    def _engine(model: dict, tiktoken):
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        byte_of = _byte_alphabet()
        char_of = {b: c for c, b in byte_of.items()}
        ranks, ids = {}, []

        def add(token: bytes, number: int) -> None:
            ranks[token] = len(ids)
            ids.append(number)

        for b in range(256):
            add(bytes([b]), vocab[char_of[b]])
        for b in range(255):  # the word end joins its byte before any other merge
            add(bytes([b]) + _END, vocab[char_of[b] + suffix])
        for left, right in model["merges"]:
            joined = left + right
            word_end = joined.endswith(suffix)
            raw = bytes(byte_of[c] for c in (joined[: -len(suffix)] if word_end else joined))
            add(raw + _END if word_end else raw, vocab[joined])
        engine = tiktoken.Encoding("words", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})
        as_bytes = [i.tobytes() for i in np.array(ids, dtype="<u4")]
        return engine._core_bpe.encode_single_piece, as_bytes

    def __missing__(self, word: bytes) -> bytes:
        text = word.decode()
        if _PLAIN.fullmatch(text):
            made = b"".join(
                [self.id_bytes[i] for p in self.pieces(text.lower()) for i in self.merge(p.encode() + _END)]
            )
        else:
            made = np.array(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        if len(self) >= CACHE:
            self.clear()
        self[word] = made
        return made

    def encode(self, text: str) -> bytes:
        raw = text.encode()
        # A wide text may hold combining marks, whose composition can depend on the letter's case.
        words = raw.split() if _WIDE.search(text) else raw.lower().split()
        return b"".join(map(self.__getitem__, words))


@lru_cache(maxsize=1)
def word_cache(path: str) -> WordCache:
    return WordCache(path)
