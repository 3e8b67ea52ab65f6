"""Token ids of whole texts by a public tokenizer file, encoded once per distinct piece.

The tokenizer of ``word_bpe_49k.json`` drops white space and never merges across it, so a
text's ids are its words' ids in a row, and a word's ids those of its runs of letters, single
digits and runs of signs. Each worker keeps the ids of the words and pieces it has met.
"""

from __future__ import annotations

import functools
import os
import re
from collections.abc import Callable
from operator import attrgetter
from struct import pack

import numpy as np
import regex

#: Words and pieces a worker remembers at most, and the longest of them in bytes.
KEPT_WORDS, KEPT_PIECES, KEPT_BYTES = 600_000, 300_000, 64

# The tokenizer's rule for pieces, as its file has it.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
ASCII_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\s\x1c-\x1fa-z0-9]+")
#: Control strings, control letters, and letters that NFC or case could join or split (those from U+0250 on).
ODD = re.compile("<\\||[\x00-\x1f\x7f-\xa0\u0250-\U0010ffff]")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.cache
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


@functools.cache
def byte_letters() -> dict[int, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it prints, else one from 256 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in prints]
    return {b: b for b in prints} | {b: 256 + i for i, b in enumerate(rest)}


#: Signs that often end a word; a run of them is one piece.
CLOSING = ".,;:!?"
_ID = attrgetter("id")


def plain_pieces(word: str) -> list[str] | None:
    """The pieces of a word of letters with signs behind it, the most common kind; None for any other."""
    body = word.rstrip(CLOSING)
    if not body.isalpha() or (not body.isascii() and max(body) >= "\u0250"):
        return None
    low = body.lower()
    if len(low) != len(body):
        return None
    if not low.isascii():
        low = low.encode().decode("latin-1").translate(byte_letters())
    return [low] if len(body) == len(word) else [low, word[len(body) :]]


def pieces_of(word: str) -> list[str]:
    """The pieces that are merged one by one, in byte letters; for words without ``ODD``."""
    low = word.lower()
    if low.isascii():
        return ASCII_PIECES.findall(low)
    return [p.encode().decode("latin-1").translate(byte_letters()) for p in PIECES.findall(low)]


class Kept(dict):
    """Computed values by key, in two generations: when the young one is full it becomes the old one.

    What is asked for again moves back to the young one, so common keys stay and rare ones go;
    both together hold ``most`` keys of up to ``KEPT_BYTES``.
    """

    def __init__(self, compute: Callable, most: int):
        super().__init__()
        self.compute, self.half, self.old = compute, most // 2, {}

    def __missing__(self, key):
        found = self.old.get(key)
        if found is None:
            found = self.compute(key)
            if len(key) > KEPT_BYTES:
                return found
        if len(self) >= self.half:
            self.old = dict(self)
            super().clear()
        self[key] = found
        return found


class Words(Kept):
    """UTF-8 word -> its ids as bytes; a missing word is encoded."""

    def __init__(self, path: str):
        super().__init__(self.encoded, KEPT_WORDS)
        self.library = tokenizer(path)
        self.tokenize = self.library.model.tokenize
        self.pieces = Kept(self.piece, KEPT_PIECES)

    def clear(self) -> None:
        super().clear()
        self.pieces.clear()
        self.old, self.pieces.old = {}, {}

    def piece(self, piece: str) -> bytes:
        ids = [*map(_ID, self.tokenize(piece))]
        return pack(f"<{len(ids)}I", *ids)

    def encoded(self, word: bytes) -> bytes:
        text = word.decode()
        found = plain_pieces(text)
        if found is None and ODD.search(text) is None:
            found = pieces_of(text)
        if found is not None:
            return self.pieces[found[0]] if len(found) == 1 else b"".join([self.pieces[p] for p in found])
        ids = self.library.encode(text, add_special_tokens=False).ids
        return pack(f"<{len(ids)}I", *ids)


@functools.cache
def words_memory(path: str) -> Words:
    return Words(path)


def encode(text: bytes, path: str) -> np.ndarray:
    """Ids of a whole text as unsigned 32-bit numbers."""
    return np.frombuffer(b"".join(map(words_memory(path).__getitem__, text.split())), "<u4")
