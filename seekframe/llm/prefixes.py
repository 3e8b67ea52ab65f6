"""Exact token counts of every prefix of a text, by dynamic programming over its pieces.

The ids of a piece (a run of letters, a digit, a run of signs) that is cut after some letter
follow from the ids of its shorter prefixes: the last token is the one that stays apart from
the token before it when both are merged alone. So each prefix costs a few look-ups, is kept
by workers, and a table of one signed byte per letter (the count's change, compressed) stores
the count of all prefixes of a text. Truncation and budgets are read from that table.

A null text is empty (no letters, no tokens); repeated rows give repeated rows; an empty table
gives no rows; other columns of the input are not read.
"""

import functools
import json
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seekframe.llm.common import batches, documents
from seekframe.llm.tokens import ASCII_PIECES, CLOSING, KEPT_BYTES, ODD, PIECES, Kept, byte_letters, tokenizer, tokenizer_path

#: Things of each kind that a worker remembers at most.
KEPT = 400_000
#: A pair of token numbers as one number: the first times this, plus the second.
PAIR = 1 << 32

_SPACE = re.compile(r"[ \t-\r]+")


class Pairs(dict):
    """Pair of token numbers -> whether the second can stand behind the first, or (behind 0) at the start."""

    def __init__(self, compute: Callable[[int, int], bool]):
        super().__init__()
        self.compute = compute

    def __missing__(self, pair: int) -> bool:
        if len(self) >= KEPT:
            self.clear()
        known = self[pair] = self.compute(*divmod(pair, PAIR))
        return known


class Counter:
    """Counts of prefixes under the merges of one byte-level vocabulary with word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            found = json.load(file)
        self.library = tokenizer(path)
        self.end = found["model"]["end_of_word_suffix"] or ""
        vocabulary = found["model"]["vocab"]
        #: Tokens by number, from 1 on.
        self.number = {token: i for i, token in enumerate(vocabulary, 1)}
        self.names = ["", *vocabulary]
        merges = (m if isinstance(m, list) else m.split(" ") for m in found["model"]["merges"])
        self.ranks = {self.number[a] * PAIR + self.number[b]: i for i, (a, b) in enumerate(merges)}
        ended = {t: t[: -len(self.end)] for t in vocabulary if self.end and t.endswith(self.end) and t != self.end}
        self.open_tokens = vocabulary.keys() - ended.keys() - {self.end}
        self.end_tokens = {body: t for t, body in ended.items()} or {t: t for t in self.open_tokens}
        self.endings = self.tree_of_endings()
        self.controls = [t["content"] for t in found["added_tokens"]]
        self.splits: dict[int, tuple[int, int, int] | None] = {}
        self.apart = Pairs(self.follows)
        # A tree of prefixes by letter: last open token (0: none yet), open count, ended count, longer prefixes.
        self.root: list = [0, 0, 0, None]
        self.nodes = 0
        self.pieces = Kept(self.piece_changes, KEPT)

    def tree_of_endings(self) -> dict:
        """Tokens by their letters from the last one back; ``""`` holds the numbers of the token as an open and as an ended one.

        So the tokens that end at a letter are the marks on one way down.
        """
        tree: dict = {}
        for ended, tokens in enumerate(({t: t for t in self.open_tokens}, self.end_tokens)):
            for body, token in tokens.items():
                node = tree
                for letter in reversed(body):
                    node = node.setdefault(letter, {})
                node.setdefault("", [0, 0])[ended] = self.number[token]
        return tree

    def letters(self, token: str) -> list[str]:
        if self.end and token.endswith(self.end) and token != self.end:
            body = token[: -len(self.end)]
            return [*body[:-1], body[-1] + self.end]
        return list(token)

    def split(self, token: int) -> tuple[int, int, int] | None:
        """Rank and parts of the merge that ends in the token: rank -1 for a letter, None if merging never ends in it."""
        if token not in self.splits:
            symbols, made = [self.number.get(x, 0) for x in self.letters(self.names[token])], (-1, token, token)
            names, never = self.names, len(self.ranks)
            while len(symbols) > 1:
                rank, i = min((self.ranks.get(a * PAIR + b, never), i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])))
                if rank == never:
                    break
                made = (rank, symbols[i], symbols[i + 1])
                # An ended token's name has the end once, behind its last part.
                symbols = [*symbols[:i], self.number[names[symbols[i]] + names[symbols[i + 1]]], *symbols[i + 2 :]]
            self.splits[token] = made if symbols == [token] else None
        return self.splits[token]

    def follows(self, before: int, token: int) -> bool:
        """Whether merging a token and the one before it in a row gives both; behind nothing (0), whether merging ends in it.

        The merges are undone from the last: what touches the border at each time must not
        have a merge of its own that comes before the next one that was done.
        """
        last = self.split(token)
        if last is None or not before:
            return last is not None
        left, right, limit = before, token, len(self.ranks)
        (a, _, left_end), (b, right_start, _), ranks = self.split(left), last, self.ranks.get
        while True:
            if ranks(left * PAIR + right, limit) < limit:
                return False
            if a < 0 and b < 0:
                return True
            # Of equal ranks the left one is merged first.
            if a > b:
                limit, left = a, left_end
                a, _, left_end = self.split(left)
            else:
                limit, right = b + 1, right_start
                b, right_start, _ = self.split(right)

    def next_state(self, states: list, piece: str, i: int) -> tuple[int, int, int]:
        """Of the first ``i`` letters: the last token and the count if the piece goes on, and the count if it ends."""
        node, at, found = self.endings, i, []
        while at and (node := node.get(piece[at - 1])) is not None:
            at -= 1
            if "" in node:
                found.append((states[at], node[""]))
        apart, last, opened, ended = self.apart, 0, 0, 0
        for before, (open_token, end_token) in reversed(found):  # the longest first
            if open_token and not last and apart[before[0] * PAIR + open_token]:
                last, opened = open_token, before[1] + 1
                if ended:
                    break
            if end_token and not ended and apart[before[0] * PAIR + end_token]:
                ended = before[1] + 1
                if last:
                    break
        if not last or not ended:
            raise ValueError(f"no token ends {piece[:i]!r}")
        return last, opened, ended

    def piece_counts(self, piece: str) -> list[int]:
        """Token counts of the piece's prefixes, each taken as a whole piece; in byte letters."""
        if self.nodes >= KEPT:
            self.root, self.nodes = [0, 0, 0, None], 0
        short, node = len(piece) <= KEPT_BYTES, self.root
        states, counts = [node], []
        for i, letter in enumerate(piece, 1):
            longer = node[3]
            state = None if longer is None else longer.get(letter)
            if state is None:
                state = [*self.next_state(states, piece, i), None]
                if short:
                    self.nodes += 1
                    if longer is None:
                        node[3] = {letter: state}
                    else:
                        longer[letter] = state
            states.append(state)
            counts.append(state[2])
            node = state
        return counts

    def piece_changes(self, piece: str) -> bytes:
        """The change of the count at each letter of a piece, a signed byte each."""
        if piece[0] == "'" and piece[1:].isalpha():
            # A contraction that is cut is a sign and letters, each a piece of its own.
            cut = [PIECES.findall(piece[:i]) for i in range(1, len(piece))]
            counts = [sum(self.piece_counts(p)[-1] for p in c) for c in [*cut, [piece]]]
        elif piece.isascii():
            counts = self.piece_counts(self.bytes_of(piece))
        else:
            whole, at, counts = self.piece_counts(self.bytes_of(piece)), 0, []
            for letter in piece:
                at += len(letter.encode())
                counts.append(whole[at - 1])
        return bytes([(n - m) & 255 for m, n in zip([0, *counts], counts)])

    def normal(self, text: str) -> tuple[str, list[int], list[tuple[int, int, str]]]:
        """The normal form, where each letter of the text ends in it, and odd inner prefixes.

        A letter joins the ones before it if their normal form is not just theirs in a row;
        prefixes that end inside such a group are given as (letter, group's start, own form).
        """
        form = self.library.normalizer.normalize_str
        out, ends, inner, at, i = [], [], [], 0, 0
        while i < len(text):
            group, made, partial = text[i], form(text[i]), []
            while i + len(group) < len(text):
                longer = form(group + text[i + len(group)])
                if longer == made + form(text[i + len(group)]):
                    break
                partial.append(made)
                group, made = group + text[i + len(group)], longer
            for j, own in enumerate(partial):
                if not made.startswith(own):
                    inner.append((i + j, at, own))
                ends.append(at + min(len(own), len(made)))
            at += len(made)
            ends.append(at)
            out.append(made)
            i += len(group)
        return "".join(out), ends, inner

    def count(self, text: str) -> int:
        return len(self.library.encode(text, add_special_tokens=False).ids)

    def plain_changes(self, text: str) -> bytes:
        """Changes for a text without control strings and ASCII white space."""
        body = text.rstrip(CLOSING)
        if body.isalpha() and body.isascii():
            changes = self.pieces[body.lower()]
            return changes if len(body) == len(text) else changes + self.pieces[text[len(body) :]]
        if ODD.search(text) is None and len(low := text.lower()) == len(text):
            found = ASCII_PIECES.findall(low) if low.isascii() else PIECES.findall(low)
            return b"".join(map(self.pieces.__getitem__, found))
        normal, ends, inner = self.normal(text)
        made, starts, at = bytearray(len(normal)), [], 0
        for found in PIECES.finditer(normal):  # blanks of the normal form change nothing
            starts.append(found.start())
            made[found.start() : found.end()] = self.pieces[found.group()]
        totals = [0, *np.cumsum(np.frombuffer(bytes(made), np.int8), dtype=np.int64).tolist()]
        counts = [totals[e] for e in ends]
        for letter, group, own in inner:
            # From the start of the piece that the group could belong to.
            at = max((s for s in starts if s <= group), default=0)
            counts[letter] = totals[at] + self.count(normal[at:group] + own)
        return bytes([(n - m) & 255 for m, n in zip([0, *counts], counts)])

    @staticmethod
    def bytes_of(piece: str) -> str:
        return piece if piece.isascii() and piece.isprintable() else piece.encode().decode("latin-1").translate(byte_letters())

    def word_changes(self, word: str) -> bytes:
        """Changes for a text without ASCII white space."""
        made, at = [], 0
        if "<|" in word:
            place = {c: word.find(c) for c in self.controls if c in word}
            while place:
                start, control = min((p, c) for c, p in place.items())
                before = word[at:start]
                made.append(self.plain_changes(before) if before else b"")
                total = self.count(before)
                # A control string that is cut is ordinary text, one with what stands before it.
                counts = [self.count(before + control[:i]) for i in range(1, len(control))] + [total + 1]
                made.append(bytes([(n - m) & 255 for m, n in zip([total, *counts], counts)]))
                at = start + len(control)
                place = {c: p if p >= at else word.find(c, at) for c, p in place.items()}
                place = {c: p for c, p in place.items() if p >= 0}
        rest = word[at:]
        return b"".join([*made, self.plain_changes(rest) if rest else b""])


def blankless(counter: Counter, chunk: str) -> bytes:
    """Changes for a text without blanks; other white space changes nothing."""
    if _SPACE.search(chunk) is None:
        return counter.word_changes(chunk) if chunk else b""
    parts = enumerate(re.split(r"([ \t-\r]+)", chunk))
    return b"".join(bytes(len(p)) if i % 2 else counter.word_changes(p) if p else b"" for i, p in parts)


@functools.cache
def tables_of(path: str) -> Kept:
    return Kept(functools.partial(blankless, Counter(path)), KEPT)


def changes(text: str, path: str) -> bytes:
    """The change of the token count at each letter of a whole text."""
    return b"\0".join(map(tables_of(path).__getitem__, text.split(" ")))


def counts_of(prefix: bytes) -> np.ndarray:
    """Token counts of the prefixes of 1, 2, ... letters, from a stored table."""
    return np.cumsum(np.frombuffer(zstandard.ZstdDecompressor().decompress(prefix), np.int8), dtype=np.int64)


def prefix_tables(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_bytes, n_letters, n_tokens and ``prefix``, the stored counts of all prefixes."""
    path = path or tokenizer_path("word_bpe_49k.json")

    def run(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1, write_content_size=True).compress
        for keys, texts in batches(found):
            made = [changes(t.decode(), path) for t in texts]
            totals = [int(np.frombuffer(m, np.int8).sum(dtype=np.int64)) for m in made]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, pa.int64()),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([len(m) for m in made], pa.int64()),
                    pa.array(totals, pa.int64()),
                    pa.array([squeeze(m) for m in made], pa.binary()),
                ],
                ["doc_id", "n_bytes", "n_letters", "n_tokens", "prefix"],
            )

    return documents(docs).mapInArrow(run, "doc_id long, n_bytes long, n_letters long, n_tokens long, prefix binary")


def kept_letters(tables: DataFrame, budget: int) -> DataFrame:
    """Tables plus ``keep``: letters of the longest prefix of at most ``budget`` tokens."""

    @F.pandas_udf("long")
    def longest(prefix: pd.Series) -> pd.Series:
        found = (np.flatnonzero(counts_of(p) <= budget) for p in prefix)
        return pd.Series([int(f[-1]) + 1 if len(f) else 0 for f in found])

    return tables.withColumn("keep", longest("prefix"))


def count_at(tables: DataFrame, letters: str) -> DataFrame:
    """Tables plus ``tokens_at``: the count of the prefix that a column of letter numbers names."""

    @F.pandas_udf("long")
    def at(prefix: pd.Series, where: pd.Series) -> pd.Series:
        out = []
        for p, n in zip(prefix, where):
            counts = counts_of(p)
            out.append(int(counts[min(int(n), len(counts)) - 1]) if n > 0 and len(counts) else 0)
        return pd.Series(out)

    return tables.withColumn("tokens_at", at("prefix", letters))
