"""Benchmark decontamination by latent semantic retrieval.

Benchmark items (or parts of very long ones) are searched in length classes, each twice as long
as the one before. For each class documents are cut into overlapping passages of about twice
the class's length, so that an item lies whole in some passage and is a good share of it. Over the
benchmark's words, TF-IDF weights come from the passage counts of the whole corpus, by the
passages of the longest class. A randomised SVD gives the latent space: each task
projects its passages on random directions and back, the sums meet in Spark, and benchmark
items are added as rows that weigh as much as all passages together, so that the space holds
their rare words. A passage is a candidate of each item whose cosine there reaches ``CUT``.

A candidate is a leak if the longest common subsequence of words holds ``MATCH`` of the item,
or ``PARAPHRASE`` of it together with its answer, the item's last sentence, word by word.
Items of fewer than ``SHORT`` words must be there as they are; they are looked up by hashes of
all runs of as many words, and every hit is compared word by word (cosine 1).

The benchmark is a stated, bounded query set (its words, ``COLUMNS`` columns at most, and items
go to every task); all passages of whole texts are searched, in blocks. A null or empty text has
no passage; null or empty items are not searched; repeated rows give their pairs once; an empty
table gives no rows; other columns of both inputs are not read.
"""

import re
import zlib
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seekframe.llm.common import batches, documents, parked, runs_of

#: Columns of TF-IDF at most, latent dimensions, and directions beyond them.
COLUMNS, RANK, EXTRA = 8192, 64, 8
#: Least cosine of a candidate; shares of an item's words that must be in order.
CUT, MATCH, PARAPHRASE = 0.4, 0.75, 0.55
#: Items below so many words must match as they are; longest part of an item that is searched as one.
SHORT, LONGEST = 8, 256
#: Upper ends of the length classes of the other items.
LENGTHS = (15, 31, 63, 127, LONGEST)
#: Passages that are multiplied at a time, and words whose places are summed at a time.
BLOCK, WORDS = 256, 32_768
#: Of these, words whose sums stay in a core's cache; cells of a table of passages and words.
NEAR, CELLS = 2_048, 1 << 22

_WORD = re.compile(r"\w+")
#: All of ASCII that is in no word, as a space.
_GAPS = bytes(b if b > 127 or chr(b).isalnum() or b == ord("_") else 32 for b in range(256))
_SENTENCE = re.compile(r"[.?!:]\s+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


class Items:
    """Benchmark items as word numbers, and their answers."""

    def __init__(self, rows: list[tuple[int, str]]):
        self.ids: list[int] = []
        texts: list[list[str]] = []
        answers: list[list[str]] = []
        for item, text in rows:
            words = words_of(text)
            last = words_of(_SENTENCE.split(text.strip().rstrip(".?!"))[-1])
            answer = last if 2 <= len(last) < len(words) else words[-max(2, len(words) // 4) :]
            # Parts of nearly equal length: none is shorter than ``SHORT`` unless the item is.
            count = -(-len(words) // LONGEST)
            for i in range(count):
                self.ids.append(item)
                texts.append(words[len(words) * i // count : len(words) * (i + 1) // count])
                answers.append(answer if answer == texts[-1][-len(answer) :] else texts[-1][-2:])
        names = sorted({w for t in texts for w in t})
        self.numbers = {w: i for i, w in enumerate(names)}
        self.ascii = {w.encode(): i for w, i in self.numbers.items() if w.isascii()}
        self.texts = [[self.numbers[w] for w in t] for t in texts]
        self.answers = [[self.numbers[w] for w in a] for a in answers]
        self.columns = max(1, min(COLUMNS, len(names)))
        #: Length class -> its items and the step of its passages; items of a length under ``SHORT`` by that length.
        self.classes: dict[int, tuple[np.ndarray, int]] = {}
        self.short: dict[int, list[int]] = {}
        for i, text in enumerate(texts):
            if len(text) < SHORT:
                self.short.setdefault(len(text), []).append(i)
        sizes = np.asarray([len(t) for t in texts], np.int64)
        place = np.searchsorted(LENGTHS, sizes)
        for c in np.unique(place[sizes >= SHORT]).tolist():
            own = np.flatnonzero((place == c) & (sizes >= SHORT))
            self.classes[c] = own, int(sizes[own].max())
        #: Words of a class's items in rows, filled up with a number that no word has.
        self.padded = {c: np.full((len(own), longest), len(names), np.intp) for c, (own, longest) in self.classes.items()}
        for c, (own, _) in self.classes.items():
            for row, i in zip(self.padded[c], own.tolist()):
                row[: len(self.texts[i])] = self.texts[i]
        self.sizes = sizes
        self.step = max(32, max((len(t) for t in texts), default=0))
        #: Length -> hash of a short item's words -> the items.
        self.runs: dict[int, dict[int, list[int]]] = {}
        for n, own in self.short.items():
            for i in own:
                self.runs.setdefault(n, {}).setdefault(int(hashed(self.texts[i], n)[0]), []).append(i)
        self.hashes = {n: np.fromiter(own, np.uint64, len(own)) for n, own in self.runs.items()}
        self.masks = []
        for text in self.texts:
            own: dict[int, int] = {}
            for i, w in enumerate(text):
                own[w] = own.get(w, 0) | 1 << i
            self.masks.append(own)

    def numbered(self, text: bytes) -> np.ndarray:
        """Word numbers of a whole text, -1 for words that no item has."""
        if text.isascii():
            found = map(self.ascii.get, text.lower().translate(_GAPS).split(), repeat(-1))
        else:
            found = map(self.numbers.get, words_of(text.decode()), repeat(-1))
        return np.array(list(found), np.int32)

    def held(self, kind: int, words: np.ndarray, spans: np.ndarray, passage: np.ndarray, member: np.ndarray) -> np.ndarray:
        """For pairs of a passage (a span of known ``words``, ascending) and an item of a class, by its place there:
        how many of the item's words the passage has. No common subsequence is longer."""
        items = self.padded[kind]
        width, out = len(self.numbers) + 1, np.zeros(len(passage), np.int64)
        rows, at = np.unique(passage, return_inverse=True)
        size = max(1, CELLS // max(width, items.size))
        has = np.zeros((min(size, len(rows)), width), bool)
        for first in range(0, len(rows), size):
            own = spans[rows[first : first + size]]
            n = own[:, 1] - own[:, 0]
            row, word = np.repeat(np.arange(len(own)), n), words[np.repeat(own[:, 0] - np.cumsum(n) + n, n) + np.arange(n.sum())]
            has[row, word] = True
            a, b = np.searchsorted(at, [first, first + size])
            out[a:b] = has[(at[a:b] - first)[:, None], items[member[a:b]]].sum(axis=1)
            has[row, word] = False
        return out

    def column(self, numbers: np.ndarray) -> np.ndarray:
        """Columns of known words; beyond ``COLUMNS`` words share one by a hash."""
        if len(self.numbers) <= self.columns:
            return numbers
        return np.asarray([zlib.crc32(b"%d" % n) % self.columns for n in numbers.tolist()], np.int64)

    def entries(self, passages: list[np.ndarray], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """TF-IDF rows of length one, one for each passage, by place: row, column and value of what is not zero."""
        flat = np.concatenate(passages)
        rows = np.repeat(np.arange(len(passages)), [len(p) for p in passages])
        known = flat >= 0
        at, n = np.unique(rows[known] * self.columns + self.column(flat[known]), return_counts=True)
        row = at // self.columns
        x = n * idf[at % self.columns]
        size = np.sqrt(np.bincount(row, x * x, len(passages)))
        return row, at % self.columns, (x / np.maximum(size[row], 1e-9)).astype(np.float32)

    def weighted(self, passages: list[np.ndarray], idf: np.ndarray) -> np.ndarray:
        """TF-IDF rows of length one as a dense table."""
        row, column, x = self.entries(passages, idf)
        out = np.zeros((len(passages), self.columns), np.float32)
        out[row, column] = x
        return out

    def placed(self, passages: list[np.ndarray], idf: np.ndarray, space: np.ndarray) -> np.ndarray:
        """Passages as unit vectors of the latent space; a passage without known words is zero."""
        row, column, x = self.entries(passages, idf)
        out = np.zeros((len(passages), space.shape[1]), np.float32)
        if len(row):
            first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
            out[row[first]] = np.add.reduceat(space[column] * x[:, None], first, axis=0)
        out /= np.maximum(np.sqrt((out**2).sum(axis=1, keepdims=True)), 1e-9)
        return out

    def exact(self, numbers: np.ndarray) -> Iterator[tuple[int, int]]:
        """Short items that a whole text has as they are, and the first word of each one's first place."""
        for n, own in self.runs.items():
            runs = hashed(numbers, n)
            missing = set(self.short[n])
            for at in np.flatnonzero(np.isin(runs, self.hashes[n])).tolist():
                if not missing:
                    break
                for i in own[int(runs[at])]:
                    if i in missing and self.texts[i] == numbers[at : at + n].tolist():
                        missing.discard(i)
                        yield i, at

    def shared(self, item: int, passage: list[int]) -> int:
        """Length of the longest common subsequence, a bit for each word of the item."""
        masks, full = self.masks[item], (1 << len(self.texts[item])) - 1
        state = full
        for word in passage:
            mask = masks.get(word)
            if mask:
                both = state & mask
                state = ((state + both) | (state - both)) & full
        return len(self.texts[item]) - state.bit_count()

    def leaks(self, item: int, passage: list[int]) -> tuple[bool, int]:
        n, common = len(self.texts[item]), self.shared(item, passage)
        if n < SHORT:
            return common == n and within(self.texts[item], passage), common
        if common >= MATCH * n:
            return True, common
        return common >= PARAPHRASE * n and within(self.answers[item], passage), common


def hashed(numbers: np.ndarray | list[int], width: int) -> np.ndarray:
    """A hash of each run of ``width`` words."""
    return runs_of(np.asarray(numbers, np.int64).view(np.uint64), width)


def within(part: list[int], whole: list[int]) -> bool:
    return any(whole[i : i + len(part)] == part for i in range(len(whole) - len(part) + 1))


def passages_of(numbers: np.ndarray, step: int) -> list[tuple[int, np.ndarray]]:
    """Passages of two steps, one step apart, over the whole text."""
    return [(s, numbers[s : s + 2 * step]) for s in range(0, max(len(numbers) - step, 1), step)] if len(numbers) else []


def numbered(docs: DataFrame, items: Items) -> DataFrame:
    """Texts as word numbers (-1: no word of the benchmark), and each task's passage counts by column."""

    def run(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, passages = np.zeros(items.columns, np.int64), 0
        for keys, texts in batches(found):
            out = []
            for text in texts:
                numbers = items.numbered(text)
                out.append(numbers.tobytes())
                n = len(range(0, max(len(numbers) - items.step, 1), items.step)) if len(numbers) else 0
                passages += n
                # A word is in the passage that begins in its step and in the one before, where they are.
                place = np.flatnonzero(numbers >= 0)
                column, first = items.column(numbers[place]), place // items.step
                both = np.concatenate([(first * items.columns + column)[first < n], ((first - 1) * items.columns + column)[first > 0]])
                counts += np.bincount(np.unique(both) % items.columns, minlength=items.columns)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(out, pa.binary()), pa.nulls(len(out), pa.list_(pa.int64()))],
                ["doc_id", "numbers", "counts"],
            )
        yield pa.RecordBatch.from_arrays(
            [pa.array([None], pa.int64()), pa.array([None], pa.binary()), pa.array([[passages, *counts.tolist()]], pa.list_(pa.int64()))],
            ["doc_id", "numbers", "counts"],
        )

    return parked(docs.mapInArrow(run, "doc_id long, numbers binary, counts array<long>"))


def totals(rows: DataFrame, column: str, size: int) -> np.ndarray:
    """Sums of the arrays of a column, place by place; as many numbers as the arrays have."""
    each = rows.where(F.col(column).isNotNull()).select(F.posexplode(column).alias("i", "n"))
    found = each.groupBy("i").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(size)
    out[found["i"].to_numpy()] = found["n"].to_numpy()
    return out


def blocks(found: Iterable[pa.RecordBatch], step: int, size: int, stride: int = 1) -> Iterator[list[tuple[int, int, np.ndarray]]]:
    """Passages of documents in blocks: document, start and word numbers."""
    waiting: list[tuple[int, int, np.ndarray]] = []
    for batch in found:
        for key, raw in zip(batch.column("doc_id").to_pylist(), batch.column("numbers").to_pylist()):
            own = passages_of(np.frombuffer(raw, np.int32), step)
            last = own[-1:] if (len(own) - 1) % stride else []
            waiting += [(key, s, p) for s, p in own[::stride] + last]
            while len(waiting) >= size:
                yield waiting[:size]
                waiting = waiting[size:]
    if waiting:
        yield waiting


def stretches(batch: pa.RecordBatch, step: int) -> Iterator[list[tuple[int, np.ndarray, int, int]]]:
    """Documents, or stretches of long ones, in groups of about ``WORDS`` words: document, its numbers, first and last start."""
    own, size = [], 0
    for key, raw in zip(batch.column("doc_id").to_pylist(), batch.column("numbers").to_pylist()):
        numbers = np.frombuffer(raw, np.int32)
        for first in range(0, len(numbers), WORDS):
            last = min(first + WORDS, len(numbers))
            own.append((key, numbers, first, last))
            size += last - first
            if size >= WORDS:
                yield own
                own, size = [], 0
    if own:
        yield own


class Sums:
    """Running sums of the words' weighted places in the latent space: a passage's place is the difference of two."""

    def __init__(self, own: list[tuple[int, np.ndarray, int, int]], items: Items, weighted: np.ndarray):
        self.own = own
        # Passages that start in a stretch may end two steps behind it.
        parts = [numbers[first : last + 2 * items.step] for _, numbers, first, last in own]
        self.at = np.cumsum([0, *map(len, parts)])
        flat = np.concatenate(parts)
        self.known = np.flatnonzero(flat >= 0)
        self.words = flat[self.known]
        columns = items.column(self.words)
        self.sums = np.zeros((len(self.known) + 1, weighted.shape[1]))
        for first in range(0, len(columns), NEAR):
            part = self.sums[first + 1 : first + 1 + NEAR]
            np.take(weighted, columns[first : first + NEAR], axis=0, out=part, mode="clip")
            part[0] += self.sums[first]
            np.add.accumulate(part, axis=0, out=part)

    def passages(self, step: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of the passages of two steps, one step apart, that hold a known word: stretch, start, unit vector and span of known words."""
        starts = [np.arange(-(-first // step) * step, min(last, max(len(x) - step, 1)), step) for _, x, first, last in self.own]
        which = np.repeat(np.arange(len(starts)), [len(x) for x in starts])
        start = np.concatenate(starts)
        shift = np.array([at - first for at, (_, _, first, _) in zip(self.at, self.own)])[which]
        end = np.minimum(start + 2 * step, np.array([len(x) for _, x, _, _ in self.own])[which])
        low, high = np.searchsorted(self.known, start + shift), np.searchsorted(self.known, end + shift)
        some = np.flatnonzero(high > low)
        vectors = (self.sums[high[some]] - self.sums[low[some]]).astype(np.float32)
        vectors /= np.maximum(np.sqrt((vectors**2).sum(axis=1, keepdims=True)), 1e-9)
        return which[some], start[some], vectors, np.stack([low[some], high[some]], axis=1)


def latent_space(rows: DataFrame, items: Items, idf: np.ndarray, queries: np.ndarray, passages: float) -> np.ndarray:
    """Columns x ``RANK``: leading right singular vectors of passages and items, by random projection.

    Every second passage covers all words once. Each task's sum has a fixed size, and the sums
    are added by Spark in slices of columns.
    """
    rng = np.random.default_rng(11)
    width = min(RANK + EXTRA, items.columns)
    probe = rng.standard_normal((items.columns, width)).astype(np.float32)

    def run(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((items.columns, width), np.float32)
        for block in blocks(found, items.step, BLOCK, 2):
            x = items.weighted([p for _, _, p in block], idf)
            total += x.T @ (x @ probe)
        cut = range(0, items.columns, 256)
        slices = [total[i : i + 256].tobytes() for i in cut]
        yield pa.RecordBatch.from_arrays([pa.array(cut, pa.int64()), pa.array(slices, pa.binary())], ["at", "part"])

    def add(_key, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, 0.0
        for batch in parts:
            for start, raw in zip(batch.column("at").to_pylist(), batch.column("part").to_pylist()):
                at, total = start, total + np.frombuffer(raw, np.float32).astype(np.float64)
        yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([total.tobytes()], pa.binary())], ["at", "part"])

    kind = "at long, part binary"
    # Slices are added in a few groups first, so that no task reads all tasks' sums.
    each = rows.where("numbers is not null").select("doc_id", "numbers").mapInArrow(run, kind)
    grouped = each.withColumn("g", F.pmod(F.xxhash64("part"), F.lit(16)))

    def first(key, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in add(key, parts):
            half = np.frombuffer(batch.column("part")[0].as_py()).astype(np.float32).tobytes()
            yield pa.RecordBatch.from_arrays([batch.column("at"), pa.array([half], pa.binary())], ["at", "part"])

    summed = grouped.groupBy("at", "g").applyInArrow(lambda key, t: pa.Table.from_batches(first(key, t.to_batches())), kind)
    final = summed.groupBy("at").applyInArrow(lambda key, t: pa.Table.from_batches(add(key, t.to_batches())), kind).toPandas()
    sketch = np.zeros((items.columns, width))
    for at, part in zip(final["at"], final["part"]):
        rows_ = np.frombuffer(part).reshape(-1, width)
        sketch[at : at + len(rows_)] += rows_
    # The items weigh as much as the passages that were summed.
    weight = max(1.0, passages / 2) / max(1, len(queries))
    sketch += weight * (queries.T @ (queries @ probe))
    basis, _ = np.linalg.qr(sketch)
    # The leading directions within the basis, as the items see them.
    inner = queries @ basis
    _, vectors = np.linalg.eigh(inner.T @ inner)
    return (basis @ vectors[:, ::-1][:, :RANK]).astype(np.float32)


def leaks(docs: DataFrame, benchmark: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``item_id``, ``start`` (word), ``common`` and ``n_words`` of the item, ``cosine``: a row for each leak."""
    spark = docs.sparkSession
    kind = "doc_id long, item_id long, start long, common long, n_words long, cosine double"
    given = benchmark.select(F.col(key).cast("long").alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t")).where("k is not null")
    items = Items(sorted((r["k"], r["t"]) for r in given.distinct().collect()))
    if not items.texts:
        return spark.createDataFrame([], kind)
    rows = numbered(documents(docs), items)
    counted = totals(rows, "counts", items.columns + 1)
    passages = float(counted[0])
    idf = np.log((1 + passages) / (1 + counted[1:])).astype(np.float32)
    queries = items.weighted([np.asarray(t) for t in items.texts], idf)
    space = latent_space(rows, items, idf, queries, passages)
    there = items.placed([np.asarray(t) for t in items.texts], idf, space)

    def exact(batch: pa.RecordBatch) -> Iterator[tuple]:
        for doc, raw in zip(batch.column("doc_id").to_pylist(), batch.column("numbers").to_pylist()):
            for item, start in items.exact(np.frombuffer(raw, np.int32)) if doc is not None else ():
                n = len(items.texts[item])
                yield doc, items.ids[item], start, n, n, 1.0

    weighted = np.ascontiguousarray(idf[:, None] * space).astype(np.float64)

    def near(batch: pa.RecordBatch) -> Iterator[tuple]:
        for own in stretches(batch, items.step):
            sums = Sums(own, items, weighted)
            for kind, (members, step) in items.classes.items():
                which, starts, vectors, spans = sums.passages(step)
                cosine = vectors @ there[members].T
                i, j = np.nonzero(cosine >= CUT)
                # Without so many of the item's words it is no leak, in whatever order they are.
                enough = items.held(kind, sums.words, spans, i, j) >= PARAPHRASE * items.sizes[members[j]]
                for i, j in zip(i[enough], j[enough]):
                    doc, numbers = own[which[i]][:2]
                    start = int(starts[i])
                    leak, common = items.leaks(members[j], numbers[start : start + 2 * step].tolist())
                    if leak and doc is not None:
                        yield doc, items.ids[members[j]], start, common, len(items.texts[members[j]]), float(cosine[i, j])

    def run(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "item_id", "start", "common", "n_words", "cosine"]
        types = [pa.int64()] * 5 + [pa.float64()]
        for batch in found:
            out = [*exact(batch), *near(batch)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    found = rows.where("numbers is not null").select("doc_id", "numbers").mapInArrow(run, kind)
    best = F.max(F.struct("common", (-F.col("start")).alias("back"), "cosine", "n_words")).alias("b")
    each = found.groupBy("doc_id", "item_id").agg(best)
    return each.select("doc_id", "item_id", (-F.col("b.back")).alias("start"), "b.common", "b.n_words", "b.cosine")
