"""Best-fit packing by patterns: non-negative least squares over few-document length patterns.

Only the histogram of lengths (at most ``capacity`` numbers) reaches the driver. There the
lengths are put into bins, every pattern of up to three bins that fills a sequence is listed,
repeat counts are fitted to the histogram by non-negative least squares and rounded down, each
pattern's last document is taken best fit, and what is left is packed best fit, longest first.
The plan says which ranks of each length go to which sequences; ranks come from a salted
count, so a length that a third of all pieces has is never one task's work.

Null texts count as empty; an empty document is its end id alone; repeated rows are packed
each; ties may change places, not lengths; an empty table gives no rows; other columns of the
input are not read.
"""

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from seekframe.llm.common import batches, documents, forgetting, parked
from seekframe.llm.tokens import encode, tokenizer_path, words_memory

CAPACITY = 2048
#: Bins of the length axis in which patterns are fitted.
BINS = 128
#: Rows of one length and salt that are ranked together, on average.
RANKED = 100_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 400) -> np.ndarray:
    """x >= 0 that makes |ax - b| least, by an active set of columns."""
    x, active = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    limit = 1e-9 * max(1.0, np.abs(a.T @ b).max(initial=0))
    for _ in range(rounds):
        slope = np.where(active, -np.inf, a.T @ (b - a @ x))
        best = int(slope.argmax())
        if slope[best] <= limit:
            break
        active[best] = True
        while True:
            own = np.flatnonzero(active)
            found = np.linalg.lstsq(a[:, own], b, rcond=None)[0]
            low = found <= 0
            if not low.any():
                x[:] = 0
                x[own] = found
                break
            before = x[own]
            step = (before[low] / np.maximum(before[low] - found[low], 1e-300)).min()
            after = before + step * (found - before)
            after[low & (after <= 1e-12)] = 0
            x[own] = after
            active[own[after <= 0]] = False
            if not active.any():
                break
    return x


def patterns(bins: int) -> list[tuple[int, ...]]:
    """Multisets of one to three bins, largest first, that sum to the whole."""
    found: list[tuple[int, ...]] = [(bins,)]
    found += [(bins - b, b) for b in range(1, bins // 2 + 1)]
    for a in range(1, bins - 1):
        found += [(a, b, bins - a - b) for b in range(1, min(a, bins - a - 1) + 1) if bins - a - b <= b]
    return found


class _Plan:
    """Sequences so far: runs of alike sequences by the room that is left in them."""

    def __init__(self, counts: np.ndarray, capacity: int):
        self.left, self.capacity, self.sequences = counts.copy(), capacity, 0
        self.rooms: dict[int, list[tuple[int, int]]] = {}
        self.rows: list[tuple[int, int, int, int]] = []  # length, how many, first sequence, offset

    def put(self, length: int, n: int, first: int, offset: int) -> None:
        self.rows.append((length, n, first, offset))
        self.left[length] -= n

    def keep(self, room: int, first: int, n: int) -> None:
        if n and room:
            self.rooms.setdefault(room, []).append((first, n))

    def new(self, n: int) -> int:
        self.sequences += n
        return self.sequences - n

    def longest(self, low: int, high: int) -> int:
        """The longest length in low..high that still has pieces, or 0."""
        found = np.flatnonzero(self.left[low : high + 1])
        return int(found[-1]) + low if len(found) else 0

    def repeat(self, pattern: tuple[int, ...], times: int, width: int) -> None:
        """A pattern so often: its first documents from its bins, the last one best fit."""
        while times:
            chosen: list[int] = []
            used = 0
            for i, b in enumerate(pattern):
                high = min(b * width if i < len(pattern) - 1 else self.capacity, self.capacity - used)
                low = (b - 1) * width + 1 if i < len(pattern) - 1 else 1
                length = self.longest(low, high) if low <= high else 0
                if not length:
                    return
                chosen.append(length)
                used += length
            n = min([times, *(int(self.left[x]) // chosen.count(x) for x in chosen)])
            if not n:  # the same length twice with one piece left
                return
            first, offset = self.new(n), 0
            for length in chosen:
                self.put(length, n, first, offset)
                offset += length
            self.keep(self.capacity - offset, first, n)
            times -= n

    def rest(self) -> None:
        """What is left, longest first, each into the least room that holds it."""
        for length in range(self.capacity, 0, -1):
            while n := int(self.left[length]):
                room = min((r for r in self.rooms if r >= length), default=0)
                if room:
                    first, there = self.rooms[room].pop()
                    if not self.rooms[room]:
                        del self.rooms[room]
                    m = min(n, there)
                    self.put(length, m, first, self.capacity - room)
                    self.keep(room - length, first, m)
                    self.keep(room, first + m, there - m)
                else:
                    m = max(1, n // (self.capacity // length))
                    first = self.new(m)
                    self.put(length, m, first, 0)
                    self.keep(self.capacity - length, first, m)


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Rows of length, first rank, end rank, first sequence, offset, sorted by length and rank."""
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    made = _Plan(counts, capacity)
    if counts[capacity]:
        made.put(capacity, int(counts[capacity]), made.new(int(counts[capacity])), 0)
    bins = min(BINS, capacity)
    width = -(-capacity // bins)
    in_bin = np.bincount((np.arange(1, capacity + 1) - 1) // width, made.left[1:], bins)
    if in_bin.any():
        listed = patterns(bins)
        a = np.zeros((bins, len(listed)))
        for j, p in enumerate(listed):
            np.add.at(a[:, j], np.asarray(p) - 1, 1)
        # Longer bins weigh more: a short document finds room later, a long one does not.
        weight = np.arange(1, bins + 1) / bins
        times = np.floor(nnls(a * weight[:, None], in_bin * weight) + 1e-6).astype(int)
        for j in sorted(np.flatnonzero(times), key=lambda j: listed[j], reverse=True):
            made.repeat(listed[j], int(times[j]), width)
        made.rest()
    rows = np.asarray(made.rows, np.int64).reshape(-1, 4)
    rows = rows[np.argsort(rows[:, 0], kind="stable")]
    ends = np.cumsum(rows[:, 1])
    starts = ends - rows[:, 1]
    new = np.r_[True, rows[1:, 0] != rows[:-1, 0]] if len(rows) else np.empty(0, bool)
    base = np.maximum.accumulate(np.where(new, starts, 0)) if len(rows) else starts
    return np.column_stack([rows[:, 0], starts - base, ends - base, rows[:, 2], rows[:, 3]])


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0, ids: bool = False, forget: bool = False) -> DataFrame:
    """Documents as ids with an end id, those over the capacity cut; with the ids on request.

    ``forget`` empties the workers' memory of words after each task, for jobs that other stages follow.
    """

    def cut(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.asarray([end_id], "<u4")
        for keys, texts in batches(found):
            out: list[tuple] = []
            for key, text in zip(keys, texts):
                whole = np.concatenate([encode(text, tokenizer), end])
                for i, start in enumerate(range(0, len(whole), capacity)):
                    own = whole[start : start + capacity]
                    out.append((key, i, start, len(own), zlib.crc32(own), own.tobytes()))
            keys_, piece, start, length, crc, raw = zip(*out) if out else ((),) * 6
            columns = [pa.array(keys_, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64())]
            columns += [pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if ids:
                columns, names = [*columns, pa.array(raw, pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names)

    work = forgetting(cut, lambda: words_memory(tokenizer)) if forget else cut
    return documents(docs).mapInArrow(work, PIECES + (", ids binary" if ids else ""))


def pack(rows: DataFrame, capacity: int = CAPACITY, order: tuple[str, ...] = ("doc_id", "piece")) -> DataFrame:
    """Rows with a ``length`` of 1..capacity, plus their ``sequence_id`` and ``offset``.

    ``rows`` must be a table that reads the same each time: park it first.
    """
    histogram = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}
    salts = max(1, max(histogram.values(), default=0) // RANKED)
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salts)))
    counted = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    counted = counted.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    rank = F.row_number().over(Window.partitionBy("length", "_salt").orderBy(*order)) - 1
    ranked = salted.join(counted, ["length", "_salt"]).withColumn("_rank", (F.col("_before") + rank).cast("long"))
    made = plan(histogram, capacity)
    # Rows of the plan are bounded by the lengths and patterns, not by the documents.
    length, low, _, sequence, offset = made.T if len(made) else np.zeros((5, 0), np.int64)
    sought = (length << 44) + low

    @F.pandas_udf("sequence_id long, offset long")
    def place(own: pd.Series, at: pd.Series) -> pd.DataFrame:
        i = np.searchsorted(sought, (own.to_numpy() << 44) + at.to_numpy(), "right") - 1
        return pd.DataFrame({"sequence_id": sequence[i] + at.to_numpy() - low[i], "offset": offset[i]})

    placed = ranked.withColumn("_at", place("length", "_rank"))
    return placed.select(*rows.columns, F.col("_at.sequence_id"), F.col("_at.offset"))


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, ids: bool = False, forget: bool = False):
    """Pieces of documents with their places in sequences of at most ``capacity`` ids."""
    return pack(parked(pieces(docs, tokenizer or tokenizer_path("word_bpe_49k.json"), capacity, ids=ids, forget=forget)), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves, from pieces that carry ``ids``: a sequence is bounded by the capacity."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "ids")))
    whole = packed.groupBy("sequence_id").agg(parts.alias("parts"), F.sum("length").alias("length"))
    joined = F.aggregate("parts", F.lit(b""), lambda made, part: F.concat(made, part["ids"]))
    bounds = F.transform("parts", lambda p: F.struct(p["doc_id"], p["piece"], p["offset"]))
    return whole.select("sequence_id", "length", joined.alias("ids"), bounds.alias("parts"))
