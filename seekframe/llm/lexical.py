"""Ranked lexical search by dense blocked multiplication.

Items are taken in blocks. The distinct terms of a block are its compact vocabulary; each document
becomes a sparse row of term counts over it, written once. Corpus counts give every term its weight,
and then tasks fill dense tiles: weights (items x terms, cut to the terms that a tile of documents
has) times impacts (terms x documents), multiplied by BLAS in float64. Vocabulary tiles are cut so
that no sum within one can reach 2^53: each product is an exact integer, and tiles are added up as
64-bit integers. A task keeps the best of each item; a tile's documents pass if they reach the
worst of these, ties included, so ties are settled by ``doc_id`` and never by the order of tiles.

Terms are the maximal runs of ASCII letters, digits and letters beyond ASCII, A-Z lower-cased. A null
or empty text has none and counts nowhere; texts are read whole. Repeated documents are ranked each;
one without ``doc_id`` comes last among equal scores. Repeated items are answered each; an item
without terms, or whose terms no document has, gives no row, and so does an empty table. Further
columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seekframe.llm.common import batches, documents, parked

#: Distinct terms and items of a block: what a task holds. One longer item is a block of its own.
BLOCK_TERMS, BLOCK_ITEMS = 100_000, 512
#: Documents and terms of a tile: 8 MB of impacts at most.
TILE_DOCS, TILE_TERMS = 256, 4096
#: Below this float64 holds every integer; an impact is at most ``IMPACT``.
EXACT, IMPACT = 1 << 53, 1_000_000
#: Groups in which the tasks' best are merged before the last merge.
MERGES = 64
NO_ID = np.iinfo(np.int64).max

_SIGNS = bytes(range(0x30)) + bytes(range(0x3A, 0x41)) + bytes(range(0x5B, 0x61)) + bytes(range(0x7B, 0x80))
_PLAIN = bytes.maketrans(_SIGNS + bytes(range(0x41, 0x5B)), b" " * len(_SIGNS) + bytes(range(0x61, 0x7B)))

FOUND = "number int, score long, doc_id long, no_id boolean, part int"


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_PLAIN).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def blocks_of(items: DataFrame) -> Iterator[list[tuple[int, Counter]]]:
    """Items with their terms' counts, a block at a time."""
    own, seen = [], set()
    for row in items.select(F.col("item_id").cast("long"), F.coalesce("text", F.lit(""))).toLocalIterator():
        counts = Counter(terms_of(row[1].encode()))
        if own and (len(seen) + len(counts) > BLOCK_TERMS or len(own) == BLOCK_ITEMS):
            yield own
            own, seen = [], set()
        if counts:
            own.append((row[0], counts))
            seen.update(counts)
    if own:
        yield own


def counted(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``doc_id``, its number of terms ``n``, and its vocabulary terms with their counts, parked."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = shared.value.get
        for keys, texts in batches(found):
            sizes, ids, counts = [], [], []
            for text in texts:
                words = terms_of(text)
                held = np.fromiter((i for i in map(place, words) if i is not None), np.int32)
                term, tf = np.unique(held, return_counts=True)
                sizes.append(len(words))
                ids.append(term)
                counts.append(tf)
            kind = pa.list_(pa.int32())
            columns = [pa.array(keys, pa.int64()), pa.array(sizes, pa.int64()), pa.array(ids, kind), pa.array(counts, kind)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "ids", "tfs"])

    return parked(documents(docs).mapInArrow(run, "doc_id long, n long, ids array<int>, tfs array<int>"))


def vocabulary_tiles(rows: np.ndarray, terms: np.ndarray, weights: np.ndarray, n_items: int) -> list[tuple]:
    """Entries (item, term, weight) cut into tiles of few terms whose sums stay below ``EXACT``.

    Entries come sorted by term. A weight that alone is too large becomes several.
    """
    most = (EXACT - 1) // IMPACT
    tiles, own, sums, held = [], [], np.zeros(n_items, np.int64), set()
    for r, t, w in zip(rows.tolist(), terms.tolist(), weights.tolist()):
        while w:
            part = min(w, most)
            if sums[r] + part > most or (len(held) == TILE_TERMS and t not in held):
                tiles.append(own)
                own, held = [], set()
                sums[:] = 0
            own.append((r, t, part))
            held.add(t)
            sums[r] += part
            w -= part
    tiles.append(own)
    return [tuple(np.array(x, np.int64) for x in zip(*tile)) for tile in tiles if tile]


def impacts(sizes: list[int], tfs: np.ndarray, of: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    m = np.array([25 + 75 * n * n_docs // n_terms for n in sizes], np.int64)
    return (1_000_000_000 * tfs) // (1000 * tfs + 8 * m[of])


class Best:
    """The best documents of each item so far, by score, then ``doc_id``."""

    def __init__(self, n_items: int, k: int):
        self.k, self.least = k, np.zeros(n_items, np.int64)
        self.rows = np.empty((0, 3), np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        """Scores of a tile, items x documents; a document equal to the worst kept one passes."""
        item, doc = np.nonzero((scores > 0) & (scores >= self.least[:, None]))
        if not len(item):
            return
        rows = np.concatenate([self.rows, np.stack([item, scores[item, doc], ids[doc]], axis=1)])
        rows = rows[np.lexsort((rows[:, 2], -rows[:, 1], rows[:, 0]))]
        first = np.searchsorted(rows[:, 0], rows[:, 0])
        rank = np.arange(len(rows)) - first
        last = rank == self.k - 1
        self.least[rows[last, 0]] = rows[last, 1]
        self.rows = rows[rank < self.k]


def scored(sparse: DataFrame, tiles: list[tuple], n_items: int, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """Each task's best documents of each item."""
    shared = sparse.sparkSession.sparkContext.broadcast(tiles)

    def run(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, part = Best(n_items, k), None
        for whole in found:
            for at in range(0, whole.num_rows, TILE_DOCS):
                batch = whole.slice(at, TILE_DOCS)
                if part is None:
                    part = batch.column("part")[0].as_py()
                term = batch.column("ids").flatten().to_numpy()
                tf = batch.column("tfs").flatten().to_numpy().astype(np.int64)
                of = np.repeat(np.arange(batch.num_rows), batch.column("ids").value_lengths().to_numpy())
                value = impacts(batch.column("n").to_pylist(), tf, of, n_docs, n_terms)
                scores = np.zeros((n_items, batch.num_rows), np.int64)
                for row, column, own in shared.value:
                    # Terms of this tile that the documents have, as the columns of both factors.
                    present = np.intersect1d(column, term)
                    if not len(present):
                        continue
                    left, right = np.zeros((n_items, len(present))), np.zeros((len(present), batch.num_rows))
                    here = np.isin(column, present)
                    left[row[here], np.searchsorted(present, column[here])] += own[here]
                    held = np.isin(term, present)
                    right[np.searchsorted(present, term[held]), of[held]] = value[held]
                    scores += (left @ right).astype(np.int64)
                ids = batch.column("doc_id").fill_null(NO_ID).to_numpy()
                best.add(scores, ids)
        r = best.rows
        ids = pa.array(r[:, 2], mask=r[:, 2] == NO_ID)
        columns = [pa.array(r[:, 0].astype(np.int32)), pa.array(r[:, 1]), ids, ids.is_null(), pa.array(np.full(len(r), part or 0, np.int32))]
        yield pa.RecordBatch.from_arrays(columns, ["number", "score", "doc_id", "no_id", "part"])

    given = sparse.where(F.size("ids") > 0).withColumn("part", F.pmod(F.spark_partition_id(), F.lit(MERGES)))
    return given.mapInArrow(run, FOUND)


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each item, merged in groups of tasks first."""
    order = (F.col("score").desc(), F.col("no_id"), F.col("doc_id"))
    some = found.withColumn("rank", F.row_number().over(Window.partitionBy("number", "part").orderBy(*order))).where(F.col("rank") <= k)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("number").orderBy(*order))).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score``: each item's ``k`` best documents with a score above 0."""
    spark, parts = docs.sparkSession, []
    for block in blocks_of(items):
        names = sorted(set().union(*(counts for _, counts in block)))
        vocabulary = {t: i for i, t in enumerate(names)}
        sparse = counted(docs, vocabulary)
        facts = sparse.where("n > 0").agg(F.count("*").alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
        if not facts["docs"]:
            break
        df = np.zeros(len(names), np.int64)
        # One row for each term of the block.
        for row in sparse.select(F.explode("ids").alias("id")).groupBy("id").count().collect():
            df[row["id"]] = row["count"]
        entries = sorted((vocabulary[t], i, c) for i, (_, counts) in enumerate(block) for t, c in counts.items() if df[vocabulary[t]])
        column, row, count = (np.array(x, np.int64) for x in zip(*entries)) if entries else (np.empty(0, np.int64),) * 3
        weights = np.array([weight(facts["docs"], int(df[t])) for t in column], np.int64) * count
        tiles = vocabulary_tiles(row, column, weights, len(block))
        found = ranked(scored(sparse, tiles, len(block), facts["docs"], facts["terms"], k), k)
        numbers = spark.createDataFrame([(i, key) for i, (key, _) in enumerate(block)], "number int, item_id long")
        parts.append(parked(found.join(F.broadcast(numbers), "number").select("item_id", "rank", "doc_id", "score")))
    if not parts:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out
