"""Approximate nearest neighbours by a hierarchical k-means tree, searched best bin first.

The tree is fitted on the driver on at most about ``SAMPLE`` vectors, chosen by a hash of their
id; every vector is indexed at the leaf that its descent ends in. A query walks the tree with a
priority queue of nodes by the distance of their centre and visits leaves until the calibrated
number is reached. That number is widened until, for ``CALIBRATED`` queries whose neighbours are
found by brute force over all vectors in blocks, the leaves visited hold ``RECALL`` of them.

Equal vectors are one entry of the index, known by its smallest id, with the ``k + 1`` smallest
ids of its copies: no more of them can be among k neighbours in ties by id. So one vector that a
third of all rows share is one entry, and one query. Large leaves are searched in blocks of
points and of queries, so no task holds a whole leaf.

Vectors that are null, of another length than most, zero or with null or non-finite components
take no part, as queries neither; rows without an id take no part; repeated rows count once; an
id with different vectors searches with each; ties go to the smaller id; an empty table gives no
rows; other columns of the input are not read.
"""

import hashlib
import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from seekframe.llm.common import parked

#: Vectors that the tree is fitted on at most, children of a node, vectors of the sample in a leaf at most.
SAMPLE, CHILDREN, LEAF = 20_000, 12, 40
#: Queries that calibrate the search, and the share of their neighbours that it must reach.
CALIBRATED, RECALL = 200, 0.98
#: Points and queries that are compared at a time.
POINTS, QUERIES = 4096, 4096
#: Parts in which a vector's copies are counted before they are put together.
SALTS = 64


def as_matrix(vectors: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(vectors), "<f8").reshape(len(vectors), -1)


def valid_vectors(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """``id``, ``key`` (a digest of the vector) and ``vector`` (doubles as bytes) of rows that take part."""
    own = rows.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    own = own.where(F.col("id").isNotNull() & F.col("vector").isNotNull())
    sizes = own.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    size = sizes["n"] if sizes else 0

    def run(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            column = batch.column("vector")
            x = column.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, size) + 0.0
            good = np.isfinite(x).all(axis=1) & (x != 0).any(axis=1)
            raw = [v.tobytes() for v in x[good].astype("<f8")]
            ids = batch.column("id").filter(pa.array(good))
            keys = [hashlib.blake2b(r, digest_size=16).digest() for r in raw]
            yield pa.RecordBatch.from_arrays([ids, pa.array(keys, pa.binary()), pa.array(raw, pa.binary())], ["id", "key", "vector"])

    return own.where(F.size("vector") == (size or -1)).mapInArrow(run, "id long, key binary, vector binary")


class Tree:
    """Centres of a k-means tree: node 0 is the root; ``leaf`` numbers the nodes without children."""

    def __init__(self, sample: np.ndarray, seed: int = 7):
        self.centres, self.children, self.leaf = [], [], []
        self.leaves = 0
        self._grow(sample, np.random.default_rng(seed))
        self.centres = np.asarray(self.centres).reshape(len(self.leaf), -1)

    def _grow(self, x: np.ndarray, rng) -> int:
        node = len(self.leaf)
        self.centres.append(x.mean(axis=0))
        self.children.append([])
        self.leaf.append(-1)
        groups = self._split(x, rng) if len(x) > LEAF else []
        if len(groups) < 2:
            self.leaf[node] = self.leaves
            self.leaves += 1
        else:
            self.children[node] = [self._grow(g, rng) for g in groups]
        return node

    @staticmethod
    def _split(x: np.ndarray, rng, rounds: int = 12) -> list[np.ndarray]:
        distinct = np.unique(x, axis=0)
        centres = distinct[rng.permutation(len(distinct))[:CHILDREN]]
        for _ in range(rounds):
            own = nearest(x, centres)
            centres = np.stack([x[own == i].mean(axis=0) if (own == i).any() else c for i, c in enumerate(centres)])
        own = nearest(x, centres)
        return [x[own == i] for i in range(len(centres)) if (own == i).any()]

    def descend(self, x: np.ndarray) -> np.ndarray:
        """The leaf at which each row's descent ends."""
        out, waiting = np.zeros(len(x), np.int64), [(0, np.arange(len(x)))]
        while waiting:
            node, rows = waiting.pop()
            if self.leaf[node] >= 0:
                out[rows] = self.leaf[node]
                continue
            kids = self.children[node]
            own = nearest(x[rows], self.centres[kids])
            waiting += [(kid, rows[own == i]) for i, kid in enumerate(kids) if (own == i).any()]
        return out

    def best_bins(self, query: np.ndarray, visits: int) -> list[int]:
        """The first leaves by a queue of nodes, the nearest centre first."""
        far = ((self.centres - query) ** 2).sum(axis=1).tolist()
        queue, out = [(far[0], 0)], []
        while queue and len(out) < visits:
            _, node = heapq.heappop(queue)
            if self.leaf[node] >= 0:
                out.append(self.leaf[node])
            for kid in self.children[node]:
                heapq.heappush(queue, (far[kid], kid))
        return out


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(axis=1) - 2 * (x @ centres.T)).argmin(axis=1)


def closest(queries: np.ndarray, points: np.ndarray, ids: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each query its k nearest points, ties by id, and their exact distances.

    A matrix product finds the points that could be among them within its rounding.
    """
    size = (points**2).sum(axis=1)
    most = float(size.max())
    for q in queries:
        own = float((q**2).sum())
        rough = size - 2 * (points @ q) + own
        if len(rough) > k:
            some = np.flatnonzero(rough <= np.partition(rough, k - 1)[k - 1] + 1e-9 * (own + most))
        else:
            some = np.arange(len(rough))
        exact = np.sqrt(((points[some] - q) ** 2).sum(axis=1))
        order = np.lexsort((ids[some], exact))[:k]
        yield ids[some[order]], exact[order]


def fitted(entries: DataFrame, rows: int, sample: int = SAMPLE) -> Tree:
    share = min(1.0, sample / max(rows, 1))
    chosen = entries.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30))).select("id", "vector").toPandas()
    return Tree(as_matrix(chosen.sort_values("id")["vector"].tolist()))


def indexed(entries: DataFrame, tree: Tree) -> DataFrame:
    def run(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            if batch.num_rows:
                leaf = tree.descend(as_matrix(batch.column("vector").to_pylist()))
                yield pa.RecordBatch.from_arrays([pa.array(leaf), batch.column("id"), batch.column("vector")], ["leaf", "id", "vector"])

    return parked(entries.select("id", "vector").mapInArrow(run, "leaf long, id long, vector binary"))


def calibrated(index: DataFrame, queries: DataFrame, tree: Tree, k: int, recall: float = RECALL) -> tuple[int, float]:
    """Leaf visits at which the calibration queries' neighbours are found, and the recall there."""
    some = queries.orderBy(F.xxhash64("id"), "id").limit(CALIBRATED).toPandas()
    if not len(some):
        return 1, 1.0
    asked, own = as_matrix(some["vector"].tolist()), some["id"].to_numpy(np.int64)

    def run(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list] = [[] for _ in own]
        for batch in found:
            if not batch.num_rows:
                continue
            points, ids = as_matrix(batch.column("vector").to_pylist()), batch.column("id").to_numpy()
            leaf = dict(zip(ids.tolist(), batch.column("leaf").to_pylist()))
            for i, (near, far) in enumerate(closest(asked, points, ids, k + 1)):
                more = [(d, n, leaf[n]) for d, n in zip(far.tolist(), near.tolist()) if n != own[i]]
                best[i] = sorted(best[i] + more)[:k]
        rows = [(int(own[i]), d, n, at) for i, b in enumerate(best) for d, n, at in b]
        columns = zip(*rows) if rows else ((),) * 4
        types = [pa.int64(), pa.float64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["query", "score", "id", "leaf"])

    exact = top(index.mapInArrow(run, "query long, score double, id long, leaf long"), k).toPandas()
    places = {int(q): {at: i for i, at in enumerate(tree.best_bins(v, tree.leaves))} for q, v in zip(own, asked)}
    needed = np.asarray([places[q][at] + 1 for q, at in zip(exact["query"], exact["leaf"])])
    visits, reached = 1, float((needed <= 1).mean()) if len(needed) else 1.0
    while reached < recall and visits < tree.leaves:
        visits = min(tree.leaves, visits + max(1, visits // 8))
        reached = float((needed <= visits).mean())
    return visits, reached


def top(found: DataFrame, k: int) -> DataFrame:
    """The k rows of least score of each query, ties by id; Spark keeps k of each task before it shuffles."""
    order = Window.partitionBy("query").orderBy("score", "id")
    return found.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= k).drop("_rank")


def searched(index: DataFrame, queries: DataFrame, tree: Tree, visits: int, k: int) -> DataFrame:
    """``query``, ``id``, ``score``: each query's k nearest entries in the leaves that it visits."""

    def walk(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            if not batch.num_rows:
                continue
            ids, raw = batch.column("id").to_pylist(), batch.column("vector").to_pylist()
            rows = [(at, i, r) for i, r, q in zip(ids, raw, as_matrix(raw)) for at in tree.best_bins(q, visits)]
            for j in range(0, len(rows), 8192):
                leaf, query, vector = zip(*rows[j : j + 8192])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(leaf, pa.int64()), pa.array(query, pa.int64()), pa.array(vector, pa.binary())], ["leaf", "query", "vector"]
                )

    asked = parked(queries.mapInArrow(walk, "leaf long, query long, vector binary"))
    # One number for each leaf, of which the tree has a bounded number.
    points = {r["leaf"]: -(-r["count"] // POINTS) for r in index.groupBy("leaf").count().collect()}
    chunks = {r["leaf"]: -(-r["count"] // QUERIES) for r in asked.groupBy("leaf").count().collect()}

    def number(counts: dict[int, int]) -> Column:
        large = [F.lit(x) for item in counts.items() if item[1] > 1 for x in item]
        return F.coalesce(F.element_at(F.create_map(*large), F.col("leaf")), F.lit(1)) if large else F.lit(1)

    part = lambda key, counts: F.pmod(F.xxhash64(key), number(counts)).cast("int")
    copies = lambda counts: F.explode(F.sequence(F.lit(0), number(counts) - 1))
    left = index.withColumn("p", part("id", points)).withColumn("q", copies(chunks))
    right = asked.withColumn("q", part("query", chunks)).withColumn("p", copies(points))

    def compare(a: pa.Table, b: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        if a.num_rows and b.num_rows:
            found, ids = as_matrix(a.column("vector").to_pylist()), a.column("id").to_numpy()
            given = as_matrix(b.column("vector").to_pylist())
            for query, (near, far) in zip(b.column("query").to_pylist(), closest(given, found, ids, k)):
                rows += [(query, n, d) for n, d in zip(near.tolist(), far.tolist())]
        columns = zip(*rows) if rows else ((),) * 3
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()))], ["query", "id", "score"])

    both = left.groupBy("leaf", "p", "q").cogroup(right.groupBy("leaf", "p", "q"))
    return top(both.applyInArrow(compare, "query long, id long, score double"), k)


def neighbours(rows: DataFrame, asked: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the k nearest other rows of each row that ``asked`` holds for.

    ``asked`` is a condition on the column ``id``.
    """
    valid = parked(valid_vectors(rows, key, vector))
    first = parked(valid.groupBy("key").agg(F.min("id").alias("id")))
    entries = parked(valid.join(first, ["key", "id"], "left_semi").dropDuplicates(["key"]))
    few = k + 1
    salted = valid.select("key", "id", F.pmod(F.xxhash64("id"), F.lit(SALTS)).alias("salt")).distinct()
    for by in (["key", "salt"], ["key"]):
        rank = F.row_number().over(Window.partitionBy(*by).orderBy("id"))
        salted = salted.withColumn("_rank", rank).where(F.col("_rank") <= few).drop("_rank")
    copies = salted.groupBy("key").agg(F.sort_array(F.collect_list("id")).alias("ids"), F.min("id").alias("id")).drop("key")

    ids = valid.where(asked).select("key", F.col("id").alias("query_id")).distinct()
    queries = parked(entries.join(ids.select("key").distinct(), "key", "left_semi").select("id", "vector"))
    n = entries.count()
    if not n:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    tree = fitted(entries, n)
    index = indexed(entries, tree)
    visits, _ = calibrated(index, queries, tree, k)
    near = searched(index, queries, tree, visits, few)
    members = near.join(copies, "id").select("query", "score", F.explode("ids").alias("id"))
    lists = top(members, few).groupBy("query").agg(F.sort_array(F.collect_list(F.struct("score", "id"))).alias("near"))
    named = ids.join(first, "key").withColumnRenamed("id", "query").drop("key").join(lists, "query")
    others = F.slice(F.filter("near", lambda c: c["id"] != F.col("query_id")), 1, k)
    ranked = named.select("query_id", F.posexplode(others).alias("at", "found"))
    return ranked.select("query_id", (F.col("at") + 1).alias("rank"), F.col("found.id").alias("vec_id"), "found.score")
