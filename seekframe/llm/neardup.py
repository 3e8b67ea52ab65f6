"""MinHash near-duplicates by tensored banding, every link verified on full shingle sets.

A document has two small collections of ``side`` sketches, each sketch ``ROWS`` minhashes. A
table's key is a pair, one sketch of each collection, so ``2 * ROWS * side`` minhashes fill
``side ** 2`` tables of ``2 * ROWS`` minhashes where they would fill ``side`` without the pairs.
``side`` is the least at which a collection misses a pair of the least similarity asked for with
a chance of ``MISS`` at most.

Copies with the same shingle set are one class, whose representative has the smallest
``doc_id``; only representatives are hashed into tables. In each bucket every member is a
candidate of the bucket's smallest node; candidates are verified in rounds, the best untested
one of each node first, as long as they join components that are apart. Buckets that still hold
several components then give all pairs across them whose sizes and sketches allow the
similarity, verified in the same way. So no link that a bucket shows is lost, a group of copies
is never expanded into all its pairs, and links within a component are not tested again.

Members of a bucket of more than ``CROWD`` are bounded by their full sets first. Shingles in at
most ``RARE`` of them are rare: a pair has at most the smaller number of other shingles in common,
and the rare ones that it shares, which a join on rare shingles counts. So near copies whose own
changes keep them below the least similarity are not paired with each other, and no link is lost.

Full sets are sorted 40-bit hashes of shingles (a pair's count is off by one with a chance of
about 2e-7 at 500 shingles); they are made for documents in shared buckets alone, found by a
Bloom filter of a fixed size at most, whose false hits the joins drop.

A null, empty or (with no words) blank text has an empty set and is linked with nothing; a text
of fewer words than a shingle is one shingle; long texts are read whole; rows with the same
``doc_id`` count as one document for links, each keeping its own row; ties fall to the smaller
id; an empty table gives no rows; other columns of the input are not read.
"""

import functools
import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seekframe.llm.bloom import bloom
from seekframe.llm.common import batches, documents, forgetting, mixed, parked, runs_of, signed, word_hashes
from seekframe.llm.components import components

#: Minhashes in a sketch, and the chance with which a collection may miss a pair.
ROWS, MISS = 3, 2e-4
#: Sketches that must agree before a pair across components is verified. At the similarities
#: 0.85 and 0.8 each of 18 and of 24 agrees with a chance of 0.61 and 0.51: fewer than 4 with a
#: chance of about 1e-4.
AGREE = 4
#: Members of a bucket from which on full sets bound the pairs, and those of them that share a rare shingle at most.
CROWD, RARE = 64, 64


def side_of(least: tuple[int, int]) -> int:
    """Sketches in each collection for a least similarity."""
    agree = (least[0] / least[1]) ** ROWS
    return 1 if agree >= 1 else max(2, math.ceil(math.log(MISS) / math.log(1 - agree)))


@functools.cache
def hash_family(n: int) -> list[tuple[np.uint64, np.uint64]]:
    rng = np.random.default_rng(20)
    return [(m | np.uint64(1), a) for m, a in rng.integers(1, 2**63, (n, 2), np.uint64)]


SKETCHES = "doc_id long, n_shingles long, content binary, sketches array<long>"


def shingles(text: bytes, k: int) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles of ``k`` words in lower case."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(runs_of(word_hashes(words), min(k, len(words))))


def sketched(hashes: np.ndarray, side: int) -> np.ndarray:
    """Both collections' sketches, in a row."""
    least = np.array([scrambled(hashes * m + a).min() for m, a in hash_family(2 * side * ROWS)])
    return signed(joined_rows(least))


def scrambled(x: np.ndarray) -> np.ndarray:
    """One round of mixing; the hashes are mixed well already."""
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def joined_rows(least: np.ndarray) -> np.ndarray:
    out = np.zeros(len(least) // ROWS, np.uint64)
    for i in range(ROWS):
        out = mixed(out ^ least[i::ROWS])
    return out


def sketches(docs: DataFrame, k: int, side: int) -> DataFrame:
    def run(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in batches(found):
            sizes, contents, rows = [], [], []
            for text in texts:
                own = shingles(text, k)
                sizes.append(len(own))
                contents.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None)
                rows.append(sketched(own, side) if len(own) else None)
            columns = [pa.array(keys, pa.int64()), pa.array(sizes, pa.int64()), pa.array(contents, pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(rows, pa.list_(pa.int64()))], ["doc_id", "n_shingles", "content", "sketches"]
            )

    return docs.mapInArrow(forgetting(run), SKETCHES)


def full_sets(docs: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """Full sets of about the documents that ``nodes`` names: ``node``, ``set``."""
    named = bloom(nodes.select(F.col("node").alias("key")))

    def run(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in batches(found):
            hit = named.holds(np.asarray([key or 0 for key in keys], np.int64))
            kept = [(key, packed(shingles(t, k))) for key, t, h in zip(keys, texts, hit.tolist()) if h and key is not None]
            nodes_, sets = zip(*kept) if kept else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(nodes_, pa.int64()), pa.array(sets, pa.binary())], ["node", "set"])

    return documents(docs).mapInArrow(run, "node long, set binary")


def packed(hashes: np.ndarray) -> bytes:
    """The high 40 bits of sorted hashes, five bytes each."""
    return np.unique(hashes >> np.uint64(24)).astype(">u8").view(np.uint8).reshape(-1, 8)[:, 3:].tobytes()


def unpacked(data: bytes) -> np.ndarray:
    raw = np.zeros((len(data) // 5, 8), np.uint8)
    raw[:, 3:] = np.frombuffer(data, np.uint8).reshape(-1, 5)
    return raw.view(">u8").ravel().astype(np.uint64)


def verified(pairs: DataFrame, sets: DataFrame, least: tuple[int, int]) -> DataFrame:
    """The pairs (a, b) whose sets are as similar as asked for, by the sizes of union and intersection."""
    num, den = least

    @F.pandas_udf("boolean")
    def similar(a: pd.Series, b: pd.Series) -> pd.Series:
        out, last, left = [], None, np.empty(0, np.uint64)
        for x, y in zip(a, b):
            if x != last:
                last, left = x, unpacked(x)
            right = unpacked(y)
            both = len(np.intersect1d(left, right, assume_unique=True))
            union = len(left) + len(right) - both
            out.append(both * den >= union * num and union > 0)
        return pd.Series(out, dtype=bool)

    second = pairs.join(sets.select(F.col("node").alias("b"), F.col("set").alias("sb")), "b")
    whole = second.join(sets.select(F.col("node").alias("a"), F.col("set").alias("sa")), "a")
    return parked(whole.where(similar("sa", "sb")).select("a", "b").distinct())


def _rare(crowd: DataFrame) -> DataFrame:
    """The rare shingles of crowded nodes: ``shingle, node, version, component``."""

    def run(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for node, version, component, own in zip(*(c.to_pylist() for c in batch.columns)):
                held = signed(unpacked(own))
                same = [pa.array(np.full(len(held), x, np.int64)) for x in (node, version, component)]
                yield pa.RecordBatch.from_arrays([pa.array(held), *same], ["shingle", "node", "version", "component"])

    kind = "shingle long, node long, version long, component long"
    held = crowd.select("node", "version", "component", "set").mapInArrow(run, kind)
    # Parked, so that a shingle that all of them hold is split in the join.
    few = parked(held.groupBy("shingle").agg(F.count("*").alias("holders")).where(F.col("holders") <= RARE))
    return held.join(few.select("shingle"), "shingle")


def _crowded(left: DataFrame, sets: DataFrame, least: tuple[int, int]) -> tuple[DataFrame, DataFrame]:
    """Crowded nodes' ``size`` and ``common``, the number of their shingles that are not rare, and
    their pairs (a, b, weight) with rare shingles in common. Texts that share an id are versions of a node."""
    num, den = least
    crowd = left.where("crowded").select("node", "component").distinct().join(sets, "node")
    crowd = parked(crowd.withColumn("version", F.xxhash64("set")).dropDuplicates(["node", "version"]))
    rare = parked(_rare(crowd))
    size = (F.length("set") / 5).cast("long")
    own = rare.groupBy("node", "version").agg(F.count("*").alias("rare"))
    facts = crowd.select("node", "version", size.alias("size")).join(own, ["node", "version"], "left")
    facts = parked(facts.select("node", "version", "size", (F.col("size") - F.coalesce("rare", F.lit(0))).alias("common")))
    a, b = (rare.select("shingle", *(F.col(c).alias(c + e) for c in ("node", "version", "component"))) for e in "ab")
    shared = a.join(b, "shingle").where("componenta < componentb")
    shared = shared.groupBy("nodea", "versiona", "nodeb", "versionb").agg(F.count("*").alias("weight"))
    a, b = (facts.select(*(F.col(c).alias(c + e) for c in facts.columns)) for e in "ab")
    found = shared.join(a, ["nodea", "versiona"]).join(b, ["nodeb", "versionb"])
    enough = (F.least("commona", "commonb") + F.col("weight")) * (num + den) >= (F.col("sizea") + F.col("sizeb")) * num
    return facts.drop("version"), found.where(enough).select(F.col("nodea").alias("a"), F.col("nodeb").alias("b"), "weight")


def _apart(pairs: DataFrame, joined: DataFrame) -> DataFrame:
    """Pairs whose ends are in different components so far."""
    of = lambda end: joined.select(F.col("node").alias(end), F.col("component").alias(f"c{end}"))
    known = pairs.join(of("a"), "a", "left").join(of("b"), "b", "left")
    known = known.withColumns({f"c{e}": F.coalesce(f"c{e}", e) for e in ("a", "b")})
    return known.where("ca <> cb")


def _settled(
    pairs: DataFrame, links: DataFrame, joined: DataFrame, sets: DataFrame, least: tuple[int, int]
) -> tuple[DataFrame, DataFrame]:
    """Links and components after every pair was verified or found within one component.

    ``pairs`` is (a, b, weight). Every ``b`` tests its heaviest pair first; what is still open
    after that is tested as a whole.
    """
    opened = parked(_apart(pairs, joined).drop("ca", "cb"))
    best = opened.groupBy("b").agg(F.max(F.struct("weight", (-F.col("a")).alias("a"))).alias("best"))
    chosen = parked(best.select((-F.col("best.a")).alias("a"), "b"))
    for tested in (lambda: chosen, lambda: opened.join(chosen, ["a", "b"], "left_anti")):
        rest = parked(_apart(tested().select("a", "b"), joined).select("a", "b"))
        if rest.isEmpty():
            break
        new = verified(rest, sets, least)
        if not new.isEmpty():
            links = links.union(new)
            # Components stand for the links that made them.
            joined = components(new.union(joined.select(F.col("node").alias("a"), F.col("component").alias("b"))))
    return links, joined


def link_components(docs: DataFrame, k: int = 5, least: tuple[int, int] = (80, 100)) -> DataFrame:
    """Every row's ``doc_id``, ``n_shingles``, ``component_id`` and ``kept``.

    Documents are linked if their sets' Jaccard similarity is at least ``least``, a fraction.
    """
    num, den = least
    side = side_of(least)
    rows = parked(sketches(documents(docs), k, side))
    filled = rows.where("n_shingles > 0")
    classes = parked(filled.groupBy("content").agg(F.min("doc_id").alias("node")))
    first = filled.join(classes.select(F.col("node").alias("doc_id")).distinct(), "doc_id", "left_semi")
    first = first.select(F.col("doc_id").alias("node"), F.col("n_shingles").alias("n"), "sketches")
    keys = F.expr(
        f"transform(sequence(0, {side * side - 1}), "
        f"t -> xxhash64(t, sketches[t div {side}], sketches[{side} + t % {side}]))"
    )
    table = first.select("node", F.explode(keys).alias("key"))
    leaders = table.groupBy("key").agg(F.min("node").alias("leader"), F.max("node").alias("_last")).where("leader < _last")
    # Parked, so that a bucket that a third of all documents share is split in the join.
    leaders = parked(leaders.drop("_last"))
    members = parked(table.join(leaders, "key"))
    sets = parked(full_sets(docs, members.select("node").distinct(), k))

    # Each member and its buckets' smallest nodes, by the number of buckets they share.
    star = members.where("node <> leader").groupBy(F.col("leader").alias("a"), F.col("node").alias("b"))
    star = parked(star.agg(F.count("*").alias("weight")))
    spark = rows.sparkSession
    none = spark.createDataFrame([], "a long, b long")
    links, joined = _settled(star, none, spark.createDataFrame([], "node long, component long"), sets, least)

    # Buckets that still hold several components: what lies in different ones.
    named = members.select("key", "node").join(joined, "node", "left")
    named = named.withColumn("component", F.coalesce("component", "node"))
    several = named.groupBy("key").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), (F.count("*") > CROWD).alias("crowded")
    )
    left = parked(named.join(several.where("low < high").select("key", "crowded"), "key").join(first, "node"))
    facts, close = _crowded(left, sets, least)
    # Less than the least similarity of a node's own size in common is too little for any pair.
    left = left.join(facts, "node", "left").where(~F.col("crowded") | (F.col("common") * den >= F.col("size") * num))
    facts_of = ("node", "component", "n", "sketches", "size", "common")
    a, b = (left.select("key", *(F.col(c).alias(c + e) for c in facts_of)) for e in "ab")
    agree = F.expr("aggregate(zip_with(sketchesa, sketchesb, (x, y) -> if(x = y, 1, 0)), 0, (s, x) -> s + x)")
    # A pair meets in every table that it shares; the first of them gives its row.
    first_of = lambda low: (
        f"(array_position(transform(sequence({low}, {low + side - 1}), i -> sketchesa[i] = sketchesb[i]), true) - 1)"
    )
    i, j = first_of(0), first_of(side)
    once = F.expr(f"key = xxhash64(cast({i} * {side} + {j} as int), get(sketchesa, cast({i} as int)), get(sketchesa, cast({side} + {j} as int)))")
    # The tests stand by their cost: a pair that numbers rule out never has its sketches compared.
    across = a.join(b, "key").where(
        (F.col("componenta") < F.col("componentb"))
        & (F.least("na", "nb") * den >= F.greatest("na", "nb") * num)
        # Crowded both: without a rare shingle in common, the others have to do; with one, ``close`` has the pair.
        & F.coalesce(F.least("commona", "commonb") * (num + den) >= (F.col("sizea") + F.col("sizeb")) * num, F.lit(True))
        & (agree >= AGREE)
        & once
    )
    across = across.select(F.col("nodea").alias("a"), F.col("nodeb").alias("b"), agree.cast("long").alias("weight"))
    across = across.union(close).groupBy("a", "b").agg(F.max("weight").alias("weight"))
    tested = star.select("a", "b").union(star.select(F.col("b").alias("a"), F.col("a").alias("b")))
    _, joined = _settled(parked(across.join(tested, ["a", "b"], "left_anti")), links, joined, sets, least)

    # A row's class and component; rows that share an id are one document.
    shared = rows.join(classes, "content").where("doc_id <> node").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    final = components(shared.union(joined.select(F.col("node").alias("a"), F.col("component").alias("b"))))
    labelled = rows.join(final.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    return labelled.select(
        "doc_id",
        "n_shingles",
        F.coalesce("component", "doc_id").alias("component_id"),
        (F.coalesce("component", "doc_id") == F.col("doc_id")).alias("kept"),
    )
