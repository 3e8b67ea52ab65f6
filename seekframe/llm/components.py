"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seekframe.llm.common import parked

#: Rounds at most; each about halves the longest way to a component's smallest node.
ROUNDS = 60
#: Edges that a task writes, about, and tasks at least and at most: a round on few edges writes few files,
#: whatever the session's number of partitions; one on many is left to that number.
TASK_EDGES, LEAST_TASKS, MOST_TASKS = 20_000, 6, 32


def _state(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def _gathered(df: DataFrame, edges: int) -> DataFrame:
    # An exchange, not a coalesce: a task would hold the memory of all partitions that it takes over.
    tasks = max(LEAST_TASKS, -(-edges // TASK_EDGES))
    return df.repartition(tasks) if tasks <= MOST_TASKS else df


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node it reaches, for every node of ``links`` (a, b).

    Each round sends a node's larger neighbours to its smallest one, then its smaller ones; a
    node's neighbours are merged by a minimum before they are shuffled and joined back, never
    collected. Links of a node with itself add nothing. The edges are parked after each round.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = parked(edges)
    before = _state(edges)
    for _ in range(ROUNDS):
        if not before[0]:
            break
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Smallest neighbours are parked, so that the hub of a large component is split in the join.
        least = parked(_gathered(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), 2 * before[0]))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = parked(_gathered(small.union(least.select("u", F.col("m").alias("v"))).distinct(), before[0]))
        now = _state(edges)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    found = edges.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return parked(_gathered(found.union(roots.join(found, "node", "left_anti")), 2 * before[0]))
