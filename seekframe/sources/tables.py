"""Table scans that feed a search."""

from __future__ import annotations

import os
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seekframe.operators.predicates import apply_in

# Ranges that one row stands for before they are spelled out by the task that gets it.
RANGE_BLOCK = 1_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))


def key_range(df: DataFrame, key: str, start, end) -> DataFrame:
    """Rows whose key lies in a closed range; reaches the scan as two bounds."""
    return df.where(F.col(key).between(start, end))


def by_keys(df: DataFrame, key: str, keys: Iterable | DataFrame) -> DataFrame:
    """Rows of a key list: literals when short, a semi join when long."""
    return apply_in(df, key, keys)


def key_bounds(df: DataFrame, key: str) -> DataFrame:
    return df.agg(F.min(key).alias("min_key"), F.max(key).alias("max_key"))


def contain(df: DataFrame, other: DataFrame, on: Column, name: str) -> DataFrame:
    """Inner join with an associated table, nested under ``name``.

    ``name.column`` is then an ordinary search, filter or sort column.
    """
    nested = F.struct(*[other[c] for c in other.columns]).alias(name)
    return df.join(other, on, "inner").select(*[df[c] for c in df.columns], nested)


def plan_ranges(
    df: DataFrame, key: str, chunk: int = 500, *, order: str = "asc", start: int | None = None, end: int | None = None
) -> DataFrame:
    """Key ranges of a bulk import: one row per range, made in blocks by many tasks."""
    if order not in ("asc", "desc"):
        raise ValueError("order must be asc or desc")
    size = max(1, chunk)
    lo = F.lit(start).cast("bigint") if start is not None else F.col("min_key").cast("bigint")
    hi = F.lit(end).cast("bigint") if end is not None else F.col("max_key").cast("bigint")
    bounds = key_bounds(df, key).select(lo.alias("lo"), hi.alias("hi")).where(F.col("hi") >= F.col("lo"))
    if start is None and end is None:
        bounds = bounds.where((F.col("lo") >= 1) & (F.col("hi") >= 1))
    count = F.ceil((F.col("hi") - F.col("lo") + 1) / F.lit(size)).cast("bigint")
    # Two steps, so that no single row or task holds the whole list of ranges.
    zero = F.lit(0).cast("bigint")
    blocks = bounds.select(
        "lo", "hi", count.alias("count"), F.explode(F.sequence(zero, F.floor((count - 1) / RANGE_BLOCK))).alias("block")
    )
    blocks = blocks.repartition("block")  # deal the blocks out to all tasks
    at = F.col("block") * RANGE_BLOCK
    steps = blocks.select(
        "lo", "hi", F.explode(F.sequence(at, F.least(at + RANGE_BLOCK, F.col("count")) - 1)).alias("n")
    )
    first = F.col("lo") + F.col("n") * size
    last = F.col("hi") - F.col("n") * size
    if order == "asc":
        return steps.select(
            F.col("n").alias("range_no"), first.alias("start"), F.least(first + size - 1, F.col("hi")).alias("end")
        )
    return steps.select(
        F.col("n").alias("range_no"), F.greatest(last - size + 1, F.col("lo")).alias("start"), last.alias("end")
    )
