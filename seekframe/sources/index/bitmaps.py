"""Bitmaps of void documents, by source segment and chunk of ordinals.

A document is known by the segment it was first written in and its ordinal there. A
row holds the bits of 32,768 ordinals as 512 words of 64; a commit writes rows only
for the chunks in which it voids something.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK_BITS, WORD_BITS = 15, 6
WORDS = 1 << (CHUNK_BITS - WORD_BITS)
VOIDS = "of string, chunk long, words array<long>"
#: Chunks that are sent to every task (4 KB each, 64 MB in all); more are joined by an exchange.
MAX_SENT = 16_384


def chunk_of(ordinal: Column) -> Column:
    return F.shiftright(ordinal, CHUNK_BITS)


def _word_of(ordinal: Column) -> Column:
    return F.shiftright(ordinal, WORD_BITS).bitwiseAND(F.lit(WORDS - 1)).cast("int")


def bitmaps(documents: DataFrame, source: str, ordinal: str) -> DataFrame:
    """The documents' bits: ``of, chunk, words``."""
    at = F.col(ordinal)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(63)).cast("int"))
    words = documents.groupBy(F.col(source).alias("of"), chunk_of(at).alias("chunk"), _word_of(at).alias("word")).agg(
        F.bit_or(bit).alias("bits")
    )
    some = words.groupBy("of", "chunk").agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("m"))
    every = F.transform(F.sequence(F.lit(0), F.lit(WORDS - 1)), lambda i: F.coalesce(F.col("m")[i], F.lit(0).cast("long")))
    return some.select("of", "chunk", every.alias("words"))


def merged(voids: DataFrame) -> DataFrame:
    """One row for each chunk: the bits of all its rows."""
    zero = F.array_repeat(F.lit(0).cast("long"), WORDS)
    either = F.aggregate("all", zero, lambda a, b: F.zip_with(a, b, lambda x, y: x.bitwiseOR(y)))
    return voids.groupBy("of", "chunk").agg(F.collect_list("words").alias("all")).select("of", "chunk", either.alias("words"))


def without_void(df: DataFrame, voids: DataFrame, source: str, ordinal: str, small: bool) -> DataFrame:
    """The rows whose document is not void. ``small`` bitmaps go to every task, so the rows stay where they are."""
    at = F.col(ordinal)
    bits = voids.select(F.col("of").alias("__of"), F.col("chunk").alias("__chunk"), F.col("words").alias("__words"))
    same = (F.col(source) == F.col("__of")) & (chunk_of(at) == F.col("__chunk"))
    void = F.getbit(F.get("__words", _word_of(at)), at.bitwiseAND(F.lit(63)).cast("int")) == 1
    joined = df.join(F.broadcast(bits) if small else bits, same, "left")
    return joined.where(F.col("__words").isNull() | ~void).select(*df.columns)
