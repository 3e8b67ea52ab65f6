"""Order-independent identity of a set of keys, used to name a write batch."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_hash(key: Column) -> Column:
    """First 15 hex digits of the key's md5 as a number."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 15), 16, 10).cast("bigint")


def batch_fingerprint(df: DataFrame, key: str) -> DataFrame:
    """One row ``n_keys, fingerprint``: equal for equal key sets in any order.

    Count and xor merge across tasks, so no task ever holds the key list.
    """
    seen = df.agg(F.count(F.col(key)).alias("n_keys"), F.bit_xor(key_hash(F.col(key))).alias("x"))
    text = F.concat_ws(":", F.col("n_keys").cast("string"), F.coalesce(F.col("x"), F.lit(0)).cast("string"))
    return seen.select("n_keys", F.md5(text).alias("fingerprint"))


def fingerprint(n_keys: int, xor: int) -> str:
    """The same from counts that are already known."""
    return hashlib.md5(f"{n_keys}:{xor}".encode()).hexdigest()


def unix_seconds(value: Column) -> Column:
    return F.unix_timestamp(value)
