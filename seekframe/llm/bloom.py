"""A Bloom filter of 64-bit keys, of bounded size, built by Spark and probed by Python workers."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seekframe.llm.common import mixed

#: Bits for each key, and bits at most (16 MB): beyond it more keys pass falsely, none is lost.
PER_KEY, MOST = 16, 1 << 27
PROBES = 3


def places(keys: np.ndarray, bits: int) -> np.ndarray:
    """The bits of each key, one row a key."""
    keys = keys.astype(np.int64).view(np.uint64)
    return np.stack([mixed(keys + np.uint64(i * 0x9E3779B97F4A7C15 & 2**64 - 1)) % np.uint64(bits) for i in range(PROBES)], axis=1)


class Bloom:
    def __init__(self, words: np.ndarray):
        self.words = words

    def holds(self, keys: np.ndarray) -> np.ndarray:
        at = places(keys, len(self.words) * 64)
        return ((self.words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).all(axis=1)


def bloom(keys: DataFrame) -> Bloom:
    """A filter of the column ``key``. Its words, bounded by ``MOST``, are all that the driver sees."""
    n = keys.count()
    bits = min(MOST, 1 << max(10, (n * PER_KEY).bit_length()))

    def run(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            at = places(batch.column("key").to_numpy(zero_copy_only=False), bits).ravel()
            word, where = np.unique(at >> np.uint64(6), return_inverse=True)
            own = np.zeros(len(word), np.uint64)
            np.bitwise_or.at(own, where, np.uint64(1) << (at & np.uint64(63)))
            yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(own.view(np.int64))], ["word", "bits"])

    found = keys.select("key").mapInArrow(run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    words = np.zeros(bits // 64, np.uint64)
    rows = found.toPandas()
    words[rows["word"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64).view(np.uint64)
    return Bloom(words)
