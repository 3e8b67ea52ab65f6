"""What the operators share: reading, parked tables, Arrow batches, word hashes."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seekframe.session import configure, shared_dir

#: Rows of an Arrow batch that goes to a Python worker; it bounds a worker's memory by rows,
#: and a batch always holds whole texts.
BATCH_ROWS = 256


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the settings that the operators rely on."""
    configure(spark)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{folder}/{name}.parquet")


def parked(df: DataFrame) -> DataFrame:
    """The rows written below the shared checkpoint folder and read again.

    This cuts the lineage: a lost executor costs the running stage only.
    """
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Key and text alone, whatever other columns the table has; a null text is empty."""
    return df.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def batches(found: Iterable[pa.RecordBatch], text: str = "text") -> Iterator[tuple[list, list[bytes]]]:
    """Keys and UTF-8 texts of Arrow batches; a null text is empty."""
    for batch in found:
        texts = batch.column(text)
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        as_bytes = texts.cast(pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary())
        yield batch.column("doc_id").to_pylist(), [t or b"" for t in as_bytes.to_pylist()]


def word_hashes(words: list[bytes], seed: int = 0) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer, applied to each element."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def runs_of(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of ``width`` consecutive elements."""
    if len(hashes) < width:
        return np.empty(0, np.uint64)
    n = len(hashes) - width + 1
    out = np.zeros(n, np.uint64)
    for i in range(width):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + n]
    return mixed(out)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def forgetting(run: Callable, *memories: Callable[[], dict]) -> Callable:
    """A task's work after which its worker's memories are empty and their room is given back.

    Workers outlive tasks, and stages share an executor: what one stage remembers is room that the next lacks.
    """

    def task(found: Iterable) -> Iterator:
        try:
            yield from run(found)
        finally:
            for memory in memories:
                memory().clear()
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return task
