"""A table laid out for substring searches: three-letter grams of blocks of rows.

The rows are written in blocks, and beside them which grams each block holds, sorted by
gram. A search string's grams choose the blocks that can hold it; the scan skips the
rest, and the search itself still tests every row it reads.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seekframe.functions.render import render_text
from seekframe.spec import SearchSpec, evaluate

#: Letters of a gram; rows of a block, as bits of a row's number; bytes of a row group.
GRAM, BLOCK_BITS, ROW_GROUP = 3, 10, 4 << 20
BLOCK = "__block"
#: Rows whose texts a task's worker holds at a time.
BATCH_ROWS = 256
#: Blocks that are named to the reader one by one; more are joined.
LISTED = 1_000
#: Letters beyond these may have more than one written form; grams with them choose nothing.
PLAIN = "ɐ"


def grams_of(text: str) -> list[str]:
    """Distinct grams of a search string that every block with it must hold."""
    low = text.lower()
    found = dict.fromkeys(low[i : i + GRAM] for i in range(len(low) - GRAM + 1))
    return [g for g in found if max(g) < PLAIN]


def cutter(gram: int = GRAM) -> Callable[[Iterable], Iterator]:
    """A task's work: the distinct grams of each run of rows of one block, ``block, text`` to ``block, gram``.

    A gram's letters are one number, so that those of many rows are sorted at once. It knows nothing
    of this package, as it is sent to the tasks by value.
    """

    def cut(found: Iterable) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def numbers(texts: list[bytes]) -> np.ndarray:
            each = []
            for text in texts:
                letters = np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le"), np.uint32).astype(np.uint64)
                own = letters[: max(len(letters) - gram + 1, 0)]
                for i in range(1, gram):
                    own = own << np.uint64(21) | letters[i : i + len(own)]
                each.append(own)
            return np.unique(np.concatenate(each))

        def rows(block: int, parts: list[np.ndarray]) -> pa.RecordBatch:
            own = np.unique(np.concatenate(parts)) if len(parts) > 1 else parts[0]
            letters = [own >> np.uint64(21 * (gram - 1 - i)) & np.uint64((1 << 21) - 1) for i in range(gram)]
            shown = np.stack(letters, axis=1).astype("<u4").tobytes().decode("utf-32-le")
            grams = pa.array([shown[i : i + gram] for i in range(0, len(shown), gram)], pa.string())
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(own), block), pa.int64()), grams], ["__block", "gram"])

        last, held = None, []
        for batch in found:
            blocks = batch.column(0).to_numpy(zero_copy_only=False)
            texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            edges = [0, *(np.flatnonzero(blocks[1:] != blocks[:-1]) + 1).tolist(), len(blocks)]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                if blocks[a] != last and held:
                    yield rows(last, held)
                    held = []
                last = int(blocks[a])
                held.append(numbers(texts[a:b]))
        if held:
            yield rows(last, held)

    return cut


class GramTable:
    """Rows and grams below one folder; ``containing`` and ``like`` are supersets of what a search of that string finds."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    @classmethod
    def build(cls, df: DataFrame, spec: SearchSpec, path: str, block_bits: int = BLOCK_BITS, row_group: int = ROW_GROUP) -> "GramTable":
        """Write a table's rows, and the grams of its document fields as they are shown to a search."""
        made = cls(df.sparkSession, path)
        numbered = df.withColumn(BLOCK, F.shiftright(F.monotonically_increasing_id(), block_bits))
        numbered.write.option("parquet.block.size", row_group).parquet(f"{made.path}/rows")
        rows = made._rows()
        values = [evaluate(field) for field in spec.fields(df.columns).values()]
        kinds = rows.select(*[v.alias(f"v{i}") for i, v in enumerate(values)]).schema
        shown = F.concat_ws("\n", *[render_text(v, k.dataType, null_text=True) for v, k in zip(values, kinds)])
        each = rows.select(BLOCK, F.lower(shown).alias("text")).mapInArrow(cutter(), f"{BLOCK} long, gram string")
        # A block that two tasks read has its grams twice.
        each = each.distinct()
        name = "spark.sql.execution.arrow.maxRecordsPerBatch"
        before = df.sparkSession.conf.get(name)
        df.sparkSession.conf.set(name, str(BATCH_ROWS))
        try:
            each.repartitionByRange("gram", BLOCK).sortWithinPartitions("gram", BLOCK).write.parquet(f"{made.path}/grams")
        finally:
            df.sparkSession.conf.set(name, before)
        return made

    def _rows(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/rows")

    def rows(self) -> DataFrame:
        """All rows."""
        return self._rows().drop(BLOCK)

    def containing(self, text: str) -> DataFrame:
        """Rows of the blocks that can hold a string, whatever its case."""
        return self._chosen(grams_of(text))

    def like(self, pattern: str) -> DataFrame:
        """Rows of the blocks that can hold a match of a LIKE pattern: each part between wildcards is looked for."""
        return self._chosen([g for part in re.split("[%_]+", pattern) for g in grams_of(part)])

    def blocks(self, grams: Sequence[str]) -> DataFrame:
        """Blocks that hold all of some grams."""
        wanted = list(dict.fromkeys(grams))
        found = self.spark.read.parquet(f"{self.path}/grams").where(F.col("gram").isin(wanted))
        return found.groupBy(BLOCK).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == len(wanted)).select(BLOCK)

    def _chosen(self, grams: Sequence[str]) -> DataFrame:
        if not grams:
            return self.rows()
        blocks = self.blocks(grams)
        some = [r[0] for r in blocks.limit(LISTED + 1).collect()]
        rows = self._rows()
        chosen = rows.where(F.col(BLOCK).isin(some)) if len(some) <= LISTED else rows.join(blocks, BLOCK, "left_semi")
        return chosen.drop(BLOCK)
