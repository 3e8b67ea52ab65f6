"""Records of searches and index writes, kept as append-only Parquet tables.

Nothing is measured unless an ``Audit`` is used.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seekframe.plans.paging import Page
from seekframe.plans.search import Search
from seekframe.session import shared_dir
from seekframe.sources.index import Index
from seekframe.sources.index.manifest import Files

# Fixed value: keys kept with one search, unless asked otherwise.
KEPT_KEYS = 50

SEARCH_SCHEMA = (
    "at TIMESTAMP, operation STRING, index STRING, strategy STRING, query STRING, "
    "filters ARRAY<STRUCT<field: STRING, op: STRING, value: STRING>>, "
    "sorted ARRAY<STRUCT<field: STRING, way: STRING>>, limited INT, "
    "found STRUCT<total: BIGINT, keys: ARRAY<STRING>, cut: BOOLEAN>, "
    "shown STRUCT<page: INT, size: INT>, duration_ms DOUBLE"
)
WRITE_SCHEMA = (
    "at TIMESTAMP, operation STRING, index STRING, segment STRING, fingerprint STRING, "
    "changed STRUCT<asked: BIGINT, written: BIGINT, removed: BIGINT>, duration_ms DOUBLE"
)
KEY_SCHEMA = "index STRING, segment STRING, op STRING, key STRING"


class Audit:
    """Records below a folder; ``kept_keys`` is how many keys a search record lists."""

    def __init__(self, spark: SparkSession, path: str, kept_keys: int = KEPT_KEYS):
        self.spark = spark
        self.path = path
        self.kept_keys = kept_keys
        self._files = Files(spark, path)

    # ---- searches -------------------------------------------------------

    def search(self, s: Search) -> DataFrame:
        """Run a search once, record it and return its rows.

        The rows are written to the shared folder in order; the record and the
        caller read them there, so that the duration is the search's own.
        """
        rows, taken = self._run(s.get())
        self._search_performed(s, "search", rows.count(), rows, taken, None)
        return rows

    def paginate(self, s: Search, per_page: int | None = None, page: int | None = None) -> Page:
        result = s.paginate(per_page, page)
        rows, taken = self._run(result.rows)
        started = time.monotonic()
        info = result.info.first()
        taken += (time.monotonic() - started) * 1000
        self._search_performed(s, "paginate", info["total_count"], rows, taken, (info["current_page"], info["per_page"]))
        return Page(rows, self.spark.createDataFrame([info], result.info.schema))

    def _run(self, rows: DataFrame) -> tuple[DataFrame, float]:
        path, started = shared_dir(self.spark), time.monotonic()
        placed = rows.withColumn("__place", F.monotonically_increasing_id())
        placed.write.parquet(path)
        taken = (time.monotonic() - started) * 1000
        return self.spark.read.schema(placed.schema).parquet(path).orderBy("__place").drop("__place"), taken

    def _search_performed(self, s: Search, operation: str, total: int, rows: DataFrame, taken: float, shown) -> None:
        listed = [str(r[0]) for r in rows.select(s.spec.key).limit(self.kept_keys + 1).collect()]
        filters = [(name, op, None if value is None else str(value)) for name, op, value in s.wheres]
        for op, lists in (("in", s.where_ins), ("not in", s.where_not_ins)):
            filters += [(name, op, _written(values)) for name, values in lists.items()]
        record = (
            datetime.now(timezone.utc),
            operation,
            s.index.manifest.name if s.index is not None else s.spec.name,
            s.strategy,
            s.query,
            filters,
            list(s.orders),
            s.limit,
            (total, listed[: self.kept_keys], len(listed) > self.kept_keys),
            shown,
            taken,
        )
        self._append("searches", SEARCH_SCHEMA, record)

    # ---- writes ---------------------------------------------------------

    def write(self, action: Callable[[], Index]) -> Index:
        """Run an index write, ``audit.write(lambda: index.write(docs))``, and record it."""
        started = time.monotonic()
        index = action()
        self.write_performed(index, (time.monotonic() - started) * 1000)
        return index

    def write_performed(self, index: Index, duration_ms: float | None = None) -> None:
        """Record the last commit; every key of it goes to the table of keys."""
        commit = index.manifest.last_commit or {}
        segment = commit.get("segment")
        if segment is not None:
            changed = index.changes().where(F.col("seg") == segment)
            keys = changed.select(F.lit(index.manifest.name).alias("index"), F.lit(segment).alias("segment"), "op", F.col("key").cast("string"))
            keys.write.mode("append").parquet(f"{self.path}/keys")
        record = (
            datetime.now(timezone.utc),
            commit.get("operation"),
            index.manifest.name,
            segment,
            commit.get("fingerprint"),
            (commit.get("count"), commit.get("written"), commit.get("removed")),
            duration_ms,
        )
        self._append("writes", WRITE_SCHEMA, record)

    # ---- reports --------------------------------------------------------

    def searches(self) -> DataFrame:
        return self._read("searches", SEARCH_SCHEMA)

    def writes(self) -> DataFrame:
        return self._read("writes", WRITE_SCHEMA)

    def written_keys(self) -> DataFrame:
        """``index, segment, op, key``: all keys of all recorded writes."""
        return self._read("keys", KEY_SCHEMA)

    def counts(self) -> DataFrame:
        """Searches and writes by index and operation."""
        both = self.searches().select("index", "operation").unionByName(self.writes().select("index", "operation"))
        return both.groupBy("index", "operation").agg(F.count(F.lit(1)).alias("n"))

    def _append(self, name: str, schema: str, record: tuple) -> None:
        self.spark.createDataFrame([record], schema).write.mode("append").parquet(f"{self.path}/{name}")

    def _read(self, name: str, schema: str) -> DataFrame:
        if not self._files.exists(name):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")


def _written(values) -> str:
    return "DataFrame" if isinstance(values, DataFrame) else ", ".join(map(str, values))
