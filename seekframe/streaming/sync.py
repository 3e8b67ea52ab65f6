"""Keep an index in step with a change feed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from seekframe.audit import Audit
from seekframe.session import shared_dir
from seekframe.sources.index import Catalog, Index
from seekframe.sources.index.manifest import Files
from seekframe.spec import SearchSpec
from seekframe.streaming.changes import change_mark, last_actions, split_actions


def apply_changes(
    index: Index, changes: DataFrame, spec: SearchSpec, batch: tuple[str, int] | None = None, ordered: bool = True
) -> Index:
    """Write the outcome of a set of changes as one commit.

    A key keeps the ``ts`` and ``seq`` of its last change, also when that removed it, and a change
    that comes late loses against it; without ``ordered`` the set that is written last wins.
    """
    held = index.manifest.paused
    # A pause holds back saves and deletes; a restore passes it.
    passing = changes.where(F.col("op") == "restore") if held else changes
    last = last_actions(passing, spec)
    # Read for the writes and for the deletes: kept in the shared folder, not on executors.
    path = shared_dir(index.spark)
    last.write.parquet(path)
    kept = index.spark.read.schema(last.schema).parquet(path)
    if ordered and index.manifest.schema is not None:
        kept = index.newer(kept, change_mark())
    docs, keys = split_actions(kept, spec, marked=True)
    try:
        return index.commit(docs=docs, delete_keys=keys, batch=batch, operation="sync", while_paused=held)
    finally:
        Files(index.spark, path).remove("")


def sync_stream(
    changes: DataFrame,
    catalog: Catalog,
    name: str,
    spec: SearchSpec,
    checkpoint: str,
    *,
    stream: str = "changes",
    compact_after: int | None = None,
    audit: Audit | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start the sync of a streaming change feed.

    A micro-batch can run more than once; the manifest remembers the last batch
    of each stream, so a repeated one changes nothing. While the index is paused
    its changes, restores aside, are dropped. An index of more than ``compact_after`` segments has
    its small ones merged; without it, run ``index.merge()`` as a job of its own now and then.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        index = catalog.open(name)
        after = apply_changes(index, batch, spec, (stream, batch_id))
        if audit is not None and after.manifest.last_commit is not index.manifest.last_commit:
            audit.write_performed(after)
        if compact_after is not None and len(after.manifest.segments) > compact_after:
            after.merge(max(2, compact_after))

    writer = changes.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
