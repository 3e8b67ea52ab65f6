"""Change feed -> index actions.

A change is ``seq, ts, op, before, after`` with row images as structs. ``op`` is
insert, update, soft_delete, hard_delete or restore.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seekframe.sources.index.store import MARK
from seekframe.spec import SearchSpec, document_columns, evaluate, has_payload

UPSERT, DELETE, SKIP = "upsert", "delete", "skip"


def _image(side: str):
    return lambda name: F.col(f"{side}.{name}")


def _image_columns(changes: DataFrame, side: str) -> list[str]:
    return changes.schema[side].dataType.names


def _eligible(spec: SearchSpec, side: str) -> Column:
    """Eligibility of an image; an image that is missing counts as eligible."""
    verdict = F.coalesce(spec.eligible(_image(side)), F.lit(False))
    return F.when(F.col(side).isNull(), F.lit(True)).otherwise(verdict)


def relevant_change(changes: DataFrame, spec: SearchSpec) -> Column:
    """Whether the fields that matter for the index differ between the images."""
    fields = spec.fields(_image_columns(changes, "after"))
    names = list(fields) if spec.relevant is None else list(spec.relevant)

    def side(name: str) -> Column:
        values = [evaluate(fields.get(n, n), _image(name)).alias(f"f{i}") for i, n in enumerate(names)]
        return F.struct(*values)

    return F.col("before").isNull() | ~side("before").eqNullSafe(side("after"))


def with_actions(changes: DataFrame, spec: SearchSpec) -> DataFrame:
    """Add ``action`` (upsert, delete or skip): each change judged by itself."""
    sync = (
        F.when(_eligible(spec, "after"), UPSERT).when(_eligible(spec, "before"), DELETE).otherwise(SKIP)
    )
    saved = F.when(relevant_change(changes, spec), sync).otherwise(SKIP)
    if spec.deleted and spec.keep_deleted:
        soft = F.when(_eligible(spec, "before"), sync).otherwise(SKIP)
    else:
        soft = F.when(_eligible(spec, "before"), DELETE).otherwise(SKIP)
    hard = F.lit(DELETE) if spec.deleted else F.when(_eligible(spec, "before"), DELETE).otherwise(SKIP)
    op = F.col("op")
    action = (
        F.when(op.isin("insert", "update"), saved)
        .when(op == "soft_delete", soft)
        .when(op == "hard_delete", hard)
        .when(op == "restore", sync)
        .otherwise(SKIP)
    )
    return changes.withColumn("action", action)


def change_key(spec: SearchSpec) -> Column:
    return F.coalesce(F.col(f"after.{spec.key}"), F.col(f"before.{spec.key}"))


def last_actions(changes: DataFrame, spec: SearchSpec) -> DataFrame:
    """One row per key: its last action that is not a skip, with the images.

    A max over (ts, seq) merges inside every task, so a key that holds a third of
    the feed is never gathered and sorted.
    """
    acted = with_actions(changes, spec).where(F.col("action") != SKIP)
    row = F.struct("action", "op", "ts", "seq", "before", "after")
    last = F.max_by(row, F.struct("ts", "seq"))
    return acted.groupBy(change_key(spec).alias("key")).agg(last.alias("last")).select("key", "last.*")


def change_mark() -> Column:
    """When a change was made: what changes of one key are ordered by."""
    return F.struct(F.col("ts").cast("timestamp").alias("ts"), F.col("seq").cast("bigint").alias("seq"))


def split_actions(last: DataFrame, spec: SearchSpec, marked: bool = False) -> tuple[DataFrame, DataFrame]:
    """Documents to write and keys to remove, from the last actions; with the changes' marks if asked for."""
    columns = _image_columns(last, "after")
    mark = [change_mark().alias(MARK)] if marked else []
    upserts = last.where(F.col("action") == UPSERT)
    if spec.enrich is not None:
        rows = upserts.select("after.*", *mark).transform(spec.enrich)
        own = [c for c in rows.columns if c != MARK]
        mark_left = [F.col(MARK)] if MARK in rows.columns else []
        docs = rows.where(has_payload(spec, own)).select(*document_columns(spec, own), *mark_left)
    else:
        c = _image("after")
        docs = upserts.where(has_payload(spec, columns, c)).select(*document_columns(spec, columns, c), *mark)
    return docs, last.where(F.col("action") == DELETE).select(F.col("key").alias(spec.key), *mark)


def final_documents(changes: DataFrame, spec: SearchSpec) -> DataFrame:
    """Documents of an index that started empty and saw the whole feed."""
    return split_actions(last_actions(changes, spec), spec)[0]
