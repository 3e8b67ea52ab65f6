"""Soft delete, forced delete and restore of table rows, and the changes they make."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seekframe.spec import SearchSpec


class NoRowsError(ValueError):
    """A delete or restore named a key the table does not have."""


@dataclass(frozen=True)
class Outcome:
    """The table afterwards, and one change per row hit (a feed for an index)."""

    table: DataFrame
    changes: DataFrame


def trashed(spec: SearchSpec) -> Column:
    """Whether a row is soft deleted."""
    if spec.deleted is None:
        return F.lit(False)
    return F.col(spec.deleted).isNotNull()


def _key_frame(df: DataFrame, key: str, keys: DataFrame | Iterable) -> DataFrame:
    dtype = df.schema[key].dataType
    if isinstance(keys, DataFrame):
        wanted = keys.select(F.col(keys.columns[0]).cast(dtype).alias("__hit_key"))
    else:
        wanted = df.sparkSession.createDataFrame(
            [(k,) for k in keys], T.StructType([T.StructField("__hit_key", dtype)])
        )
    return wanted.where(F.col("__hit_key").isNotNull()).distinct()


def _check(df: DataFrame, key: str, wanted: DataFrame) -> None:
    missing = wanted.join(df.select(key), F.col("__hit_key") == F.col(key), "left_anti").take(1)
    if missing:
        raise NoRowsError(f"no row with {key} = {missing[0][0]!r}")


def _image(df: DataFrame, **changed: Column) -> Column:
    return F.struct(*[changed.get(c, F.col(c)).alias(c) for c in df.columns])


def _changes(hit: DataFrame, at: Column, op: str, before: Column, after: Column) -> DataFrame:
    return hit.select(
        F.lit(0).cast("bigint").alias("seq"), at.alias("ts"), F.lit(op).alias("op"), before.alias("before"), after.alias("after")
    )


def _set_deleted(df, spec, keys, value: Column, at: Column, op: str, strict: bool) -> Outcome:
    if spec.deleted is None:
        raise ValueError(f"{spec.name} has no soft-delete column")
    wanted = _key_frame(df, spec.key, keys)
    if strict:
        _check(df, spec.key, wanted)
    value = value.cast(df.schema[spec.deleted].dataType)
    marked = df.join(wanted, F.col(spec.key) == F.col("__hit_key"), "left")
    changed = F.when(F.col("__hit_key").isNotNull(), value).otherwise(F.col(spec.deleted))
    columns = [changed.alias(c) if c == spec.deleted else F.col(c) for c in df.columns]
    hit = df.join(wanted, F.col(spec.key) == F.col("__hit_key"), "left_semi")
    changes = _changes(hit, at, op, _image(df), _image(df, **{spec.deleted: value}))
    return Outcome(marked.select(*columns), changes)


def delete_rows(
    df: DataFrame, spec: SearchSpec, keys: DataFrame | Iterable, at: Column | None = None, strict: bool = False
) -> Outcome:
    """Set the soft-delete column of some rows; ``strict`` fails on a missing key."""
    at = F.current_timestamp() if at is None else at
    return _set_deleted(df, spec, keys, at, at, "soft_delete", strict)


def restore_rows(
    df: DataFrame, spec: SearchSpec, keys: DataFrame | Iterable, at: Column | None = None, strict: bool = False
) -> Outcome:
    """Clear the soft-delete column of some rows."""
    at = F.current_timestamp() if at is None else at
    return _set_deleted(df, spec, keys, F.lit(None), at, "restore", strict)


def force_delete_rows(
    df: DataFrame, spec: SearchSpec, keys: DataFrame | Iterable, at: Column | None = None, strict: bool = False
) -> Outcome:
    """Remove some rows for good."""
    at = F.current_timestamp() if at is None else at
    wanted = _key_frame(df, spec.key, keys)
    if strict:
        _check(df, spec.key, wanted)
    on = F.col(spec.key) == F.col("__hit_key")
    hit = df.join(wanted, on, "left_semi")
    none = F.lit(None).cast(T.StructType(df.schema.fields))
    return Outcome(df.join(wanted, on, "left_anti"), _changes(hit, at, "hard_delete", _image(df), none))
