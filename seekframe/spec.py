"""What a table needs to be searchable: its key, its document and its rules."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from typing import Union

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seekframe.functions.render import TEXT_TYPES

# A field is a column name or a function of an accessor: the accessor turns a
# column name into a Column, so one definition serves a table and the before and
# after images of a change feed.
Accessor = Callable[[str], Column]
Field = Union[str, Callable[[Accessor], Column]]

SOFT_FLAG = "__soft_deleted"
FULLTEXT_MODES = ("plain", "phrase", "websearch", "natural", "like")


@dataclass(frozen=True)
class SearchSpec:
    """Declaration of a searchable table.

    ``document``      field name -> column name or function; a list of names stands
                      for fields equal to columns; None means every column.
    ``metadata``      extra document columns, merged after the fields.
    ``prefix``        fields matched by prefix, ``fulltext`` fields matched by word.
    ``mode``          how full text reads the string: plain, phrase, websearch,
                      natural or like.
    ``deleted``       the column that is set when a row is soft deleted.
    ``keep_deleted``  soft-deleted rows stay in an index, flagged, when true.
    ``should_index``  row eligibility, a function of the accessor.
    ``enrich``        DataFrame -> DataFrame, run before documents are built.
    ``relevant``      fields whose change makes a saved row worth indexing again;
                      None means all of them.
    null_text         a contains search sees a null field as the text ``null``.
    """

    name: str
    key: str
    document: Mapping[str, Field] | Sequence[str] | None = None
    metadata: Mapping[str, Field] = field(default_factory=dict)
    prefix: Sequence[str] = ()
    fulltext: Sequence[str] = ()
    mode: str = "plain"
    language: str = "english"
    created: str = "created"
    deleted: str | None = None
    keep_deleted: bool = False
    should_index: Callable[[Accessor], Column] | None = None
    enrich: Callable[[DataFrame], DataFrame] | None = None
    relevant: Sequence[str] | None = None
    null_text: bool = True

    def __post_init__(self) -> None:
        if self.mode not in FULLTEXT_MODES:
            raise ValueError(f"unknown full-text mode {self.mode!r}")

    def with_(self, **changes) -> "SearchSpec":
        return replace(self, **changes)

    def fields(self, columns: Sequence[str]) -> dict[str, Field]:
        """Document fields in order; ``columns`` are used when none are declared."""
        if self.document is None:
            return {c: c for c in columns}
        if isinstance(self.document, Mapping):
            return dict(self.document)
        return {c: c for c in self.document}

    def eligible(self, c: Accessor = F.col) -> Column:
        return F.lit(True) if self.should_index is None else self.should_index(c)

    def validate(self, df: DataFrame) -> None:
        """Fail early on names the table does not have."""
        wanted = [self.key, *([self.deleted] if self.deleted else [])]
        if self.enrich is None:  # enrichment may add the columns a field reads
            wanted += [f for f in self.fields(df.columns).values() if isinstance(f, str)]
        for name in wanted:
            if column_type(df, name) is None:
                raise ValueError(f"{self.name}: no column {name!r}")
        known = self.fields(df.columns)
        for name in (*self.prefix, *self.fulltext):
            if name not in known:
                raise ValueError(f"{self.name}: {name!r} is not a document field")

    def matched_columns(self, df: DataFrame) -> list[str]:
        """Document fields a scan can match: real columns, or dotted ones."""
        return [f for f in self.fields(df.columns) if "." in f or f in df.columns]


def evaluate(spec_field: Field, c: Accessor = F.col) -> Column:
    return c(spec_field) if isinstance(spec_field, str) else spec_field(c)


def column_type(df: DataFrame, name: str) -> T.DataType | None:
    """Type of a column; a dotted name walks into structs."""
    current: T.DataType = df.schema
    for part in [name] if name in df.columns else name.split("."):
        if not isinstance(current, T.StructType) or part not in current.names:
            return None
        current = current[part].dataType
    return current


def is_text(df: DataFrame, name: str) -> bool:
    return isinstance(column_type(df, name), TEXT_TYPES)


def soft_flag(column: Column) -> Column:
    return F.when(column.isNotNull(), 1).otherwise(0).cast("int")


def document_columns(spec: SearchSpec, columns: Sequence[str], c: Accessor = F.col) -> list[Column]:
    """Fields, then metadata, then the flag and the key; a later name wins."""
    merged: dict[str, Column] = {n: evaluate(f, c) for n, f in spec.fields(columns).items()}
    for name, value in spec.metadata.items():
        merged.pop(name, None)
        merged[name] = evaluate(value, c)
    if spec.deleted and spec.keep_deleted:
        merged.pop(SOFT_FLAG, None)
        merged[SOFT_FLAG] = soft_flag(c(spec.deleted))
    merged[spec.key] = c(spec.key)
    return [value.alias(name) for name, value in merged.items()]


def has_payload(spec: SearchSpec, columns: Sequence[str], c: Accessor = F.col) -> Column:
    """True when a document has at least one field of its own (metadata aside)."""
    own = [evaluate(f, c) for n, f in spec.fields(columns).items() if n != spec.key]
    if not own or spec.key in spec.fields(columns):
        return F.lit(True)
    found = own[0].isNotNull()
    for value in own[1:]:
        found = found | value.isNotNull()
    return found


def documents(df: DataFrame, spec: SearchSpec, eligible_only: bool = True) -> DataFrame:
    """Rows of a table -> documents of its index."""
    if spec.enrich is not None:
        df = df.transform(spec.enrich)
    if eligible_only and spec.should_index is not None:
        df = df.where(spec.eligible())
    if spec.deleted and not spec.keep_deleted:
        df = df.where(F.col(spec.deleted).isNull())
    return df.where(has_payload(spec, df.columns)).select(*document_columns(spec, df.columns))
