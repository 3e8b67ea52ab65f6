"""Field constraints -> typed Columns and joins."""

from __future__ import annotations

import datetime as dt
import decimal
from collections.abc import Iterable, Sequence
from enum import Enum
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seekframe.functions.render import TEXT_TYPES
from seekframe.spec import column_type

# Spellings of an operator.
OPERATORS = {
    "=": "=", "eq": "=", "==": "=",
    "!=": "!=", "<>": "!=", "neq": "!=",
    ">": ">", ">=": ">=", "<": "<", "<=": "<=",
    "like": "like", "not like": "not like", "ilike": "ilike",
    "is": "=", "is not": "!=",
}

LIKE_ESCAPE = "!"
# A longer list of values becomes a join, so that a plan never carries it; both read values alike.
MAX_LITERALS = 1000

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_RANGES = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}


def like_pattern(text: str) -> str:
    """A user pattern whose backslash is a plain character."""
    return text.replace(LIKE_ESCAPE, LIKE_ESCAPE * 2)


def literal_pattern(text: str) -> str:
    """A user string whose ``%`` and ``_`` are plain characters too."""
    return like_pattern(text).replace("%", LIKE_ESCAPE + "%").replace("_", LIKE_ESCAPE + "_")


def like(column: Column, pattern: str) -> Column:
    return F.like(column, F.lit(pattern), F.lit(LIKE_ESCAPE))


def ilike(column: Column, pattern: str) -> Column:
    return F.ilike(column, F.lit(pattern), F.lit(LIKE_ESCAPE))


def typed(value: Any, dtype: T.DataType) -> Column:
    """A literal of the column's own type, so the comparison can reach the scan."""
    if isinstance(value, Enum):
        value = value.value
    if isinstance(dtype, TEXT_TYPES):
        return F.lit(("true" if value else "false") if isinstance(value, bool) else str(value))
    if isinstance(dtype, T.BooleanType):
        if isinstance(value, str):
            return F.lit(value.strip().lower() in ("1", "true"))
        return F.lit(bool(value))
    if isinstance(value, bool):
        value = int(value)
    if isinstance(value, str) and isinstance(dtype, T.NumericType):
        value = _number(value)
    if isinstance(dtype, _WHOLE) and isinstance(value, int):
        bits = _RANGES[type(dtype)]
        if -(2 ** (bits - 1)) <= value < 2 ** (bits - 1):
            return F.lit(value).cast(dtype)
        return F.lit(float(value))
    if isinstance(dtype, T.DoubleType) and isinstance(value, (int, float)):
        return F.lit(float(value))
    if isinstance(value, str) and isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.lit(value).cast(dtype)
    if isinstance(value, (dt.datetime, dt.date)):
        return F.lit(value).cast(dtype)
    return F.lit(value)


def _number(text: str) -> int | float:
    try:
        return int(text)
    except ValueError:
        return float(text)


def compare(df: DataFrame, name: str, operator: str, value: Any) -> Column:
    """One constraint. Null compares as IS [NOT] NULL."""
    op = OPERATORS.get(operator.strip().lower())
    if op is None:
        raise ValueError(f"operator {operator!r} is not supported")
    dtype = column_type(df, name)
    if dtype is None:
        raise ValueError(f"no column {name!r} to filter on")
    column = F.col(name)
    if value is None:
        if op == "=":
            return column.isNull()
        if op == "!=":
            return column.isNotNull()
        return F.lit(None).cast("boolean")
    if op == "like":
        return like(column.cast("string"), like_pattern(str(value)))
    if op == "not like":
        return ~like(column.cast("string"), like_pattern(str(value)))
    if op == "ilike":
        return ilike(column.cast("string"), like_pattern(str(value)))
    try:
        right = typed(value, dtype)
    except ValueError:
        # As in a list: what the column's type cannot hold equals nothing; it has no order either.
        if op not in ("=", "!="):
            raise ValueError(f"{value!r} cannot be ordered among the values of {name!r}") from None
        return F.lit(False) if op == "=" else column.isNotNull()
    return {
        "=": lambda: column == right,
        "!=": lambda: column != right,
        ">": lambda: column > right,
        ">=": lambda: column >= right,
        "<": lambda: column < right,
        "<=": lambda: column <= right,
    }[op]()


def apply_wheres(df: DataFrame, wheres: Sequence[tuple[str, str, Any]]) -> DataFrame:
    """AND of all constraints as one filter."""
    parts = [compare(df, *w) for w in wheres]
    return df.where(reduce(and_, parts)) if parts else df


class _Unfit(Exception):
    """A value that no value of the column's type can equal."""


def _plain(value: Any, dtype: T.DataType) -> tuple[Any, T.DataType]:
    """A list's value and the type in which it is compared, by one rule for lists of any length."""
    if isinstance(value, Enum):
        value = value.value
    if isinstance(dtype, TEXT_TYPES):
        return ("true" if value else "false") if isinstance(value, bool) else str(value), T.StringType()
    if isinstance(dtype, T.BooleanType):
        return value.strip().lower() in ("1", "true") if isinstance(value, str) else bool(value), dtype
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return value.isoformat(" ") if isinstance(value, dt.datetime) else str(value), T.StringType()
    if not isinstance(dtype, T.NumericType):
        return value, dtype
    try:
        number = _number(value) if isinstance(value, str) else int(value) if isinstance(value, bool) else value
    except ValueError:
        raise _Unfit from None
    if isinstance(dtype, _WHOLE):
        bits = _RANGES[type(dtype)]
        if number != number or number in (float("inf"), float("-inf")) or number != int(number):
            raise _Unfit
        if not -(2 ** (bits - 1)) <= number < 2 ** (bits - 1):
            raise _Unfit
        return int(number), dtype
    if isinstance(dtype, T.DecimalType):
        exact = decimal.Decimal(str(number))
        if not exact.is_finite():
            raise _Unfit
        whole = exact.quantize(decimal.Decimal(1).scaleb(-dtype.scale), context=decimal.Context(prec=80))
        if whole != exact or len(whole.as_tuple().digits) > dtype.precision:
            raise _Unfit
        return whole, dtype
    return float(number), T.DoubleType()


def _fitting(values: list, dtype: T.DataType) -> tuple[list, T.DataType]:
    """The values that the column could equal, and the type they are compared in; nulls are left out."""
    found, kind = [], dtype
    for value in values:
        if value is not None:
            try:
                plain, kind = _plain(value, dtype)
            except _Unfit:
                continue
            found.append(plain)
    return found, kind


def _compared(name: str, dtype: T.DataType) -> Column:
    """The column as list values are compared with it: fractions as doubles, all else as it is."""
    wide = isinstance(dtype, T.FractionalType) and not isinstance(dtype, T.DecimalType)
    return F.col(name).cast("double") if wide and not isinstance(dtype, T.DoubleType) else F.col(name)


def _dated(value: Column, dtype: T.DataType, kind: T.DataType) -> Column:
    """A text value of a date or time column; null if it is not one."""
    return value.try_cast(dtype) if isinstance(kind, T.StringType) and not isinstance(dtype, TEXT_TYPES) else value


def _value_frame(df: DataFrame, values: list, dtype: T.DataType, kind: T.DataType) -> DataFrame:
    schema = T.StructType([T.StructField("__value", kind)])
    frame = df.sparkSession.createDataFrame([(v,) for v in values], schema)
    return frame.select(_dated(F.col("__value"), dtype, kind).alias("__value")).where("__value IS NOT NULL").distinct()


def _listed(df: DataFrame, name: str, values: list, dtype: T.DataType, kind: T.DataType) -> Column:
    """Membership as literals; null only where the column is."""
    items = [_dated(F.lit(v).cast(kind), dtype, kind) for v in values]
    found = _compared(name, dtype).isin(items)
    dated = isinstance(kind, T.StringType) and not isinstance(dtype, TEXT_TYPES)
    return F.when(F.col(name).isNotNull(), F.coalesce(found, F.lit(False))) if dated else found


def apply_in(df: DataFrame, name: str, values: Iterable | DataFrame) -> DataFrame:
    """Keep rows whose value is in the list. A list may be a one-column DataFrame.

    A listed value that the column's type cannot hold equals nothing.
    """
    if isinstance(values, DataFrame):
        # Distinct values: a value that fills the list is merged before it is sent.
        wanted = values.select(F.col(values.columns[0]).alias("__value")).distinct()
        return df.join(wanted, F.col(name) == F.col("__value"), "left_semi")
    dtype = _require(df, name)
    listed, kind = _fitting(list(values), dtype)
    if not listed:
        return df.where(F.lit(False))
    if len(listed) <= MAX_LITERALS:
        return df.where(_listed(df, name, listed, dtype, kind))
    return df.join(_value_frame(df, listed, dtype, kind), _compared(name, dtype) == F.col("__value"), "left_semi")


def apply_not_in(df: DataFrame, name: str, values: Iterable | DataFrame) -> DataFrame:
    """Drop rows whose value is in the list; a null value is dropped as in SQL."""
    if isinstance(values, DataFrame):
        raw = values.select(F.col(values.columns[0]).alias("__value"))
        # SQL: nothing is NOT IN a list with a null, everything is NOT IN an empty one,
        # and otherwise every value that is not null is looked up.
        n, filled = F.count(F.lit(1)), F.count("__value")
        lowest = raw.agg(F.when(n == 0, 0).when(n == filled, 1).otherwise(2).alias("lowest")).scalar()
        kept = df.where(F.when(F.col(name).isNotNull(), 1).otherwise(0) >= lowest)
        return kept.join(raw.distinct(), F.col(name) == F.col("__value"), "left_anti")
    given = list(values)
    dtype = _require(df, name)
    if not given:
        return df
    if any(v is None for v in given):
        return df.where(F.lit(False))
    listed, kind = _fitting(given, dtype)
    if not listed:
        return df.where(F.col(name).isNotNull())
    if len(listed) <= MAX_LITERALS:
        return df.where(~_listed(df, name, listed, dtype, kind))
    kept = df.where(F.col(name).isNotNull())
    return kept.join(_value_frame(df, listed, dtype, kind), _compared(name, dtype) == F.col("__value"), "left_anti")


def _require(df: DataFrame, name: str) -> T.DataType:
    dtype = column_type(df, name)
    if dtype is None:
        raise ValueError(f"no column {name!r} to filter on")
    return dtype


def apply_trashed(df: DataFrame, mode: str, deleted: str | None, flag: str | None) -> DataFrame:
    """exclude, include or only soft-deleted rows, by table column or by index flag."""
    if mode not in ("exclude", "include", "only"):
        raise ValueError(f"unknown trashed mode {mode!r}")
    if mode == "include" or (deleted is None and flag is None):
        return df
    gone = F.col(flag) == 1 if flag is not None else F.col(deleted).isNotNull()
    return df.where(gone if mode == "only" else ~gone)
