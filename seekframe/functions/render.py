"""Text form of a document value, the one a contains search looks into."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

TEXT_TYPES = (T.StringType, T.VarcharType, T.CharType)
_NESTED = (T.StructType, T.ArrayType, T.MapType)


def _fraction(value: Column) -> Column:
    """Shortest text of a float at 14 significant digits, whole numbers bare."""
    scientific = F.format_string("%.13e", value)
    rounded = scientific.cast("double")
    plain = F.regexp_replace(rounded.cast("decimal(38,18)").cast("string"), r"\.?0+$", "")
    mantissa = F.regexp_replace(F.regexp_extract(scientific, r"^(-?\d\.\d+?)0*e", 1), r"\.$", ".0")
    short = value.cast("string")
    sign = F.regexp_extract(scientific, r"e([+-])", 1)
    power = F.regexp_extract(scientific, r"e[+-]0*(\d+)$", 1)
    size = F.abs(rounded)
    return (
        F.when(value.isNull(), F.lit(None).cast("string"))
        # Nearly all values: few digits, and plain text at once.
        .when(
            (F.length(short) <= 15) & ~short.contains("E") & short.contains(".") & (value != 0),
            F.when(short.endswith(".0"), F.substring(short, F.lit(1), F.length(short) - 2)).otherwise(short),
        )
        .when(F.isnan(value), "NAN")
        .when(size == F.lit(float("inf")), F.when(value > 0, "INF").otherwise("-INF"))
        .when(value == 0, "0")
        .when((size >= 1e-4) & (size < 1e15), plain)
        .otherwise(F.concat(mantissa, F.lit("E"), sign, power))
    )


def may_contain(needle: str, dtype: T.DataType) -> bool:
    """Whether any text of a type can contain a lower-case string; when not, the
    column need not be read."""
    if isinstance(dtype, T.NumericType):
        return set(needle) <= set("0123456789.e+-") or needle in "nan" or needle in "-inf"
    if isinstance(dtype, T.BooleanType):
        return needle == "1"
    return True


def render_text(value: Column, dtype: T.DataType, null_text: bool = False) -> Column:
    """Render one value: strings as they are, true as 1, false as empty text,
    whole floats without a point, dates and nested values as JSON.

    A null stays null, or reads ``null`` when ``null_text`` is set.
    """
    if isinstance(dtype, TEXT_TYPES):
        text = value
    elif isinstance(dtype, T.BooleanType):
        text = F.when(value, "1").when(~value, "")
    elif isinstance(dtype, T.FloatType):
        text = _fraction(value.cast("string").cast("double"))
    elif isinstance(dtype, T.DoubleType):
        text = _fraction(value)
    elif isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        text = F.concat(F.lit('"'), F.date_format(value.cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ssxxx"), F.lit('"'))
    elif isinstance(dtype, T.DateType):
        text = F.concat(F.lit('"'), F.date_format(value, "yyyy-MM-dd"), F.lit('"'))
    elif isinstance(dtype, _NESTED):
        text = F.to_json(value)
    else:
        text = value.cast("string")
    return F.coalesce(text, F.lit("null")) if null_text else text
