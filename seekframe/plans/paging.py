"""Pages of a result and the facts about them."""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seekframe.operators.rank import Key, Order
from seekframe.session import shared_dir
from seekframe.sources.index.manifest import Files

# Fixed value: rows of a page that nobody sized.
DEFAULT_PER_PAGE = 15
# Rows before a page that a task may keep in memory.
DEEP_SKIP = 10_000
# Sampled rows of an order's columns, in each round that looks for a deep page.
SAMPLE = 20_000
# Bits of a monotonically increasing id that count rows inside a task.
ROW_BITS = 2**33 - 1


class Page:
    """``rows`` of one page in order and ``info``, a one-row DataFrame about it.

    Either may be given as a function; it is called when first asked for.
    """

    def __init__(self, rows: DataFrame | Callable[[], DataFrame], info: DataFrame | Callable[[], DataFrame]):
        self._rows, self._info = rows, info

    @cached_property
    def rows(self) -> DataFrame:
        return self._rows() if callable(self._rows) else self._rows

    @cached_property
    def info(self) -> DataFrame:
        return self._info() if callable(self._info) else self._info


def page_slice(df: DataFrame, order: list[Column], per_page: int, page: int, extra: int = 0) -> DataFrame:
    """Rows of one page: a top-k per task and one small merge, never a full sort.

    A page that lies deep would make every task keep all rows before it. Its place in
    the order is narrowed down first, by ``selected``, until few rows are before it.
    """
    skip, size = (page - 1) * per_page, per_page + extra
    if skip > DEEP_SKIP and isinstance(order, Order):
        df, skip = selected(df, order, skip, size)
    if skip > DEEP_SKIP:
        return _deep_slice(df, order, skip, size)
    ordered = df.orderBy(*order)
    return (ordered.offset(skip) if skip > 0 else ordered).limit(size)


def selected(df: DataFrame, order: Order, skip: int, size: int) -> tuple[DataFrame, int]:
    """The rows between two splitters that hold the places ``skip`` to ``skip + size`` of an order, and how many to skip of them.

    Each round samples the order's columns within the range, takes the splitters a little before and
    behind the wanted places, and counts the rows before either: rows are neither sorted nor written.
    A sample that misses the places is drawn again, wider. Rows that tie on all columns stay together.
    """
    names = [f"__k{i}" for i in range(len(order.keys))]
    keys = [Key(F.col(n), k.descending) for n, k in zip(names, order.keys)]
    narrow = df.select(*(k.column.alias(n) for n, k in zip(names, order.keys)))
    types = [f.dataType for f in narrow.schema]
    low, high, base, wide = None, None, 0, 1
    n = narrow.count()
    while skip - base > DEEP_SKIP and n > size:
        inside = narrow.where(_between(keys, types, low, high))
        some = inside.sample(min(1.0, SAMPLE / n), seed=11 * wide).orderBy(*Order(keys)).collect()
        slack = wide * (4 * math.sqrt(len(some)) + 1)
        place = lambda at: (at - base) / n * len(some)
        first, last = math.floor(place(skip) - slack), math.ceil(place(skip + size) + slack)
        new_low = tuple(some[first]) if 0 <= first < len(some) else low
        new_high = tuple(some[last]) if 0 <= last < len(some) else high
        if (new_low, new_high) == (low, high):
            break
        counted = inside.agg(
            F.count(F.when(_before(keys, types, new_low), 1)).alias("a"),
            F.count(F.when(~_behind(keys, types, new_high), 1)).alias("b"),
        ).first()
        if base + counted["a"] > skip or base + counted["b"] < min(skip + size, base + n):
            wide *= 2
            continue
        left = counted["b"] - counted["a"]
        base, low, high = base + counted["a"], new_low, new_high
        if left > 0.9 * n:
            break
        n, wide = left, 1
    keys = list(order.keys)
    return df.where(_between(keys, types, low, high)), skip - base


def _lexically(keys: list[Key], types: list, value: tuple, test: Callable[[Key, Column], Column]) -> Column:
    """Whether a row differs from a splitter, by the first key that does, in the way of the test."""
    out, same = F.lit(False), F.lit(True)
    for key, kind, x in zip(keys, types, value):
        given = F.lit(x).cast(kind)
        out = out | (same & F.coalesce(test(key, given), F.lit(False)))
        same = same & key.column.eqNullSafe(given)
    return out


def _before(keys: list[Key], types: list, value: tuple | None) -> Column:
    if value is None:
        return F.lit(False)
    return _lexically(keys, types, value, lambda k, x: k.before(x))


def _behind(keys: list[Key], types: list, value: tuple | None) -> Column:
    if value is None:
        return F.lit(False)
    return _lexically(keys, types, value, lambda k, x: ~k.before(x) & ~k.column.eqNullSafe(x))


def _between(keys: list[Key], types: list, low: tuple | None, high: tuple | None) -> Column:
    return ~_before(keys, types, low) & ~_behind(keys, types, high)


def _deep_slice(df: DataFrame, order: list[Column], skip: int, size: int) -> DataFrame:
    """For orders that are not made of keys, and places among more ties than a task may keep.

    Sort the rows once over all tasks and write them with their place in their
    task; the row counts of the tasks then tell where the page begins.

    Rows are told apart by their place alone, so a key may repeat or be null. The
    sorted rows are removed once the page itself is written.
    """
    spark = df.sparkSession
    placed = df.orderBy(*order).select(
        *(F.col(f"`{c}`") for c in df.columns),
        F.spark_partition_id().alias("__task"),
        F.monotonically_increasing_id().bitwiseAND(F.lit(ROW_BITS)).alias("__row"),
    )
    sorted_path, page_path = shared_dir(spark), shared_dir(spark)
    placed.write.parquet(sorted_path)
    written = spark.read.schema(placed.schema).parquet(sorted_path)
    # One row per task of the sort, joined back as a small table.
    counts = written.groupBy("__task").agg(F.count(F.lit(1)).alias("n")).orderBy("__task").collect()
    bases, start = [], 0
    for row in counts:
        if start < skip + size and start + row["n"] > skip:
            bases.append((row["__task"], start))
        start += row["n"]
    found = spark.createDataFrame(bases, "__task int, __base bigint")
    place = (F.col("__base") + F.col("__row")).alias("__place")
    numbered = written.join(F.broadcast(found), "__task").withColumn("__place", place)
    page = numbered.where((F.col("__place") >= skip) & (F.col("__place") < skip + size))
    page = page.select(*(F.col(f"`{c}`") for c in df.columns), "__place")
    page.write.parquet(page_path)
    Files(spark, sorted_path).remove("")
    return spark.read.schema(page.schema).parquet(page_path).orderBy("__place").drop("__place")


def _facts(df: DataFrame, shown: Column, total: Column, pages: Column, more: Column, per_page: int, page: int) -> DataFrame:
    # The names of the facts of a page.
    first = F.lit((page - 1) * per_page).cast("bigint")
    none = F.lit(0).cast("bigint")
    return df.select(
        shown.alias("count"),
        total.alias("total_count"),
        F.lit(per_page).alias("per_page"),
        F.lit(page).alias("current_page"),
        F.lit(page).alias("requested_page"),
        pages.alias("page_count"),
        F.lit(page > 1).alias("has_prev_page"),
        more.alias("has_next_page"),
        F.when(shown > 0, first + 1).otherwise(none).alias("start"),
        F.when(shown > 0, first + shown).otherwise(none).alias("end"),
    )


def page_info(total: DataFrame, page_count: Column, per_page: int, page: int) -> DataFrame:
    """Facts of a page with a known total; ``total`` is one row ``total_count``."""
    n = F.col("total_count")
    pages = F.greatest(F.lit(1).cast("bigint"), F.ceil(n / F.lit(per_page)).cast("bigint"))
    more = F.lit(per_page * page).cast("bigint") < n
    return _facts(total, page_count.cast("bigint"), n, pages, more, per_page, page)


def simple_info(probe: DataFrame, per_page: int, page: int) -> DataFrame:
    """Facts of a page without a total; ``probe`` holds up to one row too many."""
    n, unknown = F.col("n"), F.lit(None).cast("bigint")
    counted = probe.agg(F.count(F.lit(1)).alias("n"))
    shown = F.least(n, F.lit(per_page).cast("bigint"))
    return _facts(counted, shown, unknown, unknown, n > per_page, per_page, page)
