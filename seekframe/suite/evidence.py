"""Lists of any length, deep pages, parts of an import, pauses, records and notices."""

import datetime as dt

from pyspark.sql import functions as F

from seekframe.audit import Audit
from seekframe.operators.predicates import apply_in, apply_not_in
from seekframe.plans.search import Matched, register_strategy, search
from seekframe.session import shared_dir
from seekframe.sources.tables import contain, key_range, table
from seekframe.spec import documents
from seekframe.streaming.sync import apply_changes
from seekframe.suite.registry import case
from seekframe.suite.tables import DOCUMENTS, ORDERS, PART, documents_index, new_catalog, orders, part

FIELDS = ["p_partkey", "p_name", "p_type", "p_size"]
SPEC = PART.with_(document=FIELDS)

# ---- lists: 1 to 3 values that count, filled up to 1, 1000 or 1001 with some that do not ----

_LISTS = {
    # column, values, values without effect, what SQL is asked for, null rule
    "whole": ("p_size", [7, "8", 9.0], lambda i: (i + 0.5, 2**40 + i, f"no{i}")[i % 3], "7, 8, 9"),
    "number": ("p_size", [7, "8", 9.0], lambda i: -1 - i, "7, 8, 9"),
    "price": ("p_retailprice", [901.0, "902", 905], lambda i: -1.5 - i, "901, 902, 905"),
    "text": ("p_type", ["PROMO", "SMALL"], lambda i: f"none {i}", "'PROMO', 'SMALL'"),
    "flag": ("small", [True], lambda i: True, "true"),
}


def _flagged(spark, folder):
    size = F.col("p_size")
    return part(spark, folder).withColumn("small", F.when(size != 20, size < 20))


_FLAGGED = "(SELECT *, CASE WHEN p_size <> 20 THEN p_size < 20 END AS small FROM part)"


def _filled(name, n):
    column, values, other, _ = _LISTS[name]
    return column, (values + [other(i) for i in range(n)])[: max(n, len(values))]


def _register_lists() -> None:
    for name, (column, _, _, sql) in _LISTS.items():
        for n in (1, 1000, 1001):

            @case(f"where_in_{name}_{n}", f"SELECT p_partkey FROM {_FLAGGED} WHERE {column} IN ({sql})")
            def in_list(spark, folder, name=name, n=n):
                return apply_in(_flagged(spark, folder), *_filled(name, n)).select("p_partkey")

            @case(f"where_not_in_{name}_{n}", f"SELECT p_partkey FROM {_FLAGGED} WHERE {column} NOT IN ({sql})")
            def not_in_list(spark, folder, name=name, n=n):
                return apply_not_in(_flagged(spark, folder), *_filled(name, n)).select("p_partkey")


_register_lists()

_DAYS = ["1995-03-01", dt.date(1996, 7, 4), "not a day"]


def _days(n):
    return (_DAYS + [(dt.date(2100, 1, 1) + dt.timedelta(i)).isoformat() for i in range(n)])[: max(n, 3)]


for _n in (3, 1001):

    @case(
        f"where_in_day_{_n}",
        "SELECT o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) IN (DATE '1995-03-01', DATE '1996-07-04')",
    )
    def in_days(spark, folder, n=_n):
        rows = orders(spark, folder).withColumn("day", F.col("o_orderdate").cast("date"))
        return apply_in(rows, "day", _days(n)).select("o_orderkey")

    @case(
        f"where_not_in_day_{_n}",
        "SELECT o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) NOT IN (DATE '1995-03-01', DATE '1996-07-04')",
    )
    def not_in_days(spark, folder, n=_n):
        rows = orders(spark, folder).withColumn("day", F.col("o_orderdate").cast("date"))
        return apply_not_in(rows, "day", _days(n)).select("o_orderkey")


# ---- deep pages ----


@case(
    "page_deep",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice ASC NULLS FIRST, o_orderkey DESC LIMIT 40 OFFSET 12000",
)
def page_deep(spark, folder):
    found = search(orders(spark, folder), ORDERS).with_trashed().order_by("o_totalprice")
    return found.paginate(40, 301).rows.select("o_orderkey", "o_totalprice")


@case(
    "page_deep_joined",
    """SELECT o_orderkey, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM orders JOIN lineitem ON l_orderkey = o_orderkey
       ORDER BY l_extendedprice ASC NULLS FIRST, l_partkey ASC NULLS FIRST, l_suppkey ASC NULLS FIRST,
                l_quantity ASC NULLS FIRST, o_orderkey DESC
       LIMIT 50 OFFSET 20000""",
)
def page_deep_joined(spark, folder):
    """A key that repeats: each row of the join has its own place."""
    line = table(spark, folder, "lineitem")
    rows = orders(spark, folder)
    joined = contain(rows, line, rows["o_orderkey"] == line["l_orderkey"], "line")
    found = search(joined, ORDERS).with_trashed()
    for name in ("l_extendedprice", "l_partkey", "l_suppkey", "l_quantity"):
        found = found.order_by(f"line.{name}")
    return found.paginate(50, 401).rows.select("o_orderkey", "line.l_partkey", "line.l_suppkey", "line.l_quantity", "line.l_extendedprice")


@case(
    "simple_page_deep",
    "SELECT o_orderkey FROM orders ORDER BY o_totalprice ASC NULLS FIRST, o_orderkey DESC LIMIT 40 OFFSET 12000",
)
def simple_page_deep(spark, folder):
    found = search(orders(spark, folder), ORDERS).with_trashed().order_by("o_totalprice")
    return found.simple_paginate(40, 301).rows.select("o_orderkey")


def _orders_index(spark, folder):
    index = new_catalog(spark).create("orders", "o_orderkey", language="simple", buckets=4)
    return index.import_table(orders(spark, folder).where("o_orderkey % 2 = 0 OR o_orderstatus <> 'P'"), LEAN)


LEAN = ORDERS.with_(document=["o_orderkey", "o_orderstatus", "o_orderpriority"], deleted=None)


@case(
    "position_dense",
    """SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey DESC) AS _position FROM orders
       WHERE o_orderkey % 2 = 0 OR o_orderstatus <> 'P' ORDER BY o_orderkey DESC LIMIT 11000""",
)
def position_dense(spark, folder):
    """Places are 1, 2, ... whatever the limit."""
    found = search(orders(spark, folder), LEAN, "*").within(_orders_index(spark, folder))
    return found.order_by_desc("o_orderkey").take(11_000).get().select("o_orderkey", "_position")


# ---- parts of an import ----


@case(
    "import_range",
    """SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey BETWEEN 100 AND 900 THEN 'again' ELSE o_orderpriority END AS o_orderpriority
       FROM orders WHERE (o_orderkey BETWEEN 100 AND 900 AND o_orderstatus <> 'F')
          OR (o_orderkey NOT BETWEEN 100 AND 900 AND (o_orderkey % 2 = 0 OR o_orderstatus <> 'P'))""",
)
def import_range(spark, folder):
    """One range done again: changed, new and no longer eligible rows."""
    changed = orders(spark, folder).withColumn("o_orderpriority", F.lit("again"))
    spec = LEAN.with_(should_index=lambda c: c("o_orderstatus") != "F")
    return _orders_index(spark, folder).import_range(changed, spec, 100, 900, tidy=True).docs()


@case(
    "import_by_keys",
    """SELECT o_orderkey, o_orderstatus, CASE WHEN o_custkey % 5 = 0 THEN 'again' ELSE o_orderpriority END AS o_orderpriority
       FROM orders WHERE (o_custkey % 5 = 0 AND o_orderstatus <> 'F')
          OR (o_custkey % 5 <> 0 AND (o_orderkey % 2 = 0 OR o_orderstatus <> 'P'))""",
)
def import_by_keys(spark, folder):
    """The same for a key list of any length."""
    changed = orders(spark, folder).withColumn("o_orderpriority", F.lit("again"))
    keys = orders(spark, folder).where("o_custkey % 5 = 0").select("o_orderkey")
    spec = LEAN.with_(should_index=lambda c: c("o_orderstatus") != "F")
    return _orders_index(spark, folder).import_keys(changed, spec, keys, tidy=True).docs()


# ---- pause and repeated batches ----


def _parts_index(spark, folder):
    index = new_catalog(spark).create("part", "p_partkey", language="simple", buckets=4)
    return index.import_table(part(spark, folder), SPEC)


def _renamed(spark, folder, op):
    image = F.struct("p_partkey", F.concat(F.lit("new "), "p_name").alias("p_name"), "p_type", "p_size")
    rows = part(spark, folder).select(F.col("p_partkey").alias("seq"), F.lit("2020-01-01").cast("timestamp").alias("ts"), op.alias("op"), image.alias("after"))
    return rows.select("seq", "ts", "op", F.when(F.col("op") == "never", F.col("after")).alias("before"), "after")


@case(
    "sync_paused",
    """SELECT p_partkey, CASE WHEN p_size > 40 THEN 'new ' || p_name ELSE p_name END AS p_name, p_type, p_size FROM part""",
)
def sync_paused(spark, folder):
    """A pause holds back updates, not restores, and ends with its block."""
    op = F.when(F.col("p_size") > 40, "restore").otherwise("update")
    with _parts_index(spark, folder).paused() as index:
        held = apply_changes(index, _renamed(spark, folder, op), SPEC)
    return held.refresh().docs()


@case(
    "sync_replayed",
    """SELECT p_partkey, CASE WHEN p_size > 25 THEN 'new ' || p_name ELSE p_name END AS p_name, p_type, p_size FROM part""",
)
def sync_replayed(spark, folder):
    """A batch that was seen changes nothing, whatever it holds the second time."""
    changes = _renamed(spark, folder, F.lit("update"))
    index = apply_changes(_parts_index(spark, folder), changes.where("after.p_size > 25"), SPEC, ("feed", 1))
    return apply_changes(index, changes.where("after.p_size <= 25"), SPEC, ("feed", 1)).docs()


# ---- catalog, records and notices ----


@case("index_delete_all", "SELECT 'keep_a' AS name, count(*) AS n_docs FROM supplier")
def index_delete_all(spark, folder):
    """Only the indexes of a catalog's prefix go."""
    from seekframe.sources.index import Catalog

    root = shared_dir(spark)
    suppliers = table(spark, folder, "supplier").select("s_suppkey", "s_name")
    for prefix, name in (("tmp_", "a"), ("tmp_", "b"), ("keep_", "a")):
        Catalog(spark, root, prefix).create(name, "s_suppkey", buckets=2).write(suppliers)
    Catalog(spark, root, "tmp_").delete_all()
    left = Catalog(spark, root)
    found = [(name, left.open(name).manifest.n_docs) for name in left.names()]
    return spark.createDataFrame(found, "name STRING, n_docs BIGINT")


@case(
    "write_record",
    """SELECT 'upsert' AS op, CAST(p_partkey AS VARCHAR) AS key FROM part
       UNION ALL SELECT 'delete', CAST(p_partkey AS VARCHAR) FROM part WHERE p_type = 'PROMO'""",
)
def write_record(spark, folder):
    """The record of a write has every key of it."""
    audit = Audit(spark, shared_dir(spark))
    index = new_catalog(spark).create("part", "p_partkey", language="simple", buckets=4)
    index = audit.write(lambda: index.write(documents(part(spark, folder), SPEC)))
    audit.write(lambda: index.delete(part(spark, folder).where("p_type = 'PROMO'").select("p_partkey")))
    return audit.written_keys().select("op", "key")


@case("unmeasured", "SELECT p_partkey, 0 AS records FROM part WHERE contains(lower(p_name), 'ring') AND p_size > 10")
def unmeasured(spark, folder):
    """A search outside an audit leaves no record."""
    audit = Audit(spark, shared_dir(spark))
    spec = PART.with_(document=["p_name"])
    found = search(part(spark, folder), spec, "ring").using("contains").where("p_size", ">", 10).get()
    return found.select("p_partkey", F.lit(audit.counts().count()).alias("records"))


@case(
    "commit_notices",
    """SELECT 'update' AS operation, count(*) AS n FROM part
       UNION ALL SELECT 'delete', count(*) FROM part WHERE p_type = 'PROMO' UNION ALL SELECT 'flush', 0""",
)
def commit_notices(spark, folder):
    from seekframe.sources.index import Catalog

    told = []
    catalog = Catalog(spark, shared_dir(spark), listeners=[told.append])
    index = catalog.create("part", "p_partkey", language="simple", buckets=4)
    index = index.import_table(part(spark, folder), SPEC)
    index.delete(part(spark, folder).where("p_type = 'PROMO'").select("p_partkey")).flush()
    return spark.createDataFrame([(t["operation"], t["count"]) for t in told], "operation STRING, n BIGINT")


@case(
    "own_strategy",
    "SELECT p_partkey FROM part WHERE length(p_name) % 7 = 3 AND p_size > 5 ORDER BY p_name, p_partkey LIMIT 30",
)
def own_strategy(spark, folder):
    """A way of searching that is added under a name; constraints and limit still hold."""

    def by_length(s):
        return Matched(s.constrain(s.source).where(F.length("p_name") % 7 == int(s.query)), [F.col("p_name"), F.col("p_partkey")])

    register_strategy("length", by_length)
    return search(part(spark, folder), PART, "3").using("length").where("p_size", ">", 5).take(30).get().select("p_partkey")


@case(
    "search_highlight_all",
    r"""WITH hit AS (SELECT doc_id, string_split(trim(regexp_replace(text, '\s+', ' ', 'g')), ' ') AS w FROM documents
                     WHERE regexp_matches(lower(text), '(^|[^\p{L}\p{N}])the($|[^\p{L}\p{N}])')
                     ORDER BY doc_id DESC LIMIT 20),
             marks AS (SELECT *, list_position(list_transform(w, lambda x:
                      regexp_matches(x, '(?i)(^|[^\p{L}\p{N}])the($|[^\p{L}\p{N}])')), true) AS p FROM hit),
             cut AS (SELECT doc_id, CASE WHEN len(w) > 30 AND p > 0 THEN w[greatest(p - 4, 1):p + 4] ELSE w END AS w FROM marks)
        SELECT doc_id, array_to_string(list_transform(w, lambda x:
                 regexp_replace(x, '(^|[^\p{L}\p{N}])(the)($|[^\p{L}\p{N}])', '\1<mark>\2</mark>\3', 'gi')), ' ') AS marked FROM cut""",
)
def search_highlight_all(spark, folder):
    """The rows of a page of all documents with their marked text; long ones are cut to the words around the first mark."""
    found = search(table(spark, folder, "documents"), DOCUMENTS, "the", highlight=["text"]).order_by_desc("doc_id")
    return found.paginate(20, 1).rows.select("doc_id", F.col("_highlight.text").alias("marked"))


@case(
    "import_range_plan",
    "SELECT count(*) AS ranges, min(o_orderkey) AS first FROM (SELECT unnest(range(1, max(o_orderkey) + 1, 3)) AS o_orderkey FROM orders)",
)
def import_range_plan(spark, folder):
    """Ranges of three keys over all orders."""
    from seekframe.sources.tables import plan_ranges

    return plan_ranges(orders(spark, folder), "o_orderkey", 3, start=1).agg(F.count("*").alias("ranges"), F.min("start").alias("first"))


@case("documents_by_index_range", "SELECT doc_id FROM documents WHERE doc_id BETWEEN 20 AND 60")
def documents_by_index_range(spark, folder):
    return key_range(documents_index(spark, folder).docs(), "doc_id", 20, 60).select("doc_id")
