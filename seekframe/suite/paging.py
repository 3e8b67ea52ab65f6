"""Order, limit, pages and terminals."""

from pyspark.sql import functions as F

from seekframe.operators.rank import with_position
from seekframe.plans.search import search, search_index
from seekframe.sources.tables import table
from seekframe.spec import SearchSpec
from seekframe.suite.registry import case
from seekframe.suite.tables import ORDERS, PART, documents_index, orders, part

RING = "p_name ILIKE '%ring%' OR p_brand ILIKE '%ring%' OR p_type ILIKE '%ring%'"


def _numbered(df, *order):
    return with_position(df, list(order))


@case(
    "order_asc",
    """SELECT p_partkey, p_size, row_number() OVER (ORDER BY p_size ASC NULLS FIRST, p_partkey DESC) AS _position
       FROM part ORDER BY p_size ASC NULLS FIRST, p_partkey DESC LIMIT 40""",
)
def order_asc(spark, folder):
    page = search(part(spark, folder), PART).order_by("p_size").take(40).get().select("p_partkey", "p_size")
    return _numbered(page, F.col("p_size").asc(), F.col("p_partkey").desc())


@case(
    "order_desc",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS deleted FROM orders
       ORDER BY deleted DESC NULLS LAST, o_orderkey DESC LIMIT 50""",
)
def order_desc(spark, folder):
    found = search(orders(spark, folder), ORDERS).with_trashed().order_by_desc("deleted")
    return found.take(50).get().select("o_orderkey", "deleted")


@case(
    "order_nulls_first",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS deleted FROM orders
       ORDER BY deleted ASC NULLS FIRST, o_orderkey DESC LIMIT 50""",
)
def order_nulls_first(spark, folder):
    found = search(orders(spark, folder), ORDERS).with_trashed().order_by("deleted")
    return found.take(50).get().select("o_orderkey", "deleted")


@case(
    "order_repeated",
    """SELECT p_partkey, p_size, p_type FROM part ORDER BY p_size DESC NULLS LAST, p_type ASC NULLS FIRST, p_partkey DESC LIMIT 33""",
)
def order_repeated(spark, folder):
    """A repeated column keeps its first place and takes its last direction."""
    found = search(part(spark, folder), PART).order_by("p_size").order_by("p_type").order_by("p_size", "desc")
    return found.take(33).get().select("p_partkey", "p_size", "p_type")


@case("latest", "SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC LIMIT 25")
def latest(spark, folder):
    spec = ORDERS.with_(deleted=None)
    return search(table(spark, folder, "orders"), spec).latest().take(25).get().select("o_orderkey", "o_orderdate")


@case("oldest", "SELECT event_id, ts FROM events ORDER BY ts ASC NULLS FIRST, event_id DESC LIMIT 25")
def oldest(spark, folder):
    spec = SearchSpec("events", "event_id", ["event_type"], created="ts")
    return search(table(spark, folder, "events"), spec).oldest().take(25).get().select("event_id", "ts")


@case("default_order", f"SELECT p_partkey, p_name FROM part WHERE {RING} ORDER BY p_partkey DESC LIMIT 30")
def default_order(spark, folder):
    return search(part(spark, folder), PART, "ring").take(30).get().select("p_partkey", "p_name")


@case("take", f"SELECT * FROM part WHERE ({RING}) AND p_size > 10 ORDER BY p_partkey DESC LIMIT 10")
def take(spark, folder):
    return search(part(spark, folder), PART, "ring").where("p_size", ">", 10).take(10).get()


@case("page_ignores_take", f"SELECT * FROM part WHERE {RING} ORDER BY p_partkey DESC LIMIT 15")
def page_ignores_take(spark, folder):
    return search(part(spark, folder), PART, "ring").take(3).paginate().rows


@case("page_1", f"SELECT * FROM part WHERE {RING} ORDER BY p_partkey DESC LIMIT 12")
def page_1(spark, folder):
    return search(part(spark, folder), PART, "ring").paginate(12, 0).rows


@case("page_2", f"SELECT * FROM part WHERE {RING} ORDER BY p_size NULLS FIRST, p_partkey DESC LIMIT 12 OFFSET 12")
def page_2(spark, folder):
    return search(part(spark, folder), PART, "ring").order_by("p_size").paginate(12, 2).rows


_INFO = """SELECT {count} AS "count", total_count, 12 AS per_page, {page} AS current_page, {page} AS requested_page,
       greatest(1, CAST(ceil(total_count / 12.0) AS BIGINT)) AS page_count, {page} > 1 AS has_prev_page,
       12 * {page} < total_count AS has_next_page,
       CAST(CASE WHEN {count} > 0 THEN {page} * 12 - 11 ELSE 0 END AS BIGINT) AS start,
       CASE WHEN {count} > 0 THEN {page} * 12 - 12 + {count} ELSE 0 END AS "end"
FROM (SELECT count(*) AS total_count FROM part WHERE {where})"""
_SHOWN = "greatest(0, least(total_count - ({page} - 1) * 12, 12))"


@case("page_info", _INFO.format(count=_SHOWN.format(page=3), page=3, where=RING))
def page_info(spark, folder):
    return search(part(spark, folder), PART, "ring").paginate(12, 3).info


@case("page_info_empty", _INFO.format(count=_SHOWN.format(page=1), page=1, where="p_size = 7 AND p_size = 8"))
def page_info_empty(spark, folder):
    return search(part(spark, folder), PART).where("p_size", 7).where("p_size", 8).paginate(12, 1).info


@case("page_info_past_end", _INFO.format(count=_SHOWN.format(page=900000), page=900000, where=RING))
def page_info_past_end(spark, folder):
    return search(part(spark, folder), PART, "ring").paginate(12, 900000).info


@case("simple_page", f"SELECT * FROM part WHERE {RING} ORDER BY p_partkey DESC LIMIT 12 OFFSET 24")
def simple_page(spark, folder):
    return search(part(spark, folder), PART, "ring").simple_paginate(12, 3).rows


@case(
    "simple_page_info",
    f"""SELECT least(n, 12) AS "count", NULL::BIGINT AS total_count, 12 AS per_page, 3 AS current_page,
               3 AS requested_page, NULL::BIGINT AS page_count, true AS has_prev_page, n > 12 AS has_next_page,
               CAST(CASE WHEN n > 0 THEN 25 ELSE 0 END AS BIGINT) AS start, CASE WHEN n > 0 THEN 24 + least(n, 12) ELSE 0 END AS "end"
        FROM (SELECT count(*) AS n FROM (SELECT 1 FROM part WHERE {RING} LIMIT 13 OFFSET 24))""",
)
def simple_page_info(spark, folder):
    return search(part(spark, folder), PART, "ring").simple_paginate(12, 3).info


@case(
    "page_raw",
    r"""SELECT doc_id FROM documents
        WHERE list_contains(regexp_extract_all(lower(text), '[\p{L}\p{N}]+'), 'the')
        ORDER BY doc_id DESC LIMIT 15 OFFSET 15""",
)
def page_raw(spark, folder):
    """Hits of a page, without the join back to rows."""
    index = documents_index(spark, folder)
    return search_index(index, "the", prefix=False, policy="newest").paginate_raw(15, 2).rows.select("doc_id")


@case("page_count", f"SELECT count(*) AS n FROM (SELECT 1 FROM part WHERE {RING} LIMIT 12 OFFSET 24)")
def page_count(spark, folder):
    """What a page without a total reports as its count."""
    info = search(part(spark, folder), PART, "ring").simple_paginate(12, 3).info
    return info.select(F.col("count").alias("n"))


@case("total_count", f"SELECT count(*) AS total_count FROM part WHERE {RING}")
def total_count(spark, folder):
    return search(part(spark, folder), PART, "ring").take(3).total()


@case("capped_total", f"SELECT least(count(*), 100) AS found, count(*) AS out_of FROM part WHERE {RING}")
def capped_total(spark, folder):
    return search(part(spark, folder), PART, "ring").capped_total(100)


@case("take_capped", "SELECT p_partkey FROM part ORDER BY p_partkey DESC LIMIT 1000")
def take_capped(spark, folder):
    return search(part(spark, folder), PART, max_results=1000).take(1200).get().select("p_partkey")


@case("first", f"SELECT * FROM part WHERE {RING} ORDER BY p_retailprice NULLS FIRST, p_partkey DESC LIMIT 1")
def first(spark, folder):
    return search(part(spark, folder), PART, "ring").order_by("p_retailprice").first()


@case("keys", f"SELECT p_partkey FROM part WHERE {RING}")
def keys(spark, folder):
    return search(part(spark, folder), PART, "ring").keys()


@case("raw_hook", f"SELECT p_partkey FROM (SELECT * FROM part WHERE {RING} ORDER BY p_partkey DESC LIMIT 30) WHERE p_size > 20")
def raw_hook(spark, folder):
    found = search(part(spark, folder), PART, "ring").raw_hook(lambda hits: hits.where("p_size > 20"))
    return found.take(30).get().select("p_partkey")


@case("raw_hook_unseen", f"SELECT p_partkey FROM part WHERE {RING} ORDER BY p_partkey DESC LIMIT 30")
def raw_hook_unseen(spark, folder):
    """Keys come from before the hook."""
    found = search(part(spark, folder), PART, "ring").raw_hook(lambda hits: hits.where("p_size > 20"))
    return found.take(30).keys()


@case(
    "hit_position",
    f"""SELECT p_partkey, row_number() OVER (ORDER BY p_retailprice DESC NULLS LAST, p_partkey DESC) AS _position
        FROM part WHERE {RING} ORDER BY p_retailprice DESC NULLS LAST, p_partkey DESC LIMIT 40""",
)
def hit_position(spark, folder):
    hits = search(part(spark, folder), PART, "ring").order_by_desc("p_retailprice").take(40).raw()
    order = (F.col("p_retailprice").desc(), F.col("p_partkey").desc())
    return _numbered(hits, *order).select("p_partkey", "_position")
