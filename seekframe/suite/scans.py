"""Scans, joined search and row lookup."""

from pyspark.sql import functions as F

from seekframe.plans.search import search
from seekframe.sources.tables import by_keys, contain, key_bounds, key_range, plan_ranges, table
from seekframe.spec import SearchSpec
from seekframe.suite.registry import case
from seekframe.suite.tables import CUSTOMER, customer, orders, texts


@case("scan_all", "SELECT * FROM customer")
def scan_all(spark, folder):
    return search(customer(spark, folder), CUSTOMER).get()


@case(
    "search_joined",
    """SELECT o_orderkey, o_totalprice, c_name, c_mktsegment
       FROM orders JOIN customer ON o_custkey = c_custkey
       WHERE o_orderpriority ILIKE '%build%' OR c_mktsegment ILIKE '%build%'""",
)
def search_joined(spark, folder):
    source = table(spark, folder, "orders")
    people = customer(spark, folder)
    joined = contain(source, people, source["o_custkey"] == people["c_custkey"], "customer")
    spec = SearchSpec("orders", "o_orderkey", ["o_orderpriority", "customer.c_mktsegment"])
    return (
        search(joined, spec, "build")
        .get()
        .select("o_orderkey", "o_totalprice", "customer.c_name", "customer.c_mktsegment")
    )


@case(
    "search_joined_filter",
    """SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey
       WHERE (n_name ILIKE '%a%' OR r_name ILIKE '%a%') AND r_name <> 'ASIA'""",
)
def search_joined_filter(spark, folder):
    nations, regions = table(spark, folder, "nation"), table(spark, folder, "region")
    joined = contain(nations, regions, nations["n_regionkey"] == regions["r_regionkey"], "region")
    spec = SearchSpec("nation", "n_nationkey", ["n_name", "region.r_name"])
    found = search(joined, spec, "a").where("region.r_name", "!=", "ASIA").order_by("region.r_name").get()
    return found.select("n_nationkey", "n_name", "region.r_name")


@case("scan_key_range", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey BETWEEN 1000 AND 9999")
def scan_key_range(spark, folder):
    source = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return key_range(source, "o_orderkey", 1000, 9999)


@case(
    "scan_by_keys",
    "SELECT doc_id, lang, source, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)",
)
def scan_by_keys(spark, folder):
    good = table(spark, folder, "labels").where("quality = 1").select("doc_id")
    return by_keys(texts(spark, folder).drop("text"), "doc_id", good)


@case("scan_by_key_list", "SELECT * FROM customer WHERE c_custkey IN (3, 14, 15, 92, 65, 35, 897)")
def scan_by_key_list(spark, folder):
    return by_keys(customer(spark, folder), "c_custkey", [3, 14, 15, 92, 65, 35, 897])


@case("key_bounds", "SELECT min(o_orderkey) AS min_key, max(o_orderkey) AS max_key FROM orders")
def bounds(spark, folder):
    return key_bounds(table(spark, folder, "orders"), "o_orderkey")


@case(
    "import_ranges",
    """WITH b AS (SELECT min(l_orderkey) + 1 AS lo, max(l_orderkey) AS hi FROM lineitem)
       SELECT n AS range_no, 1 + n * 500 AS start, least(1 + n * 500 + 499, hi) AS "end"
       FROM b, range(0, 100000000) r(n) WHERE 1 + n * 500 <= hi""".replace(
        "range(0, 100000000) r(n)",
        "(SELECT unnest(range(0, (SELECT CAST(ceil(max(l_orderkey) / 500.0) AS BIGINT) FROM lineitem))) AS n) r",
    ),
)
def import_ranges(spark, folder):
    return plan_ranges(table(spark, folder, "lineitem"), "l_orderkey", 500, start=1)


@case(
    "import_ranges_desc",
    """WITH b AS (SELECT max(o_orderkey) AS hi FROM orders),
       r AS (SELECT hi, unnest(range(0, CAST(ceil(hi / 700.0) AS BIGINT))) AS n FROM b)
       SELECT n AS range_no, greatest(hi - n * 700 - 699, 1) AS start, hi - n * 700 AS "end" FROM r""",
)
def import_ranges_desc(spark, folder):
    return plan_ranges(table(spark, folder, "orders"), "o_orderkey", 700, order="desc", start=1)


@case(
    "search_nested_values",
    """SELECT event_id, event_type FROM events
       WHERE contains(props, '"k": 7') OR contains(lower(event_type), '"k": 7')""",
)
def search_nested_values(spark, folder):
    spec = SearchSpec("events", "event_id", ["event_type", "props"])
    found = search(table(spark, folder, "events"), spec, '"k": 7').using("contains").get()
    return found.select("event_id", "event_type")


@case(
    "unix_seconds",
    "SELECT o_orderkey, CAST(epoch(o_orderdate) AS BIGINT) AS ordered_at FROM orders",
)
def unix_seconds_of(spark, folder):
    from seekframe.functions.hashing import unix_seconds

    source = orders(spark, folder)
    return source.select("o_orderkey", unix_seconds(F.col("o_orderdate").cast("timestamp")).alias("ordered_at"))


@case(
    "batch_id",
    """WITH k AS (SELECT o_custkey AS k FROM orders)
       SELECT count(k) AS n_keys,
              md5(count(k) || ':' || bit_xor(CAST('0x' || substr(md5(CAST(k AS VARCHAR)), 1, 15) AS BIGINT))) AS fingerprint
       FROM k""",
)
def batch_id(spark, folder):
    from seekframe.functions.hashing import batch_fingerprint

    return batch_fingerprint(table(spark, folder, "orders"), "o_custkey")
