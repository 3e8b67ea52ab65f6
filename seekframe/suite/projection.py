"""Document building."""

from pyspark.sql import functions as F

from seekframe.functions.render import render_text
from seekframe.plans.search import search, search_index
from seekframe.sources.tables import table
from seekframe.spec import SearchSpec, documents
from seekframe.suite.registry import case
from seekframe.suite.tables import DOCUMENTS, ORDERS, ORDERS_SQL, PART, documents_index, orders, part, texts


@case("doc_project", "SELECT p_name AS name, p_size * 2 AS double_size, p_partkey FROM part")
def doc_project(spark, folder):
    spec = PART.with_(document={"name": "p_name", "double_size": lambda c: c("p_size") * 2})
    return documents(part(spark, folder), spec)


@case(
    "search_computed_field",
    "SELECT p_partkey, p_name FROM part WHERE contains(lower(reverse(p_name)), 'gnir')",
)
def search_computed_field(spark, folder):
    spec = PART.with_(document={"reversed_name": lambda c: F.reverse(c("p_name"))})
    return search(part(spark, folder), spec, "GNIR").using("contains").get().select("p_partkey", "p_name")


@case(
    "doc_enrich_join",
    """SELECT o_orderkey, o_totalprice AS price, c_name AS customer, c_mktsegment AS segment
       FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def doc_enrich_join(spark, folder):
    people = table(spark, folder, "customer")
    spec = SearchSpec(
        "orders",
        "o_orderkey",
        {"price": "o_totalprice", "customer": "c_name", "segment": "c_mktsegment"},
        enrich=lambda rows: rows.join(people, rows["o_custkey"] == people["c_custkey"]),
    )
    return documents(table(spark, folder, "orders"), spec)


@case(
    "search_enriched",
    """SELECT o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey
       WHERE contains(lower(c_mktsegment), 'machine') AND o_totalprice > 400000""",
)
def search_enriched(spark, folder):
    people = table(spark, folder, "customer")
    spec = SearchSpec(
        "orders",
        "o_orderkey",
        {"segment": "c_mktsegment"},
        enrich=lambda rows: rows.join(people, rows["o_custkey"] == people["c_custkey"]),
    )
    found = search(table(spark, folder, "orders"), spec, "machine").where("o_totalprice", ">", 400000)
    return found.using("contains").get().select("o_orderkey")


@case(
    "doc_metadata",
    """SELECT p_partkey, upper(p_name) AS p_name, p_size, 'catalog' AS origin, 1 AS __soft_deleted FROM part""",
)
def doc_metadata(spark, folder):
    spec = PART.with_(
        document=["p_name", "p_size"],
        metadata={
            "p_name": lambda c: F.upper(c("p_name")),
            "origin": lambda c: F.lit("catalog"),
            "__soft_deleted": lambda c: F.lit(1),
        },
    )
    return documents(part(spark, folder), spec)


@case(
    "doc_soft_flag",
    f"""SELECT o_orderkey, o_orderstatus, CASE WHEN deleted IS NOT NULL THEN 1 ELSE 0 END AS __soft_deleted
        FROM {ORDERS_SQL}""",
)
def doc_soft_flag(spark, folder):
    spec = ORDERS.with_(document=["o_orderstatus"], keep_deleted=True)
    return documents(orders(spark, folder), spec)


@case(
    "doc_drop_empty",
    """SELECT o_orderkey, o_orderpriority AS priority, 'x' AS origin FROM orders WHERE o_orderstatus = 'O'""",
)
def doc_drop_empty(spark, folder):
    spec = SearchSpec(
        "orders",
        "o_orderkey",
        {"priority": lambda c: F.when(c("o_orderstatus") == "O", c("o_orderpriority"))},
        metadata={"origin": lambda c: F.lit("x")},
    )
    return documents(table(spark, folder, "orders"), spec)


_FLOAT_SQL = "CASE WHEN {0} = floor({0}) THEN CAST(CAST({0} AS BIGINT) AS VARCHAR) ELSE CAST({0} AS VARCHAR) END"


@case(
    "render_text",
    f"""SELECT p_partkey, p_name AS a_text, CAST(p_size AS VARCHAR) AS a_whole,
               {_FLOAT_SQL.format("p_retailprice")} AS a_float,
               CASE WHEN p_size > 25 THEN '1' ELSE '' END AS a_bool,
               coalesce(nullif(p_type, 'PROMO'), 'null') AS a_null,
               CAST(to_json({{'brand': p_brand, 'size': p_size}}) AS VARCHAR) AS a_struct,
               CAST(to_json([p_size, p_size + 1]) AS VARCHAR) AS a_list
        FROM part""",
)
def render(spark, folder):
    df = part(spark, folder).select(
        "p_partkey",
        F.col("p_name").alias("a_text"),
        F.col("p_size").alias("a_whole"),
        F.col("p_retailprice").alias("a_float"),
        (F.col("p_size") > 25).alias("a_bool"),
        F.when(F.col("p_type") != "PROMO", F.col("p_type")).alias("a_null"),
        F.struct(F.col("p_brand").alias("brand"), F.col("p_size").alias("size")).alias("a_struct"),
        F.array("p_size", F.col("p_size") + 1).alias("a_list"),
    )
    shown = [render_text(F.col(f.name), f.dataType, null_text=True).alias(f.name) for f in df.schema[1:]]
    return df.select("p_partkey", *shown)


@case(
    "render_dates",
    """SELECT o_orderkey, '"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '+00:00"' AS ordered,
              '"' || strftime(o_orderdate, '%Y-%m-%d') || '"' AS day
       FROM orders""",
)
def render_dates(spark, folder):
    df = table(spark, folder, "orders").withColumn("day", F.to_date("o_orderdate"))
    return df.select(
        "o_orderkey",
        render_text(F.col("o_orderdate"), df.schema["o_orderdate"].dataType).alias("ordered"),
        render_text(F.col("day"), df.schema["day"].dataType).alias("day"),
    )


@case(
    "search_attributes",
    r"""SELECT doc_id, lang FROM documents
        WHERE list_contains(regexp_extract_all(lower(text), '[\p{L}\p{N}]+'), 'the')""",
)
def search_attributes(spark, folder):
    index = documents_index(spark, folder)
    return search_index(index, "the", prefix=False, attributes=["lang"]).documents().select("doc_id", "lang")


@case(
    "search_query_hook_pre",
    """SELECT p_partkey, p_size FROM part WHERE p_name ILIKE '%ring%' AND p_size < 20
       ORDER BY p_partkey DESC LIMIT 20""",
)
def search_query_hook_pre(spark, folder):
    found = search(part(spark, folder), PART, "ring").pre_filter(lambda df: df.where("p_size < 20"))
    return found.take(20).get().select("p_partkey", "p_size")


@case(
    "search_query_hook_post",
    """SELECT * FROM (SELECT p_partkey, p_size FROM part WHERE contains(lower(p_name), 'ring')
                      ORDER BY p_partkey DESC LIMIT 20) WHERE p_size < 20""",
)
def search_query_hook_post(spark, folder):
    spec = PART.with_(document=["p_name"])
    found = search(part(spark, folder), spec, "ring").using("contains")
    return found.post_filter(lambda df: df.where("p_size < 20")).take(20).get().select("p_partkey", "p_size")


@case(
    "eligible_only",
    "SELECT doc_id, lang FROM documents WHERE contains(lower(text), 'ing') AND n_chars >= 500",
)
def eligible_only(spark, folder):
    spec = DOCUMENTS.with_(should_index=lambda c: c("n_chars") >= 500)
    return search(texts(spark, folder), spec, "ing").using("contains").get().select("doc_id", "lang")
