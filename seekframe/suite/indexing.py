"""Index maintenance, from import to read-back."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from seekframe.audit import Audit
from seekframe.plans.search import search, search_index
from seekframe.session import shared_dir
from seekframe.sources.index import rejects
from seekframe.sources.tables import table
from seekframe.spec import documents
from seekframe.suite.registry import case
from seekframe.suite.tables import ORDERS, ORDERS_SQL, PART, new_catalog, orders, part

FIELDS = ["p_partkey", "p_name", "p_type", "p_size"]
SPEC = PART.with_(document=FIELDS)


def _imported(spark, folder):
    """All parts, imported into a new index."""
    index = new_catalog(spark).create("part", "p_partkey", language="simple", buckets=4)
    return index.import_table(part(spark, folder), SPEC)


def _incoming(spark, folder):
    """Changed parts and, from the suppliers, new ones; types of some are missing."""
    changed = (
        part(spark, folder)
        .where("p_size > 30")
        .select(
            "p_partkey",
            F.concat(F.lit("renamed "), "p_name").alias("p_name"),
            F.when(F.col("p_type") != "PROMO", F.lower("p_type")).alias("p_type"),
            "p_size",
        )
    )
    new = table(spark, folder, "supplier").select(
        (F.col("s_suppkey") + 1_000_000_000).alias("p_partkey"),
        F.col("s_name").alias("p_name"),
        F.lit("SUPPLIED").alias("p_type"),
        F.col("s_nationkey").alias("p_size"),
    )
    return changed.unionByName(new)


_OLD = "(SELECT p_partkey, p_name, p_type, p_size FROM part)"
_NEW = """(SELECT p_partkey, 'renamed ' || p_name AS p_name, CASE WHEN p_type <> 'PROMO' THEN lower(p_type) END AS p_type, p_size
           FROM part WHERE p_size > 30
           UNION ALL SELECT s_suppkey + 1000000000, s_name, 'SUPPLIED', s_nationkey FROM supplier)"""
_KEPT = f"SELECT * FROM {_OLD} WHERE p_partkey NOT IN (SELECT p_partkey FROM {_NEW})"


@case("import_full", "SELECT p_partkey, p_name, p_type, p_size FROM part WHERE p_size >= 10")
def import_full(spark, folder):
    spec = SPEC.with_(should_index=lambda c: c("p_size") >= 10)
    index = new_catalog(spark).create("part", "p_partkey", language="simple", buckets=4)
    return index.import_table(part(spark, folder), spec).docs()


@case("import_query", "SELECT p_partkey, p_name, p_type, p_size FROM part WHERE p_size >= 10 AND p_type = 'PROMO'")
def import_query(spark, folder):
    spec = SPEC.with_(should_index=lambda c: c("p_size") >= 10)
    index = new_catalog(spark).create("part", "p_partkey", language="simple", buckets=4)
    return index.import_table(part(spark, folder).where("p_type = 'PROMO'"), spec).docs()


@case("import_fresh", "SELECT p_partkey, p_name, p_type, p_size FROM part WHERE p_size > 25")
def import_fresh(spark, folder):
    index = _imported(spark, folder)
    return index.import_table(part(spark, folder).where("p_size > 25"), SPEC, fresh=True).docs()


@case("upsert", f"{_KEPT} UNION ALL SELECT * FROM {_NEW}")
def upsert(spark, folder):
    return _imported(spark, folder).write(_incoming(spark, folder)).docs()


@case(
    "upsert_terms",
    f"""SELECT term, count(*) AS df FROM (SELECT DISTINCT p_partkey, unnest(regexp_extract_all(
            lower(p_name || ' ' || coalesce(p_type, '')), '[a-z0-9]+')) AS term
        FROM ({_KEPT} UNION ALL SELECT * FROM {_NEW}) WHERE p_size <> 33) GROUP BY term""",
)
def upsert_terms(spark, folder):
    """Term counts stay exact through updates and deletes."""
    index = _imported(spark, folder).write(_incoming(spark, folder))
    return index.delete(index.docs().where("p_size = 33").select("p_partkey")).terms()


@case("import_create", f"SELECT * FROM {_OLD} UNION ALL SELECT * FROM {_NEW} WHERE p_partkey >= 1000000000")
def import_create(spark, folder):
    return _imported(spark, folder).write(_incoming(spark, folder), mode="create").docs()


@case("import_update", f"{_KEPT} UNION ALL SELECT * FROM {_NEW} WHERE p_partkey < 1000000000")
def import_update(spark, folder):
    return _imported(spark, folder).write(_incoming(spark, folder), mode="update").docs()


@case(
    "import_emplace",
    f"""{_KEPT} UNION ALL
        SELECT n.p_partkey, n.p_name, coalesce(n.p_type, o.p_type) AS p_type, n.p_size
        FROM {_NEW} n LEFT JOIN {_OLD} o ON n.p_partkey = o.p_partkey""",
)
def import_emplace(spark, folder):
    return _imported(spark, folder).write(_incoming(spark, folder), mode="emplace").docs()


@case(
    "import_rejects",
    "SELECT o_custkey AS key, 'duplicate key' AS reason, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 1",
)
def import_rejects(spark, folder):
    return rejects(table(spark, folder, "orders"), "o_custkey")


@case(
    "delete_keys",
    f"""SELECT * FROM {_OLD} WHERE p_partkey NOT IN
        (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45)""",
)
def delete_keys(spark, folder):
    returned = table(spark, folder, "lineitem").where("l_returnflag = 'R' AND l_quantity > 45").select("l_partkey")
    return _imported(spark, folder).delete(returned).docs()


@case("flush_query", f"SELECT * FROM {_OLD} WHERE p_type <> 'SMALL'")
def flush_query(spark, folder):
    small = part(spark, folder).where("p_type = 'SMALL'").select("p_partkey")
    return _imported(spark, folder).delete(small).docs()


@case("flush_all", f"SELECT * FROM {_OLD} WHERE false")
def flush_all(spark, folder):
    return _imported(spark, folder).flush().docs()


@case(
    "import_compact",
    f"SELECT p_partkey, p_name FROM ({_KEPT} UNION ALL SELECT * FROM {_NEW}) WHERE contains(p_name, 'ring')",
)
def import_compact(spark, folder):
    """Searches see the same documents after the segments are folded."""
    index = _imported(spark, folder).write(_incoming(spark, folder)).compact()
    found = search_index(index, "ring", fields=["p_name"]).documents()
    return found.select("p_partkey", "p_name")


@case(
    "schema_cast",
    "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus, CAST(o_custkey AS DOUBLE) AS o_custkey FROM orders",
)
def schema_cast(spark, folder):
    schema = T.StructType(
        [
            T.StructField("o_orderkey", T.StringType()),
            T.StructField("o_orderstatus", T.StringType()),
            T.StructField("o_custkey", T.DoubleType()),
        ]
    )
    index = new_catalog(spark).create("orders", "o_orderkey", schema, language="simple", buckets=4)
    source = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return index.write(source).docs()


@case(
    "index_trashed",
    f"SELECT o_orderkey, o_orderpriority FROM {ORDERS_SQL} WHERE o_orderpriority = '1-URGENT' AND deleted IS NOT NULL",
)
def index_trashed(spark, folder):
    """Soft-deleted documents stay in the index, flagged."""
    spec = ORDERS.with_(document=["o_orderpriority"], keep_deleted=True)
    index = new_catalog(spark).create("orders", "o_orderkey", language="simple", buckets=4)
    index = index.import_table(orders(spark, folder), spec)
    found = search(orders(spark, folder), spec, "urgent").within(index).only_trashed().get()
    return found.select("o_orderkey", "o_orderpriority")


@case(
    "audit_counts",
    """SELECT 'search' AS operation, count(*) AS n FROM part WHERE p_type <> 'PROMO' AND contains(p_name, 'ring')
       UNION ALL SELECT 'search', least(count(*), 5) FROM part WHERE p_name ILIKE '%gear%'
       UNION ALL SELECT 'paginate', count(*) FROM part WHERE p_name ILIKE '%gear%'
       UNION ALL SELECT 'update', count(*) FROM part UNION ALL SELECT 'delete', count(*) FROM part WHERE p_type = 'PROMO'""",
)
def audit_counts(spark, folder):
    audit = Audit(spark, shared_dir(spark))
    index = new_catalog(spark).create("part", "p_partkey", language="simple", buckets=4)
    index = audit.write(lambda: index.write(documents(part(spark, folder), SPEC)))
    index = audit.write(lambda: index.delete(part(spark, folder).where("p_type = 'PROMO'").select("p_partkey")))
    named = SPEC.with_(document=["p_name"])
    audit.search(search_index(index, "ring", prefix=False))
    audit.search(search(part(spark, folder), named, "gear").take(5))
    audit.paginate(search(part(spark, folder), named, "gear"), 10, 2)
    searches = audit.searches().select("operation", F.col("found.total").alias("n"))
    return searches.unionByName(audit.writes().select("operation", F.col("changed.asked").alias("n")))


@case(
    "audit_search",
    """SELECT 'ring' AS query, 'like' AS strategy, count(*) AS hits, least(count(*), 50) AS n_keys,
              count(*) > 50 AS cut, CAST(max(p_partkey) AS VARCHAR) AS first_key, 'p_size > 10' AS filter
       FROM part WHERE (p_name ILIKE '%ring%' OR p_type ILIKE '%ring%') AND p_size > 10""",
)
def audit_search(spark, folder):
    audit = Audit(spark, shared_dir(spark))
    audit.search(search(part(spark, folder), SPEC, "ring").where("p_size", ">", 10))
    seen = audit.searches()
    only = F.get("filters", F.lit(0))
    return seen.select(
        "query",
        "strategy",
        F.col("found.total").alias("hits"),
        F.size("found.keys").cast("bigint").alias("n_keys"),
        "found.cut",
        F.get("found.keys", F.lit(0)).alias("first_key"),
        F.concat_ws(" ", only["field"], only["op"], only["value"]).alias("filter"),
    )


@case(
    "index_alias",
    "SELECT p_partkey, p_type FROM part WHERE p_type = 'PROMO' AND contains(p_name, 'ring')",
)
def index_alias(spark, folder):
    """A new index is built aside; readers of the alias move to it in one step."""
    catalog = new_catalog(spark)
    old = catalog.create("part_v1", "p_partkey", language="simple", buckets=4)
    old.import_table(part(spark, folder), SPEC)
    catalog.point("part", "part_v1")
    new = catalog.create("part_v2", "p_partkey", language="simple", buckets=4)
    new.import_table(part(spark, folder).where("p_type = 'PROMO'"), SPEC)
    catalog.point("part", "part_v2")
    found = search(part(spark, folder), SPEC, "ring", prefix=False).within(catalog.open("part"))
    return found.get().select("p_partkey", "p_type")


@case(
    "index_settings",
    """SELECT p_partkey FROM part WHERE (p_type = 'PROMO' OR p_type = 'SMALL') AND p_size < 30
       ORDER BY p_size ASC NULLS FIRST, p_partkey DESC LIMIT 50""",
)
def index_settings(spark, folder):
    """Only the declared fields are searched, filtered and sorted on."""
    index = _imported(spark, folder).update_settings(
        searchable=["p_type"], filterable=["p_size"], sortable=["p_size"]
    )
    found = search_index(index, "promo small", mode="natural", prefix=False, sort=[("p_size", "asc")])
    return found.where("p_size", "<", 30).take(50).raw().select("p_partkey")


@case(
    "index_catalog",
    "SELECT * FROM (VALUES ('tmp_b', CAST((SELECT count(*) FROM supplier) AS BIGINT))) t(name, n_docs)",
)
def index_catalog(spark, folder):
    """Create twice, import, delete one index, then look at what is left."""
    catalog = new_catalog(spark)
    catalog.create("tmp_a", "p_partkey", buckets=4)
    catalog.create("tmp_b", "s_suppkey", buckets=4)
    again = catalog.create("tmp_b", "s_suppkey", buckets=4)
    again.write(table(spark, folder, "supplier").select("s_suppkey", "s_name"))
    catalog.delete("tmp_a")
    left = [(name, catalog.open(name).manifest.n_docs) for name in catalog.names()]
    return spark.createDataFrame(left, "name STRING, n_docs BIGINT")
