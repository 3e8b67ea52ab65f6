"""Field constraints."""

from enum import Enum

from pyspark.sql import functions as F

from seekframe.plans.search import search
from seekframe.sources.tables import table
from seekframe.suite.registry import case
from seekframe.suite.tables import CUSTOMER, ORDERS, ORDERS_SQL, PART, customer, orders, part


class Brand(Enum):
    SEVEN = "Brand#7"


def _part_where(name: str, sql: str, *wheres) -> None:
    """A search of all parts under constraints, and the same as SQL."""

    @case(name, f"SELECT * FROM part WHERE {sql}")
    def run(spark, folder):
        found = search(part(spark, folder), PART)
        for constraint in wheres:
            found = found.where(*constraint)
        return found.get()


_part_where("where_eq", "p_size = 10", ("p_size", 10))
_part_where("where_eq_text", "p_type = 'PROMO' AND p_size = 7", ("p_type", "PROMO"), ("p_size", "eq", "7"))
_part_where("where_enum", "p_brand = 'Brand#7'", ("p_brand", Brand.SEVEN))
_part_where("where_ne", "p_size <> 10 AND p_type <> 'PROMO'", ("p_size", "!=", 10), ("p_type", "<>", "PROMO"))
_part_where("where_gt", "p_retailprice > 950.5", ("p_retailprice", ">", 950.5))
_part_where("where_ge", "p_size >= 40", ("p_size", ">=", 40))
_part_where("where_lt", "p_size < 5", ("p_size", "<", 5))
_part_where("where_le", "p_retailprice <= 910", ("p_retailprice", "<=", 910))
_part_where("where_gt_text", "p_name > 'new'", ("p_name", ">", "new"))
_part_where("where_le_text", "p_name <= 'hot gear'", ("p_name", "<=", "hot gear"))
_part_where("where_range", "p_size > 10 AND p_size <= 20", ("p_size", ">", 10), ("p_size", "<=", 20))
_part_where("where_like", "p_type LIKE 'S%' AND p_name NOT LIKE '%r_ng'", ("p_type", "like", "S%"), ("p_name", "not like", "%r_ng"))
_part_where("where_ilike", "p_name ILIKE 'SMALL%'", ("p_name", "ilike", "SMALL%"))


@case("where_in", "SELECT * FROM part WHERE p_size IN (1, 2, 3) AND p_type IN ('PROMO', 'SMALL')")
def where_in(spark, folder):
    found = search(part(spark, folder), PART).where_in("p_size", [9]).where_in("p_type", ["PROMO", "SMALL"])
    return found.where_in("p_size", [1, "2", 3]).get()


@case("where_not_in", "SELECT * FROM part WHERE p_type NOT IN ('PROMO', 'SMALL')")
def where_not_in(spark, folder):
    return search(part(spark, folder), PART).where_not_in("p_type", ["PROMO", "SMALL"]).get()


@case("where_in_empty", "SELECT * FROM part WHERE false")
def where_in_empty(spark, folder):
    return search(part(spark, folder), PART).where_in("p_size", []).get()


@case("where_not_in_empty", "SELECT * FROM part")
def where_not_in_empty(spark, folder):
    return search(part(spark, folder), PART).where_not_in("p_size", []).get()


@case(
    "where_in_frame",
    "SELECT * FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')",
)
def where_in_frame(spark, folder):
    urgent = table(spark, folder, "orders").where("o_orderpriority = '1-URGENT'").select("o_custkey")
    return search(customer(spark, folder), CUSTOMER).where_in("c_custkey", urgent).get()


@case(
    "where_not_in_frame",
    "SELECT * FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')",
)
def where_not_in_frame(spark, folder):
    urgent = table(spark, folder, "orders").where("o_orderpriority = '1-URGENT'").select("o_custkey")
    return search(customer(spark, folder), CUSTOMER).where_not_in("c_custkey", urgent).get()


@case("where_in_long", "SELECT * FROM customer WHERE c_custkey IN (SELECT unnest(range(0, 6000, 2)))")
def where_in_long(spark, folder):
    """A list too long for a plan: it becomes a semi join."""
    return search(customer(spark, folder), CUSTOMER).where_in("c_custkey", range(0, 6000, 2)).get()


@case("where_bool", "SELECT p_partkey, p_size > 25 AS big FROM part WHERE p_size > 25")
def where_bool(spark, folder):
    source = part(spark, folder).withColumn("big", F.col("p_size") > 25)
    return search(source, PART).where("big", True).get().select("p_partkey", "big")


@case("where_null", f"SELECT o_orderkey, deleted FROM {ORDERS_SQL} WHERE deleted IS NULL")
def where_null(spark, folder):
    return search(orders(spark, folder), ORDERS).with_trashed().where("deleted", None).get().select("o_orderkey", "deleted")


@case("where_not_null", f"SELECT o_orderkey, deleted FROM {ORDERS_SQL} WHERE deleted IS NOT NULL")
def where_not_null(spark, folder):
    found = search(orders(spark, folder), ORDERS).with_trashed().where("deleted", "!=", None)
    return found.get().select("o_orderkey", "deleted")


@case(
    "where_date",
    "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'",
)
def where_date(spark, folder):
    found = search(table(spark, folder, "orders"), ORDERS.with_(deleted=None))
    found = found.where("o_orderdate", ">=", "1997-01-01").where("o_orderdate", "<", "1998-01-01")
    return found.get().select("o_orderkey", "o_orderdate")


_URGENT = f"SELECT o_orderkey, o_orderstatus FROM {ORDERS_SQL} WHERE o_orderpriority ILIKE '%urgent%'"


@case("trashed_default", _URGENT + " AND deleted IS NULL")
def trashed_default(spark, folder):
    return search(orders(spark, folder), ORDERS, "urgent").get().select("o_orderkey", "o_orderstatus")


@case("with_trashed", _URGENT)
def with_trashed(spark, folder):
    return search(orders(spark, folder), ORDERS, "urgent").with_trashed().get().select("o_orderkey", "o_orderstatus")


@case("only_trashed", _URGENT + " AND deleted IS NOT NULL")
def only_trashed(spark, folder):
    return search(orders(spark, folder), ORDERS, "urgent").only_trashed().get().select("o_orderkey", "o_orderstatus")


@case("search_custom", "SELECT * FROM part WHERE p_name ILIKE '%ring%' AND p_size + 1 > 30")
def search_custom(spark, folder):
    """The custom function stands in for the where constraint, which is ignored."""
    found = search(part(spark, folder), PART, "ring").where("p_size", 3)
    return found.custom(lambda df: df.where("p_size + 1 > 30")).get()
