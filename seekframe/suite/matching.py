"""The search string over short text columns."""

from pyspark.sql import functions as F

from seekframe.operators.match import prefix_match
from seekframe.plans.search import search
from seekframe.session import shared_dir
from seekframe.sources.grams import GramTable
from seekframe.sources.tables import table
from seekframe.spec import SearchSpec
from seekframe.suite.registry import case
from seekframe.suite.tables import CUSTOMER, DOCUMENTS, PART, customer, part, texts

_FLOAT = "CASE WHEN {0} = floor({0}) THEN CAST(CAST({0} AS BIGINT) AS VARCHAR) ELSE CAST({0} AS VARCHAR) END"


@case("match_empty", "SELECT * FROM part")
def match_empty(spark, folder):
    return search(part(spark, folder), PART, "").get()


@case(
    "match_contains",
    f"""SELECT * FROM part WHERE contains(CAST(p_partkey AS VARCHAR), '99') OR contains(lower(p_name), '99')
        OR contains(lower(p_brand), '99') OR contains(lower(p_type), '99') OR contains(CAST(p_size AS VARCHAR), '99')
        OR contains({_FLOAT.format("p_retailprice")}, '99')""",
)
def match_contains(spark, folder):
    """Every field counts, numbers by their text."""
    return search(part(spark, folder), PART, "99").using("contains").get()


@case(
    "match_contains_text",
    """SELECT p_partkey, p_name, p_brand FROM part
       WHERE contains(lower(p_name), 'ring') OR contains(lower(p_brand), 'ring') OR contains(lower(p_type), 'ring')""",
)
def match_contains_text(spark, folder):
    return search(part(spark, folder), PART, "RiNG").using("contains").get().select("p_partkey", "p_name", "p_brand")


@case(
    "match_contains_literal",
    "SELECT p_partkey FROM part WHERE contains(lower(p_type) || '_%' || p_size, 'o_%1')",
)
def match_contains_literal(spark, folder):
    """Pattern characters mean nothing to a contains search."""
    spec = PART.with_(document={"code": lambda c: F.concat(c("p_type"), F.lit("_%"), c("p_size").cast("string"))})
    return search(part(spark, folder), spec, "o_%1").using("contains").get().select("p_partkey")


@case(
    "match_contains_null",
    "SELECT p_partkey FROM part WHERE p_type = 'PROMO'",
)
def match_contains_null(spark, folder):
    """A missing value reads as the word null."""
    spec = PART.with_(document={"kind": lambda c: F.when(c("p_type") != "PROMO", c("p_type"))})
    return search(part(spark, folder), spec, "null").using("contains").get().select("p_partkey")


def _grams(spark, folder):
    return GramTable.build(texts(spark, folder), DOCUMENTS, shared_dir(spark), block_bits=4)


@case("grams_contains", "SELECT doc_id FROM documents WHERE contains(lower(text), 'on the reed')")
def grams_contains(spark, folder):
    """A substring search that reads only blocks whose grams fit."""
    return search(_grams(spark, folder).containing("On THE reed"), DOCUMENTS, "On THE reed").using("contains").get().select("doc_id")


@case("grams_like", "SELECT doc_id, lang FROM documents WHERE text ILIKE '%reed%thou%'")
def grams_like(spark, folder):
    spec = DOCUMENTS.with_(fulltext=[])
    return search(_grams(spark, folder).like("reed%thou"), spec, "reed%thou").get().select("doc_id", "lang")


_LIKE = "SELECT * FROM part WHERE p_name ILIKE '{0}' OR p_brand ILIKE '{0}' OR p_type ILIKE '{0}'"


@case("match_like", _LIKE.format("%o%"))
def match_like(spark, folder):
    return search(part(spark, folder), PART, "o").get()


@case("match_like_wildcard", _LIKE.format("%r%r_n%"))
def match_like_wildcard(spark, folder):
    """Percent and underscore of the search string stay wildcards."""
    return search(part(spark, folder), PART, "r%r_n").get()


@case("match_like_literal", "SELECT page_id, url FROM pages WHERE contains(html, '%%%') OR contains(url, '%%%')")
def match_like_literal(spark, folder):
    """With the literal option they are plain characters."""
    spec = SearchSpec("pages", "page_id", ["url", "html"])
    return search(table(spark, folder, "pages"), spec, "%%%", literal=True).get().select("page_id", "url")


@case("match_contains_pages", "SELECT page_id FROM pages WHERE contains(lower(url), 'page=2&')")
def match_contains_pages(spark, folder):
    spec = SearchSpec("pages", "page_id", {"address": "url"})
    return search(table(spark, folder, "pages"), spec, "PAGE=2&").using("contains").get().select("page_id")


@case("match_prefix", "SELECT * FROM part WHERE p_name ILIKE 're%' OR p_brand ILIKE '%re%' OR p_type ILIKE '%re%'")
def match_prefix(spark, folder):
    return search(part(spark, folder), PART.with_(prefix=["p_name"]), "re").get()


@case("match_prefix_exact", "SELECT p_partkey, p_name FROM part WHERE starts_with(p_name, 'red')")
def match_prefix_exact(spark, folder):
    """Case-exact prefix: the reader can skip row groups."""
    df = part(spark, folder)
    return df.where(prefix_match(df, "p_name", "red")).select("p_partkey", "p_name")


@case("match_key", "SELECT * FROM customer WHERE c_custkey = 17 OR c_name ILIKE '%17%' OR c_mktsegment ILIKE '%17%'")
def match_key(spark, folder):
    return search(customer(spark, folder), CUSTOMER, "17").get()


@case("match_key_range", "SELECT * FROM customer WHERE false")
def match_key_range(spark, folder):
    """Digits no key can hold match no key."""
    spec = CUSTOMER.with_(document=["c_custkey"])
    return search(customer(spark, folder), spec, "99999999999999999999").get()


@case("match_no_columns", "SELECT * FROM customer")
def match_no_columns(spark, folder):
    """No text column to look into: no predicate, so every row matches."""
    return search(customer(spark, folder), CUSTOMER.with_(document=["c_acctbal"]), "build").get()


@case(
    "fulltext_like",
    "SELECT * FROM part WHERE p_type ILIKE '%e%d%' OR p_name ILIKE '%e%d%' OR p_brand ILIKE '%e%d%'",
)
def fulltext_like(spark, folder):
    return search(part(spark, folder), PART.with_(fulltext=["p_name"], mode="like"), "e%d").get()
