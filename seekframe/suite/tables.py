"""The given tables as searchable tables."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seekframe.session import shared_dir
from seekframe.sources.index import Catalog, Index
from seekframe.sources.tables import table
from seekframe.spec import SearchSpec

PART = SearchSpec(
    "part", "p_partkey", ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]
)
CUSTOMER = SearchSpec("customer", "c_custkey", ["c_custkey", "c_name", "c_mktsegment", "c_acctbal"])
ORDERS = SearchSpec(
    "orders",
    "o_orderkey",
    ["o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice"],
    created="o_orderdate",
    deleted="deleted",
)
DOCUMENTS = SearchSpec("documents", "doc_id", ["text"], fulltext=["text"], language="simple")

# The same soft-delete rule on both sides.
ORDERS_SQL = """(SELECT *, CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS deleted FROM orders)"""

WORDS_SQL = r"regexp_extract_all(lower(text), '[\p{L}\p{N}]+')"
SPACED_SQL = rf"(' ' || array_to_string({WORDS_SQL}, ' ') || ' ')"


def part(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part")


def customer(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer")


def orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with the soft-delete column: a finished order counts as deleted."""
    deleted = F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate"))
    return table(spark, folder, "orders").withColumn("deleted", deleted)


def texts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def new_catalog(spark: SparkSession) -> Catalog:
    return Catalog(spark, shared_dir(spark))


_built: dict[str, Index] = {}


def _state(spark: SparkSession, folder: str, name: str) -> str:
    """Identity of a table's files, so that an index is never reused for other data."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}.parquet")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(
        spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}.parquet*")
    )
    facts = [[f.getPath().toString(), f.getLen(), f.getModificationTime()] for f in files]
    return json.dumps([spark.sparkContext.applicationId, name, facts])


INDEXED = SearchSpec("documents", "doc_id", ["text", "lang", "source", "n_chars"], language="simple")


def documents_index(spark: SparkSession, folder: str) -> Index:
    """Index of all documents, built once per session and set of files."""
    state = _state(spark, folder, "documents")
    if state not in _built:
        index = new_catalog(spark).create(
            "documents",
            "doc_id",
            language="simple",
            searchable=["text"],
            filterable=["lang", "source", "n_chars"],
            sortable=["lang", "source", "n_chars"],
            buckets=16,
            file_words=500_000,
        )
        _built[state] = index.import_table(texts(spark, folder), INDEXED)
    return _built[state]
