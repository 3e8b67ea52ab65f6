"""Time the headline searches and index jobs; print one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession

from seekframe import configure, search_index
from seekframe.suite import QUERIES
from seekframe.suite.tables import INDEXED, documents_index, new_catalog, texts

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = (
    "take",
    "match_contains",
    "match_like",
    "search_joined",
    "where_in_frame",
    "page_info",
    "order_desc",
    "fulltext_and",
    "fulltext_phrase",
    "fulltext_web",
    "bm25_topk",
    "grouped_hits",
    "rank_position",
    "index_bm25",
    "index_prefix",
    "index_phrase",
    "index_filter",
    "hydrate_order",
    "term_stats",
    "upsert",
    "delete_keys",
    "cdc_last",
    "cdc_final_docs",
)


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    started = time.perf_counter()
    action()
    return round(time.perf_counter() - started, 3)


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        # Index files of a small build are cut to keep every core busy.
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    results: dict[str, float] = {}

    def import_documents() -> None:
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
        index.import_table(texts(spark, SF_DIR), INDEXED)

    results["import_cold"] = timed(lambda: documents_index(spark, SF_DIR))
    results["import"] = timed(import_documents)
    index = documents_index(spark, SF_DIR)
    for name in HEADLINE:
        timed(lambda: run(QUERIES[name](spark, SF_DIR)))  # warm the code paths
        results[name] = timed(lambda: run(QUERIES[name](spark, SF_DIR)))
    results["index_total"] = timed(lambda: run(search_index(index, "the", prefix=False).total()))
    total = round(sum(v for k, v in results.items() if k != "import_cold"), 3)
    print(json.dumps({"metric": "total_time", "value": total, "unit": "sec", "queries": results, "sf": SF_DIR}))
    spark.stop()


if __name__ == "__main__":
    main()
