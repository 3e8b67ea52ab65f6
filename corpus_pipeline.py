"""A corpus made ready for training, in five stages, each written before the next one reads it.

In every stage a null text is an empty one, texts are read whole however long, and repeated rows are
judged each for itself, alike; a row without ``doc_id`` has no label, is linked with nothing and is not
named by a leak, so it stays until it is packed. An empty table gives an empty one. All but the last
stage keep the columns of ``docs`` as they are, whatever they are called.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seekframe.llm import decontamination, neardup, packing, quality, secrets
from seekframe.llm.common import parked, prepared, read
from seekframe.llm.tokens import tokenizer_path
from seekframe.llm.without import without


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; with no labels at all, every one.

    Null or empty texts have the evidence of a text without words; sites tie to the global rate if they are sparse.
    """
    prepared(spark)
    return quality.kept(docs, read(spark, sf_dir, "labels"), F.col("source"), F.col("lang"))


def unlike(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, similarity 0.8.

    The one with the smallest ``doc_id`` stays; rows that share an id stay or go together. Texts
    without words are near nothing and stay.
    """
    prepared(spark)
    found = parked(neardup.link_components(docs, 5, (80, 100)))
    return without(docs, found.where("not kept"))


def unseen(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which no benchmark item leaked; an empty benchmark leaks nowhere, a text without words has no leak."""
    prepared(spark)
    return without(docs, parked(decontamination.leaks(docs, read(spark, sf_dir, "benchmark"))))


def discreet(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by the secret's kind; a null text stays null."""
    prepared(spark)
    return secrets.cleaned(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences of at most 2048 ids.

    An empty text is the end id alone; one longer than a sequence is cut. Among pieces of one
    length the order is ``doc_id``, then piece.
    """
    prepared(spark)
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"), forget=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", good),
    ("near_duplicates", unlike),
    ("decontamination", unseen),
    ("secrets", discreet),
    ("packing", packed),
]

#: SQL cannot fit a classifier or encode tokens; the stages are tested against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = parked(stage(spark, docs, sf_dir))
    return docs
