"""Order of hits: relevance and the position policies."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce
from operator import add
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seekframe.functions.text import (
    ANALYZERS,
    BREAK_GAP,
    HARD_BREAK,
    LETTER,
    WORD,
    any_pattern,
    any_word,
    let,
    placed_tokens,
    text_before,
    words,
)

# Fixed values of the BM25 formula.
K1 = 1.2
B = 0.75

POLICIES = ("score", "position", "newest", "first_word")


def idf(n_docs: Column, df: Column) -> Column:
    return F.log(F.lit(1.0) + (n_docs - df + 0.5) / (df + 0.5))


def tf_norm(tf: Column, length: Column, mean_length: Column) -> Column:
    return tf * (K1 + 1) / (tf + K1 * ((1 - B) + B * length / mean_length))


def bm25(
    tfs: list[Column], dfs: list[Column], length: Column, n_docs: Column, mean_length: Column
) -> Column:
    parts = [
        F.when(tf > 0, idf(n_docs, df) * tf_norm(tf, length, mean_length)).otherwise(F.lit(0.0))
        for tf, df in zip(tfs, dfs)
    ]
    return reduce(add, parts)


def word_count(lowered: Column, language: str) -> Column:
    """Search terms of a lower-case text, stop words left out: counted in place, no word is cut out."""
    found = F.regexp_count(lowered, F.lit(WORD))
    stops = ANALYZERS[language].stops
    return found - F.regexp_count(lowered, F.lit(any_word(stops))) if stops else found


def occurrences(lowered: Column, term: str, language: str) -> Column:
    return F.regexp_count(lowered, F.lit(any_pattern([term], language)))


def corpus_facts(df: DataFrame, text: Column, terms: list[str], language: str) -> DataFrame:
    """One row: documents, mean length and document frequency of each term, in one pass over the texts."""
    p = df.select(F.lower(F.coalesce(text, F.lit(""))).alias("t"))
    return p.agg(
        F.count(F.lit(1)).cast("double").alias("n_docs"),
        F.avg(word_count(F.col("t"), language)).alias("mean_length"),
        *[F.sum(F.col("t").rlike(any_pattern([t], language)).cast("double")).alias(f"df{i}") for i, t in enumerate(terms)],
    )


def scan_scores(
    df: DataFrame,
    corpus: DataFrame,
    text: Column,
    terms: list[str],
    language: str,
    matched_only: bool = False,
    facts: DataFrame | None = None,
) -> DataFrame:
    """Add ``_score`` to the rows of ``df`` by BM25 over ``corpus``, without an index.

    Corpus statistics are one partial aggregate over a narrow scan, read back as
    a scalar subquery: one row is exchanged and nothing is joined. Where they are stored,
    such as with an index of the same rows, ``facts`` takes the place of that scan. ``matched_only``
    drops rows without any of the terms before they are scored.
    """
    if not terms:
        scored = df.withColumn("_score", F.lit(0.0))
        return scored.where(F.lit(False)) if matched_only else scored
    lowered = F.lower(F.coalesce(text, F.lit("")))
    if matched_only:
        df = df.where(lowered.rlike(any_pattern(terms, language)))
    facts = (corpus_facts(corpus, text, terms, language) if facts is None else facts).select(F.struct("*")).scalar()
    profiled = df.withColumn("__f", facts)
    score = bm25(
        [occurrences(lowered, t, language) for t in terms],
        [F.col(f"__f.df{i}") for i in range(len(terms))],
        word_count(lowered, language).cast("double"),
        F.col("__f.n_docs"),
        F.col("__f.mean_length"),
    )
    return profiled.withColumn("_score", score).drop("__f")


def first_match(text: Column, term: str, language: str = "simple", prefix: bool = True) -> Column:
    """struct<pos, rank_pos> of the first word that equals or starts with ``term``;
    both are null without such a word."""
    if language == "simple":
        word = re.escape(term)
        ending = "" if prefix else f"(?!{LETTER})"
        # Only the text before the word is cut and counted.
        head = text_before(F.lower(text), rf"{word}(?<!{LETTER}{word}){ending}")

        def count(before: Column) -> Column:
            pos = F.size(words(before))
            breaks = F.size(F.split(before, HARD_BREAK)) - 1
            found = before.isNotNull()
            return F.struct(
                F.when(found, pos).alias("pos"), F.when(found, pos + BREAK_GAP * breaks).alias("rank_pos")
            )

        return let(head, count)

    def pick(ts: Column) -> Column:
        hit = F.filter(ts, lambda t: t["term"].startswith(term) if prefix else t["term"] == term)
        return F.get(hit, F.lit(0))

    first = let(placed_tokens(text, language), pick)
    return F.struct(first["pos"].alias("pos"), first["rank_pos"].alias("rank_pos"))


class Key(NamedTuple):
    """One column of an order; nulls come first going up and last going down."""

    column: Column
    descending: bool = False

    def sort(self) -> Column:
        return self.column.desc_nulls_last() if self.descending else self.column.asc_nulls_first()

    def before(self, value: Column) -> Column:
        """Whether a row comes before a value (null: before or behind all others) by this key alone."""
        if self.descending:
            return self.column.isNotNull() & (value.isNull() | (self.column > value))
        return value.isNotNull() & (self.column.isNull() | (self.column < value))


class Order(list):
    """Sort columns, and the keys that they were made of."""

    def __init__(self, keys: Iterable[Key]):
        self.keys = tuple(keys)
        super().__init__(k.sort() for k in self.keys)


def policy_order(policy: str, key: str) -> Order:
    """Sort keys of a ranking policy over ``_score``, ``_pos`` and ``_rank_pos``."""
    if policy == "score":
        return Order([Key(F.col("_score"), True), Key(F.col(key), True)])
    if policy == "position":
        return Order([Key(F.col("_rank_pos")), Key(F.col(key))])
    if policy == "newest":
        return Order([Key(F.col(key), True)])
    if policy == "first_word":
        return Order([Key(F.col("_pos") == 0, True), Key(F.col(key), True)])
    raise ValueError(f"unknown ranking policy {policy!r}; use one of {POLICIES}")


def top_per_group(df: DataFrame, group: str, order_column: str, key: str, descending: bool = True) -> DataFrame:
    """First hit of each group.

    A max over (rank value, key) merges inside every task, so a group that holds
    a third of all hits is never gathered, unlike with a ranking window.
    """
    rank = F.struct(F.col(order_column), F.col(key))
    row = F.struct(*[F.col(c) for c in df.columns])
    best = F.max_by(row, rank) if descending else F.min_by(row, rank)
    return df.groupBy(F.col(group).alias("__group")).agg(best.alias("__row")).select("__row.*")


def with_position(page: DataFrame, order: list[Column], name: str = "_position") -> DataFrame:
    """Number the rows of one page (already limited, so one small partition)."""
    return page.withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("bigint"))
