"""Search of an index: postings of the query's terms, scored and filtered."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seekframe.functions.text import query_terms
from seekframe.operators.match import parse_web
from seekframe.operators.predicates import apply_trashed
from seekframe.operators.rank import Key, Order, bm25, policy_order
from seekframe.plans.search import Matched, Search, register_strategy
from seekframe.sources.index.postings import STORED
from seekframe.sources.index.store import Index
from seekframe.spec import SOFT_FLAG

MATCH_ALL = "*"


@dataclass(frozen=True)
class Slot:
    """One thing to find: a term, a term prefix, or a phrase of (term, place)."""

    words: tuple[tuple[str, int], ...]
    prefix: bool = False

    @property
    def term(self) -> str:
        return self.words[-1][0]


def _groups(s: Search, language: str) -> list[list[tuple[bool, Slot]]]:
    """OR'ed groups of AND'ed (negated, slot)."""
    mode = s.options.get("mode", "plain")
    if mode == "websearch":
        return [[(neg, Slot(tuple(p))) for neg, p in g] for g in parse_web(s.query, language)]
    terms = query_terms(s.query, language)
    if not terms:
        return []
    if mode == "phrase":
        return [[(False, Slot(tuple(terms)))]]
    by_prefix = s.options.get("prefix", True)
    slots = [Slot((t,), by_prefix and i == len(terms) - 1) for i, t in enumerate(terms)]
    if mode == "natural":
        return [[(False, slot)] for slot in slots]
    return [[(False, slot) for slot in slots]]


def _word_condition(word: str, prefix: bool) -> Column:
    return F.col("term").startswith(word) if prefix else F.col("term") == word


def _scan_words(slots: list[Slot]) -> list[tuple[str, bool]]:
    """Words and prefixes whose postings are read."""
    return list(dict.fromkeys((word, slot.prefix) for slot in slots for word, _ in slot.words))


def _scan_condition(words: list[tuple[str, bool]], fields: list[str] | None) -> Column:
    """Terms wanted, as tests the reader applies."""
    condition = reduce(or_, [_word_condition(*w) for w in words])
    return condition if fields is None else condition & F.col("field").isin(fields)


def _per_document(postings: DataFrame, slots: list[Slot], one_field: bool, used: list[str]) -> DataFrame:
    """One row per document: ``tf<i>`` and ``exact<i>`` of each slot, rank inputs and stored fields in use.

    A partial aggregate runs before the exchange; all postings of a term are
    spread over many files, so a very common term is no single task's work. One
    word in one field has one posting per document: nothing needs to move.
    """
    if one_field and len(slots) == 1 and len(slots[0].words) == 1 and not slots[0].prefix:
        return postings.select(
            "key",
            "len",
            "gone",
            *used,
            F.col("first_rank").alias("_rank_pos"),
            F.get(F.col("positions"), F.lit(0)).alias("_pos"),
            F.col("tf").alias("tf0"),
            F.lit(1).alias("exact0"),
        )
    phrases = [i for i, slot in enumerate(slots) if len(slot.words) > 1]
    # Stored fields follow from the key; as part of it they stay out of the aggregates.
    grouping = ["key", *used, "field"] if phrases else ["key", *used]
    inputs = [
        F.max("len").alias("len"),
        F.max("gone").alias("gone"),
        F.min("first_rank").alias("_rank_pos"),
        F.min(F.get(F.col("positions"), F.lit(0))).alias("_pos"),
    ]
    for i, slot in enumerate(slots):
        if i in phrases:
            for j, (word, _) in enumerate(slot.words):
                places = F.collect_list(F.when(F.col("term") == word, F.col("positions")))
                inputs.append(F.flatten(places).alias(f"__places{i}_{j}"))
            continue
        hit = _word_condition(slot.term, slot.prefix)
        inputs.append(F.sum(F.when(hit, F.col("tf")).otherwise(0)).alias(f"tf{i}"))
        inputs.append(F.max((F.col("term") == slot.term).cast("int")).alias(f"exact{i}"))
    grouped = postings.groupBy(*grouping).agg(*inputs)
    if not phrases:
        return grouped
    for i in phrases:
        first = slots[i].words[0][1]
        follow = [(j, place - first) for j, (_, place) in enumerate(slots[i].words)][1:]
        starts = F.filter(F.col(f"__places{i}_0"), _phrase_test(i, follow))
        grouped = grouped.withColumn(f"tf{i}", F.size(starts)).withColumn(f"exact{i}", F.lit(1))
    merged = [F.max("len").alias("len"), F.max("gone").alias("gone")]
    merged += [F.min("_rank_pos").alias("_rank_pos"), F.min("_pos").alias("_pos")]
    merged += [F.sum(f"tf{i}").alias(f"tf{i}") for i in range(len(slots))]
    merged += [F.max(f"exact{i}").alias(f"exact{i}") for i in range(len(slots))]
    return grouped.groupBy("key", *used).agg(*merged)


def _phrase_test(i: int, follow: list[tuple[int, int]]):
    return lambda p: reduce(
        and_, [F.array_contains(F.col(f"__places{i}_{j}"), p + distance) for j, distance in follow]
    )


def _document_frequencies(index: Index, docs: DataFrame, slots: list[Slot], fields) -> DataFrame:
    """One row ``df0, df1, ...``: from the dictionary when it can tell, else from the hits."""
    plain = fields is None and all(len(s.words) == 1 and not s.prefix for s in slots)
    if plain:
        dictionary = index.term_changes(F.col("term").isin([s.term for s in slots]))
        counts = [
            F.coalesce(F.sum(F.when(F.col("term") == s.term, F.col("df"))), F.lit(0)).alias(f"df{i}")
            for i, s in enumerate(slots)
        ]
        return dictionary.agg(*counts)
    return docs.agg(*[F.count(F.when(F.col(f"tf{i}") > 0, 1)).alias(f"df{i}") for i in range(len(slots))])


def _declared(index: Index, s: Search) -> None:
    """Fields used to filter or sort must be declared when the index declares any."""
    m = index.manifest
    filters = [w[0] for w in s.wheres] + list(s.where_ins) + list(s.where_not_ins)
    for kind, used, allowed in (
        ("filterable", filters, m.filterable),
        ("sortable", [n for n, _ in (*s.options.get("sort", ()), *s.orders)], m.sortable),
    ):
        for name in used:
            if name not in index.schema.names:
                raise ValueError(f"{m.name}: no field {name!r}")
            if allowed is not None and name not in allowed and name != index.key:
                raise ValueError(f"{m.name}: {name!r} is not {kind}")


def _used_fields(s: Search) -> set[str]:
    """Fields of the documents that the search filters or sorts on."""
    ordered = [n for n, _ in (*s.options.get("sort", ()), *s.orders)]
    return {*(w[0] for w in s.wheres), *s.where_ins, *s.where_not_ins, *ordered}


def index_strategy(s: Search) -> Matched:
    index: Index = s.index
    if s.pre is not None:
        raise ValueError("an index search has no row query to change before its limit; use post_filter")
    _declared(index, s)
    key = index.key
    flag = SOFT_FLAG if SOFT_FLAG in index.schema.names else None
    explicit = s.sort_columns()
    used = _used_fields(s)
    needs_docs = s.custom_fn is not None or bool(used - {key, *index.manifest.stored})

    if s.query in ("", MATCH_ALL):
        docs = apply_trashed(index.docs(), s.trashed, None, flag)
        return Matched(s.constrain(docs), explicit or Order([Key(F.col(key), True)]))

    groups = _groups(s, index.manifest.language)
    if not groups:
        return Matched(index.docs().where(F.lit(False)), explicit or Order([Key(F.col(key), True)]))
    slots = list(dict.fromkeys(slot for g in groups for _, slot in g))
    at = {slot: i for i, slot in enumerate(slots)}
    fields = s.options.get("fields")
    excluding = any(all(negated for negated, _ in g) for g in groups)
    # Documents without any of the words have no postings to read a field from.
    needs_docs = needs_docs or (excluding and bool(used - {key}))
    stored = [] if needs_docs else [STORED + f for f in index.manifest.stored if f in used]
    wanted = _scan_words(slots)
    postings = index.postings(wanted, _scan_condition(wanted, fields))
    found = _per_document(postings, slots, len(fields or index.text_fields) == 1, stored)

    policy = s.options.get("policy", "score")
    order = explicit or policy_order(policy, key)
    hits = found
    if excluding:
        # "everything but": documents without any of the terms can match too.
        everything = index.docs().select(F.col(key).alias("key"), *([F.col(flag).alias("__flag")] if flag else []))
        hits = everything.join(found, "key", "left")
        if flag:
            hits = hits.withColumn("gone", F.col("__flag")).drop("__flag")
    present = lambda slot: F.coalesce(F.col(f"tf{at[slot]}"), F.lit(0)) > 0
    tests = [reduce(and_, [~present(x) if neg else present(x) for neg, x in g]) for g in groups]
    hits = hits.where(reduce(or_, tests))
    if flag is not None:
        hits = apply_trashed(hits, s.trashed, None, "gone")

    scored = [slot for g in groups for neg, slot in g if not neg]
    if explicit is None and policy == "score" and scored:
        scored = list(dict.fromkeys(scored))
        facts = _document_frequencies(index, found, slots, fields).select(F.struct("*")).scalar()
        hits = hits.withColumn("__f", facts)
        score = bm25(
            [F.coalesce(F.col(f"tf{at[x]}"), F.lit(0)).cast("double") for x in scored],
            [F.col(f"__f.df{at[x]}").cast("double") for x in scored],
            F.col("len").cast("double"),
            F.lit(float(index.manifest.n_docs)),
            F.lit(float(index.manifest.mean_length)),
        )
        exact = F.greatest(F.lit(0), F.lit(0), *[F.col(f"exact{at[x]}") for x in scored if x.prefix])
        hits = hits.withColumn("_score", score).withColumn("_exact", exact)
        if s.options.get("exact_first", True) and any(x.prefix for x in scored):
            order = Order([Key(F.col("_exact"), True), *order.keys])
    else:
        hits = hits.withColumn("_score", F.lit(0.0)).withColumn("_exact", F.lit(0))
    values = [F.col(f).alias(f.removeprefix(STORED)) for f in stored]
    hits = hits.select(F.col("key").alias(key), "_score", "_exact", "_pos", "_rank_pos", *values)
    if needs_docs:
        hits = s.constrain(hits.join(index.docs(), key, "inner"))
    elif used:
        hits = s.constrain(hits)
    return Matched(hits, order)


register_strategy("index", index_strategy)
