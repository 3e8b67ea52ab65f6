"""The search string as a row predicate: one pass over the table, no shuffle."""

from __future__ import annotations

import re
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seekframe.functions.render import may_contain, render_text
from seekframe.functions.text import phrase_pattern, query_terms, stem_root
from seekframe.operators.predicates import ilike, like_pattern, literal_pattern
from seekframe.spec import SearchSpec, column_type, evaluate, is_text

MAX_KEY = 2**63 - 1


def contains_any(df: DataFrame, spec: SearchSpec, query: str, null_text: bool = True) -> Column | None:
    """Literal, case-blind substring of any document field, whatever its type."""
    if query == "":
        return None
    needle = query.lower()
    values = [evaluate(field) for field in spec.fields(df.columns).values()]
    shown = df.select(*[v.alias(f"v{i}") for i, v in enumerate(values)]).schema
    parts = []
    for value, shown_as in zip(values, shown):
        if may_contain(needle, shown_as.dataType):
            parts.append(F.lower(render_text(value, shown_as.dataType)).contains(needle))
        if null_text and needle in "null":
            parts.append(value.isNull())
    return reduce(or_, parts) if parts else F.lit(False)


def like_any(
    df: DataFrame, spec: SearchSpec, query: str, *, literal: bool = False, strict: bool = False
) -> Column | None:
    """The mixed text search: key equality, LIKE, prefix and full text, OR'ed.

    None means no predicate: an empty string, or no column to look into.
    """
    if query == "":
        return None
    columns = spec.matched_columns(df)
    by_key = spec.key in columns and re.fullmatch(r"[0-9]+", query) is not None
    body = literal_pattern(query) if literal else like_pattern(query)
    parts: list[Column] = []
    if by_key:
        parts.append(key_equals(df, spec.key, query))
    for name in columns:
        if name in spec.fulltext or (by_key and name == spec.key) or not is_text(df, name):
            continue
        parts.append(ilike(F.col(name), f"{body}%" if name in spec.prefix else f"%{body}%"))
    if spec.fulltext:
        if spec.mode == "like":
            parts += [ilike(F.col(n), f"%{body}%") for n in spec.fulltext if is_text(df, n)]
        else:
            parts.append(fulltext(df, spec, query))
    if not parts:
        if strict:
            raise ValueError(f"{spec.name}: no column can be searched")
        return None
    return reduce(or_, parts)


def key_equals(df: DataFrame, key: str, digits: str) -> Column:
    number = int(digits)
    if is_text(df, key):
        return F.col(key) == digits
    if number > MAX_KEY:
        return F.lit(False)
    return F.col(key) == F.lit(number).cast("bigint")


def joined_text(spec: SearchSpec) -> Column:
    """Full-text columns as one text, nulls as nothing."""
    return F.concat_ws(" ", *[F.coalesce(F.col(c), F.lit("")) for c in spec.fulltext])


def fulltext(df: DataFrame, spec: SearchSpec, query: str) -> Column:
    """Word match over the full-text columns in the spec's mode."""
    return fulltext_match(joined_text(spec), query, spec.mode, spec.language)


def fulltext_match(text: Column, query: str, mode: str, language: str) -> Column:
    """Boolean word match of one text.

    Every word or phrase is one regular expression over the text, put into lower
    case once, so a text is never cut into words. A plain substring test goes
    first: it is far cheaper, and most rows fail it.
    """
    if mode == "websearch":
        groups = parse_web(query, language)
    elif mode == "natural":
        groups = [[(False, [t])] for t in query_terms(query, language)]
    elif mode == "phrase":
        terms = query_terms(query, language)
        groups = [[(False, terms)]] if terms else []
    else:
        terms = query_terms(query, language)
        groups = [[(False, [t]) for t in terms]] if terms else []
    if not groups:
        return F.lit(False)

    def test(lowered: Column) -> Column:
        tests = []
        for group in groups:
            parts = [holds(lowered, phrase, language) for negated, phrase in group if not negated]
            parts += [~holds(lowered, phrase, language) for negated, phrase in group if negated]
            tests.append(reduce(and_, parts))
        return reduce(or_, tests)

    return F.exists(F.array(F.lower(text)), test)


def holds(lowered: Column, phrase: list[tuple[str, int]], language: str) -> Column:
    """Whether a lower-case text has the words of a phrase at their distances."""
    needed = [lowered.contains(stem_root(w, language)) for w, _ in phrase]
    return reduce(and_, needed) & lowered.rlike(phrase_pattern(phrase, language))


def parse_web(query: str, language: str) -> list[list[tuple[bool, list[tuple[str, int]]]]]:
    """Quotes, ``or`` and ``-``: a list of OR'ed groups of AND'ed (negated, phrase)."""
    groups: list[list] = [[]]
    for quoted_not, quoted, bare in re.findall(r'(-?)"([^"]*)"?|(\S+)', query):
        if bare.lower() == "or":
            groups.append([])
            continue
        negated = bool(quoted_not) or (bare.startswith("-") and len(bare) > 1)
        terms = query_terms(quoted or bare.lstrip("-"), language)
        if terms:
            groups[-1].append((negated, terms))
    return [g for g in groups if g]


def prefix_match(df: DataFrame, name: str, prefix: str) -> Column:
    """Case-exact prefix, a test the Parquet reader can apply to row groups."""
    if column_type(df, name) is None:
        raise ValueError(f"no column {name!r}")
    return F.col(name).startswith(prefix)
