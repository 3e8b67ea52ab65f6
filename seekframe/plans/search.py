"""The search builder: immutable, and every terminal compiles to one DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field, replace
from functools import cache
from typing import Any

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from seekframe.functions.text import highlight, query_terms, word_forms
from seekframe.operators.hydrate import hydrate
from seekframe.operators.match import contains_any, joined_text, like_any
from seekframe.operators.predicates import apply_in, apply_not_in, apply_trashed, apply_wheres
from seekframe.operators.rank import Key, Order, policy_order, scan_scores, with_position
from seekframe.plans.paging import DEFAULT_PER_PAGE, Page, page_info, page_slice, simple_info
from seekframe.spec import SearchSpec

Transform = Callable[[DataFrame], DataFrame]
HIDDEN_PLACE = "__place"


@dataclass(frozen=True)
class Matched:
    """What a strategy returns: every hit, and the order they come in."""

    hits: DataFrame
    order: list[Column]


Strategy = Callable[["Search"], Matched]
STRATEGIES: dict[str, Strategy] = {}


def register_strategy(name: str, strategy: Strategy) -> None:
    """Add a way of searching under a name for ``Search.using``."""
    STRATEGIES[name] = strategy


@dataclass(frozen=True)
class Search:
    source: DataFrame
    spec: SearchSpec
    query: str = ""
    strategy: str = "like"
    index: Any = None
    wheres: tuple = ()
    where_ins: dict = field(default_factory=dict)
    where_not_ins: dict = field(default_factory=dict)
    trashed: str = "exclude"
    limit: int | None = None
    orders: tuple = ()
    options: dict = field(default_factory=dict)
    pre: Transform | None = None
    post: Transform | None = None
    custom_fn: Callable[[DataFrame], DataFrame] | None = None
    raw_fn: Transform | None = None

    # ---- what to search -------------------------------------------------

    def using(self, strategy: str) -> "Search":
        if strategy not in STRATEGIES:
            raise ValueError(f"unknown strategy {strategy!r}; use one of {sorted(STRATEGIES)}")
        return replace(self, strategy=strategy)

    def within(self, index) -> "Search":
        """Search an index instead of the table (an ``Index`` or what a catalog opens)."""
        return replace(self, index=index, strategy="index")

    def with_options(self, **options) -> "Search":
        return replace(self, options={**self.options, **options})

    # ---- constraints ----------------------------------------------------

    def where(self, name: str, operator: Any, *value: Any) -> "Search":
        """``where(f, v)`` or ``where(f, operator, v)``."""
        triple = (name, operator, value[0]) if value else (name, "=", operator)
        return replace(self, wheres=(*self.wheres, triple))

    def where_in(self, name: str, values: Iterable | DataFrame) -> "Search":
        listed = values if isinstance(values, DataFrame) else list(values)
        return replace(self, where_ins={**self.where_ins, name: listed})

    def where_not_in(self, name: str, values: Iterable | DataFrame) -> "Search":
        listed = values if isinstance(values, DataFrame) else list(values)
        return replace(self, where_not_ins={**self.where_not_ins, name: listed})

    def with_trashed(self) -> "Search":
        return replace(self, trashed="include")

    def only_trashed(self) -> "Search":
        return replace(self, trashed="only")

    # ---- order and size -------------------------------------------------

    def take(self, limit: int) -> "Search":
        return replace(self, limit=limit)

    def order_by(self, name: str, direction: str = "asc") -> "Search":
        way = "asc" if direction.lower() == "asc" else "desc"
        return replace(self, orders=(*self.orders, (name, way)))

    def order_by_desc(self, name: str) -> "Search":
        return self.order_by(name, "desc")

    def latest(self, name: str | None = None) -> "Search":
        return self.order_by(name or self.spec.created, "desc")

    def oldest(self, name: str | None = None) -> "Search":
        return self.order_by(name or self.spec.created, "asc")

    # ---- hooks ----------------------------------------------------------

    def pre_filter(self, fn: Transform) -> "Search":
        """Change the row query of a scan before it is limited and paged."""
        return replace(self, pre=fn)

    def post_filter(self, fn: Transform) -> "Search":
        """Change the rows of a page; its size, keys and total stay as they were."""
        return replace(self, post=fn)

    def custom(self, fn: Callable[[DataFrame], DataFrame]) -> "Search":
        """Replace the handling of all where constraints."""
        return replace(self, custom_fn=fn)

    def raw_hook(self, fn: Transform) -> "Search":
        """Change the hits after the search; not seen by ``raw`` and ``keys``."""
        return replace(self, raw_fn=fn)

    # ---- building blocks for strategies ----------------------------------

    def sort_columns(self) -> Order | None:
        """Explicit order: a column keeps its first place and its last direction.

        A ``sort`` option, pairs of name and direction, comes before ``order_by``.
        """
        orders = (*self.options.get("sort", ()), *self.orders)
        if not orders:
            return None
        folded: dict[str, str] = {}
        for name, way in orders:
            folded[name] = way
        keys = [Key(F.col(n), way != "asc") for n, way in folded.items()]
        # The key makes the order total, so that pages never overlap.
        if self.spec.key not in folded:
            keys.append(Key(F.col(self.spec.key), True))
        return Order(keys)

    def constrain(self, df: DataFrame) -> DataFrame:
        """Where, IN and NOT IN lists, or the custom function in their place."""
        if self.custom_fn is not None:
            return df.transform(self.custom_fn)
        df = apply_wheres(df, self.wheres)
        for name, values in self.where_ins.items():
            df = apply_in(df, name, values)
        for name, values in self.where_not_ins.items():
            df = apply_not_in(df, name, values)
        return df

    def matched(self) -> Matched:
        return STRATEGIES[self.strategy](self)

    # ---- terminals ------------------------------------------------------

    def raw(self) -> DataFrame:
        """Hits in order, limited, before any hook."""
        found = self.matched()
        ordered = found.hits.orderBy(*found.order)
        return ordered if self._cap() is None else ordered.limit(self._cap())

    def get(self) -> DataFrame:
        """Rows in order."""
        found = self.matched()
        ordered = found.hits.orderBy(*found.order)
        cap = self._cap()
        return self._rows(ordered if cap is None else ordered.limit(cap), found.order, cap)

    def first(self) -> DataFrame:
        found = self.matched()
        return self._rows(found.hits.orderBy(*found.order).limit(1), found.order, 1)

    def cursor(self) -> Iterator[Row]:
        """Rows one by one, one task's worth on the driver at a time."""
        return self.get().toLocalIterator()

    def documents(self) -> DataFrame:
        """Indexed documents of the hits, in hit order, from the index alone.

        The ``attributes`` option narrows them to some fields and the key.
        """
        found = self.matched()
        cap = self._cap()
        hits = found.hits.orderBy(*found.order)
        hits = _placed(hits if cap is None else hits.limit(cap), found.order, cap)
        docs = self.index.docs()
        attributes = self.options.get("attributes")
        if attributes is not None:
            docs = docs.select(*dict.fromkeys([self.spec.key, *attributes]))
        return self._highlighted(_in_place(hydrate(hits, docs, self.spec.key, n_hits=cap)))

    def keys(self) -> DataFrame:
        return self.raw().select(self.spec.key)

    def total(self) -> DataFrame:
        """One row ``total_count``: all hits, whatever the limit."""
        return self.matched().hits.agg(F.count(F.lit(1)).alias("total_count"))

    def capped_total(self, cap: int) -> DataFrame:
        """Hits a capped fetch gathers (``found``) and all there are (``out_of``)."""
        n = F.count(F.lit(1))
        return self.matched().hits.agg(F.least(n, F.lit(cap).cast("bigint")).alias("found"), n.alias("out_of"))

    def paginate(self, per_page: int | None = None, page: int | None = None) -> Page:
        """A page with its total. A limit set by ``take`` plays no part."""
        per_page, page = per_page or DEFAULT_PER_PAGE, max(1, page or 1)
        found = self.matched()

        def rows() -> DataFrame:
            return self._rows(page_slice(found.hits, found.order, per_page, page), found.order, per_page)

        return Page(rows, lambda: self._page_info(rows, per_page, page))

    def simple_paginate(self, per_page: int | None = None, page: int | None = None) -> Page:
        """A page that only tells whether another one follows: nothing is counted."""
        per_page, page = per_page or DEFAULT_PER_PAGE, max(1, page or 1)
        found = self.matched()
        # One fetch of a row too many serves the rows and the facts.
        probe = cache(lambda: page_slice(found.hits, found.order, per_page, page, extra=1))

        def rows() -> DataFrame:
            return self._rows(probe().orderBy(*found.order).limit(per_page), found.order, per_page)

        return Page(rows, lambda: simple_info(probe(), per_page, page))

    def paginate_raw(self, per_page: int | None = None, page: int | None = None) -> Page:
        """As ``paginate``, with hits (after the raw hook) in place of rows."""
        per_page, page = per_page or DEFAULT_PER_PAGE, max(1, page or 1)
        found = self.matched()

        def hits() -> DataFrame:
            sliced = page_slice(found.hits, found.order, per_page, page)
            return sliced if self.raw_fn is None else sliced.transform(self.raw_fn)

        return Page(hits, lambda: self._page_info(hits, per_page, page, hooked=self.raw_fn))

    # ---- helpers --------------------------------------------------------

    def _cap(self) -> int | None:
        caps = [c for c in (self.limit, self.options.get("max_results")) if c is not None]
        return min(caps) if caps else None

    def _page_info(self, rows: Callable[[], DataFrame], per_page: int, page: int, hooked: Any = None) -> DataFrame:
        if hooked is not None or self.raw_fn is not None or self.post is not None or self._joins_rows():
            count = rows().agg(F.count(F.lit(1)).alias("n")).scalar()
        else:
            left = F.col("total_count") - F.lit((page - 1) * per_page)
            count = F.greatest(F.lit(0).cast("bigint"), F.least(left, F.lit(per_page).cast("bigint")))
        return page_info(self.total(), count, per_page, page)

    def _joins_rows(self) -> bool:
        return self.index is not None and self.source is not None

    def _rows(self, hits: DataFrame, order: list[Column], n_hits: int | None) -> DataFrame:
        """Rows of hits, with ``_highlight`` (a struct of the fields that the option names) if asked for."""
        return self._highlighted(self._hit_rows(hits, order, n_hits))

    def _highlighted(self, rows: DataFrame) -> DataFrame:
        fields = self.options.get("highlight")
        if not fields:
            return rows
        missing = [f for f in fields if f not in rows.columns]
        if missing:
            raise ValueError(f"no field {missing[0]!r} to highlight; an index search has its fields in documents(), or with its table")
        language = self.spec.language if self.index is None else self.index.manifest.language
        terms = [w for t, _ in query_terms(self.query, language) for w in word_forms(t, language)]
        marked = [highlight(F.col(f), list(dict.fromkeys(terms)), self.options.get("prefix", False)).alias(f) for f in fields]
        return rows.withColumn("_highlight", F.struct(*marked))

    def _hit_rows(self, hits: DataFrame, order: list[Column], n_hits: int | None) -> DataFrame:
        """Hooks and, for an index, the join back to the table, in hit order."""
        if not self._joins_rows():
            if self.raw_fn is None and self.post is None:
                return hits
            hooked = hits if self.raw_fn is None else hits.transform(self.raw_fn)
            hooked = hooked if self.post is None else hooked.transform(self.post)
            return hooked.orderBy(*order)
        hits = _placed(hits, order, n_hits)
        if self.raw_fn is not None:
            hits = hits.transform(self.raw_fn)
        rows = self.source if self.post is None else self.source.transform(self.post)
        # A hook may multiply hits, and with it goes the bound of the page.
        bound = n_hits if self.raw_fn is None else None
        return _in_place(hydrate(hits, rows, self.spec.key, n_hits=bound))


def _placed(hits: DataFrame, order: list[Column], n_hits: int | None) -> DataFrame:
    """Limited hits with their ``_position`` 1, 2, ... (a limit has gathered them);
    all hits with a hidden place that grows along them over many tasks."""
    if n_hits is not None:
        return with_position(hits, order)
    return hits.withColumn(HIDDEN_PLACE, F.monotonically_increasing_id())


def _in_place(rows: DataFrame) -> DataFrame:
    if HIDDEN_PLACE in rows.columns:
        return rows.orderBy(HIDDEN_PLACE).drop(HIDDEN_PLACE)
    return rows.orderBy("_position")


def search(source: DataFrame, spec: SearchSpec, query: str = "", **options) -> Search:
    """Start a search of a table."""
    spec.validate(source)
    return Search(source=source, spec=spec, query=query).with_options(**options)


def search_index(index, query: str = "", **options) -> Search:
    """Start a search of an index, without the table it was built from."""
    spec = SearchSpec(index.manifest.name, index.key)
    return Search(source=None, spec=spec, query=query, strategy="index", index=index).with_options(**options)


def _visible(s: Search) -> DataFrame:
    return apply_trashed(s.source, s.trashed, s.spec.deleted, None)


def _contains_strategy(s: Search) -> Matched:
    """Literal substring in any field of eligible rows; order is the key, descending."""
    df = s.constrain(_visible(s))
    if s.pre is not None and s.custom_fn is None:
        df = df.transform(s.pre)
    if s.spec.enrich is not None:
        df = df.transform(s.spec.enrich)
    if s.spec.should_index is not None:
        df = df.where(s.spec.eligible())
    predicate = contains_any(df, s.spec, s.query, s.options.get("null_text", s.spec.null_text))
    if predicate is not None:
        df = df.where(predicate)
    return Matched(df, s.sort_columns() or Order([Key(F.col(s.spec.key), True)]))


def _like_strategy(s: Search) -> Matched:
    """LIKE, prefix, key and full-text match; by relevance when words are matched."""
    visible = _visible(s)
    df = s.constrain(visible)
    if s.pre is not None and s.custom_fn is None:
        df = df.transform(s.pre)
    predicate = like_any(
        df, s.spec, s.query, literal=s.options.get("literal", False), strict=s.options.get("strict", False)
    )
    if predicate is not None:
        df = df.where(predicate)
    explicit = s.sort_columns()
    if explicit is not None:
        return Matched(df, explicit)
    ranked = s.spec.fulltext and s.query != "" and s.spec.mode in ("plain", "phrase", "websearch")
    if not ranked:
        return Matched(df, Order([Key(F.col(s.spec.key), True)]))
    terms = list(dict.fromkeys(t for t, _ in query_terms(s.query, s.spec.language)))
    stored = s.options.get("statistics")
    facts = None if stored is None else stored.facts(terms)
    df = scan_scores(df, visible, joined_text(s.spec), terms, s.spec.language, facts=facts)
    return Matched(df, policy_order("score", s.spec.key))


register_strategy("contains", _contains_strategy)
register_strategy("like", _like_strategy)
