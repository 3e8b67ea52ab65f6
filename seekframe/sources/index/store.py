"""Keyed document indexes in Parquet: catalog, writes and reads.

An index is a folder of Parquet tables, each split by ``seg``, the commit that
wrote it::

    docs/seg=../bucket=..     documents, by hash of the key, with the terms of each
    postings/seg=..           term postings in files of disjoint ranges of terms
    ranges/seg=...json        the first and last term of each of these files
    terms/seg=..              change of each term's document count
    voids/seg=..              bitmaps of older documents that the commit voids
    removed/seg=..            those documents' keys, lengths and terms
    deletes/seg=..            keys the commit was asked to delete

A document is known by ``__src``, the segment it was first written in, and ``__ord``,
its ordinal there; a merge keeps both, so bitmaps hold whatever is merged meanwhile.
A commit writes new files only, and appears when its manifest does. A reader pins
one manifest. A commit's work grows with the change: it looks changed keys up in
the key columns of the buckets they fall in and never reads an old text. ``merge``
folds small segments into one by merging their sorted postings.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seekframe.functions.hashing import fingerprint, key_hash
from seekframe.functions.render import TEXT_TYPES
from seekframe.session import shared_dir
from seekframe.sources.index.bitmaps import MAX_SENT, VOIDS, bitmaps, chunk_of, merged, without_void
from seekframe.sources.index.manifest import Files, Manifest, Versions
from seekframe.sources.index.postings import (
    LENGTH,
    ORDINAL,
    RUN,
    RUNS,
    SOURCE,
    STORED,
    bucket_of,
    build_postings,
    document_runs,
    packed,
    packed_term,
    run_length,
    unpacked,
)
from seekframe.sources.tables import by_keys, key_range
from seekframe.spec import SOFT_FLAG, SearchSpec, documents

Listener = Callable[[dict], None]
PARTS = ("docs", "postings", "ranges", "terms", "voids", "removed", "deletes")
MODES = ("upsert", "create", "update", "emplace")
# Times a commit is made again after another job was first.
RETRIES = 3
#: Changed keys that are looked up as a list the reader can skip by; more are joined.
LISTED = 1_000
#: Postings files of a segment, about, at most; beyond it they grow. Their term ranges are read by searches.
MOST_FILES = 4_096
#: Words whose postings a task sorts, and the tasks at most; beyond it they sort more and cut what they
#: write into files. Up to so many ranges Spark hands rows out straight to disk; with more, a task
#: that reads documents sorts all postings of theirs first, in memory that it spills.
TASK_WORDS, MOST_RANGES = 500_000, 200
#: Of documents and postings, which make up nearly all that an import writes.
CODEC = "zstd"
#: Of documents: a term of theirs is written as what it adds to the one before.
DOCS_FORMAT = {"compression": CODEC, "parquet.writer.version": "PARQUET_2_0"}
#: Segments of like size that are merged into one.
FAN = 8
#: The change that wrote a document or asked for its removal: a later one wins, whenever it comes.
MARK = "__mark"
MARK_TYPE = T.StructType([T.StructField("ts", T.TimestampType()), T.StructField("seq", T.LongType())])


class IndexWriteError(ValueError):
    """A write that would break the index; nothing of it becomes visible."""


class LostRace(IndexWriteError):
    """Another job published the version first."""


def rejects(docs: DataFrame, key: str) -> DataFrame:
    """Documents an import cannot take: ``key, reason, n``."""
    counted = docs.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    reason = F.when(F.col("key").isNull(), "null key").when(F.col("n") > 1, "duplicate key")
    return counted.select("key", reason.alias("reason"), "n").where(F.col("reason").isNotNull())


def merge_documents(live: DataFrame, incoming: DataFrame, key: str, mode: str = "upsert") -> DataFrame:
    """The documents an import writes, given the live ones."""
    if mode not in MODES:
        raise ValueError(f"unknown import mode {mode!r}; use one of {MODES}")
    if mode == "upsert":
        return incoming
    if mode == "create":
        return incoming.join(live.select(key), key, "left_anti")
    if mode == "update":
        return incoming.join(live.select(key), key, "left_semi")
    old = live.select(F.col(key).alias("__old_key"), F.struct(*live.columns).alias("__old"))
    joined = incoming.join(old, F.col(key) == F.col("__old_key"), "left")
    fields = dict.fromkeys([*live.columns, *incoming.columns])
    return joined.select(*[_emplaced(f, f in incoming.columns, f in live.columns).alias(f) for f in fields])


def _emplaced(name: str, is_new: bool, is_old: bool) -> Column:
    if is_new and is_old:
        return F.coalesce(F.col(name), F.col(f"__old.{name}"))
    return F.col(name) if is_new else F.col(f"__old.{name}")


class Index:
    """One index at one version; writes return the index at the next version."""

    def __init__(self, spark: SparkSession, files: Files, manifest: Manifest, listeners: Sequence[Listener] = ()):
        self.spark = spark
        self.manifest = manifest
        self._files = files
        self._listeners = listeners
        self._versions = Versions(files, f"{manifest.name}/_manifest")

    @property
    def path(self) -> str:
        return f"{self._files.root}/{self.manifest.name}"

    @property
    def key(self) -> str:
        return self.manifest.key

    def refresh(self) -> "Index":
        return Index(self.spark, self._files, Manifest(**self._versions.latest()), self._listeners)

    def at_version(self, version: int) -> "Index":
        return Index(self.spark, self._files, Manifest(**self._versions.at(version)), self._listeners)

    # ---- reads ----------------------------------------------------------

    @property
    def schema(self) -> T.StructType:
        if self.manifest.schema is None:
            return T.StructType([])
        return T.StructType.fromJson(self.manifest.schema)

    @property
    def key_type(self) -> T.DataType:
        return self.schema[self.key].dataType

    @property
    def text_fields(self) -> list[str]:
        if self.manifest.searchable is not None:
            return list(self.manifest.searchable)
        return [
            f.name
            for f in self.schema
            if isinstance(f.dataType, TEXT_TYPES) and f.name != self.key and not f.name.startswith("_")
        ]

    def _read(self, part: str, schema: T.StructType | str, segments: Sequence[str] | None = None) -> DataFrame:
        ids = self.manifest.with_part(part) if segments is None else segments
        if not ids:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.path}/{part}/seg={i}" for i in ids]
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/{part}").parquet(*paths)

    def _docs_schema(self) -> T.StructType:
        runs = T.StructType.fromDDL(f"{RUNS} array<struct<{RUN.replace(' ', ':').replace(',:', ',')}>>")
        extra = [
            T.StructField(LENGTH, T.IntegerType()),
            *runs.fields,
            T.StructField(SOURCE, T.StringType()),
            T.StructField(ORDINAL, T.LongType()),
            T.StructField(MARK, MARK_TYPE),
        ]
        return T.StructType([*self.schema.fields, *extra, T.StructField("bucket", T.IntegerType())])

    def _postings_schema(self) -> T.StructType:
        known = T.StructType.fromDDL(f"{RUN}, len int, gone int, src string, ord long")
        own = [T.StructField(STORED + f, self.schema[f].dataType) for f in self.manifest.stored]
        return T.StructType([*known.fields, T.StructField("key", self.key_type), *own])

    def _live(self, df: DataFrame, source: str, ordinal: str) -> DataFrame:
        """Drop what a later commit has replaced or removed."""
        ids = self.manifest.with_part("voids")
        if not ids:
            return df
        voids = self._read("voids", VOIDS, ids).select("of", "chunk", "words")
        chunks = sum(s.get("chunks", 0) for s in self.manifest.segments)
        return without_void(df, voids if len(ids) == 1 else merged(voids), source, ordinal, chunks <= MAX_SENT)

    def _live_docs(self, segments: Sequence[str] | None = None) -> DataFrame:
        return self._live(self._read("docs", self._docs_schema(), segments), SOURCE, ORDINAL)

    def docs(self) -> DataFrame:
        """Live documents."""
        return self._live_docs().select(*self.schema.names)

    def postings(self, words: Sequence[tuple[str, bool]] | None = None, condition: Column | None = None) -> DataFrame:
        """Live postings; the condition is applied at the scan.

        With ``words`` (term, or prefix if the flag is set) only the files whose term ranges hold one are opened.
        """
        if words is None:
            found = self._read("postings", self._postings_schema())
        else:
            paths = [p for i in self.manifest.with_part("postings") for p in self.posting_files(i, words)]
            reader = self.spark.read.schema(self._postings_schema())
            found = reader.parquet(*paths) if paths else self.spark.createDataFrame([], self._postings_schema())
        return self._live(found if condition is None else found.where(condition), "src", "ord")

    def posting_files(self, segment: str, words: Sequence[tuple[str, bool]]) -> list[str]:
        """The postings files of a segment that can hold one of the words."""

        def may_hold(first: str, last: str) -> bool:
            return any(last >= w and (first <= w or (prefix and first.startswith(w))) for w, prefix in words)

        ranges = _ranges(self._files, f"{self.manifest.name}/ranges/seg={segment}.json")
        return [f"{self.path}/postings/seg={segment}/{name}" for name, first, last in ranges if may_hold(first, last)]

    def term_changes(self, condition: Column | None = None) -> DataFrame:
        """``term, df`` of each commit: what it added to the count of a term."""
        found = self._read("terms", TERMS).select("term", "df")
        return found if condition is None else found.where(condition)

    def terms(self, condition: Column | None = None) -> DataFrame:
        """Term dictionary: ``term, df``, exact under updates and deletes."""
        return self.term_changes(condition).groupBy("term").agg(F.sum("df").alias("df")).where("df > 0")

    def stats(self) -> DataFrame:
        m = self.manifest
        return self.spark.range(1).select(
            F.lit(m.n_docs).cast("bigint").alias("n_docs"), F.lit(m.mean_length).alias("avg_len")
        )

    def facts(self, terms: Sequence[str]) -> DataFrame:
        """One row: documents, mean length and document frequency of each term, kept in step by every commit.

        With it a scan of the indexed table is scored without a pass over its texts (option ``statistics``).
        """
        counted = [F.coalesce(F.sum(F.when(F.col("term") == t, F.col("df"))), F.lit(0)).cast("double").alias(f"df{i}") for i, t in enumerate(terms)]
        m = self.manifest
        known = [F.lit(float(m.n_docs)).alias("n_docs"), F.lit(float(m.mean_length)).alias("mean_length")]
        return self.term_changes(F.col("term").isin(list(terms))).agg(*counted).select(*known, "*")

    def changes(self) -> DataFrame:
        """Keys and operations of the commits: ``key, op, seg``."""
        written = self._read("docs", self._docs_schema()).select(
            F.col(self.key).alias("key"), F.lit("upsert").alias("op"), F.col(SOURCE).alias("seg")
        )
        removed = self._read("deletes", self._deletes_schema()).select("key", F.lit("delete").alias("op"), F.col("src").alias("seg"))
        return written.unionByName(removed)

    def _deletes_schema(self) -> T.StructType:
        return T.StructType(
            [
                T.StructField("key", self.key_type),
                T.StructField("bucket", T.IntegerType()),
                T.StructField("src", T.StringType()),
                T.StructField(MARK, MARK_TYPE),
            ]
        )

    # ---- settings -------------------------------------------------------

    def update_settings(
        self,
        searchable: Sequence[str] | None = None,
        filterable: Sequence[str] | None = None,
        sortable: Sequence[str] | None = None,
    ) -> "Index":
        """Declare attributes. The soft-delete flag is always filterable. A new
        list of searchable fields rebuilds the postings of an index in use; values of newly
        declared fields are read from the documents until then, and from beside the postings after it."""
        changes: dict = {}
        if searchable is not None:
            changes["searchable"] = list(searchable)
        if filterable is not None:
            changes["filterable"] = list(dict.fromkeys([*filterable, SOFT_FLAG]))
        if sortable is not None:
            changes["sortable"] = list(sortable)
        if searchable is None or not self.manifest.segments:
            return self._publish(self.manifest.next(**changes))
        # One commit: no reader sees new fields over old postings.
        changed = Index(self.spark, self._files, Manifest(**{**self.manifest.to_dict(), **changes}), self._listeners)
        return changed.commit(docs=self.docs(), replace=True, operation="compact")

    def declare_schema(self, schema: T.StructType) -> "Index":
        if self.manifest.schema is not None:
            raise IndexWriteError(f"{self.manifest.name} already has a schema")
        return self._publish(self.manifest.next(schema=json.loads(schema.json())))

    def pause(self) -> "Index":
        """Drop changes from now on, until ``resume``."""
        return self._change(paused=True)

    def resume(self) -> "Index":
        return self._change(paused=False)

    @contextmanager
    def paused(self) -> Iterator["Index"]:
        """Pause for a block of work; changes pass again after it, also when it raises."""
        before = self.manifest.paused
        held = self if before else self.pause()
        try:
            yield held
        finally:
            if not before:
                held.refresh().resume()

    def _change(self, **changes) -> "Index":
        """Publish a change of the manifest alone, on whatever version is the latest."""
        for _ in range(RETRIES):
            try:
                return self._publish(self.manifest.next(**changes))
            except LostRace:
                self = self.refresh()
        return self._publish(self.manifest.next(**changes))

    # ---- writes ---------------------------------------------------------

    def import_table(self, df: DataFrame, spec: SearchSpec, mode: str = "upsert", fresh: bool = False) -> "Index":
        """Bulk import of a table or of any filtered part of it; eligible rows only."""
        docs = documents(df, spec)
        return self.replace_all(docs) if fresh else self.write(docs, mode)

    def import_range(
        self, df: DataFrame, spec: SearchSpec, start, end, mode: str = "upsert", tidy: bool = False
    ) -> "Index":
        """Import the rows whose key lies in a closed range, as one part of a bulk import.

        ``tidy`` also removes documents of the range whose rows are gone or not eligible.
        """
        docs = documents(key_range(df, spec.key, start, end), spec)
        gone = self._left(docs, lambda live: key_range(live, self.key, start, end)) if tidy else None
        return self.commit(docs=docs, delete_keys=gone, mode=mode, operation="update")

    def import_keys(
        self, df: DataFrame, spec: SearchSpec, keys: DataFrame | Iterable, mode: str = "upsert", tidy: bool = False
    ) -> "Index":
        """Import the rows that a key list names; ``tidy`` as for a range."""
        listed = keys if isinstance(keys, DataFrame) else list(keys)
        docs = documents(by_keys(df, spec.key, listed), spec)
        gone = self._left(docs, lambda live: by_keys(live, self.key, listed)) if tidy else None
        return self.commit(docs=docs, delete_keys=gone, mode=mode, operation="update")

    def _left(self, docs: DataFrame, part: Callable[[DataFrame], DataFrame]) -> DataFrame | None:
        """Keys of a part of the index that the documents for it no longer have."""
        if self.manifest.schema is None or not self.manifest.segments:
            return None
        live = part(self.docs().select(self.key))
        return live.join(docs.select(F.col(self.key).cast(self.key_type).alias(self.key)), self.key, "left_anti")

    def write(self, docs: DataFrame, mode: str = "upsert") -> "Index":
        """Write documents by key."""
        return self.commit(docs=docs, mode=mode, operation="update")

    def replace_all(self, docs: DataFrame) -> "Index":
        """Flush and import in one step: readers see the old or the new documents."""
        return self.commit(docs=docs, replace=True, operation="update")

    def delete(self, keys: DataFrame | Iterable) -> "Index":
        """Remove documents by key; keys the index does not have are ignored."""
        if not isinstance(keys, DataFrame):
            field = T.StructField(self.key, self.key_type)
            keys = self.spark.createDataFrame([(k,) for k in keys], T.StructType([field]))
        return self.commit(delete_keys=keys, operation="delete")

    def flush(self) -> "Index":
        """Remove every document."""
        return self._publish(
            self.manifest.next(segments=[], n_docs=0, sum_len=0, last_commit={"operation": "flush", "count": 0})
        )

    def compact(self) -> "Index":
        """Fold all segments into one; the documents stay the same."""
        return self._merge([s["id"] for s in self.manifest.segments])

    def merge(self, fan: int = FAN) -> "Index":
        """Fold ``fan`` or more segments of like size into one, smallest first, until there are none.

        Larger segments are neither read nor written. Meant as a job of its own: other
        commits may go on, and what they void in the merged segments stays void. Where
        another job folded the same segments first, this one leaves it at that.
        """
        index = self
        while (ids := _tier(index.manifest.segments, fan)) is not None:
            try:
                index = index._merge(ids)
            except LostRace:
                return index.refresh()
        return index

    def _merge(self, ids: list[str]) -> "Index":
        """One segment in place of some: live documents and postings copied, counts and bitmaps added up."""
        void = any(s.get("chunks") for s in self.manifest.segments)
        if not ids or (len(ids) == 1 and not void):
            return self
        having = lambda part: [i for i in self.manifest.with_part(part) if i in ids]
        segment = f"{self.manifest.version + 1:012d}-{uuid.uuid4().hex[:8]}"
        parts, docs, words, chunks = [], 0, 0, 0
        if having("docs"):
            laid = self._live_docs(having("docs")).hint("rebalance", F.col("bucket")).sortWithinPartitions("bucket", self.key)
            laid.write.options(**DOCS_FORMAT).partitionBy("bucket").parquet(f"{self.path}/docs/seg={segment}")
            facts = self._read("docs", self._docs_schema(), [segment]).agg(F.count(F.lit(1)), F.coalesce(F.sum(LENGTH), F.lit(0))).first()
            docs, words = facts[0], facts[1]
            parts.append("docs")
        if having("postings"):
            old = self._read("postings", self._postings_schema(), having("postings"))
            self._write_postings(self._live(old, "src", "ord").select(*old.columns), words, segment)
            parts.append("postings")
        if having("terms"):
            old = self._read("terms", TERMS, having("terms")).groupBy("term").agg(F.sum("df").alias("df")).where("df <> 0")
            self._write_terms(old, segment)
            parts.append("terms")
        if having("postings"):
            self._write_ranges(self._placed(segment).select("term", "file").distinct(), segment)
        if having("voids"):
            # Bits of documents that these segments hold have done their work.
            own = self._read("docs", self._docs_schema(), having("docs")).select(F.col(SOURCE).alias("of")).distinct()
            left = merged(self._read("voids", VOIDS, having("voids"))).join(own, "of", "left_anti")
            left.write.parquet(f"{self.path}/voids/seg={segment}")
            chunks = self._read("voids", VOIDS, [segment]).count()
            parts += ["voids"] if chunks else []
        if having("deletes"):
            self._read("deletes", self._deletes_schema(), having("deletes")).distinct().write.parquet(f"{self.path}/deletes/seg={segment}")
            parts.append("deletes")
        entry = {"id": segment, "parts": parts, "docs": docs, "chunks": chunks}
        fact = {"operation": "compact", "count": docs, "written": docs, "removed": 0, "fingerprint": None, "segment": segment}
        return self._replace(ids, entry, fact)

    def _replace(self, ids: list[str], entry: dict, fact: dict) -> "Index":
        """Publish a merged segment on the latest version; a race with other commits is run again at no cost."""
        index = self
        while True:
            segments = index.manifest.segments
            if not set(ids) <= {s["id"] for s in segments}:
                raise LostRace(f"{self.manifest.name}: segments of a merge were replaced by another job")
            kept = [s for s in segments if s["id"] not in ids]
            place = next(i for i, s in enumerate(segments) if s["id"] in ids)
            try:
                return index._publish(index.manifest.next(segments=[*kept[:place], entry, *kept[place:]], last_commit=fact))
            except LostRace:
                index = index.refresh()

    def vacuum(self, keep: int = 10) -> list[str]:
        """Delete segments that none of the last ``keep`` versions uses. Segments of
        later versions, such as one being written now, are left alone."""
        oldest = self.manifest.version - keep + 1
        kept = [n for n in self._versions.numbers() if n >= oldest]
        used = {s["id"] for n in kept for s in self._versions.at(n)["segments"]}
        gone = set()
        for part in PARTS:
            for name in self._files.names(f"{self.manifest.name}/{part}"):
                segment = name.removeprefix("seg=").removesuffix(".json")
                if name.startswith("seg=") and segment not in used and int(segment.split("-")[0]) < oldest:
                    self._files.remove(f"{self.manifest.name}/{part}/{name}")
                    gone.add(segment)
        return sorted(gone)

    def commit(
        self,
        docs: DataFrame | None = None,
        delete_keys: DataFrame | None = None,
        mode: str = "upsert",
        replace: bool = False,
        batch: tuple[str, int] | None = None,
        operation: str = "update",
        while_paused: bool = False,
    ) -> "Index":
        """Write one segment and publish it. A batch already seen is skipped.

        If another job publishes first, an upsert or delete is made again on its version.
        """
        args = (docs, delete_keys, mode, replace, batch, operation, while_paused)
        for _ in range(RETRIES):
            try:
                return self._commit(*args)
            except LostRace:
                if replace or mode != "upsert":
                    raise
                self = self.refresh()
        return self._commit(*args)

    def _commit(
        self,
        docs: DataFrame | None,
        delete_keys: DataFrame | None,
        mode: str,
        replace: bool,
        batch: tuple[str, int] | None,
        operation: str,
        while_paused: bool,
    ) -> "Index":
        m = self.manifest
        if batch is not None and m.batches.get(batch[0], -1) >= batch[1]:
            return self
        batches = m.batches if batch is None else {**m.batches, batch[0]: batch[1]}
        if m.paused and operation != "compact" and not while_paused:
            return self._publish(m.next(batches=batches)) if batch is not None else self
        if m.schema is None and docs is None:
            return self._publish(m.next(batches=batches))
        if m.schema is None:
            # The first documents declare the schema.
            own = T.StructType([f for f in docs.schema if f.name != MARK])
            declared = Manifest(**{**m.to_dict(), "schema": json.loads(own.json())})
            index = Index(self.spark, self._files, declared, self._listeners)
            return index._commit(docs, delete_keys, mode, replace, batch, operation, while_paused)
        if replace or not m.segments:
            # All postings are written anew, with the fields that are declared now.
            m = Manifest(**{**m.to_dict(), "stored": self._storable()})
            self = Index(self.spark, self._files, m, self._listeners)
        segment = f"{m.version + 1:012d}-{uuid.uuid4().hex[:8]}"
        parts: list[str] = []

        new, seen, counts = None, None, {"n": 0, "len": 0}
        if docs is not None:
            if mode != "upsert" and not replace:
                docs = self._merged_in(docs, mode)
            new = self._write_docs(self._conform(docs), segment)
            parts.append("docs")
            counts = self._check(new)
            seen = new.select(F.col(self.key).alias("key"), "bucket")
        if delete_keys is not None:
            deleted = self._write_deletes(delete_keys, segment)
            parts.append("deletes")
            counts = self._count_deletes(deleted, counts)
            seen = deleted if seen is None else seen.unionByName(deleted)

        if not replace and not counts["n"] and not counts.get("deletes"):
            return self._publish(m.next(batches=batches))  # nothing to keep a segment for
        words, void = bool(self.text_fields and counts["n"]), bool(m.with_part("docs") and not replace and seen is not None)
        # What the commit adds and what it voids are jobs that do not wait for each other.
        with ThreadPoolExecutor(1) as other:
            added = other.submit(inheritable_thread_target(self.spark)(self._write_words), new, counts, segment) if words else None
            gone = self._write_void(seen, counts, segment) if void else {"n": 0, "len": 0, "chunks": 0}
            if added is not None:
                added.result()
        parts += ["postings"] if words else []
        parts += ["removed", "voids"] if gone["n"] else []
        parts += ["terms"] if self.text_fields and (words or gone["n"]) else []

        entry = {"id": segment, "parts": parts, "docs": counts["n"], "chunks": gone["chunks"]}
        return self._publish(
            m.next(
                segments=[*([] if replace else m.segments), entry],
                n_docs=counts["n"] if replace else m.n_docs + counts["n"] - gone["n"],
                sum_len=counts["len"] if replace else m.sum_len + counts["len"] - gone["len"],
                batches=batches,
                last_commit={
                    "operation": operation,
                    "count": counts["n"] + counts.get("deletes", 0),
                    "written": counts["n"],
                    "removed": gone["n"],
                    "fingerprint": counts.get("fingerprint"),
                    "segment": segment,
                },
            )
        )

    def _storable(self) -> list[str]:
        """Declared fields whose values can lie beside the postings."""
        m, plain = self.manifest, (T.ArrayType, T.MapType, T.StructType, T.BinaryType)
        declared = dict.fromkeys([*(m.filterable or ()), *(m.sortable or ())])
        return [f.name for f in self.schema if f.name in declared and f.name not in (self.key, SOFT_FLAG) and not isinstance(f.dataType, plain)]

    def _merged_in(self, docs: DataFrame, mode: str) -> DataFrame:
        """What a create, update or emplace writes; of the live documents only those of its keys are read."""
        path = shared_dir(self.spark)
        docs.write.parquet(path)
        incoming = self.spark.read.schema(docs.schema).parquet(path)
        keyed = incoming.select(F.col(self.key).cast(self.key_type).alias("key"))
        keyed = keyed.withColumn("bucket", bucket_of(F.col("key"), self.manifest.buckets))
        facts = keyed.agg(F.count(F.lit(1)).alias("n"), F.collect_set("bucket").alias("buckets")).first()
        found = self._found(self._live_docs(), keyed, facts["n"], facts["buckets"])
        live = found.select(*(self.schema.names if mode == "emplace" else [self.key]))
        return merge_documents(live, incoming, self.key, mode)

    def _found(self, df: DataFrame, keyed: DataFrame, n: int, buckets: Sequence[int], key: str | None = None) -> DataFrame:
        """The rows of some keys. Their buckets prune the folders; few keys are a list by which the reader skips."""
        key = key or self.key
        inside = df.where(F.col("bucket").isin(list(buckets)))
        if n <= LISTED:
            return inside.where(F.col(key).isin([r[0] for r in keyed.select("key").distinct().collect() if r[0] is not None]))
        some = keyed.select(F.col("key").alias("__key")).distinct()
        return inside.join(some, F.col(key) == F.col("__key"), "left_semi")

    def newer(self, changes: DataFrame, mark: Column) -> DataFrame:
        """The changes (``key``, ...) that no known change of their key comes after.

        The mark of a key's last change is kept with its document, or with the order to delete it.
        """
        if not self.manifest.segments:
            return changes
        keyed = changes.select(F.col("key").cast(self.key_type).alias("key"))
        keyed = keyed.withColumn("bucket", bucket_of(F.col("key"), self.manifest.buckets))
        facts = keyed.agg(F.count(F.lit(1)).alias("n"), F.collect_set("bucket").alias("buckets")).first()
        live = self._found(self._live_docs(), keyed, facts["n"], facts["buckets"])
        gone = self._found(self._read("deletes", self._deletes_schema()), keyed, facts["n"], facts["buckets"], "key")
        known = live.select(F.col(self.key).alias("__key"), MARK).unionByName(gone.select(F.col("key").alias("__key"), MARK))
        known = known.where(F.col(MARK).isNotNull()).groupBy("__key").agg(F.max(MARK).alias("__known"))
        joined = changes.join(known, F.col("key").cast(self.key_type) == F.col("__key"), "left")
        return joined.where(F.col("__known").isNull() | (mark >= F.col("__known"))).select(*changes.columns)

    def _check(self, new: DataFrame) -> dict:
        """Facts of the written documents, in one job; raises on a bad key."""
        by_key = new.groupBy(F.col(self.key).alias("key")).agg(
            F.count(F.lit(1)).alias("n"), F.sum(LENGTH).alias("len"), F.max("bucket").alias("bucket")
        )
        facts = by_key.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
            F.coalesce(F.sum("len"), F.lit(0)).alias("len"),
            F.coalesce(F.max("n"), F.lit(0)).alias("most"),
            F.count(F.when(F.col("key").isNull(), 1)).alias("nulls"),
            F.coalesce(F.bit_xor(key_hash(F.col("key"))), F.lit(0)).alias("x"),
            # At most one entry per bucket of the index.
            F.collect_set("bucket").alias("buckets"),
        ).first()
        if facts["most"] > 1 or facts["nulls"]:
            bad = rejects(new, self.key).first()
            raise IndexWriteError(f"{self.manifest.name}: {bad['reason']} {bad['key']!r}")
        return {
            "n": facts["n"],
            "len": facts["len"],
            "fingerprint": fingerprint(facts["n"], facts["x"]),
            "buckets": sorted(facts["buckets"]),
        }

    def _count_deletes(self, deleted: DataFrame, counts: dict) -> dict:
        facts = deleted.agg(
            F.count(F.lit(1)).alias("n"),
            F.coalesce(F.bit_xor(key_hash(F.col("key"))), F.lit(0)).alias("x"),
            F.collect_set("bucket").alias("buckets"),
        ).first()
        touched = sorted({*counts.get("buckets", []), *facts["buckets"]})
        mark = counts.get("fingerprint") or fingerprint(facts["n"], facts["x"])
        return {**counts, "deletes": facts["n"], "buckets": touched, "fingerprint": mark}

    def _publish(self, manifest: Manifest) -> "Index":
        if not self._versions.publish(manifest.version, manifest.to_dict()):
            raise LostRace(f"{manifest.name}: version {manifest.version} was written by another job")
        commit = manifest.last_commit
        if commit is not None and commit != self.manifest.last_commit:
            for listener in self._listeners:
                listener({"index": manifest.name, "version": manifest.version, **commit})
        return Index(self.spark, self._files, manifest, self._listeners)

    def _conform(self, docs: DataFrame) -> DataFrame:
        """Cast to the declared schema; a value that does not fit fails the write."""
        unknown = [c for c in docs.columns if c not in self.schema.names and c != MARK]
        if unknown:
            raise IndexWriteError(f"{self.manifest.name}: no field {unknown[0]!r} in the schema")
        columns = [
            (F.col(f.name) if f.name in docs.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in [*self.schema, T.StructField(MARK, MARK_TYPE)]
        ]
        return docs.select(*columns)

    def _write_docs(self, docs: DataFrame, segment: str) -> DataFrame:
        laid = docs.withColumn("bucket", bucket_of(F.col(self.key), self.manifest.buckets))
        # Rebalance splits a large bucket over many tasks and merges small ones; texts are
        # cut after it, once, by as many tasks, however few files they came from.
        ordered = laid.hint("rebalance", F.col("bucket")).sortWithinPartitions("bucket", self.key)
        cut = ordered.withColumn(RUNS, document_runs(self.text_fields, self.manifest.language))
        cut = cut.withColumns({SOURCE: F.lit(segment), ORDINAL: F.monotonically_increasing_id()})
        written = cut.withColumn(LENGTH, run_length(F.col(RUNS))).write.options(**DOCS_FORMAT)
        written.partitionBy("bucket").parquet(f"{self.path}/docs/seg={segment}")
        return self._read("docs", self._docs_schema(), [segment])

    def _write_deletes(self, delete_keys: DataFrame, segment: str) -> DataFrame:
        key = F.col(next(c for c in delete_keys.columns if c != MARK)).cast(self.key_type).alias("key")
        mark = F.col(MARK) if MARK in delete_keys.columns else F.lit(None).cast(MARK_TYPE).alias(MARK)
        path = f"{self.path}/deletes/seg={segment}"
        keys = delete_keys.select(key, mark).where("key IS NOT NULL").groupBy("key").agg(F.max(MARK).alias(MARK))
        keys.select(
            "key", bucket_of(F.col("key"), self.manifest.buckets).alias("bucket"), F.lit(segment).alias("src"), MARK
        ).write.parquet(path)
        return self._read("deletes", self._deletes_schema(), [segment]).select("key", "bucket")

    def _write_void(self, changed: DataFrame, counts: dict, segment: str) -> dict:
        """Live documents a change voids: their bitmaps, and what the term counts lose by them."""
        found = self._found(self._live_docs(), changed, counts["n"] + counts.get("deletes", 0), counts["buckets"])
        removed = found.select(
            F.col(self.key).alias("key"),
            F.col(SOURCE).alias("src"),
            F.col(ORDINAL).alias("ord"),
            F.col(LENGTH).alias("len"),
            F.array_distinct(F.col(RUNS)["term"]).alias("terms"),
        )
        path = f"{self.path}/removed/seg={segment}"
        removed.write.parquet(path)
        removed = self.spark.read.schema(removed.schema).parquet(path)
        gone = removed.agg(
            F.count(F.lit(1)).alias("n"),
            F.coalesce(F.sum("len"), F.lit(0)).alias("len"),
            F.count_distinct("src", chunk_of(F.col("ord"))).alias("chunks"),
        ).first()
        if gone["n"]:
            bitmaps(removed, "src", "ord").write.parquet(f"{self.path}/voids/seg={segment}")
            if self.text_fields:
                lost = removed.select(F.explode("terms").alias("term")).groupBy("term").agg((-F.count(F.lit(1))).alias("df"))
                self._write_terms(lost, segment)
        return gone.asDict()

    def _write_words(self, new: DataFrame, counts: dict, segment: str) -> None:
        """Postings of the new documents, the counts of their terms and the ranges of the files."""
        flag = F.col(SOFT_FLAG) if SOFT_FLAG in self.schema.names else F.lit(0)
        same = {"src": F.lit(segment)}
        if SOFT_FLAG not in self.schema.names:
            same["gone"] = F.lit(0)
        if len(self.text_fields) == 1:
            # A document without words has one posting, without a term.
            holds = F.col("term").isNotNull()
            same |= {"field": F.when(holds, F.lit(self.text_fields[0])), "lead": holds}
        self._write_postings(build_postings(new, self.key, flag, self.manifest.stored), counts["len"], segment, same)
        counted = self._placed(segment).groupBy("term", "file").agg(F.count(F.when(F.col("lead"), 1)).alias("df"))
        self._write_ranges(self._write_terms(counted.select("term", "df", "file"), segment), segment)

    def _write_postings(self, built: DataFrame, words: int, segment: str, same: dict[str, Column] | None = None) -> None:
        """Files of disjoint ranges of (term, ordinal), each sorted: a very common term is many files.

        What is the same in all postings (``same``) or follows from another column is left out of the exchange.
        """
        known = {**(same or {}), "tf": F.array_size("positions")}
        files = min(MOST_FILES, max(1, math.ceil(words / self.manifest.file_words)))
        ranges = min(MOST_RANGES, max(files, math.ceil(words / TASK_WORDS)))
        told = built.drop(*known)
        laid = told.coalesce(1) if ranges == 1 else unpacked(packed(told).repartitionByRange(ranges, packed_term(), "ord"))
        laid = laid.sortWithinPartitions("term", *(["ord"] if "src" in known else ["src", "ord"]))
        writer = laid.withColumns(known).select(*built.columns).write.option("compression", CODEC)
        if files > ranges:
            writer = writer.option("maxRecordsPerFile", math.ceil(words / files))
        writer.parquet(f"{self.path}/postings/seg={segment}")

    def _placed(self, segment: str) -> DataFrame:
        """The terms of a segment's postings, and the names of the files they stand in."""
        found = self._read("postings", self._postings_schema(), [segment]).where("term IS NOT NULL")
        return found.select("term", "lead", F.substring_index(F.input_file_name(), "/", -1).alias("file"))

    def _write_terms(self, terms: DataFrame, segment: str) -> DataFrame:
        path = f"{self.path}/terms/seg={segment}"
        # Terms come out of an aggregate's exchange, which is cut to size already.
        terms.sortWithinPartitions("term").write.mode("append").parquet(path)
        return self._read("terms", TERMS, [segment]).where("file IS NOT NULL")

    def _write_ranges(self, placed: DataFrame, segment: str) -> None:
        """First and last term of each file (at most ``MOST_FILES``). Takes a term of a file once: this aggregate sorts."""
        rows = placed.groupBy("file").agg(F.min("term").alias("first"), F.max("term").alias("last")).orderBy("first").collect()
        self._files.publish(f"{self.manifest.name}/ranges/seg={segment}.json", json.dumps([[r["file"], r["first"], r["last"]] for r in rows]))


TERMS = "term string, df long, file string"


#: Ranges of the segments read last; a segment's never change.
_KNOWN_RANGES: dict[tuple[str, str], list[list[str]]] = {}


def _ranges(files: Files, name: str) -> list[list[str]]:
    known = (files.root, name)
    if known not in _KNOWN_RANGES:
        if len(_KNOWN_RANGES) >= 256:
            _KNOWN_RANGES.clear()
        _KNOWN_RANGES[known] = json.loads(files.read(name))
    return _KNOWN_RANGES[known]


def _tier(segments: list[dict], fan: int) -> list[str] | None:
    """The smallest ``fan`` or more segments of like size, if there are so many."""
    tiers: dict[int, list[str]] = {}
    for s in segments:
        tiers.setdefault(int(math.log(max(s.get("docs", 0), 1), fan)), []).append(s["id"])
    full = [t for t, ids in sorted(tiers.items()) if len(ids) >= fan]
    return tiers[full[0]] if full else None


class Catalog:
    """Indexes and aliases below one folder.

    ``listeners`` are told the facts of every commit (import, delete, flush).
    """

    def __init__(self, spark: SparkSession, root: str, prefix: str = "", listeners: Sequence[Listener] = ()):
        self.spark = spark
        self.prefix = prefix
        self._files = Files(spark, root)
        self._listeners = tuple(listeners)

    def names(self) -> list[str]:
        return [n for n in self._files.names() if not n.startswith(("_", ".")) and n.startswith(self.prefix)]

    def create(self, name: str, key: str, schema: T.StructType | None = None, **settings) -> Index:
        """Create an index, or open the one that is there."""
        full = self.prefix + name
        versions = Versions(self._files, f"{full}/_manifest")
        state = versions.latest()
        if state is None:
            declared = json.loads(schema.json()) if schema is not None else None
            versions.publish(0, Manifest(name=full, key=key, schema=declared, **settings).to_dict())
            state = versions.latest()
        return Index(self.spark, self._files, Manifest(**state), self._listeners)

    def open(self, name: str) -> Index:
        """An index by its name or by an alias."""
        pointed = Versions(self._files, f"_aliases/{self.prefix}{name}").latest()
        full = pointed["index"] if pointed else self.prefix + name
        state = Versions(self._files, f"{full}/_manifest").latest()
        if state is None:
            raise KeyError(f"no index {name!r}")
        return Index(self.spark, self._files, Manifest(**state), self._listeners)

    def point(self, alias: str, name: str) -> None:
        """Make readers of ``alias`` see another index from now on."""
        versions = Versions(self._files, f"_aliases/{self.prefix}{alias}")
        if not versions.publish(max(versions.numbers(), default=-1) + 1, {"index": self.prefix + name}):
            raise IndexWriteError(f"alias {alias!r} was moved by another job")

    def delete(self, name: str) -> None:
        self._files.remove(self.prefix + name)

    def delete_all(self) -> list[str]:
        """Delete every index that has the catalog's prefix."""
        gone = self.names()
        for name in gone:
            self._files.remove(name)
        return gone
