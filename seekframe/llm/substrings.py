"""Substring deduplication: a De Bruijn graph of token k-mers, its unbranching paths compacted.

Of all k-mers (runs of ``K`` words) those that are the least of some window of ``WINDOW`` words
are kept as edges; the consecutive windows that share one are a path, and the words they cover
its content. A path's place in the graph is its k-mer; its content is known by a digest of the
words themselves. A k-mer in several documents is repeated; if all its paths have one content
it does not branch, and all its windows repeat from its first document on. Where contents
differ, one occurrence of each distinct content is read again at its source coordinates, its
windows are told apart by digests of their words, and Spark joins give the first document of
each window. So copies cost a row for each path, and windows are spelled out only once for each
distinct content.

K-mers, paths and windows are grouped by 128 bits together, half of them from a digest of the
words. The documents to read again pass a Bloom filter of bounded size, and an exact join.

A null or empty text has no words; texts shorter than a window keep all words; long texts are
read whole; rows that share a doc_id are never each other's source, and each keeps its own row;
an empty table gives no rows; other columns of the input are not read.
"""

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seekframe.llm.bloom import Bloom, bloom
from seekframe.llm.common import batches, mixed, parked, runs_of, signed, word_hashes

WINDOW, K = 50, 16

PATHS = "doc_id long, version long, anchor long, content long, start int, n int"
#: Rows of ``removed``: the first window of a path, and a bit for each of its windows that repeats.
MARKS = "array<struct<start:int,mask:long>>"


def digest(words: list[bytes]) -> int:
    return int.from_bytes(hashlib.blake2b(b" ".join(words), digest_size=8).digest(), "little", signed=True)


def paths_of(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """K-mer, first window and number of windows of each path of a text."""
    windows = len(words) - WINDOW + 1
    if windows <= 0:
        return (np.empty(0, np.int64),) * 3
    mers = runs_of(word_hashes(words), K)
    least = np.lib.stride_tricks.sliding_window_view(mers, WINDOW - K + 1).argmin(axis=1) + np.arange(windows)
    first = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
    return signed(mers[least[first]]), first, np.diff(np.r_[first, windows])


def paths(docs: DataFrame) -> DataFrame:
    """The paths of every document, with the digest of the words that each covers."""

    def run(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            versions = batch.column("version").to_pylist()
            for keys, texts in batches([batch]):
                rows: list[list] = [[] for _ in range(6)]
                for key, version, text in zip(keys, versions, texts):
                    words = text.split()
                    anchors, starts, sizes = paths_of(words)
                    contents = [digest(words[s : s + n + WINDOW - 1]) for s, n in zip(starts.tolist(), sizes.tolist())]
                    for column, values in zip(rows, ([key] * len(starts), [version] * len(starts), anchors, contents, starts, sizes)):
                        column.extend(values)
                types = [pa.int64()] * 4 + [pa.int32()] * 2
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r, t) for r, t in zip(rows, types)], ["doc_id", "version", "anchor", "content", "start", "n"]
                )

    return docs.mapInArrow(run, PATHS)


def source_key(doc: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    return signed(mixed(doc.astype(np.int64).view(np.uint64) + mixed(anchor.astype(np.int64).view(np.uint64))))


def keyed(sources: DataFrame) -> DataFrame:
    """One key for each document and k-mer, as workers make it."""

    def run(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            doc, anchor = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "anchor"))
            yield pa.RecordBatch.from_arrays([pa.array(source_key(doc, anchor))], ["key"])

    return sources.select("doc_id", "anchor").mapInArrow(run, "key long")


def windows_at(docs: DataFrame, sources: Bloom) -> DataFrame:
    """Window digests of the paths that ``sources`` may name: ``doc_id``, ``anchor``, ``content``, ``windows``."""

    def run(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in batches(found):
            rows: list[list] = [[] for _ in range(4)]
            for key, text in zip(keys, texts):
                words = text.split()
                anchors, starts, sizes = paths_of(words)
                if not len(anchors) or key is None:
                    continue
                hit = sources.holds(source_key(np.full(len(anchors), key), anchors))
                for a, s, n in zip(anchors[hit].tolist(), starts[hit].tolist(), sizes[hit].tolist()):
                    rows[0].append(key)
                    rows[1].append(a)
                    rows[2].append(digest(words[s : s + n + WINDOW - 1]))
                    rows[3].append([digest(words[i : i + WINDOW]) for i in range(s, s + n)])
            types = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(r, t) for r, t in zip(rows, types)], ["doc_id", "anchor", "content", "windows"])

    return docs.mapInArrow(run, "doc_id long, anchor long, content long, windows array<long>")


def versioned(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and text alone, and a number that tells texts under one key apart."""
    own = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return own.withColumn("version", F.xxhash64("text"))


def repeats(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``version``, ``start`` and ``mask``: windows that also start in a document with a smaller id."""
    own = versioned(docs)
    found = parked(paths(own))
    graph = found.groupBy("anchor").agg(
        F.min("doc_id").alias("first_doc"),
        F.max("doc_id").alias("_last"),
        (F.min("content") != F.max("content")).alias("branches"),
    )
    # Parked, so that a k-mer that a third of all documents share is split in the join.
    graph = parked(graph.where("first_doc < _last").drop("_last"))
    repeated = parked(found.join(graph, "anchor"))
    whole = F.expr("shiftleft(1L, n) - 1").alias("mask")
    straight = repeated.where("not branches and doc_id > first_doc").select("doc_id", "version", "start", whole)

    # Each distinct content of a branching k-mer, at its first document.
    sources = repeated.where("branches").groupBy("anchor", "content").agg(F.min("doc_id").alias("doc_id"))
    sources = parked(sources)
    read = windows_at(own.select("doc_id", "text"), bloom(keyed(sources))).distinct()
    spelled = parked(read.join(sources, ["doc_id", "anchor", "content"]))
    each = spelled.select("doc_id", "anchor", "content", F.posexplode("windows").alias("i", "window"))
    earliest = each.groupBy("anchor", "window").agg(F.min("doc_id").alias("source"), F.max("doc_id").alias("_last"))
    place = each.join(earliest.where("source < _last").drop("_last"), ["anchor", "window"])
    # A content's windows that have an earlier or the same first document: at most one for each of K-mer's places.
    first = place.groupBy("anchor", "content").agg(F.collect_list(F.struct("i", "source")).alias("sources"))
    # A content that recurs is its own source, window by window, if nothing is earlier.
    shared = spelled.select("anchor", "content", F.col("doc_id").alias("own"), F.size("windows").alias("_n"))
    shared = shared.join(first, ["anchor", "content"], "left")
    branched = repeated.where("branches").join(shared, ["anchor", "content"])
    earlier = F.expr(
        "aggregate(coalesce(filter(sources, s -> s.source < doc_id), array()), 0L, (m, s) -> m | shiftleft(1L, s.i))"
    )
    mask = F.when(F.col("own") < F.col("doc_id"), F.expr("shiftleft(1L, n) - 1")).otherwise(earlier)
    branched = branched.select("doc_id", "version", "start", mask.alias("mask")).where("mask <> 0")
    return straight.unionByName(branched)


def covered(n: int, marks: list) -> np.ndarray:
    """Which of a text's ``n`` words its repeating windows cover."""
    ends = np.zeros(n + 1, np.int64)
    for mark in marks:
        start, mask = mark["start"], mark["mask"]
        while mask:
            low = (mask & -mask).bit_length() - 1
            run = ((mask >> low) ^ ((mask >> low) + 1)).bit_length() - 1  # ones in a row
            ends[start + low] += 1
            ends[start + low + run + WINDOW - 1] -= 1
            mask &= ~(((1 << run) - 1) << low)
    return np.cumsum(ends)[:n] > 0


def deduplicated(docs: DataFrame, text: bool = True) -> DataFrame:
    """Every document's ``n_words``, ``n_removed``, ``kept_sha256`` and, on request, its ``kept`` words."""
    marks = repeats(docs).groupBy("doc_id", "version").agg(F.collect_list(F.struct("start", "mask")).alias("marks"))
    joined = versioned(docs).join(marks, ["doc_id", "version"], "left")

    @F.pandas_udf("n_words long, n_removed long, kept_sha256 string" + ", kept string" * text)
    def kept(texts: pd.Series, found: pd.Series) -> pd.DataFrame:
        rows = []
        for own, own_marks in zip(texts, found):
            words = own.encode().split()
            gone = covered(len(words), own_marks) if own_marks is not None else None
            left = words if gone is None else [w for w, g in zip(words, gone.tolist()) if not g]
            made = b" ".join(left)
            row = (len(words), len(words) - len(left), hashlib.sha256(made).hexdigest())
            rows.append((*row, made.decode()) if text else row)
        return pd.DataFrame(rows, columns=["n_words", "n_removed", "kept_sha256", *["kept"] * text])

    return joined.select("doc_id", kept("text", "marks").alias("found")).select("doc_id", "found.*")
