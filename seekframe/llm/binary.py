"""Token ids as binary files: zstandard frames with a seek table and checksums.

A file is the ids of its documents in a row, little-endian, cut every ``FRAME`` bytes into
independent zstandard frames; a skippable frame at its end lists the compressed size, size and
checksum (low 32 bits of XXH64) of each frame, so a reader decompresses only the frames that
hold a document. An index table says where each document lies.

Files are written by tasks under names of their own attempt and named in the index only when
the task's output is committed: a lost executor leaves a file that no index names. The folder
may be any that ``pyarrow.fs`` opens. Null texts are empty: their end id alone. Repeated rows
are written each; an empty table gives no file and an empty index; further columns are not read.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seekframe.llm.common import batches, documents, parked
from seekframe.llm.tokens import encode, tokenizer_path
from seekframe.session import shared_dir

# Fixed values of the public seekable format.
SKIPPABLE, FOOTER = 0x184D2A5E, 0x8F92EAB1
CHECKSUMS = 0x80

#: Bytes of ids in a frame; bytes of ids in a file, aimed at; files at most (their totals are gathered).
FRAME, FILE, FILES = 1 << 18, 1 << 27, 10_000

INDEX = "file string, doc_id long, at long, n_tokens long"


class FrameWriter:
    """Writes bytes as frames; ``close`` adds the seek table."""

    def __init__(self, out, level: int = 3):
        self.out, self.entries, self.waiting = out, [], bytearray()
        self.compressor = zstandard.ZstdCompressor(level=level, write_content_size=True)

    def write(self, data: bytes) -> None:
        self.waiting += data
        while len(self.waiting) >= FRAME:
            self._frame(bytes(self.waiting[:FRAME]))
            del self.waiting[:FRAME]

    def _frame(self, raw: bytes) -> None:
        packed = self.compressor.compress(raw)
        self.out.write(packed)
        self.entries.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))

    def close(self) -> None:
        if self.waiting:
            self._frame(bytes(self.waiting))
        table = b"".join(struct.pack("<III", *e) for e in self.entries)
        table += struct.pack("<IBI", len(self.entries), CHECKSUMS, FOOTER)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)


class FrameReader:
    """Reads any span of the bytes, decompressing the frames that hold it alone."""

    def __init__(self, file):
        self.file, size = file, file.size()
        n, flags, magic = struct.unpack("<IBI", file.read_at(9, size - 9))
        if magic != FOOTER or not flags & CHECKSUMS:
            raise ValueError("no seek table at the end of the file")
        entries = np.frombuffer(file.read_at(12 * n, size - 9 - 12 * n), "<u4").reshape(n, 3).astype(np.int64)
        self.packed = np.r_[0, np.cumsum(entries[:, 0])]
        self.raw = np.r_[0, np.cumsum(entries[:, 1])]
        self.sums, self.last = entries[:, 2], (-1, b"")
        self.decompressor = zstandard.ZstdDecompressor()

    def frame(self, i: int) -> bytes:
        if self.last[0] != i:
            packed = self.file.read_at(int(self.packed[i + 1] - self.packed[i]), int(self.packed[i]))
            raw = self.decompressor.decompress(packed)
            if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.sums[i]:
                raise ValueError(f"frame {i} does not match its checksum")
            self.last = (i, raw)
        return self.last[1]

    def read(self, start: int, size: int) -> bytes:
        out, i = [], int(np.searchsorted(self.raw, start, "right")) - 1
        while size > 0:
            own = self.frame(i)[start - int(self.raw[i]) :][:size]
            out.append(own)
            start, size, i = start + len(own), size - len(own), i + 1
        return b"".join(out)


def write_ids(docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = 1, dtype: str = "<u2") -> DataFrame:
    """Write documents in ascending ``doc_id`` order; return the index, a parked table with ``start``.

    Texts are dealt out by ranges of ``doc_id`` and encoded by the tasks that write them, so ids are written once.
    """
    path = tokenizer or tokenizer_path("word_bpe_49k.json")
    texts = documents(docs)
    # Ids take about as many bytes as half of the text.
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = min(FILES, max(4 * docs.sparkSession.sparkContext.defaultParallelism, -(-size // (2 * FILE))))

    def encoded(text: bytes) -> np.ndarray:
        ids = np.append(encode(text, path), np.uint32(end_id))
        if int(ids.max()) > np.iinfo(dtype).max:
            raise ValueError(f"an id is too large for {dtype}")
        return ids.astype(dtype)

    def write(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        store, base = pyarrow.fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        name = f"ids-{task.partitionId():06d}-{uuid.uuid4().hex}.zst"
        out = writer = None
        at = 0
        for keys, texts in batches(found):
            if not keys:
                continue
            if out is None:
                out = store.open_output_stream(f"{base}/{name}", compression=None)
                writer = FrameWriter(out)
            starts, sizes = [], []
            for text in texts:
                ids = encoded(text)
                writer.write(ids.tobytes())
                starts.append(at)
                sizes.append(len(ids))
                at += len(ids)
            rows = [pa.array([name] * len(sizes)), pa.array(keys, pa.int64()), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays(rows, ["file", "doc_id", "at", "n_tokens"])
        if out is not None:
            writer.close()
            out.close()

    # Ties of doc_id are ordered by their texts, so that files come out the same.
    ordered = texts.repartitionByRange(files, "doc_id").sortWithinPartitions("doc_id", "text")
    index = parked(ordered.mapInArrow(write, INDEX))
    # One row for each file, of at most FILES of them.
    totals = index.groupBy("file").agg(F.sum("n_tokens").alias("n")).orderBy("file").collect()
    before = np.r_[0, np.cumsum([r["n"] for r in totals])][:-1] if totals else []
    spark = docs.sparkSession
    bases = spark.createDataFrame([(r["file"], int(b)) for r, b in zip(totals, before)], "file string, _base long")
    return index.join(F.broadcast(bases), "file").withColumn("start", F.col("_base") + F.col("at")).drop("_base")


def read_ids(index: DataFrame, folder: str, dtype: str = "<u2") -> DataFrame:
    """The ids of the index's documents, read from the files: ``doc_id``, ``start``, ``n_tokens``, ``ids``."""
    width = np.dtype(dtype).itemsize

    def run(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = pyarrow.fs.FileSystem.from_uri(folder)
        name, reader = None, None
        for batch in found:
            out = []
            for file, at, n in zip(*(batch.column(c).to_pylist() for c in ("file", "at", "n_tokens"))):
                if file != name:
                    name, reader = file, FrameReader(store.open_input_file(f"{base}/{file}"))
                out.append(reader.read(at * width, n * width))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("start"), batch.column("n_tokens"), pa.array(out, pa.binary())],
                ["doc_id", "start", "n_tokens", "ids"],
            )

    own = index.select("file", "at", "doc_id", "start", "n_tokens")
    return own.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def summed(ids: DataFrame, dtype: str = "<u2") -> DataFrame:
    """Documents read from files with the CRC-32 of their ids as unsigned 32-bit numbers."""

    def run(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            sums = [zlib.crc32(np.frombuffer(x, dtype).astype("<u4")) for x in batch.column("ids").to_pylist()]
            columns = [batch.column(c) for c in ("doc_id", "start", "n_tokens")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return ids.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def ids_folder(spark) -> str:
    return shared_dir(spark)
