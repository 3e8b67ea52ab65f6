"""WARC archives of pages, and one globally ordered index of their captures.

Tasks write archives: a ``warcinfo`` record, then a record for each capture, each a gzip member of
its own. Of captures with equal payloads the one with the smallest ``page_id`` is a ``response``;
the others are ``revisit`` records, which name it and hold its headers alone. Each task's captures,
sorted by URL key (the host's names reversed, then the path), time and ``page_id``, are a *run*, a
Parquet file. Runs are merged externally: splitters cut the keys into ranges, and a task merges one
range of up to ``FAN`` runs with a tree of losers, a few rows of each in memory; levels follow until
each range is one file. A URL with a third of all captures is cut by time. Archives are read back
through the merged index, file by file in the order of their bytes.

A null page is empty; equal payloads of any size count as one, so all empty pages but one revisit
it. Pages without ``page_id`` come after all others, equal rows in the order of the table. A null
URL is written as ``urn:seekframe:none``, characters that a URI cannot hold are percent-encoded. An
empty table gives no archive and an empty index; further columns are not read. A lost executor
leaves files that no index names. The folder may be any that ``pyarrow.fs`` opens.
"""

from __future__ import annotations

import base64
import datetime as dt
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import quote, urlsplit

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seekframe.llm.bloom import bloom
from seekframe.llm.common import parked
from seekframe.llm.losertree import LoserTree
from seekframe.session import shared_dir

#: Bytes of an archive, aimed at; runs merged by one task; index rows in a range, aimed at; rows read of a run at once.
ARCHIVE, FAN, RANGE_ROWS, RUN_ROWS = 1 << 30, 32, 1_000_000, 2048
#: Keys sampled for each range.
SAMPLED = 40
#: Payloads of fewer bytes are never revisits.
SMALLEST = 0

# Fixed values of the format.
VERSION = "WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NO_URL = "urn:seekframe:none"
EPOCH = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
#: Date of the archives' own records, so that a task that runs again writes the same bytes.
MADE = "2024-01-01T00:00:00Z"

#: The order of an index, and what else it tells of a capture.
ORDER = ("url_key", "at", "no_id", "page_id", "file", "start")
ENTRY = "url_key string, at long, no_id boolean, page_id long, file string, start long, size long, digest string, kind string"
_NAMES = [x.split()[0] for x in ENTRY.split(", ")]
WORK = "range int, group int, files array<struct<path:string,part:array<int>>>"
_TYPES = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}
_SCHEMA = pa.schema([(n, _TYPES[t]) for n, t in (x.split() for x in ENTRY.split(", "))])


def url_key(url: str | None) -> str:
    """``com,example,news)/a?b=c``: names of the host reversed, no scheme, ``www``, default port or fragment."""
    try:
        parts = urlsplit(url or NO_URL)
        host, port = (parts.hostname or "").rstrip("."), parts.port
    except ValueError:
        return f"){url}"
    host = re.sub(r"^www\d*\.", "", host)
    named = ",".join(reversed(host.split(".")))
    if port and port != {"http": 80, "https": 443}.get(parts.scheme):
        named += f":{port}"
    return f"{named}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else "")


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, salt: str) -> str:
    """A UUID of the free form (version 8) that holds the page's id: all of it, a mark for none, and 57 bits of ``salt``."""
    tail = int.from_bytes(hashlib.sha256(salt.encode()).digest()[:8], "big") >> 7
    bits = ((page_id or 0) & (1 << 64) - 1) << 58 | (page_id is None) << 57 | tail
    top, middle, low = bits >> 74, bits >> 62 & 0xFFF, bits & (1 << 62) - 1
    return f"urn:uuid:{uuid.UUID(int=top << 80 | 8 << 76 | middle << 64 | 2 << 62 | low)}"


def page_of(record: str) -> int | None:
    """The page's id in a record's."""
    n = uuid.UUID(record.strip("<>").removeprefix("urn:uuid:")).int
    bits = (n >> 80) << 74 | (n >> 64 & 0xFFF) << 62 | n & (1 << 62) - 1
    page = bits >> 58
    return None if bits >> 57 & 1 else page - (1 << 64 if page >> 63 else 0)


def moment(at: int) -> str:
    return (EPOCH + dt.timedelta(seconds=at)).strftime("%Y-%m-%dT%H:%M:%SZ")


def default_time() -> Column:
    """Seconds since ``EPOCH`` for tables that have no time of capture: a day's worth, by id."""
    return F.pmod(F.coalesce(F.col("page_id"), F.lit(0)), F.lit(86_400))


def framed(kind: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = [f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in fields), f"Content-Length: {len(block)}"]
    return f"{VERSION}\r\n".encode() + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(raw: bytes) -> bytes:
    """A gzip member, the same bytes for the same record."""
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def captures(pages: DataFrame, at: Column | None = None, smallest: int = SMALLEST) -> DataFrame:
    """Pages with their ``row``, ``at``, payload and, for revisits, the ``original`` they have the payload of.

    The rows are parked with a number each. Who revisits whom is found on digests alone; pages that
    a Bloom filter of the revisits does not hold are joined to nothing.
    """
    own = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce("html", F.lit("")).cast("binary").alias("payload"),
        (default_time() if at is None else at).cast("long").alias("at"),
    )
    rows = parked(own.withColumn("row", F.monotonically_increasing_id()).withColumn("same", F.unhex(F.sha2("payload", 256))))
    large = rows.where(F.octet_length("payload") >= smallest) if smallest else rows
    ids = F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "row")
    narrow = large.select("same", "row", ids.alias("id"))
    # Parked, so that a payload with a third of all pages is split in the join.
    first = parked(narrow.groupBy("same").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"))
    again = narrow.join(first, "same").where(F.col("row") != F.col("first.row"))
    again = parked(again.select("row", F.col("first.page_id").alias("original"), F.lit(True).alias("revisit")))
    held = bloom(again.select(F.col("row").alias("key")))

    @F.pandas_udf("boolean")
    def maybe(row: pd.Series) -> pd.Series:
        return pd.Series(held.holds(row.to_numpy(np.int64)))

    new = rows.where(~maybe("row")).withColumns({"original": F.lit(None).cast("long"), "revisit": F.lit(False)})
    old = rows.where(maybe("row")).join(again, "row", "left").withColumn("revisit", F.coalesce("revisit", F.lit(False)))
    fields = ["page_id", "url", "at", "payload", "same", "original", "revisit"]
    return new.select(*fields).union(old.select(*fields))


class Archive:
    """One file of records; ``add`` returns where a record lies."""

    def __init__(self, store, base: str, name: str):
        self.name, self.at = name, 0
        self.out = store.open_output_stream(f"{base}/{name}", compression=None)
        note = b"software: seekframe\r\nformat: WARC File Format 1.1\r\n"
        fields = [("WARC-Record-ID", f"<{record_id(None, name)}>"), ("WARC-Date", MADE), ("WARC-Filename", name), ("Content-Type", "application/warc-fields")]
        self.add(framed("warcinfo", fields, note))

    def add(self, raw: bytes) -> tuple[int, int]:
        packed = member(raw)
        self.out.write(packed)
        self.at += len(packed)
        return self.at - len(packed), len(packed)


def record_of(page_id: int | None, url: str | None, at: int, payload: bytes, same: bytes, original: int | None, revisit: bool, salt: str) -> tuple[str, str, bytes]:
    """A capture's kind, payload digest and record."""
    digest, kind = digest32(payload), "revisit" if revisit else "response"
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    # A response's id follows from page and payload, so a revisit in another archive can name it.
    fields = [
        ("WARC-Record-ID", f"<{record_id(page_id, salt if revisit else same.hex())}>"),
        ("WARC-Date", moment(at)),
        ("WARC-Target-URI", NO_URL if url is None else quote(url, safe=":/?#[]@!$&'()*+,;=%-._~")),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{digest32(block)}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if revisit:
        fields += [("WARC-Profile", SAME_PAYLOAD), ("WARC-Refers-To", f"<{record_id(original, same.hex())}>")]
    return kind, digest, framed(kind, fields, block)


def write_archives(found: DataFrame, folder: str) -> list[str]:
    """Write captures as archives; return the runs of their index, each a sorted Parquet file."""

    def write(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = pyarrow.fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        archive, task = None, TaskContext.get()
        for batch in parts:
            rows = []
            columns = (batch.column(c).to_pylist() for c in ("page_id", "url", "at", "payload", "same", "original", "revisit"))
            for page_id, url, at, payload, same, original, revisit in zip(*columns):
                if archive is None or archive.at >= ARCHIVE:
                    if archive is not None:
                        archive.out.close()
                    archive = Archive(store, base, f"pages-{task.partitionId():06d}-{uuid.uuid4().hex}.warc.gz")
                salt = f"{archive.name}:{archive.at}"
                kind, digest, raw = record_of(page_id, url, at, payload, same, original, revisit, salt)
                start, size = archive.add(raw)
                rows.append((url_key(url), at, page_id is None, page_id, archive.name, start, size, digest, kind))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _SCHEMA.types)], _NAMES)
        if archive is not None:
            archive.out.close()

    entries = found.mapInArrow(write, ENTRY).sortWithinPartitions(*ORDER)
    return _written(entries).inputFiles()


def _written(entries: DataFrame) -> DataFrame:
    """Entries parked in small row groups, a file for each task, in the task's order."""
    spark, path = entries.sparkSession, shared_dir(entries.sparkSession)
    entries.write.option("maxRecordsPerFile", 0).option("parquet.block.size", 1 << 20).parquet(path)
    return spark.read.schema(entries.schema).parquet(path)


def _order_key(row: tuple) -> tuple:
    """What rows are compared by; an absent id comes last by ``no_id``."""
    return (row[0], row[1], row[2], row[3] or 0, row[4], row[5])


def _may_hold(facts: pq.RowGroupMetaData, part: list[int] | None, low: tuple | None, high: tuple | None) -> bool:
    """Whether a row group can have rows of a part between two keys, by its columns' bounds."""
    bounds = {}
    for i in range(facts.num_columns):
        column = facts.column(i)
        if column.statistics is not None and column.statistics.has_min_max:
            bounds[column.path_in_schema] = (column.statistics.min, column.statistics.max)
    wanted = [("url_key", low and low[0], high and high[0])]
    wanted += [(name, x, x) for name, x in zip(("range", "group"), part or ())]
    for name, least, most in wanted:
        if name in bounds and ((least is not None and bounds[name][1] < least) or (most is not None and bounds[name][0] > most)):
            return False
    return True


def _rows(path: str, part: list[int] | None, low: tuple | None, high: tuple | None) -> Iterator[tuple]:
    """The sorted rows of a file, or of its part (range, group), from ``low`` on and before ``high``, their order first.

    Row groups outside are skipped; one is in memory at a time, a few rows of it as objects.
    """
    store, name = pyarrow.fs.FileSystem.from_uri(path)
    with store.open_input_file(name) as source:
        file = pq.ParquetFile(source)
        for group in range(file.num_row_groups):
            if not _may_hold(file.metadata.row_group(group), part, low, high):
                continue
            for batch in file.iter_batches(RUN_ROWS, row_groups=[group]):
                if part is not None:
                    batch = batch.filter((pc.field("range") == part[0]) & (pc.field("group") == part[1]))
                for row in zip(*(batch.column(n).to_pylist() for n in _NAMES)):
                    key = _order_key(row)
                    if high is not None and key >= high:
                        return
                    if low is None or key >= low:
                        yield key, row


def splitters(entries: DataFrame, rows: int) -> list[tuple]:
    """Keys that cut the entries into ranges of about ``rows``, from a sample of ``SAMPLED`` keys a range."""
    n = entries.count()
    ranges = -(-n // rows)
    if ranges < 2:
        return []
    some = entries.sample(min(1.0, SAMPLED * ranges / n), seed=7).select(*ORDER).collect()
    keys = sorted(_order_key(tuple(r)) for r in some)
    return sorted({keys[i * len(keys) // ranges] for i in range(1, ranges)}) if keys else []


def merged(work: DataFrame, bounds: list[tuple]) -> DataFrame:
    """Each row of ``work`` (range, group, files) done: its files' rows of the range, merged, parked.

    A task's file holds what it merged for each of its rows, one after another.
    """

    def batch_of(rows: list[tuple], place: int, group: int) -> pa.RecordBatch:
        columns = [pa.array(c, t) for c, t in zip(zip(*rows), _SCHEMA.types)]
        own = [pa.array([x] * len(rows), pa.int32()) for x in (place, group)]
        return pa.RecordBatch.from_arrays([*columns, *own], [*_NAMES, "range", "group"])

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for todo in batch.to_pylist():
                streams = [_rows(f["path"], f["part"], *bounds[todo["range"]]) for f in todo["files"]]
                rows = []
                for _, row in LoserTree(streams):
                    rows.append(row)
                    if len(rows) == RUN_ROWS:
                        yield batch_of(rows, todo["range"], todo["group"])
                        rows = []
                if rows:
                    yield batch_of(rows, todo["range"], todo["group"])

    return _written(work.mapInArrow(run, f"{ENTRY}, range int, group int"))


def merge_runs(spark: SparkSession, runs: list[str], fan: int | None = None, rows: int | None = None) -> DataFrame:
    """All captures in ``ORDER``: entries with their ``range``; each range is one file that holds its entries in order.

    A level merges up to ``fan`` runs into one. Its ranges are as many as keep a task at about
    ``rows`` entries: the more runs are left, the wider they are, and each lies in one of the
    level before, so that a task reads one file of each of its runs.
    """
    fan, rows = fan or FAN, rows or RANGE_ROWS
    if not runs:
        return spark.createDataFrame([], f"{ENTRY}, range int")
    cuts = splitters(spark.read.schema(ENTRY).parquet(*runs), rows)
    stride = 1
    while stride * fan < len(runs):
        stride *= fan

    def bounds() -> list[tuple]:
        own = cuts[stride - 1 :: stride]
        return list(zip([None, *own], [*own, None]))

    groups = [[(f, None) for f in runs[i : i + fan]] for i in range(0, len(runs), fan)]
    todo = [(r, g, files) for r in range(len(bounds())) for g, files in enumerate(groups)]
    work, n = spark.createDataFrame(todo, WORK), len(groups)
    while True:
        done = merged(work.repartition(len(bounds()) * n, "range", "group"), bounds())
        if stride == 1:
            return done.drop("group")
        stride, n = stride // fan, -(-n // fan)
        last, parts = len(bounds()) - 1, F.col("range") * fan
        placed = done.select("range", "group", F.input_file_name().alias("path")).distinct()
        file = F.struct("path", F.array("range", "group").alias("part"))
        finer = F.explode(F.sequence(parts, F.least(parts + fan - 1, F.lit(last))))
        placed = placed.select(finer.alias("range"), (F.col("group") / fan).cast("int").alias("next"), F.struct("group", file.alias("file")).alias("f"))
        work = placed.groupBy("range", F.col("next").alias("group")).agg(F.sort_array(F.collect_list("f")).alias("f"))
        work = work.select("range", "group", F.col("f.file").alias("files"))


def read_archives(index: DataFrame, folder: str) -> DataFrame:
    """The captures of an index, read from their archives; digests and lengths are checked against the bytes.

    ``page_id``, ``kind``, ``url`` (as written), ``date``, ``payload`` (null for revisits), ``payload_bytes``, ``payload_digest``, ``refers_to``.
    """

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = pyarrow.fs.FileSystem.from_uri(folder)
        name, source = None, None
        for batch in parts:
            out = []
            for file, start, size, digest, kind in zip(*(batch.column(c).to_pylist() for c in ("file", "start", "size", "digest", "kind"))):
                if file != name:
                    if source is not None:
                        source.close()
                    name, source = file, store.open_input_file(f"{base}/{file}")
                row = parsed(zlib.decompress(source.read_at(size, start), 31))
                if (row["kind"], row["payload_digest"]) != (kind, digest):
                    raise ValueError(f"{file} at {start}: not the record that the index names")
                out.append(row)
            yield pa.RecordBatch.from_pylist(out, schema=_READ)

    ordered = index.select("file", "start", "size", "digest", "kind").repartitionByRange("file", "start").sortWithinPartitions("file", "start")
    return ordered.mapInArrow(run, READ)


READ = "page_id long, kind string, url string, date string, payload binary, payload_bytes long, payload_digest string, refers_to long"
_READ = pa.schema([(n, {**_TYPES, "binary": pa.binary()}[t]) for n, t in (x.split() for x in READ.split(", "))])


def parsed(raw: bytes) -> dict:
    """A record's parts; a record that does not match its own lengths and digests is refused."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    if lines[0] != VERSION or rest[len(block) :] != b"\r\n\r\n" or f"sha1:{digest32(block)}" != fields["WARC-Block-Digest"]:
        raise ValueError(f"damaged record {fields.get('WARC-Record-ID')}")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
    digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or digest32(payload) != digest):
        raise ValueError(f"damaged payload of {fields['WARC-Record-ID']}")
    refers = fields.get("WARC-Refers-To")
    return {
        "page_id": page_of(fields["WARC-Record-ID"]),
        "kind": kind,
        "url": fields["WARC-Target-URI"],
        "date": fields["WARC-Date"],
        "payload": payload if kind == "response" else None,
        "payload_bytes": size,
        "payload_digest": digest,
        "refers_to": page_of(refers) if refers else None,
    }
