"""Small versioned files: what an index consists of, and where aliases point."""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Files:
    """Whole small files on the cluster's file system."""

    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        self._jvm = spark._jvm
        self._gateway = spark.sparkContext._gateway
        self._fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}".rstrip("/"))

    def names(self, folder: str = "") -> list[str]:
        path = self._path(folder)
        if not self._fs.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(path))

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._path(name))

    def read(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> bool:
        """Make a file appear whole under a name nobody has taken; False if taken.

        The rename refuses a taken name, and does so in one step on file systems (such as
        HDFS) whose ``FileContext`` rename is atomic. Others are for tests and single writers.
        """
        target = self._path(name)
        if self._fs.exists(target):
            return False
        folder, _, leaf = name.rpartition("/")
        draft = self._path(f"{folder}/.{leaf}.{uuid.uuid4().hex}")
        out = self._fs.create(draft, False)
        try:
            out.write(bytearray(text, "utf-8"))
        finally:
            out.close()
        hadoop = self._jvm.org.apache.hadoop.fs
        context = hadoop.FileContext.getFileContext(self._fs.getUri(), self._fs.getConf())
        options = self._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(draft, target, options)
        except Py4JJavaError as error:
            if "FileAlreadyExists" in str(error.java_exception):
                self._fs.delete(draft, False)
                return False
            raise
        return True

    def remove(self, name: str) -> None:
        self._fs.delete(self._path(name), True)


class Versions:
    """Numbered JSON files in a folder; the highest number is the current state."""

    def __init__(self, files: Files, folder: str):
        self._files = files
        self._folder = folder

    def numbers(self) -> list[int]:
        return [int(n[:-5]) for n in self._files.names(self._folder) if n.endswith(".json") and n[0] != "."]

    def latest(self) -> dict | None:
        numbers = self.numbers()
        return self.at(max(numbers)) if numbers else None

    def at(self, number: int) -> dict:
        return json.loads(self._files.read(f"{self._folder}/{number:012d}.json"))

    def publish(self, number: int, state: dict) -> bool:
        return self._files.publish(f"{self._folder}/{number:012d}.json", json.dumps(state, sort_keys=True))


@dataclass(frozen=True)
class Manifest:
    """State of an index at one version."""

    name: str
    key: str
    version: int = 0
    language: str = "english"
    schema: dict | None = None
    searchable: list[str] | None = None
    filterable: list[str] | None = None
    sortable: list[str] | None = None
    buckets: int = 16
    #: Words whose postings share a file, about.
    file_words: int = 4_000_000
    #: Fields whose values lie beside the postings of every segment.
    stored: list[str] = field(default_factory=list)
    segments: list[dict] = field(default_factory=list)
    n_docs: int = 0
    sum_len: int = 0
    batches: dict[str, int] = field(default_factory=dict)
    paused: bool = False
    last_commit: dict | None = None

    def to_dict(self) -> dict:
        return asdict(self)

    def next(self, **changes) -> "Manifest":
        return replace(self, version=self.version + 1, **changes)

    def with_part(self, part: str) -> list[str]:
        """Ids of the segments that hold a part (docs, postings, terms, voids)."""
        return [s["id"] for s in self.segments if part in s["parts"]]

    @property
    def mean_length(self) -> float:
        return self.sum_len / self.n_docs if self.n_docs else 0.0
