"""Captured pages as a Spark data source: one partition per capture file, source filters pushed down, offsets for streams.

A capture is a file ``<folder>/<source>/<stamp>.jsonl`` with a JSON object per page (url, html). A batch read lists the folder and
plans one partition per capture of a wanted source; a stream's offset is the last stamp read, and each trigger plans the captures
with later stamps. Captures are written once, in order of their stamps; the folder may be on any file system that
pyarrow knows, and executors read the files themselves.
"""

from __future__ import annotations

import json
import posixpath
from collections.abc import Iterable, Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, In, InputPartition
from pyspark.sql.types import StructType

NAME = "captures"
SCHEMA = "source string, stamp string, url string, html string"


class Capture(InputPartition):
    def __init__(self, path: str, source: str, stamp: str):
        self.path, self.source, self.stamp = path, source, stamp


def _files(folder: str) -> tuple:
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def listed(folder: str, sources: set[str] | None = None) -> list[Capture]:
    """The captures in a folder, by stamp and source; only of ``sources`` where given."""
    from pyarrow import fs

    files, root = _files(folder)
    out = []
    for info in files.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
        source, name = posixpath.split(posixpath.relpath(info.path, root))
        if info.type == fs.FileType.File and name.endswith(".jsonl") and source and "/" not in source and (sources is None or source in sources):
            out.append(Capture(info.path, source, name.removesuffix(".jsonl")))
    return sorted(out, key=lambda c: (c.stamp, c.source))


def _rows(folder: str, capture: Capture) -> Iterator[tuple]:
    files, _ = _files(folder)
    with files.open_input_stream(capture.path) as file:
        for line in file.read().decode().split("\n"):
            if line.strip():
                page = json.loads(line)
                yield capture.source, capture.stamp, page.get("url"), page.get("html")


class _Batch(DataSourceReader):
    def __init__(self, folder: str):
        self.folder, self.sources = folder, None

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            wanted = {f.value} if isinstance(f, EqualTo) and f.attribute == ("source",) else set(f.value) if isinstance(f, In) and f.attribute == ("source",) else None
            if wanted is None:
                yield f
            else:
                self.sources = wanted if self.sources is None else self.sources & wanted

    def partitions(self) -> list[InputPartition]:
        return listed(self.folder, self.sources)

    def read(self, partition: Capture | None) -> Iterator[tuple]:
        # Without captures Spark plans one partition of nothing.
        return _rows(self.folder, partition) if partition is not None else iter(())


class _Stream(DataSourceStreamReader):
    def __init__(self, folder: str):
        self.folder = folder

    def initialOffset(self) -> dict:
        return {"stamp": ""}

    def latestOffset(self) -> dict:
        return {"stamp": max([c.stamp for c in listed(self.folder)], default="")}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [c for c in listed(self.folder) if start["stamp"] < c.stamp <= end["stamp"]]

    def read(self, partition: Capture) -> Iterator[tuple]:
        return _rows(self.folder, partition)


class Captures(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Batch(self.options["path"])

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _Stream(self.options["path"])


def register(spark: SparkSession) -> None:
    """Makes ``spark.read.format("captures")`` and ``spark.readStream.format("captures")`` known, with filters pushed down."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Captures)
