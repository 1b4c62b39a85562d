"""A data source of file names and sizes, listed in tasks; no content is read.

Spark's own readers hold every file name on the driver and pass over empty files. Here the
driver looks at the folders down to ``depth`` levels only; what lies below each of the last
ones is listed by a task, folder by folder, and goes straight into rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as afs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from lakejobs.session import file_system, share_package

SCHEMA = "path string, n_bytes long"
BATCH = 10_000


@dataclass
class Folder(InputPartition):
    """``path`` as the store names it; ``whole`` if the folders below belong to it."""

    path: str
    whole: bool

    def __post_init__(self) -> None:
        super().__init__(self.path)


def store_of(uri: str) -> tuple[afs.FileSystem, str]:
    """The store of a qualified path, and the path in it."""
    local = re.match(r"file:/+", uri)
    if local:
        return afs.LocalFileSystem(), "/" + uri[local.end() :]
    return afs.FileSystem.from_uri(uri)


def hidden(name: str) -> bool:
    """Whether Spark's readers pass over a file or folder of this name."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name)


def children(store: afs.FileSystem, path: str) -> list[afs.FileInfo]:
    found = store.get_file_info(afs.FileSelector(path))
    return [f for f in found if not hidden(f.base_name)]


class FolderListing(DataSource):
    """Options: ``path``, qualified; ``depth``, the levels that the driver looks at."""

    @classmethod
    def name(cls) -> str:
        return "folder_listing"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return FolderReader(self.options["path"], int(self.options.get("depth", "1")))


class FolderReader(DataSourceReader):
    def __init__(self, path: str, depth: int) -> None:
        self.uri, self.depth = path, depth

    def partitions(self) -> list[Folder]:
        store, root = store_of(self.uri)
        level, out = [root], []
        for _ in range(self.depth):
            below = [f.path for path in level for f in children(store, path) if f.type == afs.FileType.Directory]
            out += [Folder(path, False) for path in level]
            level = below
        return out + [Folder(path, True) for path in level]

    def read(self, partition: Folder) -> Iterator[pa.RecordBatch]:
        store, _ = store_of(self.uri)
        todo = [partition.path]
        names, sizes = [], []
        while todo:
            for found in children(store, todo.pop()):
                if found.type == afs.FileType.Directory:
                    todo += [found.path] if partition.whole else []
                    continue
                names.append(found.path)
                sizes.append(found.size)
                if len(names) == BATCH:
                    yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(sizes, pa.int64())], ["path", "n_bytes"])
                    names, sizes = [], []
        if names:
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(sizes, pa.int64())], ["path", "n_bytes"])


def folder_listing(spark: SparkSession, path: str, depth: int = 1) -> DataFrame:
    """``path`` and ``n_bytes`` of every file below the folder ``path``.

    A path without a scheme is one of the cluster's default store, as for Spark's readers.
    """
    share_package(spark)
    store, folder = file_system(spark, path)
    spark.dataSource.register(FolderListing)
    options = {"path": store.makeQualified(folder).toString(), "depth": str(depth)}
    return spark.read.format(FolderListing.name()).options(**options).load()
