"""Files below a folder as a Spark data source, also those whose names Spark's own readers hide.

Spark's file readers pass over names that start with ``_``. This source lists by itself: one task
for the files right below the folder and one for each folder below it. It gives names and sizes
only; contents are read afterwards, dealt by file (:func:`casework.sources.files.scan_files`).
"""

from __future__ import annotations

from collections.abc import Iterator

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

SCHEMA = "path string, name string, size long, modified timestamp"


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path in it of a local path or a URI that Arrow knows."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def dotted(path: str) -> bool:
    return any(part.startswith(".") for part in path.split("/"))


class Folder(InputPartition):
    """One folder to list: with all below it, or only its own files."""

    def __init__(self, path: str, deep: bool):
        super().__init__(path)
        self.path, self.deep = path, deep


class ListingReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[Folder]:
        store, root = opened(self.path)
        below = store.get_file_info(fs.FileSelector(root))
        folders = [Folder(i.path, True) for i in below if i.type == fs.FileType.Directory and not dotted(i.base_name)]
        return [Folder(root, False), *folders]

    def read(self, partition: Folder) -> Iterator[tuple]:
        store, root = opened(self.path)
        for info in store.get_file_info(fs.FileSelector(partition.path, recursive=partition.deep)):
            inner = info.path[len(root.rstrip("/")) + 1 :]
            if info.type == fs.FileType.File and not dotted(inner):
                yield inner, info.base_name, info.size, info.mtime


class FileListing(DataSource):
    """``path`` (relative), ``name``, ``size`` and ``modified`` of every file below the option ``path``."""

    @classmethod
    def name(cls) -> str:
        return "file_listing"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> ListingReader:
        return ListingReader(self.options["path"])


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """All files below ``path`` but those whose name, or a folder's on the way, starts with a dot."""
    spark.dataSource.register(FileListing)
    return spark.read.format("file_listing").load(path.rstrip("/") or "/")
