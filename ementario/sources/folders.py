"""Folders listed, and their files read, by the executors: a Python data source.

Spark's own file sources list on the driver and keep every name there. Here the driver sees the folders of the first level
only; each is a partition, whose task walks it and hands its names out in batches.
"""

from __future__ import annotations

import fnmatch
from collections.abc import Iterator
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

NAME = "ementario_folders"
SCHEMA = "rel_path string, size bigint"
#: Names in a batch.
ROWS = 10_000


def file_system(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder and its path there. A folder without a scheme is local, or on a mount all executors have."""
    parts = urlsplit(folder)
    if len(parts.scheme) < 2 or parts.scheme == "file":
        return fs.LocalFileSystem(), (unquote(parts.path) if parts.scheme == "file" else folder).rstrip("/") or "/"
    found, path = fs.FileSystem.from_uri(folder)
    return found, path.rstrip("/")


def _hidden(name: str) -> bool:
    return name.startswith(("_", "."))


class Folder(InputPartition):
    """A folder below the root, or with ``deep=False`` the root's own files."""

    def __init__(self, path: str, deep: bool) -> None:
        self.path, self.deep = path, deep


class FolderReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.folder, self.pattern = options["path"], options.get("pattern", "*")

    def partitions(self) -> list[Folder]:
        system, root = file_system(self.folder)
        below = system.get_file_info(fs.FileSelector(root))
        inner = [i.path for i in below if i.type == fs.FileType.Directory and not _hidden(i.base_name)]
        return [Folder(root, deep=False), *(Folder(path, deep=True) for path in sorted(inner))]

    def read(self, partition: Folder) -> Iterator[pa.RecordBatch]:
        system, root = file_system(self.folder)
        skip = len(root.rstrip("/")) + 1
        todo, names, sizes = [partition.path], [], []
        while todo:
            for info in system.get_file_info(fs.FileSelector(todo.pop())):
                if _hidden(info.base_name):
                    continue
                if info.type == fs.FileType.Directory:
                    if partition.deep:
                        todo.append(info.path)
                elif fnmatch.fnmatchcase(info.base_name, self.pattern):
                    names.append(info.path[skip:])
                    sizes.append(info.size)
                if len(names) >= ROWS:
                    yield _batch(names, sizes)
                    names, sizes = [], []
        yield _batch(names, sizes)


def _batch(names: list[str], sizes: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(sizes, pa.int64())], names=["rel_path", "size"])


class FolderSource(DataSource):
    """``spark.read.format("ementario_folders").option("pattern", "*.json").load(folder)``: the files below a folder.

    Names that start with ``_`` or ``.`` are hidden, as for Spark's own sources.
    """

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: object) -> FolderReader:
        return FolderReader(dict(self.options))


def list_folder(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """``rel_path, size`` of every matching file below ``folder``, empty ones included. No name reaches the driver."""
    spark.dataSource.register(FolderSource)
    return spark.read.format(NAME).option("pattern", pattern).load(folder)


def open_files(files: DataFrame, folder: str) -> DataFrame:
    """``rel_path, text`` of files below ``folder``, whole, empty ones included. Bytes that are no UTF-8 are replaced.

    The rows are dealt out before they are read, so that one folder's files are many tasks'.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = file_system(folder)
        for batch in batches:
            for name in batch.column("rel_path").to_pylist():  # one file at a time: it may be large
                with system.open_input_stream(f"{root}/{name}", compression=None) as f:
                    text = f.read().decode("utf-8", "replace")
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([text])], names=["rel_path", "text"])

    return files.select("rel_path").repartition("rel_path").mapInArrow(run, "rel_path string, text string")
