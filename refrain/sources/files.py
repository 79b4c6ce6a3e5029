"""Files and byte ranges, opened by tasks through Arrow's file systems; the driver holds names of folders and no content."""

from __future__ import annotations

import fnmatch
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

#: Bytes of a range that one task reads at a time, and those that are read of a file for its first lines.
RANGE, HEAD = 32 << 20, 1 << 16
#: Folders that are looked up before the tasks list what is below them.
FOLDERS = 1000


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path, as Spark writes it, and the path inside."""
    if path.startswith(("/", "file:/")):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    found, inside = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    return found, inside


def can_open(path: str) -> bool:
    """Whether Arrow knows the path's scheme; other paths are left to Spark's readers."""
    try:
        opened(path)
    except (pa.ArrowException, OSError, ValueError):
        return False
    return True


def _named(path: str, inside: str, root: str) -> str:
    """``inside`` written as Spark writes paths below ``path``, whose own inner path is ``root``."""
    if path.startswith(("/", "file:/")):
        return f"file:{inside}"
    return path.rstrip("/") + inside.removeprefix(root.rstrip("/"))


def _children(system: fs.FileSystem, folder: str) -> tuple[list[fs.FileInfo], list[str]]:
    found = system.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    shown = [x for x in found if not x.base_name.startswith(("_", "."))]  # others are hidden, as for Spark's readers
    return [x for x in shown if x.type == fs.FileType.File], [x.path for x in shown if x.type == fs.FileType.Directory]


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """``path`` and ``length`` of all files below ``path`` whose name matches ``pattern``; their content is not read.

    The driver looks up folders, level by level, until there are ``FOLDERS`` of them or none is left; tasks list
    what is in each and below. An object store's listing so never meets in one place, and a task holds that of
    one folder at a time.
    """
    system, root = opened(path)
    ready: list[tuple[str, bool]] = []
    waiting = [root.rstrip("/") or "/"]
    while waiting and len(waiting) + len(ready) < FOLDERS:
        level, waiting = waiting, []
        for folder in level:
            ready.append((folder, False))
            waiting += _children(system, folder)[1]
    ready += [(folder, True) for folder in waiting]
    schema = pa.schema([("path", pa.string()), ("length", pa.int64())])

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = opened(path)
        for batch in batches:
            for folder, below in zip(*(c.to_pylist() for c in batch.columns)):
                stack = [folder]
                while stack:
                    files, folders = _children(system, stack.pop())
                    stack += folders if below else []
                    chosen = [x for x in files if fnmatch.fnmatch(x.base_name, pattern)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([_named(path, x.path, root) for x in chosen], pa.string()), pa.array([x.size for x in chosen], pa.int64())],
                        schema=schema,
                    )

    folders = spark.createDataFrame(ready, "folder string, below boolean").repartition(min(len(ready), FOLDERS))
    return folders.mapInArrow(listed, "path string, length long")


def first_lines(files: DataFrame, lines: int, head: int = HEAD) -> DataFrame:
    """``path``, ``length``, ``lines`` and ``bytes_read`` of files (``path``, ``length``): their first lines, however long they are.

    A task reads ``head`` bytes of a file, and more only while they hold fewer line feeds.
    """
    ddl = "path string, length long, lines array<string>, bytes_read long"
    schema = pa.schema([("path", pa.string()), ("length", pa.int64()), ("lines", pa.list_(pa.string())), ("bytes_read", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for path, length in zip(*(c.to_pylist() for c in batch.columns)):
                system, inside = opened(path)
                with system.open_input_file(inside) as file:
                    data = b""
                    while data.count(b"\n") < lines and (more := file.read(max(head, len(data)))):
                        data += more
                text = data.removeprefix(b"\xef\xbb\xbf").decode("utf-8", "replace")
                rows.append((path, length, [x.removesuffix("\r") for x in text.split("\n")[:lines]], len(data)))
            columns = [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return files.select("path", "length").mapInArrow(read, ddl)


def ranges(files: DataFrame, size: int = RANGE) -> DataFrame:
    """``path``, ``start``, ``end`` of the byte ranges of files (``path``, ``length``)."""
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(size).cast("long")))
    cut = files.select("path", "length", starts.alias("start"))
    return cut.select("path", "start", F.least(F.col("start") + size, F.col("length")).alias("end"))


def read_range(path: str, start: int, end: int) -> bytes:
    system, inside = opened(path)
    with system.open_input_file(inside) as file:
        return file.read_at(end - start, start)
