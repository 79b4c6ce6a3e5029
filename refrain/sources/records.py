"""Records of delimited files whose quoted cells may hold line feeds, by many tasks for each file.

Whether a byte lies inside quotes depends on the number of quotes before it in the whole file, but only on whether it is odd.
So tasks count the quotes of their byte ranges, running sums over the ranges of a file say in which state each one
begins, and every range then knows its first line feed outside of quotes. Between those cuts lie whole records.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from refrain.sources.files import RANGE, ranges, read_range
from refrain.sources.scratch import settle

QUOTE, FEED = ord('"'), ord("\n")


def cuts_of(data: bytes, inside: bool = False) -> np.ndarray:
    """Places after the line feeds that are outside of quotes, if ``data`` begins outside (or ``inside``) of them."""
    text = np.frombuffer(data, np.uint8)
    feeds = np.flatnonzero(text == FEED)
    before = np.searchsorted(np.flatnonzero(text == QUOTE), feeds)
    return feeds[(before + inside) % 2 == 0] + 1


def _measured(of: DataFrame) -> DataFrame:
    """Of each range its number of quotes, and its first cut for either state that it may begin in."""
    ddl = "path string, start long, end long, quotes long, cut_outside long, cut_inside long"
    schema = pa.schema([(c.split()[0], pa.string() if c.startswith("path") else pa.int64()) for c in ddl.split(", ")])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, end in zip(*(batch.column(c).to_pylist() for c in ("path", "start", "end"))):
                data = read_range(path, start, end)
                firsts = [start + int(c[0]) if len(c) else None for c in (cuts_of(data), cuts_of(data, True))]
                row = (path, start, end, data.count(b'"'), *firsts)
                yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, schema)], schema=schema)

    return of.mapInArrow(measure, ddl)


def _tasks(files: DataFrame, size: int) -> int:
    """As many tasks as there are ranges of ``size`` bytes, ``RANGE`` at least, in all files together, and a few where these are small.

    Smaller ranges are read one by one all the same: a task for each would take longer to start than to run.
    """
    total = files.agg(F.sum("length")).first()[0] or 0
    return max(files.sparkSession.sparkContext.defaultParallelism, -(-total // max(size, RANGE)))


def segments(files: DataFrame, size: int = RANGE) -> DataFrame:
    """``path``, ``begin``, ``end``: stretches of files (``path``, ``length``) that hold whole records, about ``size`` bytes each.

    A record longer than a range makes its stretch as much longer. The ranges are read once for this, when it is called.
    """
    own = ranges(files, size)
    measured = settle(_measured(own.repartition(_tasks(files, size), "path", "start")), "ranges")
    upwards = Window.partitionBy("path").orderBy("start")
    before = F.coalesce(F.sum("quotes").over(upwards.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cut = F.when(F.col("start") == 0, F.lit(0)).when(before % 2 == 0, F.col("cut_outside")).otherwise(F.col("cut_inside"))
    begun = measured.select("path", F.col("end").alias("last"), "start", cut.alias("begin"))
    length = F.max("last").over(Window.partitionBy("path"))
    begun = begun.withColumn("length", length).where("begin IS NOT NULL AND (begin < length OR begin = 0)")
    following = F.coalesce(F.lead("begin").over(Window.partitionBy("path").orderBy("begin")), F.col("length"))
    return begun.select("path", "begin", following.alias("end")).where("end > begin")


def records(files: DataFrame, size: int = RANGE) -> DataFrame:
    """``path`` and ``record``, the text of each record of files (``path``, ``length``), in UTF-8; empty lines are none.

    A quote in a cell must be doubled and its cell quoted. Lines end with a line feed, before which a carriage return goes;
    line ends inside a cell stay as they are.
    """
    found = segments(files, size)
    schema = pa.schema([("path", pa.string()), ("record", pa.string())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, begin, end in zip(*(batch.column(c).to_pylist() for c in ("path", "begin", "end"))):
                data = read_range(path, begin, end)
                if begin == 0:
                    data = data.removeprefix(b"\xef\xbb\xbf")
                cuts = cuts_of(data)
                bounds = [0, *cuts.tolist()] + ([len(data)] if not len(cuts) or cuts[-1] < len(data) else [])
                lines = [data[a:b].removesuffix(b"\n").removesuffix(b"\r") for a, b in zip(bounds, bounds[1:])]
                texts = pa.array([x.decode("utf-8", "replace") for x in lines if x], pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(texts), pa.string()), texts], schema=schema)

    return found.repartitionByRange(_tasks(files, size), "path", "begin").mapInArrow(read, "path string, record string")
