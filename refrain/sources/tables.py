"""Parquet and JDBC tables, local rows, object listings."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from refrain.functions.text import id_from_segment
from refrain.sources.files import can_open, list_files


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_partition(spark: SparkSession, path: str, column: str, value) -> DataFrame:
    """Rows of one partition value; the filter prunes directories and the column stays in the result."""
    return spark.read.parquet(path).where(F.col(column) == F.lit(value))


def append_table(df: DataFrame, path: str, rows_per_file: int = 5_000_000) -> None:
    """Append as files of bounded size, written by all tasks at once."""
    df.write.mode("append").option("maxRecordsPerFile", rows_per_file).parquet(path)


def append_counted(df: DataFrame, path: str, rows_per_file: int = 5_000_000) -> int:
    """Append and say how many rows that were; the job that writes them counts them."""
    written = Observation()
    append_table(df.observe(written, F.count(F.lit(1)).alias("rows")), path, rows_per_file)
    return written.get["rows"]


def append_partitioned(df: DataFrame, path: str, column: str | Sequence[str], rows_per_file: int = 5_000_000) -> None:
    """Append partitioned by ``column``, or by several.

    The rebalance brings a rare value into one file and splits a value that holds much of the table over
    as many tasks as its measured size calls for.
    """
    columns = [column] if isinstance(column, str) else list(column)
    (
        df.hint("rebalance", *columns)
        .write.mode("append")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy(*columns)
        .parquet(path)
    )


def write_batch(df: DataFrame, path: str, batch: str | int, column: str | Sequence[str] = (), rows_per_file: int = 5_000_000) -> None:
    """Append the rows of one batch, once: writing a batch again replaces what it wrote before.

    The batch id is a partition of the table (``batch_id``), above those by ``column``, and each write replaces the
    partitions of its own batch as a whole, also those that it has no rows for now. Readers of other batches aren't touched.
    """
    columns = [column] if isinstance(column, str) else list(column)
    writer = (df.hint("rebalance", *columns) if columns else df).write.mode("overwrite").option("maxRecordsPerFile", rows_per_file)
    if columns:
        writer = writer.partitionBy(*columns)
    writer.parquet(f"{path.rstrip('/')}/batch_id={batch}")


def jdbc_options(url: str, user: str | None = None, password: str | None = None, driver: str | None = None) -> dict:
    given = {"url": url, "user": user, "password": password, "driver": driver}
    return {k: v for k, v in given.items() if v is not None}


def jdbc_split(column: str, lower: int, upper: int, parts: int) -> dict:
    """Options that make a JDBC scan run as ``parts`` range queries."""
    return {"partitionColumn": column, "lowerBound": lower, "upperBound": upper, "numPartitions": parts}


def read_jdbc(spark: SparkSession, connection: dict, table: str, split: dict | None = None) -> DataFrame:
    """A database table; filters and column choice are pushed into its query."""
    return spark.read.format("jdbc").options(**connection, dbtable=table, **(split or {})).load()


def append_jdbc(df: DataFrame, connection: dict, table: str, connections: int = 16, batch: int = 10_000) -> None:
    """Append over at most ``connections`` connections at once."""
    options = {**connection, "dbtable": table, "numPartitions": connections, "batchsize": batch}
    df.write.format("jdbc").options(**options).mode("append").save()


def local_rows(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType | str) -> DataFrame:
    """A small table from rows at hand, with a stated schema and hence no inference job."""
    return spark.createDataFrame(list(rows), schema)


def list_objects(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """Path and size of all objects below ``path`` whose name matches; their content is not read.

    Tasks list them by folders. Only where Arrow can't open the path Spark's own file index does, on the driver.
    """
    if can_open(path):
        return list_files(spark, path, pattern)
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "length")
    )


def keyed_objects(listing: DataFrame, segment: int, extension: str, path: str = "path") -> DataFrame:
    """Listed objects with ``extension`` in their key and the integer id that a key segment holds."""
    return listing.where(F.col(path).contains(extension)).withColumn(
        "track_id", id_from_segment(F.col(path), segment, extension)
    )
