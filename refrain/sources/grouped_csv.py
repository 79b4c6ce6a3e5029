"""CSV whose header has two lines: a group line above a name line."""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from refrain.sources.files import HEAD, RANGE, can_open, first_lines
from refrain.sources.records import records

SEPARATOR = "__"
CORRUPT = "corrupt_record"


def grouped_columns(group_line: str, name_line: str, id_name: str) -> list[str]:
    """Flat column names ``group__name``; the unnamed first column is the id."""
    groups, names = next(csv.reader([group_line])), next(csv.reader([name_line]))
    if len(groups) != len(names):
        raise ValueError(f"header lines differ in width: {len(groups)} and {len(names)}")
    pairs = [(g.strip(), n.strip()) for g, n in zip(groups, names)]
    return [id_name] + [f"{g}{SEPARATOR}{n}" for g, n in pairs[1:]]


def header_lines(spark: SparkSession, path: str) -> dict[tuple[str, str], list[tuple[str, int]]]:
    """The files, with their sizes, of each pair of header lines; of a file two lines go to the driver.

    A task opens a file and stops after its first bytes. Only where Arrow can't open a path the driver does so itself.
    """
    listed = spark.read.format("binaryFile").load(path).select("path", "length")
    if can_open(path):
        heads = first_lines(listed, 2).drop("bytes_read").collect()
        of_file = {(r["path"], r["length"]): r["lines"] for r in heads}
    else:
        of_file = {(r["path"], r["length"]): _opened_by_spark(spark, r["path"]) for r in listed.collect()}
    found: dict[tuple[str, str], list[tuple[str, int]]] = {}
    for file, lines in sorted(of_file.items()):
        if len(lines) < 2:
            raise ValueError(f"{file[0]} has no two header lines")
        found.setdefault((lines[0], lines[1]), []).append(file)
    return found


def _opened_by_spark(spark: SparkSession, path: str) -> list[str]:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(target)
    try:
        text = bytes(stream.readNBytes(HEAD)).decode("utf-8", "replace")
    finally:
        stream.close()
    return [x.removesuffix("\r") for x in text.split("\n")[:2]]


def read_grouped_csv(
    spark: SparkSession,
    path: str,
    id_name: str = "track_id",
    keep_nan_strings: bool = False,
    multi_line: bool = True,
    range_bytes: int = RANGE,
) -> DataFrame:
    """Two-level-header CSV as flat string columns, and ``corrupt_record``.

    Every file has its own two header lines; files with other columns, or the same in another order, meet by name, and
    a column that a file lacks is NULL there. The header lines and the row that only names the index are dropped by
    content. A cell that is empty or ``nan`` becomes NULL, or the string ``nan`` with ``keep_nan_strings``. A row with
    too few or too many cells keeps what could be read and its text in ``corrupt_record``.

    Blanks before an unquoted cell are dropped, those inside quotes stay.

    Quoted cells may hold line feeds: files are cut between records by many tasks (``refrain.sources.records``, which reads
    all bytes once more for that and once when this is called), and each record is parsed by Spark. Where Arrow can't open
    the path, a task reads a file as a whole. ``multi_line=False`` says that no cell has a line feed, so that Spark can
    split the files itself. Headers are read when this is called.
    """
    result = None
    for (group_line, name_line), files in header_lines(spark, path).items():
        columns = grouped_columns(group_line, name_line, id_name)
        schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, CORRUPT]])
        options = dict(quote='"', escape='"', ignoreLeadingWhiteSpace=True, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)
        if multi_line and can_open(path):
            of_header = spark.createDataFrame(files, "path string, length long")
            ddl = ", ".join(f"`{c}` string" for c in schema.names)
            parsed = F.from_csv("record", ddl, {k: str(v) for k, v in options.items()})
            raw = records(of_header, range_bytes).select(parsed.alias("row")).select("row.*")
        else:
            raw = spark.read.csv([f for f, _ in files], schema=schema, header=False, multiLine=multi_line, **options)
        key = F.col(f"`{id_name}`")
        rows = raw.where(~F.coalesce(key == id_name, F.lit(False)))
        for line in (group_line, name_line):
            cells = [c.strip() for c in next(csv.reader([line]))]
            same = [F.col(f"`{c}`").eqNullSafe(F.lit(x or None)) for c, x in zip(columns, cells)]
            rows = rows.where(~F.forall(F.array(*same), lambda x: x))
        if keep_nan_strings:
            cells = [F.coalesce(F.col(f"`{c}`"), F.lit("nan")).alias(c) for c in columns]
        else:
            cells = [F.nullif(F.col(f"`{c}`"), F.lit("nan")).alias(c) for c in columns]
        part = rows.select(*cells, CORRUPT)
        result = part if result is None else result.unionByName(part, allowMissingColumns=True)
    if result is None:
        raise ValueError(f"no file in {path}")
    return result


def select_group(df: DataFrame, group: str, id_name: str = "track_id") -> DataFrame:
    """The id and the columns of one header group, without the group in their names."""
    prefix = group + SEPARATOR
    chosen = [c for c in df.columns if c.startswith(prefix)]
    if not chosen:
        raise ValueError(f"no column group {group!r}")
    names = [c[len(prefix):] for c in chosen]
    spaced = [n for n in names if " " in n]
    if spaced:
        raise ValueError(f"column names with spaces: {spaced}")
    return df.select(id_name, *[F.col(f"`{c}`").alias(n) for c, n in zip(chosen, names)])
