"""The corpus pipeline: quality rules, line dedup, near-dedup, benchmark decontamination, encoding
and decoding.

Every stage takes the documents that the one before has kept, and all but the last return the columns of documents;
``n_chars`` follows the text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from refrain.llm import decontaminate, lines, near, pieces, quality
from refrain.llm.queries import MODEL
from refrain.sources.scratch import settle


def counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; lines that too many documents of a source share are left out."""
    return counted(quality.apply_rules(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of three-line windows are left out; no document goes."""
    return counted(lines.drop_repeated(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays (five words a shingle, similarity 0.8)."""
    return near.drop_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go; spans of test items in others are left out."""
    return counted(decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with the ids of their pieces; ``text`` is what these decode to, with spaces for escape signs."""
    return pieces.decode(pieces.encode(docs, MODEL), MODEL).select(*docs.columns, "tokens")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near-dedup", near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("encoding", encoding),
]

#: Encoding has no SQL form; the pipeline is tested against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; what a stage returns is written before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
