"""Registry of queries and the helpers they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The driver tables of one scale, read on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(sql: str | None = None):
    """Register a function of ``Tables`` under its name, with its SQL."""

    def register(function):
        name = function.__name__
        QUERIES[name] = lambda spark, folder: function(Tables(spark, folder))
        if sql:
            ORACLES[name] = sql
        return function

    return register


def sql_clean(text: str) -> str:
    """SQL for the cleaned name."""
    span_cut = rf"regexp_replace({text}, '(?s)\(.+\)', '', 'g')"
    return f"lower(regexp_replace({span_cut}, '[^a-zA-Z0-9]', '', 'g'))"


def sql_key(name: str) -> str:
    first = f"substring({name}, 1, 1)"
    return f"CASE WHEN {first} BETWEEN '0' AND '9' THEN 'others' ELSE {first} END"
