"""Cleaning, keying, de-duplication and lookups on whole tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from refrain.functions.text import clean_name, has_clean_name, name_key, tagged_id


def remove_noise(df: DataFrame, column: str) -> DataFrame:
    """Clean a name column and keep its input as ``original_<column>``; rows left without a name go."""
    kept = [F.col(c).alias(f"original_{column}" if c == column else c) for c in df.columns]
    named = df.where(has_clean_name(F.col(column)))
    return named.select(*kept, clean_name(F.col(column)).alias(column))


def add_name_key(df: DataFrame, source: str, id_column: str = "track_id", name: str = "song_title") -> DataFrame:
    """Mark the ids with their catalogue and add the blocking key ``name_key_1``."""
    return df.withColumns(
        {id_column: tagged_id(F.col(id_column), source), "name_key_1": name_key(F.col(name))}
    )


def as_strings(df: DataFrame) -> DataFrame:
    return df.select([F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def union_sides(sides: dict[str, DataFrame], label: str = "side") -> DataFrame:
    """All rows of several frames, by column name, with the name of the frame they come from."""
    (first_name, result), *others = sides.items()
    result = result.withColumn(label, F.lit(first_name))
    for name, df in others:
        result = result.unionByName(df.withColumn(label, F.lit(name)))
    return result


def _carry(df: DataFrame, keys: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in df.columns if c not in keys])


def _grouped(df: DataFrame, keys: Sequence[str]):
    """``df`` grouped by ``keys`` behind a digest of them: rows are sorted and dealt by one number, and the keys themselves,
    which may be long texts, are compared only where digests are equal. So a collision merges nothing."""
    named = [F.col(f"`{k}`") for k in keys]
    return df.withColumn("__digest", F.xxhash64(*named)).groupBy("__digest", *named)


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key under ``order``, whose last column must make it unique.

    An aggregate, so every task reduces its rows to one per key before the shuffle, however many rows a key has.
    Spark sorts the rows of a task by key for it, as the rows it keeps are no fixed-width values; see ``_grouped``.
    """
    first = F.min_by(_carry(df, keys), F.struct(*order)).alias("row")
    return _grouped(df, keys).agg(first).select(*keys, "row.*")


def first_k_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows of each key; Spark keeps only ``k`` per key and task before the shuffle."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)


def distinct_names(df: DataFrame, keys: Sequence[str], id_column: str) -> DataFrame:
    """One row per combination of ``keys``: the one with the smallest id."""
    return one_per_key(df, keys, [F.col(id_column)])


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key under ``order``."""
    last = F.max_by(_carry(df, keys), F.struct(*[F.col(c) for c in order])).alias("row")
    return _grouped(df, keys).agg(last).select(*keys, "row.*")


def best_match(pairs: DataFrame, left_id: str, right_id: str, score: str, digits: int = 9) -> DataFrame:
    """The best right member of each left one; scores equal to ``digits`` places go to the smallest right id.

    A NULL or NaN score comes after all others, so it is chosen only where a left member has no better one.
    """
    value = F.col(score).cast("double")
    missing = value.isNull() | F.isnan(value)
    return one_per_key(pairs, [left_id], [missing, -F.round(value, digits), F.col(right_id)])


def smallest(df: DataFrame, value: str, id_column: str, k: int) -> DataFrame:
    """The ``k`` rows with the smallest value, NaN after all numbers and NULL last."""
    return df.orderBy(F.col(value).asc_nulls_last(), F.col(id_column)).limit(k)


def block_pair_counts(left: DataFrame, right: DataFrame, block: str) -> DataFrame:
    """Number of candidate pairs in each block both sides have, without forming any pair."""
    n_left = left.groupBy(block).agg(F.count(F.lit(1)).alias("left_rows"))
    n_right = right.groupBy(block).agg(F.count(F.lit(1)).alias("right_rows"))
    return n_left.join(n_right, block).withColumn("pairs", F.col("left_rows") * F.col("right_rows"))
