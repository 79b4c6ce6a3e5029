"""Term counts and TF-IDF weights, fitted per block."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from refrain.functions.text import ALPHABET, char_counts, tokens
from refrain.sources.scratch import settle

# Bytes of words whose IDF may be sent to all tasks, of one such word, and what a row of them takes besides its strings;
# levels of the logarithm of their df by which the commonest are chosen.
MOST_BYTES, LONGEST, ROW_BYTES = 8 << 20, 1024, 48
LEVELS = 64
SLOTS = len(ALPHABET)


def with_char_counts(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Replace text fields by their character counts, so that no text goes through later shuffles."""
    others = [c for c in df.columns if c not in fields]
    return df.select(*others, *[char_counts(F.col(f)).alias(f) for f in fields])


def _idf(block_rows: Column, rows_with_term: Column) -> Column:
    return F.log((block_rows + 1.0) / (rows_with_term + 1.0))


def char_idf(counts: DataFrame, block: str, fields: Sequence[str]) -> DataFrame:
    """Per block its number of rows and, per field, arrays of document frequency and IDF over ``ALPHABET``.

    Every row has all slots, so each (block, slot) counts the rows of the block. A task sends one row per
    block and slot, however many rows it holds.
    """
    cells = F.arrays_zip(*[F.col(f) for f in fields])
    per_slot = (
        counts.select(block, F.posexplode(cells).alias("slot", "cell"))
        .groupBy(block, "slot")
        .agg(
            F.count(F.lit(1)).alias("block_rows"),
            *[F.count_if(F.col("cell")[f] > 0).alias(f"{f}_df") for f in fields],
        )
    )
    in_order = F.sort_array(F.collect_list(F.struct("slot", *[f"{f}_df" for f in fields])))
    per_block = per_slot.groupBy(block, "block_rows").agg(in_order.alias("slots"))
    columns = [F.col(block), F.col("block_rows")]
    for field in fields:
        found = F.col("slots")[f"{field}_df"]
        columns.append(found.alias(f"{field}_df"))
        columns.append(F.transform(found, lambda n: _idf(F.col("block_rows"), n)).alias(f"{field}_idf"))
    return per_block.select(columns)


def _per_field(fields: Sequence[str], *parts: str) -> Column:
    """One struct per field: its name and, for each suffix, the column ``<field><suffix>``."""
    return F.explode(
        F.array(
            *[
                F.struct(F.lit(f).alias("field"), *[F.col(f + p).alias("part" + p) for p in parts])
                for f in fields
            ]
        )
    )


def term_counts(df: DataFrame, keep: Sequence[str], fields: Sequence[str], mode: str = "char") -> DataFrame:
    """Rows ``(keep, field, term, tf)``; ``keep`` must identify a row."""
    if mode == "char":
        one_field = with_char_counts(df.select(*keep, *fields), fields).select(*keep, _per_field(fields, "").alias("f"))
        return (
            one_field.select(*keep, "f.field", F.posexplode("f.part").alias("slot", "tf"))
            .where(F.col("tf") > 0)
            .select(*keep, "field", F.substring(F.lit(ALPHABET), F.col("slot") + 1, F.lit(1)).alias("term"), F.col("tf").cast("long").alias("tf"))
        )
    one_field = df.select(*keep, _per_field(fields, "").alias("f"))
    return (
        one_field.select(*keep, "f.field", F.explode(tokens(F.col("f.part"), mode)).alias("term"))
        .groupBy(*keep, "field", "term")
        .agg(F.count(F.lit(1)).alias("tf"))
    )


def term_idf(df: DataFrame, block: str, id_column: str, fields: Sequence[str], mode: str = "char") -> DataFrame:
    """Rows ``(block, field, term, df, block_rows, idf)`` for the terms each block has."""
    if mode == "char":
        per_block = char_idf(with_char_counts(df.select(block, *fields), fields), block, fields)
        one_field = per_block.select(block, "block_rows", _per_field(fields, "_df", "_idf").alias("f"))
        slots = one_field.select(
            block, "block_rows", "f.field", "f.part_idf", F.posexplode("f.part_df").alias("slot", "df")
        ).where(F.col("df") > 0)
        return slots.select(
            block,
            "field",
            F.substring(F.lit(ALPHABET), F.col("slot") + 1, F.lit(1)).alias("term"),
            "df",
            "block_rows",
            F.get(F.col("part_idf"), F.col("slot")).alias("idf"),
        )
    return _word_idf(term_counts(df, [block, id_column], fields, mode), _block_sizes(df, block), block)


def _block_sizes(df: DataFrame, block: str) -> DataFrame:
    return settle(df.groupBy(block).agg(F.count(F.lit(1)).alias("block_rows")), "sizes")


def _word_idf(counts: DataFrame, sizes: DataFrame, block: str) -> DataFrame:
    found = counts.groupBy(block, "field", "term").agg(F.count(F.lit(1)).alias("df"))
    return found.join(sizes, block).withColumn("idf", _idf(F.col("block_rows"), F.col("df")))


def term_weights(
    df: DataFrame, block: str, id_column: str, fields: Sequence[str], mode: str = "char", frequent_from: int = 10_000
) -> DataFrame:
    """TF-IDF in long form: rows ``(block, id, field, term, weight)``.

    Counts are written once, as they are needed twice: for the IDF and for the weights; that runs when this is called.
    The IDF of words that a block has in ``frequent_from`` rows or more is sent to all tasks, so that the rows of a
    stop word are never shuffled by it; only rows of rarer words are. What is sent is measured: if such words take more than
    ``MOST_BYTES``, only the commonest are sent, and the others, like any word of over ``LONGEST`` bytes, are shuffled
    with the rarer ones.
    """
    if mode == "char":
        counts = settle(with_char_counts(df.select(block, id_column, *fields), fields), "counts")
        weighted = with_char_weights(counts, settle(char_idf(counts, block, fields), "idf"), block, fields)
        one_field = weighted.select(block, id_column, _per_field(fields, "").alias("f"))
        return (
            one_field.select(block, id_column, "f.field", F.posexplode("f.part").alias("slot", "cell"))
            .where(F.col("cell.tf") > 0)
            .select(
                block,
                id_column,
                "field",
                F.substring(F.lit(ALPHABET), F.col("slot") + 1, F.lit(1)).alias("term"),
                F.col("cell.weight").alias("weight"),
            )
        )
    counts = settle(term_counts(df, [block, id_column], fields, mode), "counts")
    found = _word_idf(counts, _block_sizes(df, block), block).select(block, "field", "term", "df", "idf")
    idf = settle(found, "word-idf")
    sent = _is_sent(idf, block, frequent_from)
    keys = [block, "field", "term"]
    met = counts.join(F.broadcast(idf.where(sent).drop("df")), keys, "left")
    rare = met.where(F.col("idf").isNull()).drop("idf").join(idf.where(~sent).drop("df"), keys)
    columns = [block, id_column, "field", "term", (F.col("tf") * F.col("idf")).alias("weight")]
    return met.where(F.col("idf").isNotNull()).select(*columns).unionByName(rare.select(*columns))


def _is_sent(idf: DataFrame, block: str, frequent_from: int) -> Column:
    """Whether a row of ``idf`` is sent to all tasks: those of ``MOST_BYTES`` at most are, whole levels from the highest df on."""
    size = F.octet_length("term") + F.octet_length("field") + F.coalesce(F.octet_length(F.col(block).cast("string")), F.lit(0)) + ROW_BYTES
    often = (F.col("df") >= frequent_from) & (F.octet_length("term") <= LONGEST)
    level = F.floor(F.log(F.col("df").cast("double")) * LEVELS)
    sizes = idf.where(often).groupBy(level.alias("level")).agg(F.sum(size.cast("long")).alias("bytes")).collect()
    room, lowest = MOST_BYTES, None
    for row in sorted(sizes, key=lambda r: -r["level"]):
        room -= row["bytes"]
        if room < 0:
            break
        lowest = row["level"]
    return F.lit(False) if lowest is None else often & (level >= lowest)


def with_char_weights(counts: DataFrame, idf: DataFrame, block: str, fields: Sequence[str]) -> DataFrame:
    """Replace count arrays by arrays of ``(tf, weight)`` under the IDF of the row's block."""
    others = [c for c in counts.columns if c not in fields]
    joined = counts.join(idf.select(block, *[f"{f}_idf" for f in fields]), block)
    cells = [
        F.zip_with(
            F.col(f),
            F.col(f"{f}_idf"),
            lambda tf, w: F.struct(tf.alias("tf"), (tf * w).alias("weight")),
        ).alias(f)
        for f in fields
    ]
    return joined.select(*others, *cells)


def unit_weights(counts: DataFrame, idf: DataFrame, block: str, fields: Sequence[str]) -> DataFrame:
    """Replace count arrays by weight arrays of length one; arrays without any weight stay all zero."""
    others = [c for c in counts.columns if c not in fields]
    joined = counts.join(idf.select(block, *[f"{f}_idf" for f in fields]), block)
    raw = joined.select(
        *others, *[F.zip_with(F.col(f), F.col(f"{f}_idf"), lambda tf, w: tf * w).alias(f) for f in fields]
    )
    lengths = raw.select(
        *others,
        *fields,
        *[F.sqrt(F.aggregate(F.col(f), F.lit(0.0), lambda t, w: t + w * w)).alias(f"{f}_norm") for f in fields],
    )
    units = []
    for f in fields:
        size = F.col(f"{f}_norm")
        units.append(F.when(size > 0.0, F.transform(F.col(f), lambda w: w / size)).otherwise(F.col(f)).alias(f))
    return lengths.select(*others, *units)
