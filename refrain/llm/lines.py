"""Line dedup: repeated windows of three lines are found over all documents, later occurrences are removed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from refrain.llm.common import content_key
from refrain.sources.scratch import settle

#: Lines of a window.
WINDOW = 3


def windows(docs: DataFrame, text: str, id: str) -> DataFrame:
    """One row per window: ``key_1``, ``key_2``, ``id``, the numbers of its lines in ``places``, its hash in ``hash_1``, ``hash_2``."""
    parts = docs.filter(F.col(text).isNotNull()).select(
        *content_key(F.col(id), F.col(text)),
        F.col(id).alias("id"),
        F.filter(
            F.transform(F.split(text, "\n"), lambda line, i: F.struct(i.alias("place"), line.alias("line"))),
            lambda x: x["line"].rlike(r"[^\x20\x09-\x0D]"),
        ).alias("full"),
    )
    hashed = parts.select(
        "key_1",
        "key_2",
        "id",
        F.col("full.place").alias("place"),
        F.transform("full", lambda x: F.xxhash64(F.lit(1), x["line"])).alias("one"),
        F.transform("full", lambda x: F.xxhash64(F.lit(2), x["line"])).alias("two"),
    )

    def shifted(name: str, by: int) -> Column:
        return F.slice(name, F.lit(1 + by), F.greatest(F.size("place") - (WINDOW - 1), F.lit(0)))

    zipped = F.arrays_zip(
        *(shifted(name, by).alias(f"{name}_{by}") for name in ("place", "one", "two") for by in range(WINDOW))
    )
    rows = hashed.select("key_1", "key_2", "id", F.explode(zipped).alias("w"))
    return rows.select(
        "key_1",
        "key_2",
        "id",
        F.array(*(F.col(f"w.place_{by}") for by in range(WINDOW))).alias("places"),
        F.xxhash64(*(F.col(f"w.one_{by}") for by in range(WINDOW))).alias("hash_1"),
        F.xxhash64(*(F.col(f"w.two_{by}") for by in range(WINDOW))).alias("hash_2"),
    )


def covered_lines(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """``key_1``, ``key_2``, ``gone``: the numbers of the lines that later occurrences of windows cover.

    One aggregate finds the first occurrence of each repeated window (partial sums leave a task at most one row for
    a window, however common). The occurrences then meet that small written table in a join that Spark can split.
    """
    found = windows(docs, text, id)
    place = F.struct(F.col("id"), F.col("key_1"), F.col("key_2"), F.get("places", F.lit(0)).alias("place"))
    repeated = found.groupBy("hash_1", "hash_2").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first"))
    repeated = settle(repeated.filter("n > 1").select("hash_1", "hash_2", "first"), "repeated-windows")
    later = found.join(repeated, ["hash_1", "hash_2"]).filter(~place.eqNullSafe(F.col("first")))
    return later.groupBy("key_1", "key_2").agg(F.array_distinct(F.flatten(F.collect_set("places"))).alias("gone"))


def drop_repeated(docs: DataFrame, text: str = "text", id: str = "doc_id", counts: tuple[str, str] | None = None) -> DataFrame:
    """``docs`` without the lines of later occurrences; with ``counts``, also the numbers of lines and of removed ones.

    A line is what stands between line feeds. Windows are ``WINDOW`` consecutive lines that aren't blank (a blank
    line has only ASCII white space; it parts no window and is never removed). A window that occurs again, in the
    same document or another, keeps its first occurrence by id (null first), then by place; the lines of all later
    ones are removed, overlapping ones once. What is left is joined by line feeds again.

    Null texts stay null, with no lines; texts of fewer than three full lines stay as they are. Rows that agree in id
    and text are one document and get the same result. Empty tables give no rows. Other columns are passed on; those
    named like ``counts`` are replaced.
    """
    columns = [c for c in docs.columns if c not in (counts or ())]
    gone = covered_lines(docs, text, id).toDF("of_1", "of_2", "gone")
    rows = docs.select(F.struct(*columns).alias("row"), F.col(text).alias("text"), *content_key(F.col(id), F.col(text)))
    met = rows.join(gone, (F.col("key_1") == F.col("of_1")) & (F.col("key_2") == F.col("of_2")), "left")
    split = met.withColumn("lines", F.split("text", "\n"))
    numbers = F.sequence(F.lit(0), F.size("lines") - 1)
    kept = F.array_join(F.transform(F.array_except(numbers, "gone"), lambda i: F.get("lines", i)), "\n")
    result = F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept)
    chosen = [result.alias(c) if c == text else F.col("row").getField(c).alias(c) for c in columns]
    if counts:
        n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size("lines"))
        n_gone = F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone"))
        chosen += [n_lines.cast("long").alias(counts[0]), n_gone.cast("long").alias(counts[1])]
    return split.select(*chosen)
