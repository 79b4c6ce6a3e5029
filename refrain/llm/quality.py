"""Quality rules: counts within each text, and lines that too many documents of a host share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from refrain.llm.common import as_bytes, content_key, map_rows, shingle_hashes, with_columns, word_hashes
from refrain.sources.scratch import settle

#: A line is above the limits if it is in more distinct documents of its host than this,
LEAST_DOCUMENTS = 20
#: and in more than this share of its host's documents.
LEAST_SHARE = 0.002
#: A document of which at least this share of the words stands in lines that so many texts share is a copy with changes,
#: or nothing but blocks. Such documents are distinct only if they begin with different shared lines; all others are
#: distinct if their texts differ. So lines that are common because one document has copies stay (near-duplicate removal
#: deals with those), whereas footers, menus and licences on different pages go.
COPY_SHARE = 0.8
#: A document is depleted if less than this share of its words is left without such lines.
LEAST_LEFT = 0.3

#: Characters that count as symbols.
SYMBOLS = b"#*$%&|<>"
_SPACE = (9, 10, 11, 12, 13, 32)
_IN_WORDS = np.array([b not in _SPACE and not 0x80 <= b < 0xC0 for b in range(256)])  # one byte of each code point
_IS_SYMBOL = np.array([b in SYMBOLS for b in range(256)])

_MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "lines array<long>, line_words array<long>"
)


def line_hash(line: bytes) -> int:
    """Of a line without regard to case in A-Z and to the amount of white space."""
    return xxhash.xxh3_64_intdigest(b" ".join(line.lower().split())) - (1 << 63)


def repeated_words(words: np.ndarray, width: int = 3) -> int:
    """Number of words inside windows of ``width`` words that occur twice or more, the first ones included."""
    if len(words) <= width:
        return 0
    windows = shingle_hashes(words, width)
    ordered = np.sort(windows)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    mask = np.zeros(len(words), bool)
    found = np.isin(windows, np.unique(twice))
    for i in range(width):
        mask[i : len(words) - width + 1 + i] |= found
    return int(mask.sum())


def measures(data: bytes) -> tuple:
    """The values of ``_MEASURES`` for one text."""
    words = word_hashes(data)
    bytes_of = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    seen: dict[bytes, None] = {}
    repeated = 0
    order, hashes = [], []
    for line in data.split(b"\n"):
        if line.strip():
            order.append(line)
            hashes.append(line_hash(line))
            repeated += line in seen
            seen[line] = None
    counts: dict[int, int] = {}
    for line, value in zip(order, hashes):
        counts[value] = counts.get(value, 0) + len(line.split())
    return (
        len(words), int(bytes_of[_IN_WORDS].sum()), int(bytes_of[_IS_SYMBOL].sum()), repeated, repeated_words(words),
        list(counts), list(counts.values()),
    )


def measure(docs: DataFrame, text: str, host: str, identity: list[Column]) -> DataFrame:
    """``identity``, host, a digest of the text and the values of ``_MEASURES``, for every row."""
    chosen = docs.select(
        *identity,
        F.col(host).cast("string").alias("host"),
        F.xxhash64(F.lit(3), text).alias("text_1"),
        F.xxhash64(F.lit(4), text).alias("text_2"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    kept = [c for c in chosen.columns if c != "text"]
    names = [x.split()[0] for x in _MEASURES.split(", ")]

    def rows(batch: dict[str, pa.Array]) -> dict[str, object]:
        found = [measures(data) for data in as_bytes(batch["text"])]
        return {c: batch[c] for c in kept} | {n: [f[i] for f in found] for i, n in enumerate(names)}

    return map_rows(chosen, with_columns(chosen.drop("text"), _MEASURES), rows)


def frequent_lines(
    measured: DataFrame,
    least_documents: int = LEAST_DOCUMENTS,
    least_share: float = LEAST_SHARE,
    copy_share: float = COPY_SHARE,
) -> DataFrame:
    """``host``, ``line`` of the lines above the limits.

    Texts are counted first, those that are the same once. Only lines above the limits by that count go on: their documents
    get a signature, and the distinct signatures are counted. Both counts are sums of sums, so neither a host nor a line
    meets in one task with more than a row for each task and signature.
    """
    distinct = measured.groupBy("host", "text_1", "text_2").agg(
        F.first("n_words").alias("n_words"), F.first(F.arrays_zip("lines", "line_words")).alias("own")
    )
    distinct = settle(distinct, "distinct-lines")
    hosts = settle(distinct.groupBy("host").agg(F.count(F.lit(1)).alias("documents")), "hosts")
    spread = distinct.select("host", "text_1", "text_2", "n_words", F.posexplode("own").alias("place", "own"))
    spread = spread.select("host", "text_1", "text_2", "n_words", "place", F.col("own.lines").alias("line"), F.col("own.line_words").alias("words"))

    def above(counted: DataFrame) -> DataFrame:
        many = counted.filter(F.col("n") > least_documents)
        met = many.join(hosts.withColumnRenamed("host", "of"), F.col("host").eqNullSafe(F.col("of")))
        return met.filter(F.col("n") > least_share * F.col("documents")).select("host", "line")

    often = settle(above(spread.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n"))), "often-lines").toDF("of", "often")
    shared = spread.join(often, F.col("host").eqNullSafe(F.col("of")) & (F.col("line") == F.col("often")))
    texts = shared.groupBy("host", "text_1", "text_2", "n_words").agg(
        F.sum("words").alias("shared"), F.sort_array(F.collect_list(F.struct("place", "line"))).alias("lines")
    )
    is_copy = F.col("shared") >= F.lit(copy_share) * F.col("n_words")
    first = F.col("lines")[0]["line"]
    signature = F.when(is_copy, F.struct(first.alias("a"), F.lit(None).cast("long").alias("b"))).otherwise(F.struct(F.col("text_1").alias("a"), F.col("text_2").alias("b")))
    signed = texts.select("host", signature.alias("signature"), F.explode("lines.line").alias("line"))
    kinds = signed.groupBy("host", "line", "signature").agg(F.lit(1).alias("one"))
    return settle(above(kinds.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n"))), "frequent-lines")


def frequent_words(measured: DataFrame, frequent: DataFrame) -> DataFrame:
    """``key_1``, ``key_2``, ``frequent`` (the frequent lines of a row) and their words; rows with any.

    Rows with the same key hold the same lines, so any of them stands for all.
    """
    spread = measured.select(
        "key_1", "key_2", "host", F.explode(F.arrays_zip("lines", "line_words")).alias("pair")
    ).select("key_1", "key_2", "host", F.col("pair.lines").alias("line"), F.col("pair.line_words").alias("words"))
    met = spread.join(frequent, spread["host"].eqNullSafe(frequent["host"]) & (spread["line"] == frequent["line"]))
    return (
        met.groupBy("key_1", "key_2", spread["line"])
        .agg(F.first("words").alias("words"))
        .groupBy("key_1", "key_2")
        .agg(F.sum("words").alias("frequent_words"), F.collect_list("line").alias("frequent"))
    )


def base_failed() -> Column:
    """Too few words, or more than half of them repeated."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def judge(
    docs: DataFrame, text: str = "text", host: str = "source", id: str = "doc_id", least_left: float = LEAST_LEFT, **limits
) -> DataFrame:
    """One row per row of ``docs``: id, the counts, ``frequent_words``, ``frequent`` lines, ``base_failed``, ``kept``.

    Lines are hashed without regard to case and white space and counted once per distinct document of a host (see
    ``COPY_SHARE`` for what is distinct). Lines
    above the limits don't count for a document; one with less than ``least_left`` of its words left is depleted.

    A null text has no words and fails. A null host is a host. Empty tables give no rows; rows that are the same get
    the same verdict, one each. Other columns are ignored, whatever their names. The keys ``key_1`` and ``key_2`` in
    the result are those of ``content_key(id, host, text)``.
    """
    identity = [F.col(id).alias("id"), *content_key(F.col(id), F.col(host), F.col(text))]
    measured = settle(measure(docs, text, host, identity), "measured-texts")
    found = frequent_words(measured, frequent_lines(measured, **limits))
    rows = measured.drop("lines", "line_words", "host", "text_1", "text_2").join(found, ["key_1", "key_2"], "left")
    rows = rows.withColumn("frequent_words", F.coalesce("frequent_words", F.lit(0).cast("long")))
    left = F.col("n_words") - F.col("frequent_words") >= F.lit(least_left) * F.col("n_words")
    return rows.withColumns({"base_failed": base_failed(), "kept": ~base_failed() & left}).withColumnRenamed("id", id)


def apply_rules(docs: DataFrame, text: str = "text", host: str = "source", id: str = "doc_id", **options) -> DataFrame:
    """``docs`` without the rejected rows; in the others lines above the limits are left out.

    Rows without such lines stay as they are. Nulls, empty tables and repeated rows as in ``judge``.
    """
    judged = judge(docs, text, host, id, **options).filter("kept").select("key_1", "key_2", "frequent")
    verdicts = judged.dropDuplicates(["key_1", "key_2"]).toDF("of_1", "of_2", "frequent")
    key = content_key(F.col(id), F.col(host), F.col(text))
    rows_of = docs.select(F.struct("*").alias("row"), F.col(text).alias("text"), *key)
    met = rows_of.join(verdicts, (F.col("key_1") == F.col("of_1")) & (F.col("key_2") == F.col("of_2")))
    met = met.select("row", "text", "frequent")

    def rows(batch: dict[str, pa.Array]) -> dict[str, object]:
        out = []
        for data, frequent in zip(as_bytes(batch["text"]), batch["frequent"].to_pylist()):
            if frequent:
                gone = set(frequent)
                data = b"\n".join(x for x in data.split(b"\n") if not x.strip() or line_hash(x) not in gone)
            out.append(data)
        return batch | {"text": pa.array(out, pa.binary()).cast(pa.string())}

    cleaned = map_rows(met.select("row", "text", "frequent"), met.schema, rows)
    return cleaned.select(*(F.col("text" if c == text else f"row.`{c}`").alias(c) for c in docs.columns))
