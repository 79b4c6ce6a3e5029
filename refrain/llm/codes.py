"""Vector codes: each of several parts of a vector is named by its nearest codebook entry.

The codebooks come from Lloyd rounds over resident members. After the first assignment the parts of all vectors lie
with their owners, the key (position, entry, salt); a position's or entry's share of the data doesn't matter, as salts
cut it into bounded parcels. In each round an owner finds the nearest entries of its members under the new codebook.
Those that keep their entry stay where they are; only those that change it go through the shuffle to their new owner.
Owners then add up what they hold, and the sums alone, one row per entry and component, make the next codebook.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from refrain.llm.common import to_arrow
from refrain.llm.integers import floored, is_usable, matrix, products
from refrain.sources.scratch import settle

#: Parts of a vector, entries of a codebook (256 at most, two hex digits), and Lloyd rounds.
PARTS, ENTRIES, ROUNDS = 16, 64, 2
#: Members of one position and entry that a salt stands for, if all vectors have that entry; and the fewest salts.
OWNED, LEAST_SALTS = 1 << 20, 4

_OWNED = "position int, entry int, salt int, members long, parts binary"


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry, the lower one of equals, and the squared distance to it, of every row."""
    square = (book * book).sum(axis=1)
    rough = square[None, :] - 2 * products(parts, book.T)
    codes = rough.argmin(axis=1)
    return codes, rough[np.arange(len(parts)), codes] + (parts * parts).sum(axis=1)


def packed(parts: np.ndarray) -> bytes:
    """Small components take two bytes each, others four."""
    return parts.astype(np.int16 if np.abs(parts).max(initial=0) < 1 << 15 else np.int32).tobytes()


def unpacked(data: bytes, members: int, width: int) -> np.ndarray:
    kind = np.int16 if len(data) == 2 * members * width else np.int32
    return np.frombuffer(data, kind).astype(np.int64).reshape(members, width)


def parcels(position: int, codes: np.ndarray, parts: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    """``entry``, number and bytes of the members of each entry."""
    order = np.argsort(codes, kind="stable")
    cuts = np.flatnonzero(np.diff(codes[order])) + 1
    for mine in np.split(order, cuts) if len(order) else ():
        yield int(codes[mine[0]]), len(mine), packed(parts[mine])


def batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def salt_of(salts: int, *key: int) -> int:
    return xxhash.xxh3_64_intdigest(repr(key)) % salts


def deal(vectors: DataFrame, books: np.ndarray, salts: int) -> DataFrame:
    """The first assignment: all parts, a row for each entry that a batch has members of."""
    sent = vectors.sparkSession.sparkContext.broadcast(books)
    schema = to_arrow(_OWNED)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books, task = sent.value, TaskContext.get().partitionId()
        for number, batch in enumerate(source):
            if not batch.num_rows:
                continue
            rows = []
            whole = matrix(batch.column("v")).reshape(batch.num_rows, len(books), -1)
            for position, book in enumerate(books):
                own = np.ascontiguousarray(whole[:, position])
                for entry, n, data in parcels(position, nearest(own, book)[0], own):
                    rows.append((position, entry, salt_of(salts, task, number, position, entry), n, data))
            yield batch_of(rows, schema)

    return vectors.select("v").mapInArrow(batches, _OWNED)


def reassigned(residents: DataFrame, books: np.ndarray) -> DataFrame:
    """The rows of all owners under new codebooks; ``moved`` where the members have another entry than before."""
    sent = residents.sparkSession.sparkContext.broadcast(books)
    ddl = f"{_OWNED}, moved boolean"
    schema = to_arrow(ddl)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = sent.value
        for batch in source:
            rows = []
            for position, entry, salt, n, data in zip(*(batch.column(c).to_pylist() for c in batch.schema.names)):
                own = unpacked(data, n, books.shape[2])
                for new, count, part in parcels(position, nearest(own, books[position])[0], own):
                    rows.append((position, new, salt, count, part, new != entry))
            yield batch_of(rows, schema)

    return residents.mapInArrow(batches, ddl)


def updated(residents: DataFrame, books: np.ndarray) -> np.ndarray:
    """Each entry as the floored mean of its members, added up by their owners; entries without members stay."""
    width = books.shape[2]
    ddl = "position int, entry int, component int, members long, total long"
    schema = to_arrow(ddl)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            rows = []
            for position, entry, n, data in zip(*(batch.column(c).to_pylist() for c in ("position", "entry", "members", "parts"))):
                totals = unpacked(data, n, width).sum(axis=0)
                rows += [(position, entry, i, n, int(x)) for i, x in enumerate(totals)]
            yield batch_of(rows, schema)

    sums = residents.drop("salt").mapInArrow(batches, ddl).groupBy("position", "entry", "component")
    new = books.copy()
    for row in sums.agg(F.sum("members").alias("n"), F.sum("total").alias("total")).collect():
        new[row["position"], row["entry"], row["component"]] = row["total"] // row["n"]
    return new


def train(
    vectors: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> np.ndarray:
    """The codebooks of all usable vectors, as integers by part, entry and component.

    Vectors without components or with one that is null, NaN or infinite are left out; the others must have one length
    that ``parts`` divides. A codebook begins with the parts of the vectors of the ``entries`` smallest ids (nulls last,
    then by vector; repeated rows count one by one), all if there are fewer, and is empty if there is none. Equal
    distances go to the lower entry, entries without members stay. ``rounds`` jobs run and write their members when
    this is called; the driver gets one number per part, entry and component.
    """
    kept = vectors.filter(is_usable(vector) & (F.size(vector) > 0)).select(F.col(id).alias("id"), floored(vector).alias("v"))
    size = kept.agg(F.count(F.lit(1)).alias("n"), F.min(F.size("v")).alias("low"), F.max(F.size("v")).alias("high")).first()
    if not size["n"]:
        return np.zeros((parts, 0, 0), np.int64)
    if size["low"] != size["high"] or size["low"] % parts:
        raise ValueError(f"vectors have {size['low']} to {size['high']} components; {parts} parts need one length they divide")
    first = kept.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect()
    books = np.array([row["v"] for row in first], np.int64).reshape(len(first), parts, -1).transpose(1, 0, 2).copy()
    salts = max(LEAST_SALTS, -(-size["n"] // OWNED))
    owner = ["position", "entry", "salt"]
    residents = None
    for _ in range(rounds):
        if residents is None:
            residents = settle(deal(kept, books, salts).repartition(*owner), "residents")
        else:
            found = settle(reassigned(residents, books), "reassigned")
            arrived = settle(found.filter("moved").drop("moved").repartition(*owner), "arrived")
            residents = found.filter("NOT moved").drop("moved").unionByName(arrived)
        books = updated(residents, books)
    return books


def digest(books: np.ndarray) -> str:
    """Of all integers in order, in decimal and joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def encode(
    vectors: DataFrame, books: np.ndarray, id: str = "vec_id", vector: str = "embedding", label: str | None = None
) -> DataFrame:
    """``id``, ``label``, ``code`` (two hex digits per part) and ``error`` (squared distance) of every usable vector.

    Unusable vectors, as ``train`` has it, give no row; repeated rows give one each. Other columns are ignored, whatever
    their names. Nothing is shuffled; the codebooks, whose size is a parameter, go to all tasks.
    """
    chosen = vectors.filter(is_usable(vector) & (F.size(vector) > 0))
    labels = [F.col(label).alias("label")] if label else []
    chosen = chosen.select(F.col(id).alias("id"), *labels, floored(vector).alias("v"))
    sent = vectors.sparkSession.sparkContext.broadcast(books)
    columns = chosen.columns[:-1]
    fields = [f"{c} {chosen.schema[c].dataType.simpleString()}" for c in columns]
    ddl = ", ".join([*fields, "code string", "error long"])
    schema = to_arrow(ddl)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = sent.value
        for batch in source:
            if not batch.num_rows:
                continue
            whole = matrix(batch.column("v")).reshape(batch.num_rows, len(books), -1)
            codes, error = np.zeros((len(whole), len(books)), np.uint8), np.zeros(len(whole), np.int64)
            for p, book in enumerate(books):
                codes[:, p], far = nearest(np.ascontiguousarray(whole[:, p]), book)
                error += far
            named = pa.array([c.tobytes().hex() for c in codes], pa.string())
            out = [*(batch.column(c).cast(f.type) for c, f in zip(columns, schema)), named, pa.array(error)]
            yield pa.RecordBatch.from_arrays(out, schema=schema)

    return chosen.mapInArrow(batches, ddl).withColumnRenamed("id", id)


def vector_codes(
    vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label", **options
) -> DataFrame:
    """``id``, ``code``, ``error``, ``label_error`` (of all vectors with that label, null being one) and ``codebooks_sha256``.

    One row per usable row, under codebooks trained on all of them; see ``train`` and ``encode``. The sums by label are
    written first, so that Spark sees whether they are small enough to broadcast.
    """
    books = train(vectors, id, vector, **options)
    coded = settle(encode(vectors, books, id, vector, label), "coded")
    by_label = settle(coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "label-errors")
    met = coded.join(by_label, coded["label"].eqNullSafe(by_label["of"]))
    return met.select(id, "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
