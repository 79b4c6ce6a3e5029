"""Helpers that several operators share: Arrow columns as bytes, words and their hashes, keys of rows."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Words whose hash a Python worker remembers.
CACHED_WORDS = 100_000
#: Long texts are cut into pieces of about so many bytes, always between two words.
PIECE_BYTES = 4 << 20
#: Table that lowers A-Z and leaves all other bytes.
LOWER_CASE = bytes(x + 32 if 65 <= x <= 90 else x for x in range(256))


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column, without decoding."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def give_back() -> None:
    """Return memory that isn't in use to the system. Workers outlive their tasks, and what each keeps adds up."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def map_rows(
    df: DataFrame, schema: str | StructType, rows: Callable[[dict[str, pa.Array]], dict[str, object]]
) -> DataFrame:
    """``df`` through ``rows``, which turns the columns of a batch into columns of ``schema``."""
    wanted = to_arrow(schema)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            out = rows({name: batch.column(i) for i, name in enumerate(batch.schema.names)})
            columns = [
                x.cast(f.type) if isinstance(x, pa.Array) else pa.array(x, f.type)
                for f, x in ((f, out[f.name]) for f in wanted)
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=wanted)
            del batch, out, columns
            give_back()

    return df.mapInArrow(batches, schema)


def to_arrow(schema: str | StructType) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(schema) if isinstance(schema, str) else schema)


def with_columns(df: DataFrame, ddl: str) -> StructType:
    """The schema of ``df`` plus the columns in ``ddl``."""
    return StructType([*df.schema.fields, *StructType.fromDDL(ddl).fields])


def pieces(data: bytes) -> Iterator[bytes]:
    """``data`` in parts of bounded size that end at white space; one longer word stays whole."""
    start = 0
    while len(data) - start > PIECE_BYTES:
        end = start + PIECE_BYTES
        cuts = [x for x in (data.find(bytes([c]), end, end + 65536) for c in b" \t\n\v\f\r") if x >= 0]
        if not cuts:
            cuts = [x for x in (data.find(bytes([c]), end) for c in b" \t\n\v\f\r") if x >= 0] or [len(data)]
        yield data[start : min(cuts)]
        start = min(cuts)
    yield data[start:]


class WordHashes(dict):
    """64-bit hashes of words, remembered for the commonest."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = WordHashes()


def word_hashes(data: bytes) -> np.ndarray:
    """Hashes of the words between ASCII white space, in order."""
    parts = []
    for piece in pieces(data):
        words = piece.split()
        parts.append(np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words)))
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def mixed(x: np.ndarray) -> np.ndarray:
    """Well-spread 64-bit values of a one-to-one mapping."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every ``width`` consecutive words; of all words if there are fewer; none of none."""
    if not len(words):
        return words
    width = min(width, len(words))
    out = mixed(words[: len(words) - width + 1])
    for i in range(1, width):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + words[i : len(words) - width + 1 + i])
    return out


def content_key(*columns: Column) -> list[Column]:
    """128 bits that only rows with equal values in ``columns`` share, as ``key_1`` and ``key_2``; nulls count as values."""
    parts = [x for c in columns for x in (c.isNull(), c)]
    return [F.xxhash64(F.lit(1), *parts).alias("key_1"), F.xxhash64(F.lit(2), *parts).alias("key_2")]


def drawn(key: Column) -> Column:
    """A number from 0 to 1 that depends on ``key`` alone, for samples that a repeated task draws again."""
    return F.pmod(F.xxhash64(F.lit("draw"), key), F.lit(1 << 40)) / float(1 << 40)


def stretch(text: Column, key: Column, characters: Column | int) -> Column:
    """``characters`` of a text from a place that depends on ``key`` and its length alone; all of a shorter one."""
    most = F.lit(characters) if isinstance(characters, int) else characters
    places = F.greatest(F.length(text) - most + 1, F.lit(1))
    start = F.pmod(F.xxhash64(F.lit("stretch"), key), places.cast("long")).cast("int")
    return F.substring(text, start + 1, most)
