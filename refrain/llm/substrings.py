"""Removal of repeated byte strings by refining buckets of text positions.

A position stands for the string of ``LENGTH`` bytes that starts there. As in bucket-pointer refinement, positions begin
in buckets by a q-gram, a bucket is split by the identifiers of longer strings at later offsets, only buckets with
two members or more are refined further, and each level reuses what the level before has settled. Three things
make this fit many machines:

* The first bucket of a position is the q-gram of the least hash inside its string. Positions with the same one form
  runs, some seventy positions long, and a run is one row.
* A bucket's identifier is a hash of the string that its members share, so any task can name it without the others.
* A run whose whole stretch (its positions and the bytes they reach) is found twice is settled at once, and a bucket of
  one is settled as unique. Only runs at the edge of a repeated stretch go on: to nodes of ``NODE`` positions, then to
  single ones, where the identifier is that of the string itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window as W, functions as F

from refrain.llm.common import as_bytes, content_key, map_rows, mixed, to_arrow, with_columns
from refrain.sources.scratch import settle

#: Bytes of a string and of a q-gram, positions of a node of the second level.
LENGTH, Q, NODE = 200, 32, 16
#: Bytes that are hashed at a time, rows that a task combines before it hands them on.
CHUNK, FLUSH = 1 << 18, 1_000_000

_RUN = LENGTH - Q + 1  # positions whose string holds a given q-gram
_BASE = 0x9E3779B97F4A7C15
_PLACE = np.uint64((1 << 24) - 1)

# A row's ``at``: two flags, length of the run less one, distance of the q-gram from its end, first position, and 14
# bits that make the key of the document 78 bits long.
_SURE, _TWICE, _SIZE, _BACK, _FIRST, _CHECK = 1, 2, 2, 10, 18, 49
_ROWS = "deal long, g long, o long, key long, at long"

Runs = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def qgram_hashes(data: bytes) -> np.ndarray:
    """A hash of the ``Q`` bytes from each position on, by doubling."""
    values = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)
    size, factor = 1, _BASE
    while size < Q:
        values = values[:-size] * np.uint64(factor) + values[size:]
        size, factor = 2 * size, factor * factor % (1 << 64)
    return mixed(values)


def least_in_window(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` neighbours."""
    size, out = 1, values
    while 2 * size <= width:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    rest = width - size
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def runs_of(data: bytes, ends: np.ndarray) -> Runs:
    """First and last positions, q-gram places and q-gram hashes of the runs in texts that end at ``ends``."""
    if len(data) < LENGTH:
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64)
    hashes = qgram_hashes(data)
    ranked = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
    place = (least_in_window(ranked, _RUN) & _PLACE).astype(np.int64)
    inside = np.zeros(len(place), bool)
    start = 0
    for end in ends.tolist():
        inside[start : max(start, end - LENGTH + 1)] = True
        start = end
    edge = np.flatnonzero(place[1:] != place[:-1]) + 1
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    first[edge] |= inside[edge]
    last[edge - 1] |= inside[edge - 1]
    lo, hi = np.flatnonzero(first), np.flatnonzero(last)
    return lo, hi, place[lo], hashes[place[lo]]


def stretch_hashes(data: bytes, lo: np.ndarray, hi: np.ndarray, seed: int = 0) -> np.ndarray:
    """Hashes of the bytes from each ``lo`` up to the end of the string at ``hi``."""
    view, digest = memoryview(data), xxhash.xxh3_64_intdigest
    return np.fromiter(
        (digest(view[a : b + LENGTH], seed) for a, b in zip(lo.tolist(), hi.tolist())), np.uint64, len(lo)
    )


def combined(g: np.ndarray, o: np.ndarray, key: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """The columns of ``_ROWS`` for the rows of one task, ready to be dealt.

    Of a bucket ``g`` one row is dealt by ``g`` and speaks for the others, which need no more telling that it has several
    members and are dealt evenly; of a refined bucket (``g``, ``o``) one row keeps its identifiers, and the others, which
    are settled, get some of their own. So no task sends more than one row of a bucket, however large, to one place.
    """
    order = np.lexsort((o, g))
    g, o, key, at = g[order], o[order], key[order], at[order]
    if not len(g):
        return [x.view(np.int64) for x in (g, g, o, key, at)]
    new_g = np.concatenate(([True], g[1:] != g[:-1]))
    new_o = new_g | np.concatenate(([True], o[1:] != o[:-1]))
    of_g, of_o = np.cumsum(new_g) - 1, np.cumsum(new_o) - 1
    several, twice = np.bincount(of_g)[of_g] > 1, np.bincount(of_o)[of_o] > 1
    at = at | np.where(several, np.uint64(_SURE), np.uint64(0)) | np.where(twice, np.uint64(_TWICE), np.uint64(0))
    spread = mixed(key ^ mixed(at + np.uint64(_BASE)))
    deal = np.where(new_g, g, spread)
    return [x.view(np.int64) for x in (deal, np.where(new_o, g, spread), np.where(new_o, o, ~spread), key, at)]


def rows_from(df: DataFrame, produce: Callable[[dict[str, pa.Array]], Iterator[tuple]]) -> DataFrame:
    """Rows (``_ROWS``) that ``produce`` makes from each batch: g, o, key, at; combined within a task, in bounded parts."""
    schema = to_arrow(_ROWS)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                columns = combined(*(np.concatenate(x) for x in zip(*held)))
                for i in range(0, len(columns[0]), 100_000):
                    yield pa.RecordBatch.from_arrays([pa.array(c[i : i + 100_000]) for c in columns], schema=schema)

        for batch in source:
            for part in produce({name: batch.column(i) for i, name in enumerate(batch.schema.names)}):
                held.append(part)
                size += len(part[0])
                if size >= FLUSH:
                    yield from flush()
                    held, size = [], 0
        yield from flush()

    return df.mapInArrow(batches, _ROWS)


def packed(check: np.ndarray, lo: np.ndarray, hi: np.ndarray, back: np.ndarray | int = 0) -> np.ndarray:
    u = np.uint64
    lo, size = lo.astype(u), (hi - lo).astype(u)
    return check << u(_CHECK) | lo << u(_FIRST) | size << u(_SIZE) | np.asarray(back).astype(u) << u(_BACK)


def unpacked(at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First position, last position, place of the q-gram."""
    lo = at >> _FIRST & (1 << (_CHECK - _FIRST)) - 1
    hi = lo + (at >> _SIZE & 0xFF)
    return lo, hi, hi + (at >> _BACK & 0xFF)


def settled(rows: DataFrame, label: str) -> DataFrame:
    """``key``, ``at``, ``g`` of the rows whose bucket has several members; ``repeated`` if their refined bucket has, too,
    and ``first`` for one row of that. Two exchanges, none with a hot key; the result is written."""
    in_bucket = F.count(F.lit(1)).over(W.partitionBy("deal"))
    sure = F.col("at").bitwiseAND(F.lit(_SURE)) > 0
    several = rows.withColumn("n", in_bucket).filter((F.col("n") > 1) | sure).select("g", "o", "key", "at")
    refined = W.partitionBy("g", "o").orderBy("key", "at")
    members = F.sum(1 + F.shiftright(F.col("at"), 1).bitwiseAND(F.lit(1))).over(
        refined.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    )
    found = several.select("key", "at", "g", (members > 1).alias("repeated"), (F.row_number().over(refined) == 1).alias("first"))
    return settle(found, label)


def carried(found: DataFrame) -> DataFrame:
    """Rows for the next level: those that aren't settled, and of each bucket that has any, one of every refined bucket.

    The latter are repeated for sure, but others of their bucket may share a part of them.
    """
    unsettled = found.filter("NOT repeated")
    buckets = unsettled.select("g").distinct()
    witnesses = found.filter("repeated AND first").join(buckets, "g", "left_semi")
    return unsettled.select("key", "at").union(witnesses.select("key", "at")).withColumn("repeated", F.lit(False))


def per_document(found: DataFrame) -> DataFrame:
    """``of``, ``of_check``, ``gone`` (settled as repeated) and ``open`` (for the next level) of each document."""
    check = F.shiftrightunsigned(F.col("at"), _CHECK)
    return found.groupBy(F.col("key").alias("of"), check.alias("of_check")).agg(
        F.collect_list(F.when(F.col("repeated"), F.col("at"))).alias("gone"),
        F.collect_list(F.when(~F.col("repeated"), F.col("at"))).alias("open"),
    )


def repeated(found: DataFrame) -> DataFrame:
    return found.filter("repeated").select("key", "at", "repeated")


def first_level(docs: DataFrame) -> DataFrame:
    """Rows of the runs of all texts (``key``, ``check``, ``text``)."""

    def produce(batch: dict[str, pa.Array]) -> Iterator[tuple]:
        keys = batch["key"].to_numpy(zero_copy_only=False).view(np.uint64)
        checks = batch["check"].to_numpy(zero_copy_only=False).view(np.uint64)
        held: list[tuple[int, int, bytes]] = []
        size = 0

        def parts() -> tuple:
            data = b"".join(x for _, _, x in held)
            ends = np.cumsum([len(x) for _, _, x in held])
            lo, hi, place, g = runs_of(data, ends)
            o = stretch_hashes(data, lo, hi)
            of = np.searchsorted(ends, lo, "right")
            row = np.array([r for r, _, _ in held])[of]
            moved = np.array([start for _, start, _ in held])[of] - np.concatenate(([0], ends))[of]
            return g, o, keys[row], packed(checks[row], lo + moved, hi + moved, place - hi)

        for row, data in enumerate(as_bytes(batch["text"])):
            for start in range(0, max(0, len(data) - LENGTH + 1), CHUNK):  # parts share the bytes that strings reach
                held.append((row, start, data[start : start + CHUNK + LENGTH - 1]))
                size += len(held[-1][2])
                if size >= CHUNK:
                    yield parts()
                    held, size = [], 0
        if held:
            yield parts()

    return rows_from(docs, produce)


def open_documents(batch: dict[str, pa.Array]) -> Iterator[tuple]:
    """Key, check, text and runs to be refined of each document."""
    keys = batch["key"].to_numpy(zero_copy_only=False).view(np.uint64)
    checks = batch["check"].to_numpy(zero_copy_only=False).view(np.uint64)
    expand = zstandard.ZstdDecompressor().decompress
    for i, (packed_text, open_) in enumerate(zip(batch["packed"].to_pylist(), batch["open"])):
        yield keys[i], checks[i], expand(packed_text), unpacked(np.unique(open_.values.to_numpy(zero_copy_only=False)))


def whole(key: np.uint64, n: int) -> np.ndarray:
    return np.full(n, key, np.uint64)


def second_level(docs: DataFrame) -> DataFrame:
    """Rows of the nodes of open runs: ``NODE`` positions by their distance from the run's q-gram.

    The bucket is named by the bytes that the strings of all ``NODE`` distances share, whether or not the run has all.
    """

    def produce(batch: dict[str, pa.Array]) -> Iterator[tuple]:
        for key, check, text, (lo, hi, place) in open_documents(batch):
            low, high = (place - hi) // NODE, (place - lo) // NODE
            counts = high - low + 1
            of = np.repeat(np.arange(len(lo)), counts)
            node = low[of] + np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
            near, far = place[of] - node * NODE, place[of] - node * NODE - (NODE - 1)
            first, last = np.maximum(lo[of], far), np.minimum(hi[of], near)
            view, digest = memoryview(text), xxhash.xxh3_64_intdigest
            g = np.fromiter(
                (digest(view[a : b + LENGTH], n + 1) for a, b, n in zip(near.tolist(), far.tolist(), node.tolist())),
                np.uint64,
                len(of),
            )
            yield g, stretch_hashes(text, first, last), whole(key, len(of)), packed(whole(check, len(of)), first, last)

    return rows_from(docs, produce)


def third_level(docs: DataFrame) -> DataFrame:
    """Rows of the single positions of open nodes, named by their strings."""

    def produce(batch: dict[str, pa.Array]) -> Iterator[tuple]:
        for key, check, text, (lo, hi, _) in open_documents(batch):
            at = np.unique(np.concatenate([np.arange(a, b + 1) for a, b in zip(lo.tolist(), hi.tolist())]))
            names = [stretch_hashes(text, at, at, seed) for seed in (1, 2)]
            yield *names, whole(key, len(at)), packed(whole(check, len(at)), at, at)

    return rows_from(docs, produce)


def merged(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal stretches that the strings of such positions cover."""
    lo, hi, _ = unpacked(at)
    order = np.argsort(lo, kind="stable")
    lo, ends = lo[order], np.maximum.accumulate(hi[order] + LENGTH)
    new = np.concatenate(([True], lo[1:] > ends[:-1])) if len(lo) else np.zeros(0, bool)
    return lo[new], ends[np.concatenate((new[1:], [True]))] if len(lo) else ends


def remove_repeated(docs: DataFrame, text: str = "text", id: str = "doc_id", keep_text: bool = False) -> DataFrame:
    """One row per row of ``docs``: id, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``, and ``kept`` if asked for.

    Every byte of a text (in UTF-8) that is covered by a string of ``LENGTH`` bytes that also starts anywhere else, in any
    text or at another place of the same, is removed. Strings never cross texts and are judged on the texts as given.
    ``kept`` are the bytes left, which need not be UTF-8.

    A null text is empty; shorter texts stay whole. Rows that agree in id and text repeat each other, so both lose
    what is ``LENGTH`` bytes long. Empty tables give no rows. Other columns are ignored, whatever their names.
    """
    key_1, key_2 = content_key(F.col(id), F.col(text))
    chosen = docs.select(
        F.col(id).alias("id"),
        key_1.alias("key"),
        key_2.bitwiseAND(F.lit((1 << 14) - 1)).alias("check"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    runs = settled(first_level(chosen), "runs")
    found = per_document(repeated(runs).union(carried(runs)))
    first = settle(judge(met(pack(chosen), found), keep_text, final=False), "first-level")
    done = first.filter("packed IS NULL").drop("packed", "gone", "open", "key", "check")

    pending = first.filter("packed IS NOT NULL").select("id", "key", "check", "packed", "gone", "open")
    nodes = settled(second_level(pending), "nodes")
    narrow = met(pending.drop("open", "gone"), per_document(carried(nodes)))
    singles = settled(third_level(narrow.filter("open IS NOT NULL")), "positions")
    more = per_document(repeated(nodes).union(repeated(singles)))
    last = met(pending.withColumnRenamed("gone", "before").drop("open"), more)
    rest = judge(last, keep_text, final=True).drop("packed", "gone", "open", "key", "check")
    return done.unionByName(rest).withColumnRenamed("id", id)


def met(texts: DataFrame, found: DataFrame) -> DataFrame:
    """``texts`` with what has been found in them."""
    same = (F.col("key") == F.col("of")) & (F.col("check") == F.col("of_check"))
    return texts.join(found, same, "left").drop("of", "of_check")


def pack(docs: DataFrame) -> DataFrame:
    """Texts compressed, for the exchanges to come."""

    def rows(batch: dict[str, pa.Array]) -> dict[str, object]:
        press = zstandard.ZstdCompressor(level=6).compress
        return batch | {"packed": [press(x) for x in as_bytes(batch["text"])]}

    return map_rows(docs, with_columns(docs.drop("text"), "packed binary"), rows)


def judge(docs: DataFrame, keep_text: bool, final: bool) -> DataFrame:
    """The result of each document in which nothing is open; the others with their texts."""

    def rows(batch: dict[str, pa.Array]) -> dict[str, object]:
        expand = zstandard.ZstdDecompressor().decompress
        names = ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "packed")
        out: dict[str, list] = {n: [] for n in names}
        lists = [batch[c].to_pylist() for c in ("gone", "open")]
        before = batch["before"].to_pylist() if final else [[]] * len(lists[0])
        for data, gone, open_, earlier in zip(batch["packed"].to_pylist(), *lists, before):
            if open_ and not final:
                row = (None, None, None, None, None, data)
            else:
                text = expand(data)
                starts, ends = merged(np.array([*(gone or ()), *(earlier or ())], np.int64))
                cuts = zip([0, *ends.tolist()], [*starts.tolist(), len(text)])
                kept = b"".join(text[a:b] for a, b in cuts)
                digest = hashlib.sha256(kept).hexdigest()
                row = (len(text), len(text) - len(kept), len(starts), digest, kept if keep_text else None, None)
            for name, value in zip(names, row):
                out[name].append(value)
        return batch | out

    kept = ", kept binary" if keep_text else ""
    own = docs.select("id", "key", "check", "packed", "gone", "open")
    return map_rows(docs, with_columns(own, f"n_bytes long, n_removed long, n_spans long, kept_sha256 string{kept}"), rows)
