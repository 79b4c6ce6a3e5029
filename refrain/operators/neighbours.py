"""Nearest vectors by squared Euclidean distance within a group."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from refrain.functions.vectors import squared_l2, squared_l2_to
from refrain.operators import cells
from refrain.operators.relational import first_k_per_key, smallest
from refrain.sources.scratch import settle

TILE_ITEMS = 4096
TILE_QUERIES = 8192
TILES_PER_SIDE = 64
TILE_GROWTH = 16


def nearest_to_point(
    vectors: DataFrame, point: Sequence[float], id_column: str, vector: str, k: int = 5, group: tuple | None = None
) -> DataFrame:
    """The ``k`` vectors nearest to one point, optionally within one group ``(column, value)``."""
    if group is not None:
        column, value = group
        vectors = vectors.where(F.col(column) == F.lit(value))
    scored = vectors.select(id_column, squared_l2_to(F.col(vector), point).alias("distance"))
    return smallest(scored, "distance", id_column, k)


def nearest_to_one_per_group(
    vectors: DataFrame, queries: DataFrame, group: str, id_column: str, vector: str, query_vector: str, k: int = 5
) -> DataFrame:
    """The ``k`` vectors of each group nearest to the one query vector of that group; a second one is refused.

    The queries are written first: with their size known, few of them are broadcast and the vectors stay put.
    """
    queries = settle(queries, "queries")
    if not queries.groupBy(group).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        raise ValueError("a group has several queries; use nearest")
    scored = vectors.join(queries, group).select(
        group, id_column, squared_l2(F.col(vector), F.col(query_vector)).alias("distance")
    )
    return first_k_per_key(scored, [group], [F.col("distance").asc_nulls_last(), F.col(id_column)], k)


def nearest(
    queries: DataFrame,
    items: DataFrame,
    group: str,
    query_id: str,
    item_id: str,
    vector: str,
    k: int = 1,
    spans: Sequence[tuple[int, int]] | None = None,
    quantum: float | None = None,
    tile_items: int = TILE_ITEMS,
    tile_queries: int = TILE_QUERIES,
    prune: bool = False,
    clean: bool = False,
    **index,
) -> DataFrame:
    """Exactly the ``k`` nearest items of each query's group: ``(group, query_id, item_id, distance, parts)``.

    ``parts`` holds the squared distance within each span of the vector, ``distance`` their sum. Equal distances go
    to the smallest item id, with ``quantum`` also those that are equal after rounding to it; items with NaN come
    last. A query is known by its group and id, so an id may recur in other groups. Queries whose group has no item
    give no row.

    No pair becomes a row. Queries and items meet in tiles of bounded size, in which one matrix product
    scores all pairs and only the ``k`` best per query leave. With ``prune`` items are stored in an index of cells, and
    only cells whose box a neighbour can lie in are scored; see ``refrain.operators.cells``, whose ``search`` takes the
    options in ``index``. That changes the work and never the result.

    ``clean`` states that no two items of a group have the same vector and that no vector has NaN. The layout of the
    tiles, and with ``prune`` the first scan, run and are written when this is called.
    """
    queries = queries.select(F.col(group).alias("g"), F.col(query_id).alias("query"), _doubles(vector))
    items = items.select(F.col(group).alias("g"), F.col(item_id).alias("item"), _doubles(vector))
    undefined = None
    if not clean:
        items = settle(_without_surplus_copies(items, k), "items")
        undefined = _undefined_pairs(queries, items, k)
        queries, items = queries.where(~_has_nan()), items.where(~_has_nan())

    if prune:
        if clean:
            items = settle(items, "items")
        found = cells.search(queries, items, k, spans, quantum, tile_queries, **index)
    else:
        found = _scan(queries, items, k, spans, quantum, tile_items, tile_queries)
    best = _best(found if undefined is None else found.unionByName(undefined), k)
    return best.select(
        F.col("g").alias(group), F.col("query").alias(query_id), F.col("item").alias(item_id), "distance", "parts"
    )


def _doubles(vector: str):
    return F.col(vector).cast("array<double>").alias("v")


def _has_nan():
    return F.exists("v", lambda x: F.isnan(x) | x.isNull()) | F.col("v").isNull()


def _without_surplus_copies(items: DataFrame, k: int) -> DataFrame:
    """Of identical vectors only the ``k`` smallest ids can be among the ``k`` nearest."""
    marked = items.withColumn("digest", F.xxhash64("v"))
    return first_k_per_key(marked, ["g", "digest", "v"], [F.col("item")], k, rank="copy").drop("copy", "digest")


def _undefined_pairs(queries: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """The pairs with NaN as distance that can still be among the ``k`` first of a query."""
    broken = first_k_per_key(items.where(_has_nan()), ["g"], [F.col("item")], k, rank="n").select("g", "item")
    anything = first_k_per_key(items, ["g"], [F.col("item")], k, rank="n").select("g", "item")
    pairs = queries.where(~_has_nan()).join(broken, "g").unionByName(queries.where(_has_nan()).join(anything, "g"))
    last = F.lit(float("inf")).alias("rank")
    nan = F.lit(float("nan"))
    return pairs.select("g", "query", "item", nan.alias("distance"), F.array(nan).alias("parts"), last)


def _best(found: DataFrame, k: int) -> DataFrame:
    if k == 1:
        first = F.min(F.struct("rank", "item", "distance", "parts")).alias("best")
        return found.groupBy("g", "query").agg(first).select("g", "query", "best.item", "best.distance", "best.parts")
    return first_k_per_key(found, ["g", "query"], [F.col("rank"), F.col("item")], k, rank="place")


def _scan(
    queries: DataFrame, items: DataFrame, k: int, spans, quantum: float | None, tile_items: int, tile_queries: int
) -> DataFrame:
    """Score ``queries (g, query, v)`` against ``items (g, item, v)``; the ``k`` best per query and tile.

    Both sides of a group are cut by hash into as many parts as their counts call for, so a group
    that holds much of the data becomes many tiles of bounded size. A row is sent once per part of the other
    side, so large groups get larger tiles, up to ``TILE_GROWTH`` times the usual size.
    """

    def parts(size: int):
        rows = F.count(F.lit(1))
        return F.ceil(rows / F.least(F.greatest(rows / TILES_PER_SIDE, F.lit(size)), F.lit(size * TILE_GROWTH)))

    asked = queries.groupBy("g").agg(parts(tile_queries).alias("query_parts"))
    held = items.groupBy("g").agg(parts(tile_items).alias("item_parts"))
    # Written first, so that its size is known and a small layout is broadcast instead of shuffling vectors for it.
    layout = settle(asked.join(held, "g"), "layout")
    key = ["g", "query_part", "item_part"]

    def part(of: str, count: str):
        return F.pmod(F.xxhash64(of), F.col(count))

    def every(count: str):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1))

    left = queries.join(layout, "g").select(
        "g", part("query", "query_parts").alias("query_part"), every("item_parts").alias("item_part"), "query", "v"
    )
    right = items.join(layout, "g").select(
        "g", every("query_parts").alias("query_part"), part("item", "item_parts").alias("item_part"), "item", "v"
    )
    typed = (("g", queries), ("query", queries), ("item", items))
    id_types = [f"{c} {df.schema[c].dataType.simpleString()}" for c, df in typed]
    schema = ", ".join([*id_types, "distance double", "parts array<double>", "rank double"])
    return (
        left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_tile_scorer(k, spans, quantum), schema)
    )


def _tile_scorer(k: int, spans, quantum: float | None):
    def score(left, right):
        def matrix(table):
            column = table.column("v").combine_chunks()
            return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)

        types = [(c, left.schema.field(c).type) for c in ("g", "query")] + [("item", right.schema.field("item").type)]
        results = [("distance", pa.float64()), ("parts", pa.list_(pa.float64())), ("rank", pa.float64())]
        schema = pa.schema([*types, *results])
        if left.num_rows == 0 or right.num_rows == 0:
            return schema.empty_table()
        right = right.sort_by("item")
        q, c = matrix(left), matrix(right)
        cuts = spans or [(0, c.shape[1])]
        # One product gives |c|^2 - 2 q.c, which ranks the items of a query as their distance does.
        c_square = np.einsum("ij,ij->i", c, c)
        q_square = np.einsum("ij,ij->i", q, q)
        against = np.hstack([c, c_square[:, None]]).T.copy()
        asked = np.hstack([-2.0 * q, np.ones((len(q), 1))])
        # That form loses digits: shortlist with room for it, then subtract directly.
        room = 1e-12 * (q_square + c_square.max()) + 2.0 * (quantum or 0.0)
        last = min(k, len(c)) - 1
        rows, columns, within, ranks = [], [], [], []
        step = max(8, (1 << 18) // len(c))  # a block of scores stays in the cache
        for start in range(0, len(q), step):
            block = q[start : start + step]
            rough = asked[start : start + step] @ against
            kth = rough.min(axis=1) if last == 0 else np.partition(rough, last, axis=1)[:, last]
            i, j = np.nonzero(rough <= (kth + room[start : start + step])[:, None])
            parts = np.empty((len(i), len(cuts)))
            for some in range(0, len(i), 1 << 16):
                s = slice(some, some + (1 << 16))
                gap = block[i[s]] - c[j[s]]
                for n, (a, b) in enumerate(cuts):
                    parts[s, n] = np.einsum("ij,ij->i", gap[:, a:b], gap[:, a:b])
            rank = parts.sum(axis=1)
            if quantum:
                rank = np.rint(rank / quantum)
            order = np.lexsort((j, rank, i))
            i, j, parts, rank = i[order], j[order], parts[order], rank[order]
            place = np.arange(len(i)) - np.searchsorted(i, i, side="left")
            kept = place < k
            rows.append(i[kept] + start)
            columns.append(j[kept])
            within.append(parts[kept])
            ranks.append(rank[kept])
        parts = np.concatenate(within)
        offsets = pa.array(np.arange(0, parts.size + 1, len(cuts), dtype=np.int32))
        return pa.table(
            [
                left.column("g").take(pa.array(np.concatenate(rows))),
                left.column("query").take(pa.array(np.concatenate(rows))),
                right.column("item").take(pa.array(np.concatenate(columns))),
                pa.array(parts.sum(axis=1)),
                pa.ListArray.from_arrays(offsets, pa.array(parts.ravel())),
                pa.array(np.concatenate(ranks)),
            ],
            schema=schema,
        )

    return score
