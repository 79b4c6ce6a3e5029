"""An index of vectors by group, and exact nearest-neighbour search over it.

A group of ``n`` items has about ``sqrt(n) / root`` regions, each around a vector drawn from the group itself, and a region
has cells of a few items, cut by the median of the coordinate that varies most. Every cell and region knows the box it
fills after a rotation, within each span of the vector, to the principal axes of the data, where few coordinates hold most
of a distance. The distance of a query to a box bounds that to all items inside.

Vectors are also compared in short: the coordinates along the axes on which the items of a block vary, and the length of what
is left. Short vectors are never farther apart than the whole ones, and one matrix product of them bounds all pairs of some
queries with some cells, at a fraction of the price of a box for every few items; only pairs within reach are scored in full.

Cells are rows of a stored table with their items packed; regions are rows of a small one. A query first visits the region
with the nearest mean, which gives it a real distance to beat, then in further rounds those whose bound doesn't exceed it. Boxes
overlap, so that the least bound says little about where the nearest items are; the mean does.
Inside a region families of cells are visited in the same way. What is joined are queries and boxes of one group,
then queries and items of one block of regions; no list of pivots or boxes goes to the driver or to all tasks. A query is sent
once per block, however many of its regions it visits, and a block once per as many queries as it has items, so that what is
shuffled grows as queries and items do, up to groups of ``BLOCKS * MOST_ITEMS`` items.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Accumulator
from pyspark.sql import DataFrame, functions as F

from refrain.operators.relational import first_k_per_key
from refrain.sources.scratch import settle

#: Regions of a group of n items: sqrt(n) / ROOT. Items of a cell.
ROOT, CELL = 10.0, 8
#: Cells, next to each other by the cuts, that a query visits together, by their joint box.
FAMILY = 32
#: Share of the variance of some items that may lie outside of the axes that short vectors keep; that of a block that is
#: searched, where an axis more costs less than the pairs which it rules out.
LEFT_OUT, LEFT_OUT_OF_BLOCK = 1e-3, 1e-5
#: Items drawn for each region of a group, and for each group, of which the first by hash become pivots.
DRAWN, DRAWN_MORE = 4, 16
#: Items or queries of one group that a task compares with its regions at a time.
PART = 1 << 13
#: Items from which the rotation is taken; it decides how much work is saved and nothing else.
SAMPLE = 4096
#: Regions that a query visits in each of the first rounds; the last round visits all that are left in reach.
FIRST_VISITS = (1,)
#: Items of a block of regions, at least and at most, and the blocks that a group of a size between has.
BLOCK_ITEMS, MOST_ITEMS, BLOCKS = 1 << 12, 1 << 16, 8
#: Queries that look through a region at a time.
VISITING = 1 << 13
#: Of those, queries that are compared with a family at a time, in the cache.
TOGETHER = 1 << 9
#: Room for rounding, as a share of the squared size of the vectors.
SLACK = 1e-9


def vectors_of(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return whole.flatten().to_numpy(zero_copy_only=False).reshape(len(whole), -1)


def list_array(rows: np.ndarray) -> pa.ListArray:
    width = rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(np.arange(0, rows.size + 1, width, dtype=np.int32)), pa.array(rows.ravel()))


def _place(name: str):
    return F.pmod(F.xxhash64(F.lit(name), "item"), F.lit(1 << 40))


def rotation(items: DataFrame, rows: int, spans) -> np.ndarray:
    """The principal axes within each span, from a sample of at most ``SAMPLE`` items, drawn by hash, as columns."""
    drawn = items.where(_place("axes") < int((1 << 40) * min(1.0, 2.0 * SAMPLE / max(rows, 1))))
    sample = np.array([r["v"] for r in drawn.orderBy(_place("axes"), "item").limit(SAMPLE).select("v").collect()])
    if len(sample) < 2:
        return np.eye(sample.shape[1] if len(sample) else 1)
    axes = np.eye(sample.shape[1])
    for a, b in spans or [(0, sample.shape[1])]:
        spread = np.cov(sample[:, a:b], rowvar=False).reshape(b - a, b - a)
        axes[a:b, a:b] = np.linalg.eigh(spread)[1][:, ::-1]
    return axes


def drawn_pivots(items: DataFrame, sizes: DataFrame) -> DataFrame:
    """``g``, ``region``, ``v``: as many items of each group as it has regions, by hash.

    Only drawn items are put in order; a group of which none is drawn is drawn from again, as a whole.
    """
    several = items.join(sizes.where("regions > 1"), "g")
    order = [_place("pivot"), F.col("item")]

    def firsts(some: DataFrame) -> DataFrame:
        numbered = first_k_per_key(some, ["g"], order, 1 << 30, rank="place").where("place <= regions")
        return numbered.select("g", (F.col("place") - 1).cast("int").alias("region"), "v")

    likely = _place("pivot") < F.lit(float(1 << 40)) * (DRAWN * F.col("regions") + DRAWN_MORE) / F.col("n")
    pivots = settle(firsts(several.where(likely)), "pivots")
    missed = settle(sizes.where("regions > 1").join(pivots.select("g").distinct(), "g", "left_anti").select("g"), "missed")
    if missed.isEmpty():
        return pivots
    return settle(pivots.unionByName(firsts(several.join(missed, "g"))), "pivots")


def _parts(of: DataFrame, key: list[str], size: int) -> DataFrame:
    return of.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias("parts"))


def _dealt(rows: DataFrame, by: str, others: DataFrame, parts: DataFrame, key: list[str]):
    """``rows`` dealt by hash into the parts of their key and ``others`` sent to each part of it, to be co-grouped."""
    left = rows.join(parts, key).withColumn("part", F.pmod(F.xxhash64(by), F.col("parts")).cast("int")).drop("parts")
    right = others.join(parts, key).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    return left.groupBy(*key, "part").cogroup(right.groupBy(*key, "part"))


def _type(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def with_regions(items: DataFrame, sizes: DataFrame) -> DataFrame:
    """``items`` with the ``region`` of the nearest pivot; groups with one region don't move for it."""
    one = items.join(sizes.where("regions = 1").select("g"), "g").withColumn("region", F.lit(0))
    several = items.join(sizes.where("regions > 1").select("g"), "g")

    def assign(rows: pa.Table, pivots: pa.Table) -> pa.Table:
        region = np.zeros(rows.num_rows, np.int32)
        if rows.num_rows and pivots.num_rows:
            v, p, names = vectors_of(rows.column("v")), vectors_of(pivots.column("v")), pivots.column("region").to_numpy()
            square = (p * p).sum(axis=1)
            for start in range(0, len(v), 4096):
                region[start : start + 4096] = names[(square - 2.0 * (v[start : start + 4096] @ p.T)).argmin(axis=1)]
        return rows.select(["g", "item", "v"]).append_column("region", pa.array(region))

    parts = settle(_parts(several, ["g"], PART), "parts")
    ddl = f"g {_type(items, 'g')}, item {_type(items, 'item')}, v array<double>, region int"
    return one.unionByName(_dealt(several, "item", drawn_pivots(items, sizes), parts, ["g"]).applyInArrow(assign, ddl))


def split(points: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """Rows of ``points`` by cells of at most ``size``, halved again and again along the coordinate that varies most."""
    waiting = [np.arange(len(points))]
    while waiting:
        rows = waiting.pop()
        if len(rows) <= size:
            yield rows
            continue
        own = points[rows]
        order = np.argpartition(own[:, own.var(axis=0).argmax()], len(rows) // 2)
        waiting += [rows[order[len(rows) // 2 :]], rows[order[: len(rows) // 2]]]


def build(items: DataFrame, spans=None, root: float = ROOT, cell_items: int = CELL) -> tuple[DataFrame, DataFrame, DataFrame, np.ndarray]:
    """The stored cells, the stored regions, the number of regions of each group and the rotation for ``items`` (``g``, ``item``, ``v``, no NaN).

    Cells: ``g``, ``region``, ``cell``, box ``low`` and ``high``, ``items``, their vectors packed. Regions: ``g``, ``region``, box and
    ``middle``, the mean, all after the rotation.
    """
    count = F.count(F.lit(1))
    sizes = items.groupBy("g").agg(count.alias("n"), F.greatest(F.lit(1), F.ceil(F.sqrt(count) / root)).cast("int").alias("regions"))
    of_block = F.least(F.greatest(F.col("n") / BLOCKS, F.lit(BLOCK_ITEMS)), F.lit(MOST_ITEMS))
    sizes = settle(sizes.withColumn("blocks", F.least(F.ceil(F.col("n") / of_block).cast("int"), "regions")), "sizes")
    axes = rotation(items, sizes.agg(F.sum("n")).first()[0] or 0, spans)
    boxes = "low array<double>, high array<double>"
    ddl = f"g {_type(items, 'g')}, region int, cell int, {boxes}, items array<{_type(items, 'item')}>, v binary, whole struct<{boxes}, middle array<double>>"

    def cut(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("item").combine_chunks()
        v = vectors_of(rows.column("v"))
        turned = v @ axes
        cells = list(split(turned, cell_items))
        low, high = (np.stack([f(turned[c], axis=0) for c in cells]) for f in (np.min, np.max))
        whole = {"low": low.min(axis=0).tolist(), "high": high.max(axis=0).tolist(), "middle": turned.mean(axis=0).tolist()}
        ids = rows.column("item").combine_chunks()
        flat = pa.ListArray.from_arrays(
            pa.array(np.cumsum([0, *map(len, cells)]).astype(np.int32)), ids.take(pa.array(np.concatenate(cells)))
        )
        first = pa.array(np.zeros(len(cells), np.int64))
        return pa.table(
            {
                "g": rows.column("g").take(first),
                "region": rows.column("region").take(first),
                "cell": pa.array(np.arange(len(cells), dtype=np.int32)),
                "low": list_array(low),
                "high": list_array(high),
                "items": flat,
                "v": pa.array([v[c].tobytes() for c in cells], pa.binary()),
                "whole": pa.array([whole, *[None] * (len(cells) - 1)], pa.struct([(name, pa.list_(pa.float64())) for name in whole])),
            }
        )

    cells = settle(with_regions(items, sizes).groupBy("g", "region").applyInArrow(cut, ddl), "cells")
    regions = settle(cells.where("cell = 0").select("g", "region", "whole.low", "whole.high", "whole.middle"), "regions")
    return cells.drop("whole"), regions, sizes, axes


def bounds(turned: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of every box, as a row, to every row of ``turned``, as a column, from below."""
    out = np.empty((len(low), len(turned)), turned.dtype)
    columns = np.ascontiguousarray(turned.T)
    step = max(1, (1 << 15) // max(1, len(low)))  # what is in between stays in the cache
    for start in range(0, len(turned), step):
        total = np.zeros((len(low), len(turned[start : start + step])), turned.dtype)
        gap = np.empty_like(total)
        for q, a, b in zip(columns[:, start : start + step], low.T, high.T):
            np.clip(q[None], a[:, None], b[:, None], out=gap)
            np.subtract(gap, q, out=gap)
            np.multiply(gap, gap, out=gap)
            total += gap
        out[:, start : start + step] = total
    return out


def nearness(points: np.ndarray, middles: np.ndarray) -> np.ndarray:
    """For every row of ``points`` a number that orders ``middles`` as their distances to it do."""
    return (middles * middles).sum(axis=1) - 2.0 * (points @ middles.T)


def shortener(items: np.ndarray, axes: np.ndarray, spans, left_out: float = LEFT_OUT) -> Callable[[np.ndarray], np.ndarray]:
    """A function to short vectors: the coordinates along the ``axes`` on which ``items`` vary most, and the length of the rest
    within each span. By the triangle inequality they are no farther apart than the vectors themselves."""
    middle = items.mean(axis=0)
    spread = ((items - middle) @ axes).var(axis=0)
    order = np.argsort(-spread)
    beyond = spread.sum() - np.cumsum(spread[order])
    most = 1 + int(np.argmax(beyond <= left_out * spread.sum()))
    kept, rest = np.sort(order[:most]), np.ones(len(order), bool)
    rest[kept] = False
    over = [np.arange(a, b)[rest[a:b]] for a, b in spans or [(0, len(order))]]

    def shorten(v: np.ndarray) -> np.ndarray:
        turned = (v - middle) @ axes
        return np.hstack([turned[:, kept], *[np.sqrt(np.einsum("ij,ij->i", w, w))[:, None] for w in (turned[:, o] for o in over)]])

    return shorten


def _reach(beat: np.ndarray, q: np.ndarray, quantum: float | None) -> np.ndarray:
    """``beat`` with room for rounding."""
    return beat * (1.0 + SLACK) + SLACK * (q * q).sum(axis=1) + 2.0 * (quantum or 0.0)


def choose(
    queries: DataFrame, regions: DataFrame, parts: DataFrame, axes: np.ndarray, most: int | None, quantum: float | None
) -> DataFrame:
    """The next visits of ``queries`` (``g``, ``query``, ``v``, ``seen`` regions, ``beat``): at most ``most`` regions each, those
    with the nearest means, and none whose bound is beyond ``beat``."""
    ddl = f"g {_type(queries, 'g')}, query {_type(queries, 'query')}, v array<double>, seen array<int>, beat double, next array<int>"

    def pick(rows: pa.Table, boxes: pa.Table) -> pa.Table:
        rows = rows.select(["g", "query", "v", "seen", "beat"])
        if not rows.num_rows or not boxes.num_rows:
            return rows.slice(0, 0).append_column("next", pa.array([], pa.list_(pa.int32())))
        v, names = vectors_of(rows.column("v")), boxes.column("region").to_numpy()
        low, high, middle = (vectors_of(boxes.column(c)) for c in ("low", "high", "middle"))
        turned = v @ axes
        beat = np.nan_to_num(rows.column("beat").to_numpy().astype(float), nan=np.inf)
        left = np.ones((len(v), len(names)), bool)
        if np.isfinite(beat).any():
            left = np.ascontiguousarray(bounds(turned, low, high).T) <= _reach(beat, v, quantum)[:, None]
        seen = rows.column("seen").combine_chunks()
        in_order = np.argsort(names)
        place = in_order[np.searchsorted(names[in_order], seen.flatten().to_numpy(zero_copy_only=False))]
        left[np.repeat(np.arange(len(v)), np.diff(seen.offsets.to_numpy())), place] = False
        if most is not None and most < len(names):
            far = nearness(turned, middle)
            far[~left] = np.inf
            nearest = np.zeros(left.shape, bool)
            nearest[np.arange(len(v))[:, None], np.argpartition(far, most - 1, axis=1)[:, :most]] = True
            left &= nearest
        at, column = np.nonzero(left)
        offsets = np.searchsorted(at, np.arange(len(v) + 1)).astype(np.int32)
        chosen = pa.ListArray.from_arrays(pa.array(offsets), pa.array(names[column].astype(np.int32)))
        return rows.append_column("next", chosen)

    return _dealt(queries, "query", regions, parts, ["g"]).applyInArrow(pick, ddl)


def _block(region):
    return F.floor(region * F.col("blocks") / F.col("regions")).cast("int")


def visit(
    visits: DataFrame, cells: DataFrame, sizes: DataFrame, k: int, spans, quantum: float | None, axes: np.ndarray, tile: int, tally: Accumulator | None
) -> DataFrame:
    """Queries (``g``, ``query``, ``v``, ``next`` regions, ``beat``) against the cells of the regions they visit: ``g``, ``query``,
    ``item``, ``distance``, ``parts``, ``rank``."""
    numbered = visits.join(sizes.select("g", "regions", "blocks"), "g")
    numbered = numbered.withColumn("block", F.explode(F.array_distinct(F.transform("next", _block))))
    sent = numbered.select("g", "query", "v", F.filter("next", lambda r: _block(r) == F.col("block")).alias("visited"), "beat", "block")
    whole = cells.select("g", "region", "cell", "items", "v").join(sizes.select("g", "regions", "blocks"), "g")
    held = whole.withColumn("block", _block(F.col("region"))).drop("regions", "blocks")
    asked = numbered.groupBy("g", "block").agg(F.count(F.lit(1)).alias("rows"))
    most = F.greatest(F.lit(tile), F.least(F.col("n") / F.col("blocks"), F.lit(MOST_ITEMS)))
    parts = settle(asked.join(sizes, "g").select("g", "block", F.ceil(F.col("rows") / most).cast("int").alias("parts")), "visits")
    id_type = _type(cells, "items").removeprefix("array<").removesuffix(">")
    ddl = f"g {_type(visits, 'g')}, query {_type(visits, 'query')}, item {id_type}, distance double, parts array<double>, rank double"
    return _dealt(sent, "query", held, parts, ["g", "block"]).applyInArrow(_scorer(k, spans, quantum, axes, tally), ddl)


def _scorer(k: int, spans, quantum: float | None, axes: np.ndarray, tally: Accumulator | None):
    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        item = right.schema.field("items").type.value_type
        schema = pa.schema([
            ("g", left.schema.field("g").type), ("query", left.schema.field("query").type), ("item", item),
            ("distance", pa.float64()), ("parts", pa.list_(pa.float64())), ("rank", pa.float64()),
        ])
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        right = right.sort_by([("region", "ascending"), ("cell", "ascending")])
        q = vectors_of(left.column("v"))
        held = [np.frombuffer(x, np.float64).reshape(-1, q.shape[1]) for x in right.column("v").to_pylist()]
        starts = np.cumsum([0, *map(len, held)])
        flat = np.concatenate(held)
        q_square = np.einsum("ij,ij->i", q, q)
        beat = np.nan_to_num(left.column("beat").to_numpy().astype(float), nan=np.inf)
        room = 1e-12 * (q_square + float(np.einsum("ij,ij->i", flat, flat).max())) + 2.0 * (quantum or 0.0)
        slack = room + _reach(np.zeros(len(q)), q, quantum)
        shorten = shortener(flat, axes, spans, LEFT_OUT_OF_BLOCK)
        short, asked = shorten(flat), shorten(q)
        # Single precision after scaling by a power of two, with room for what that rounds.
        length, most = np.sqrt(np.einsum("ij,ij->i", asked, asked)), float(np.sqrt(np.einsum("ij,ij->i", short, short).max()))
        scale = 2.0 ** -np.ceil(np.log2(max(float(length.max()), most) or 1.0))
        short, asked, widest = short * scale, asked * scale, 2.0 * ((length + most) * scale) ** 2
        rounded = (short.shape[1] + 4) * 2.0**-24 * widest + 1e-40
        # One product gives the squared distance of short vectors.
        against_all = np.hstack([short, np.einsum("ij,ij->i", short, short)[:, None], np.ones((len(short), 1))])
        asking_all = np.hstack([-2.0 * asked, np.ones((len(q), 1)), np.einsum("ij,ij->i", asked, asked)[:, None]])
        against_few, asking_few, asked_few, short_few = (np.ascontiguousarray(x, np.float32) for x in (against_all, asking_all, asked, short))
        best = np.repeat(beat[:, None], k, axis=1)  # the k least distances so far, in order or not, the last one the largest
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        scored = 0

        def distances(rows: np.ndarray, at: np.ndarray) -> np.ndarray:
            nonlocal scored
            scored += len(rows)
            out = np.empty(len(rows))
            for some in range(0, len(rows), 1 << 12):
                s = slice(some, some + (1 << 12))
                gap = q[rows[s]] - flat[at[s]]
                out[s] = np.einsum("ij,ij->i", gap, gap)
            return out

        def weigh(rows: np.ndarray, at: np.ndarray) -> None:
            """Pairs that may be among the best, with the ``rows`` of queries in order, in full."""
            if not len(rows):
                return
            real = distances(rows, at)
            order = np.lexsort((real, rows))
            place = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left")
            first = np.r_[True, rows[1:] != rows[:-1]]
            who, line = rows[first], np.cumsum(first) - 1
            own = np.full((len(who), k), np.inf)
            own[line[place < k], place[place < k]] = real[order][place < k]
            best[who] = np.partition(np.hstack([best[who], own]), k - 1, axis=1)[:, :k]
            close = real <= best[rows, k - 1] + 2.0 * room[rows]
            found.append((rows[close], at[close], real[close]))

        def limit(asking: np.ndarray, within: np.ndarray) -> np.ndarray:
            """The scaled squared distance of short vectors in single precision from which nothing is within reach of ``asking``."""
            reach = (within * (1.0 + SLACK) + slack[asking]) * (scale * scale * (1.0 + 1e-6))
            return np.minimum(reach, widest[asking]) + rounded[asking]

        held_own = np.empty((TOGETHER, asking_few.shape[1]), np.float32)
        held_rough = np.empty(TOGETHER * int(max(np.diff(starts)) * FAMILY), np.float32)
        held_hits = np.empty(len(held_rough) + 8, bool)

        def hits_of(start: int, stop: int, asking: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """The pairs of ``asking`` and the items from ``start`` to ``stop`` within ``reach``, by number, and what their bounds lack to it."""
            items, wide, hits, lack = against_few[start:stop].T, stop - start, [], []
            last = (asking_all[asking, -1] - reach).astype(np.float32)
            for some in range(0, len(asking), TOGETHER):
                now = asking[some : some + TOGETHER]
                own, size = held_own[: len(now)], len(now) * wide
                np.take(asking_few, now, axis=0, out=own, mode="clip")
                own[:, -1] = last[some : some + TOGETHER]
                rough, within = held_rough[:size], held_hits[:size]
                np.matmul(own, items, out=rough.reshape(-1, wide))
                np.less_equal(rough, 0.0, out=within)
                held_hits[size : size + 8] = False
                eights = held_hits[: (size + 7) // 8 * 8].reshape(-1, 8)  # few of them have a hit
                some_hit = np.flatnonzero(eights.view(np.uint64))
                row, column = np.nonzero(eights[some_hit])
                found = some_hit[row] * 8 + column
                hits.append(found + some * wide)
                lack.append(rough[found])
            return np.concatenate(hits), np.concatenate(lack)

        def against(start: int, stop: int, asking: np.ndarray) -> None:
            """``asking`` queries, in order, against the items from ``start`` to ``stop``."""
            within, size = best[asking, k - 1], len(asking) * (stop - start)
            new = np.flatnonzero(np.isinf(within))
            if len(new) and k <= stop - start:  # the k items of the least bounds give something to beat
                rough = asking_few[asking[new]] @ against_few[start:stop].T
                least = rough.argmin(axis=1)[:, None] if k == 1 else np.argpartition(rough, k - 1, axis=1)[:, :k]
                real = distances(np.repeat(asking[new], k), start + least.ravel())
                within[new] = real.reshape(-1, k).max(axis=1)
            reach = limit(asking, within)
            hits, lack = hits_of(start, stop, asking, reach)
            if len(hits) > size >> 3:  # rounded too much for vectors of such different lengths, or near to all
                own = asking_all[asking]
                own[:, -1] -= (within + room[asking]) * (scale * scale)
                rough = (own @ against_all[start:stop].T).ravel()
                hits = np.flatnonzero(rough <= 0.0)
                lack = rough[hits]
            if not len(hits):
                return
            i, j = np.divmod(hits, stop - start)
            # First the k of the least bounds, which seldom leave others within reach.
            first = np.zeros(len(i), bool)
            first[np.lexsort((lack, i))[np.arange(len(i)) - np.searchsorted(i, i, side="left") < k]] = True
            weigh(asking[i[first]], start + j[first])
            others = np.flatnonzero(~first)
            if len(others):
                now = limit(asking, np.minimum(best[asking, k - 1], within))
                others = others[lack[others] <= (now - reach + rounded[asking])[i[others]]]
                weigh(asking[i[others]], start + j[others])

        def through(visiting: np.ndarray, first: int, end: int) -> None:
            """``visiting`` queries against the cells of one region, those from ``first`` to ``end``."""
            edges = starts[[*range(first, end, FAMILY), end]]
            own = short_few[edges[0] : edges[-1]]
            low, high = (f.reduceat(own, edges[:-1] - edges[0]) for f in (np.minimum, np.maximum))
            near = bounds(asked_few[visiting], low, high)
            # First the family with the nearest mean, for something to beat; then the others by how near they are to all queries.
            middles = np.add.reduceat(own, edges[:-1] - edges[0]) / np.diff(edges)[:, None].astype(np.float32)
            home = nearness(asked_few[visiting], middles).argmin(axis=1)
            reach = limit(visiting, best[visiting, k - 1])
            for at_home in (True, False):
                for family in np.argsort(near.mean(axis=1), kind="stable"):
                    some = np.flatnonzero(((home == family) == at_home) & (near[family] <= reach))
                    if len(some):
                        against(edges[family], edges[family + 1], visiting[some])
                        reach[some] = limit(visiting[some], best[visiting[some], k - 1])

        visited = left.column("visited").combine_chunks()
        asking = np.repeat(np.arange(len(q)), np.diff(visited.offsets.to_numpy()))
        wanted = visited.flatten().to_numpy(zero_copy_only=False)
        order = np.argsort(wanted, kind="stable")
        asking, wanted = asking[order], wanted[order]
        region = right.column("region").to_numpy()
        for name in np.unique(wanted):
            visiting = asking[slice(*np.searchsorted(wanted, [name, name + 1]))]
            first, end = np.searchsorted(region, [name, name + 1])
            if first < end:
                for some in range(0, len(visiting), VISITING):
                    through(visiting[some : some + VISITING], first, end)
        if tally is not None:
            tally.add(scored)

        rows, at, real = (np.concatenate([f[n] for f in found]) if found else np.zeros(0, int) for n in range(3))
        close = real <= best[rows, k - 1] + 2.0 * room[rows]
        rows, at = rows[close], at[close]
        cuts = spans or [(0, q.shape[1])]
        parts = np.empty((len(rows), len(cuts)))
        for some in range(0, len(rows), 1 << 16):
            s = slice(some, some + (1 << 16))
            gap = q[rows[s]] - flat[at[s]]
            for n, (a, b) in enumerate(cuts):
                parts[s, n] = np.einsum("ij,ij->i", gap[:, a:b], gap[:, a:b])
        rank = parts.sum(axis=1)
        if quantum:
            rank = np.rint(rank / quantum)
        ids = right.column("items").combine_chunks().flatten()
        by_id = np.empty(len(ids), np.int64)
        by_id[pc.sort_indices(ids).to_numpy()] = np.arange(len(ids))
        order = np.lexsort((by_id[at], rank, rows))
        rows, at, parts, rank = rows[order], at[order], parts[order], rank[order]
        kept = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left") < k
        rows, at, parts, rank = rows[kept], at[kept], parts[kept], rank[kept]
        taken = pa.array(rows.astype(np.int64))
        out = [left.column("g").take(taken), left.column("query").take(taken), ids.take(pa.array(at.astype(np.int64)))]
        return pa.table([*out, pa.array(parts.sum(axis=1)), list_array(parts), pa.array(rank)], schema=schema)

    return score


def search(
    queries: DataFrame,
    items: DataFrame,
    k: int,
    spans,
    quantum: float | None,
    tile: int,
    root: float = ROOT,
    cell_items: int = CELL,
    tally: Accumulator | None = None,
) -> DataFrame:
    """Candidates ``(g, query, item, distance, parts, rank)`` that hold the ``k`` nearest items of each query (``g``, ``query``, ``v``).

    ``tally`` counts the pairs that were scored in full. The index and all rounds but the last are written when this is called.
    """
    queries = settle(queries, "queries")
    cells, regions, sizes, axes = build(items, spans, root, cell_items)
    scan = dict(sizes=sizes, k=k, spans=spans, quantum=quantum, axes=axes, tile=tile, tally=tally)
    one = queries.join(sizes.where("regions = 1").select("g"), "g")
    alone = one.select("g", "query", "v", F.array(F.lit(0)).alias("next"), F.lit(None).cast("double").alias("beat"))
    if sizes.where("regions > 1").isEmpty():
        return visit(alone, cells, **scan)
    several = queries.join(sizes.where("regions > 1").select("g"), "g")
    parts = settle(_parts(several, ["g"], PART), "parts")
    waiting = several.select("g", "query", "v", F.array().cast("array<int>").alias("seen"), F.lit(None).cast("double").alias("beat"))
    results: DataFrame | None = None
    for most in (*FIRST_VISITS, None):
        chosen = choose(waiting, regions, parts, axes, most, quantum).where(F.size("next") > 0)
        chosen = settle(chosen, "chosen")
        visits = chosen.select("g", "query", "v", "next", "beat")
        found = visit(visits if results is not None else visits.unionByName(alone), cells, **scan)
        if most is None:
            return results.unionByName(found)
        found = settle(found, "found")
        results = found if results is None else results.unionByName(found)
        # The k-th distance so far is one to beat; with fewer than k found nothing is ruled out.
        kept = first_k_per_key(results, ["g", "query"], [F.col("rank"), F.col("item")], k, rank="place")
        beat = kept.groupBy("g", "query").agg(F.count(F.lit(1)).alias("n"), F.max("distance").alias("far"))
        beat = beat.select("g", "query", F.when(F.col("n") >= k, F.col("far")).alias("to_beat"))
        seen = F.concat("seen", "next").alias("seen")
        waiting = chosen.join(beat, ["g", "query"], "left").select("g", "query", "v", seen, F.col("to_beat").alias("beat"))
    return results
