"""Hard negatives by Fagin's threshold algorithm over blocks of rows.

Rows are dealt into blocks of bounded size and anchors into tiles; a tile visits every block that can hold a partner.
Each block has one list per dimension, sorted by that component. An anchor reads every list from the end that its own
component's sign favours, scores each row that turns up by random access to the whole vector, in exact integers, and
stops once the threshold, the score of a row that would stand at the current place of all lists, is strictly below
the kth score of each of its windows. So rows with an equal score are all seen and ids decide between them. Of each
block and anchor only the best rows of each window leave; no pair of rows becomes a row otherwise.

Positives are a window without bounds over the blocks of the anchor's label, negatives one window per positive over
the blocks of all rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from refrain.llm.common import content_key, to_arrow
from refrain.llm.integers import floored, is_usable, matrix, products
from refrain.operators.relational import first_k_per_key
from refrain.sources.scratch import settle

#: Positives of an anchor and negatives of a positive; a negative's score in per cent of the positive's.
POSITIVES, NEGATIVES, LEAST_PERCENT = 5, 5, 80
#: Rows of a block: the share of all rows that leaves a cluster enough tasks, within these bounds. Anchors of a tile.
LEAST_BLOCK, MOST_BLOCK, BLOCKS, TILE = 2048, 1 << 16, 32, 2048
#: Places that all lists go on by at first; each step doubles the depth.
STEP = 32
#: Scores that a window without bounds allows.
UNBOUNDED = (-(1 << 62), 1 << 62)


class Lists:
    """A block's rows and, for every dimension, their numbers in the order of that component."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.order = np.argsort(vectors, axis=0, kind="stable").astype(np.int32)
        self.sorted = np.take_along_axis(vectors, self.order, axis=0)

    def best(self, anchor: np.ndarray, allowed: np.ndarray, windows: list[tuple[int, int]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """The rows and scores of the ``k`` best rows of each window; equal scores in the order of the rows."""
        size = len(self.vectors)
        used = np.flatnonzero(anchor)
        up = anchor[used] > 0
        seen = np.zeros(size, bool)
        rows, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        depth, open_ = 0, list(range(len(windows)))
        while open_ and depth < size:
            reach = min(size, 2 * depth or STEP) if len(used) else size
            if len(used):
                seen_now = np.zeros(size, bool)
                for d, ascending in zip(used, ~up):
                    part = self.order[depth:reach, d] if ascending else self.order[size - reach : size - depth, d]
                    seen_now[part] = True
            else:  # all scores are equal, and no list says anything
                seen_now = np.ones(size, bool)
            fresh = np.flatnonzero(seen_now & ~seen & allowed)
            seen |= seen_now
            depth = reach
            rows = np.concatenate((rows, fresh))
            scores = np.concatenate((scores, products(self.vectors[fresh], anchor)))
            if seen.all():
                break
            last = np.where(up, self.sorted[size - depth, used], self.sorted[depth - 1, used])
            threshold = int((last * anchor[used]).sum())
            open_ = [w for w in open_ if not self._closed(scores, threshold, *windows[w], k)]
        order = np.lexsort((rows, -scores))
        rows, scores = rows[order], scores[order]
        found = []
        for low, high in windows:
            inside = np.flatnonzero((scores >= low) & (scores <= high))[:k]
            found.append((rows[inside], scores[inside]))
        return found

    @staticmethod
    def _closed(scores: np.ndarray, threshold: int, low: int, high: int, k: int) -> bool:
        """No row that hasn't been seen, which scores the threshold at most, can be among the best of the window."""
        if threshold < low:
            return True
        if threshold >= high:
            return False
        inside = scores[(scores >= low) & (scores <= high)]
        return len(inside) >= k and np.partition(inside, len(inside) - k)[len(inside) - k] > threshold


def _searched(same_label: bool, k: int, schema: pa.Schema):
    """A tile of anchors against a block of rows; the best of each window as rows of ``schema``."""

    def search(anchors: pa.Table, block: pa.Table) -> pa.Table:
        if not anchors.num_rows or not block.num_rows:
            return schema.empty_table()
        block = block.sort_by("id")  # nulls last; equal scores then go by the number of the row
        lists = Lists(matrix(block.column("v")))
        ids, labels = (block.column(c).combine_chunks().dictionary_encode() for c in ("id", "label"))
        of_id, of_label = (x.indices.fill_null(-1).to_numpy(zero_copy_only=False) for x in (ids, labels))
        id_codes, label_codes = ({v: i for i, v in enumerate(x.dictionary.to_pylist())} for x in (ids, labels))
        queries = matrix(anchors.column("q"))
        wanted = anchors.column("windows").to_pylist() if "windows" in anchors.column_names else None
        taken, windows, rows, scores = [], [], [], []
        for i, (anchor, label) in enumerate(zip(anchors.column("anchor").to_pylist(), anchors.column("label").to_pylist())):
            alike = of_label == label_codes.get(label, -2)
            allowed = (alike if same_label else ~alike) & (of_id != id_codes.get(anchor, -2))
            bounds = [(w["low"], w["high"]) for w in wanted[i]] if wanted else [UNBOUNDED]
            for w, (row, score) in enumerate(lists.best(queries[i], allowed, bounds, k)):
                taken.append(np.full(len(row), i))
                windows.append(np.full(len(row), w))
                rows.append(row)
                scores.append(score)
        taken, windows, rows, scores = (pa.array(np.concatenate(x).astype(np.int64)) for x in (taken, windows, rows, scores))
        keys = [anchors.column(c).take(taken) for c in ("key_1", "key_2", "anchor")]
        out = [*keys, windows, block.column("id").take(rows), scores]
        return pa.table([c.cast(f.type) for c, f in zip(out, schema)], schema=schema)

    return search


def _dealt(anchors: DataFrame, rows: DataFrame, k: int, same_label: bool) -> DataFrame:
    """Tiles of anchors, with their ``blocks`` and ``tiles``, against the blocks of rows that they visit.

    A row is sent once per tile that visits its block, an anchor once per block.
    """

    def part(count: str, *key: str) -> Column:
        return F.pmod(F.xxhash64(F.lit("dealt"), *key), F.col(count)).cast("int")

    def every(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    left = anchors.select("*", part("tiles", "key_1", "key_2").alias("tile"), every("blocks").alias("block"))
    right = rows.select("id", "label", "v", every("tiles").alias("tile"), part("blocks", "id", "v").alias("block"))
    key = ["label", "tile", "block"] if same_label else ["tile", "block"]
    kinds = {c: t for c, t in [*anchors.dtypes, *rows.dtypes]}
    ddl = f"key_1 long, key_2 long, anchor {kinds['anchor']}, window int, id {kinds['id']}, score long"
    met = left.drop("blocks", "tiles").groupBy(*key).cogroup(right.groupBy(*key))
    found = met.applyInArrow(_searched(same_label, k, to_arrow(ddl)), ddl)
    order = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    return first_k_per_key(found, ["key_1", "key_2", "anchor", "window"], order, k)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    least_percent: int = LEAST_PERCENT,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    A score is the inner product with the anchor of the integers of ``floored``; higher ones come first, equal ones by id,
    nulls last. Positives are an anchor's first ``positives`` rows of its label. Each of them has the first
    ``negatives`` rows of other labels that score from ``least_percent`` per cent of its score up to all of it; a positive
    of a negative score has none, as that range is empty.

    Rows with a null label, without components, or with one that is null, NaN or infinite take no part; the others must
    have one length. A row is no partner of rows with its own id. Repeated rows are partners each for itself, but as
    anchors they are one. A table without anchors gives no rows. Other columns are ignored, whatever their names. The
    rows, the layout and the positives are written when this is called.
    """
    chosen = vectors.filter(F.col(label).isNotNull() & is_usable(vector) & (F.size(vector) > 0))
    rows = chosen.select(F.col(id).alias("id"), F.col(label).alias("label"), floored(vector).alias("v"), is_anchor.alias("asks"))
    rows = settle(rows, "integers")
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.min(F.size("v")).alias("low"), F.max(F.size("v")).alias("high")).first()
    if size["low"] != size["high"]:
        raise ValueError(f"vectors have {size['low']} to {size['high']} components")
    in_block = min(MOST_BLOCK, max(LEAST_BLOCK, size["n"] // BLOCKS))
    asking = rows.filter("asks").select(F.col("id").alias("anchor"), "label", F.col("v").alias("q"), *content_key(F.col("id"), F.col("label"), F.col("v")))
    asking = settle(asking.dropDuplicates(["key_1", "key_2"]), "anchors")

    def parts(of: int) -> Column:
        return F.ceil(F.count(F.lit(1)) / of).cast("int")

    held = rows.groupBy("label").agg(parts(in_block).alias("blocks"))
    layout = settle(held.join(asking.groupBy("label").agg(parts(TILE).alias("tiles")), "label"), "layout")
    best = _dealt(asking.join(layout, "label"), rows.join(layout, "label"), positives, same_label=True)
    best = settle(best.drop("window"), "positives")

    low = F.expr(f"({least_percent} * score + 99) div 100")
    ranges = F.struct(F.col("rank"), low.alias("low"), F.col("score").alias("high"))
    windows = best.filter("score >= 0").groupBy("key_1", "key_2").agg(F.sort_array(F.collect_list(ranges)).alias("windows"))
    counts = {"blocks": F.lit(max(1, -(-size["n"] // in_block))), "tiles": F.lit(max(1, -(-asking.count() // TILE)))}
    asking = asking.join(windows, ["key_1", "key_2"]).withColumns(counts)
    worst = _dealt(asking, rows.withColumns(counts), negatives, same_label=False)
    named = best.select(
        "key_1", "key_2", (F.col("rank") - 1).alias("window"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    return worst.join(named, ["key_1", "key_2", "window"]).select(
        F.col("anchor").alias("anchor_id"),
        "positive_id",
        "rank",
        F.col("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
