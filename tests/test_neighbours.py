import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from refrain.operators import cells, neighbours

SCHEMA = "g string, id long, v array<double>"


def brute_force(queries, items, k, quantum=None):
    expected = {}
    for g, q, x in queries:
        ranked = []
        for h, c, y in items:
            if g == h:
                d = sum((a - b) ** 2 for a, b in zip(x, y))
                ranked.append((math.inf if math.isnan(d) else round(d / quantum) if quantum else d, c))
        if ranked:
            expected[g, q] = [c for _, c in sorted(ranked)[:k]]
    return expected


def searched(spark, queries, items, k, **options):
    q = spark.createDataFrame(queries, SCHEMA).withColumnRenamed("id", "q")
    c = spark.createDataFrame(items, SCHEMA).withColumnRenamed("id", "c")
    found = {}
    rows = neighbours.nearest(q, c, "g", "q", "c", "v", k=k, **options).collect()
    quantum = options.get("quantum") or 0

    def place(r):
        if math.isnan(r.distance):
            return math.inf, r.c
        return round(r.distance / quantum) if quantum else r.distance, r.c

    for r in sorted(rows, key=place):
        found.setdefault((r.g, r.q), []).append(r.c)
    return found


def cloud(rng, rows, groups, dim, start=0, scale=1.0, hot=0.4):
    """Clustered vectors; one group holds a large share of them and some vectors occur often."""
    centres = rng.normal(size=(12, dim)) * scale
    common = rng.normal(size=dim) * scale
    out = []
    for i in range(rows):
        g = groups[0] if rng.random() < hot else groups[rng.integers(len(groups))]
        v = common if rng.random() < 0.1 else centres[rng.integers(12)] + rng.normal(size=dim) * 0.2 * scale
        out.append((g, start + i, [float(x) for x in v]))
    return out


TILED = dict(tile_items=16, tile_queries=32, spans=[(0, 2), (2, 6)])
CELLS = dict(prune=True, root=2.0, cell_items=5)
WAYS = {"one tile": {}, "tiles": TILED, "cells": {**TILED, **CELLS}, "cells, one span": CELLS, "cells, one region": dict(prune=True)}


@pytest.mark.parametrize("k", [1, 5])
@pytest.mark.parametrize("way", WAYS)
def test_equals_brute_force(spark, k, way):
    rng = np.random.default_rng(k)
    items = cloud(rng, 900, ["a", "b", "c"], 6)
    queries = cloud(rng, 120, ["a", "b", "c", "without items"], 6, start=10_000)
    assert searched(spark, queries, items, k, **WAYS[way]) == brute_force(queries, items, k)


def test_far_from_the_origin(spark):
    rng = np.random.default_rng(7)
    shift = 1e6
    items = [(g, i, [x + shift for x in v]) for g, i, v in cloud(rng, 400, ["a"], 4)]
    queries = [(g, i, [x + shift for x in v]) for g, i, v in cloud(rng, 40, ["a"], 4, start=5000)]
    expected = brute_force(queries, items, 3, 1e-6)
    assert searched(spark, queries, items, 3, quantum=1e-6) == expected
    assert searched(spark, queries, items, 3, quantum=1e-6, **CELLS) == expected


def test_wide_distances_keep_their_order(spark):
    items = [("a", i, [1e7 * ((i * 37) % 101), 0.0]) for i in range(101)]
    queries = [("a", 1, [0.0, 0.0])]
    expected = brute_force(queries, items, 4)
    assert searched(spark, queries, items, 4) == expected
    assert searched(spark, queries, items, 4, **CELLS) == expected


def test_copies_go_to_the_smallest_ids(spark):
    items = [("a", i, [1.0, 1.0]) for i in range(300, 0, -1)] + [("a", 1000, [5.0, 5.0])]
    assert searched(spark, [("a", 1, [1.0, 1.0])], items, 4) == {("a", 1): [1, 2, 3, 4]}


@pytest.mark.parametrize("way", [{}, CELLS])
def test_small_vectors_and_ids_in_two_groups(spark, way):
    rng = np.random.default_rng(9)
    items = [("a", 1, [1e-5]), ("a", 2, [0.0]), *[(g, i, [float(x)]) for i, (g, x) in enumerate(zip("ab" * 100, rng.normal(size=200) * 1e-7), 3)]]
    queries = [("a", 1, [0.0]), ("b", 1, [2e-8]), ("a", 5, [1e-5])]
    expected = brute_force(queries, items, 2)
    assert expected["a", 1][0] == 2 and len(expected) == 3
    assert searched(spark, queries, items, 2, **way) == expected


def test_a_second_query_of_a_group_is_refused(spark):
    df = spark.createDataFrame([("a", 1, [1.0]), ("a", 2, [2.0])], SCHEMA)
    with pytest.raises(ValueError, match="several"):
        neighbours.nearest_to_one_per_group(df, df.select("g", F.col("v").alias("q")), "g", "id", "v", "q")


def test_nan_comes_last(spark):
    nan = math.nan
    items = [("a", 1, [nan, 0.0]), ("a", 2, [9.0, 0.0]), ("a", 3, [nan, nan]), ("b", 4, [nan, 1.0])]
    queries = [("a", 1, [0.0, 0.0]), ("a", 2, [nan, 0.0]), ("b", 3, [0.0, 0.0])]
    assert searched(spark, queries, items, 2) == {("a", 1): [2, 1], ("a", 2): [1, 2], ("b", 3): [4]}


def test_parts_add_up(spark):
    q = spark.createDataFrame([("a", 1, [0.0, 0.0, 0.0])], "g string, q long, v array<double>")
    c = spark.createDataFrame([("a", 2, [1.0, 2.0, 3.0])], "g string, c long, v array<double>")
    row = neighbours.nearest(q, c, "g", "q", "c", "v", spans=[(0, 1), (1, 3)]).first()
    assert (row.distance, row.parts) == (14.0, [1.0, 13.0])


def test_a_stored_vector_finds_itself(spark):
    rows = cloud(np.random.default_rng(3), 50, ["a"], 5, hot=1.0)
    df = spark.createDataFrame(rows, SCHEMA)
    hits = neighbours.nearest_to_point(df, rows[7][2], "id", "v", 3, group=("g", "a")).collect()
    assert hits[0].distance == 0.0 and len(hits) == 3


def test_point_search_puts_nan_and_null_last(spark):
    df = spark.createDataFrame([(1, [math.nan]), (2, None), (3, [1.0])], "id int, v array<double>")
    assert [r.id for r in neighbours.nearest_to_point(df, [0.0], "id", "v", 3).collect()] == [3, 1, 2]


def indexed(spark, rows):
    return spark.createDataFrame(rows, "g string, item long, v array<double>")


def test_cells_hold_all_items_within_their_boxes(spark):
    rows = cloud(np.random.default_rng(4), 700, ["a", "b", "c"], 6)
    stored, regions, sizes, axes = cells.build(indexed(spark, rows), [(0, 2), (2, 6)], root=2.0, cell_items=6)
    assert np.allclose(axes @ axes.T, np.eye(6)) and not axes[:2, 2:].any()
    boxes = {(r.g, r.region): (np.array(r.low), np.array(r.high)) for r in regions.collect()}
    of_group = {r.g: r.regions for r in sizes.collect()}
    found = []
    for r in stored.collect():
        v = np.frombuffer(r.v).reshape(-1, 6)
        assert len(v) == len(r["items"]) <= 6
        turned = v @ axes
        for low, high in ((np.array(r.low), np.array(r.high)), boxes[r.g, r.region]):
            assert (turned >= low - 1e-12).all() and (turned <= high + 1e-12).all()
        assert r.region < of_group[r.g]
        found += [(r.g, i, x.tolist()) for i, x in zip(r["items"], v)]
    assert sorted(found) == sorted(rows)
    assert len({k for k in boxes if k[0] == "a"}) > 4


def test_a_group_without_drawn_pivots_is_drawn_from_again(spark, monkeypatch):
    monkeypatch.setattr(cells, "DRAWN", 0)
    monkeypatch.setattr(cells, "DRAWN_MORE", 0)
    rows = cloud(np.random.default_rng(5), 300, ["a", "b"], 3)
    _, regions, _, _ = cells.build(indexed(spark, rows), root=2.0)
    assert {r.g for r in regions.where("region > 2").collect()} == {"a", "b"}


def test_large_and_small_groups_skip_cells(spark):
    """Pairs that are scored, in a group of 100,000 items and in one of 50."""
    rng = np.random.default_rng(6)
    sizes = {"large": 100_000, "small": 50}
    for group, n in sizes.items():
        v = rng.normal(size=(n, 3))
        items = indexed(spark, [(group, i, x.tolist()) for i, x in enumerate(v)]).withColumnsRenamed({"item": "c"})
        asked = rng.normal(size=(40, 3))
        queries = spark.createDataFrame([(group, i, x.tolist()) for i, x in enumerate(asked)], "g string, q long, v array<double>")
        tally = spark.sparkContext.accumulator(0)
        rows = neighbours.nearest(queries, items, "g", "q", "c", "v", k=2, prune=True, clean=True, tally=tally).collect()
        distances = ((asked[:, None] - v[None]) ** 2).sum(axis=2)
        wanted = {(i, int(j)) for i, line in enumerate(distances) for j in np.argsort(line)[:2]}
        assert {(r.q, r.c) for r in rows} == wanted
        assert tally.value < 0.7 * 40 * n
        assert group == "small" or tally.value < 0.01 * 40 * n


def blurred(rng, rows, strong=6, weak=30):
    """Vectors that vary much along few axes and a little along many others."""
    return np.hstack([rng.normal(size=(rows, strong)), 0.01 * rng.normal(size=(rows, weak))])


@pytest.mark.parametrize("spans", [None, [(0, 9), (9, 36)]])
def test_short_vectors_are_never_farther_apart(spans):
    rng = np.random.default_rng(8)
    v, q = blurred(rng, 300), 3.0 + blurred(rng, 50)
    shorten = cells.shortener(v, np.eye(36), spans)
    a, b = shorten(q), shorten(v)
    assert a.shape[1] < 12
    near, real = (((x[:, None] - y[None]) ** 2).sum(axis=2) for x, y in ((a, b), (q, v)))
    assert (near <= real * (1 + 1e-12)).all() and (near > 0.9 * real).all()


def test_wide_vectors_are_seldom_scored_in_full(spark):
    rng = np.random.default_rng(10)
    v, asked = blurred(rng, 3000), blurred(rng, 200)
    items = indexed(spark, [("a", i, x.tolist()) for i, x in enumerate(v)]).withColumnsRenamed({"item": "c"})
    queries = spark.createDataFrame([("a", i, x.tolist()) for i, x in enumerate(asked)], "g string, q long, v array<double>")
    tally = spark.sparkContext.accumulator(0)
    rows = neighbours.nearest(queries, items, "g", "q", "c", "v", k=2, prune=True, clean=True, tally=tally).collect()
    distances = ((asked[:, None] - v[None]) ** 2).sum(axis=2)
    assert {(r.q, r.c) for r in rows} == {(i, int(j)) for i, line in enumerate(distances) for j in np.argsort(line)[:2]}
    assert tally.value < 0.02 * 200 * 3000


def test_few_pairs_are_scored_where_much_lies_along_weak_axes(spark):
    """Nearest vectors that differ mostly along axes that hold little of the variance, with all of them in single precision first."""
    rng = np.random.default_rng(12)
    strong = np.repeat(rng.normal(size=(150, 4)), 20, axis=0)
    v = np.hstack([strong, 0.005 * rng.normal(size=(3000, 30))])
    asked = np.hstack([strong[::15], 0.005 * rng.normal(size=(200, 30))])
    items = indexed(spark, [("a", i, x.tolist()) for i, x in enumerate(v)]).withColumnsRenamed({"item": "c"})
    queries = spark.createDataFrame([("a", i, x.tolist()) for i, x in enumerate(asked)], "g string, q long, v array<double>")
    tally = spark.sparkContext.accumulator(0)
    rows = neighbours.nearest(queries, items, "g", "q", "c", "v", k=2, prune=True, clean=True, tally=tally).collect()
    distances = ((asked[:, None] - v[None]) ** 2).sum(axis=2)
    assert {(r.q, r.c) for r in rows} == {(i, int(j)) for i, line in enumerate(distances) for j in np.argsort(line)[:2]}
    assert tally.value < 20 * 200


@pytest.mark.parametrize("way", [CELLS, dict(prune=True), dict(prune=True, root=1.0, tile_queries=16)])
@pytest.mark.parametrize("k", [1, 4])
def test_lengths_of_many_orders(spark, way, k):
    """Vectors of lengths that single precision can't hold side by side, or not at all."""
    rng = np.random.default_rng(13)

    def spread(rows, start):
        powers = rng.choice([-170, -60, -24, -6, 0, 5, 18, 40, 100], size=rows)
        return [("ab"[i % 2], start + i, [float(x) * 10.0 ** int(p) for x in rng.integers(1, 90, 3)]) for i, p in enumerate(powers)]

    items, queries = spread(500, 0), spread(80, 1000)
    assert searched(spark, queries, items, k, **way) == brute_force(queries, items, k)


def test_boxes_bound_from_below():
    rng = np.random.default_rng(14)
    q, v = rng.normal(size=(70, 5)), rng.normal(size=(40, 6, 5))
    near = cells.bounds(q, v.min(axis=1), v.max(axis=1))
    real = ((q[None, :, None] - v[:, None]) ** 2).sum(axis=3).min(axis=2)
    assert near.shape == (40, 70) and (near <= real).all() and (near > 0).any() and (near == 0).any()


def test_queries_first_visit_the_region_with_the_nearest_mean(spark):
    """Where all boxes hold all queries, so that their bounds tell nothing; then, with a distance to beat, what is left by bound."""
    box = ([-9.0, -9.0], [9.0, 9.0])
    middles = [[-5.0, 0.0], [0.0, 4.0], [6.0, 1.0], [0.0, -7.0]]
    rows = [("a", i, *box, m) for i, m in enumerate(middles)] + [("a", 4, [30.0, 30.0], [40.0, 40.0], [35.0, 35.0])]
    regions = spark.createDataFrame(rows, "g string, region int, low array<double>, high array<double>, middle array<double>")
    asked = [("a", i, [x + 0.5, y - 0.5]) for i, (x, y) in enumerate(middles)]
    parts = spark.createDataFrame([("a", 1)], "g string, parts int")
    queries = spark.createDataFrame(asked, "g string, query long, v array<double>")
    new = queries.select("g", "query", "v", F.array().cast("array<int>").alias("seen"), F.lit(None).cast("double").alias("beat"))
    for turn in (np.eye(2), np.array([[0.0, 1.0], [1.0, 0.0]])):
        turned = regions.withColumn("middle", F.reverse("middle")) if turn[0, 0] == 0 else regions
        first = cells.choose(new, turned, parts, turn, 1, None)
        assert {r.query: r.next for r in first.collect()} == {i: [i] for i in range(4)}
    later = first.select("g", "query", "v", F.col("next").alias("seen"), F.lit(0.5).alias("beat"))
    others = cells.choose(later, regions, parts, np.eye(2), None, None)
    assert {r.query: sorted(r.next) for r in others.collect()} == {i: [j for j in range(4) if j != i] for i in range(4)}


def test_regions_know_their_mean(spark):
    rows = cloud(np.random.default_rng(15), 300, "ab", 6)
    stored, regions, _, axes = cells.build(indexed(spark, rows), [(0, 2), (2, 6)], root=2.0, cell_items=6)
    vectors = {(g, i): np.array(v) for g, i, v in rows}
    held = {}
    for r in stored.collect():
        held.setdefault((r.g, r.region), []).extend(vectors[r.g, i] for i in r["items"])
    found = {(r.g, r.region): r.middle for r in regions.collect()}
    assert found.keys() == held.keys()
    assert all(np.allclose(found[key], np.mean(v, axis=0) @ axes) for key, v in held.items())
