"""Hard negatives and vector codes against brute force: ties, nulls, repeated rows, empty tables, clashing names."""

import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from refrain.llm import codes, negatives
from refrain.llm.integers import LIMIT, products

SCHEMA = "vec_id long, embedding array<float>, label int"
CLASHING = ("id", "v", "code", "error", "tile", "block", "asks", "rank", "score")
INF, NAN = math.inf, math.nan


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts).withColumns({c: F.lit("own") for c in CLASHING})


def cloud(seed, n, dim, centres=6, labels=3):
    """Clusters; vectors and scores recur, a third of the rows is one vector, some labels are null."""
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dim)) * 0.4
    common = (np.round(rng.normal(size=dim) * 8) / 64).tolist()
    rows = []
    for i in range(n):
        v = common if i % 3 == 0 else (np.round((middle[i % centres] + rng.normal(size=dim) * 0.1) * 32) / 32).tolist()
        rows.append((i, v, None if i % 29 == 5 else int(rng.integers(labels))))
    return rows


def usable(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v)


def whole(v):
    return [math.floor(256 * float(np.float32(x))) for x in v]


BROKEN = [(1, None, 1), (2, [NAN] * 4, 1), (3, [0.1, INF, 0.1, 0.1], 1), (4, [0.1, None, 0.1, 0.1], 1), (5, [], 1)]


def mined(rows, anchors, k=5, least=80):
    """Every anchor against every row."""
    rows = [(i, whole(v), label) for i, v, label in rows if label is not None and usable(v)]
    last = (lambda i: (i is None, i or 0))
    found = []
    for i, v, label in {(i, tuple(v), label) for i, v, label in rows if i is not None and anchors(i)}:
        scored = sorted(
            ((-sum(a * b for a, b in zip(v, w)), last(j), j, other) for j, w, other in rows if j != i), key=lambda x: x[:2]
        )
        for p, _, j, _ in [s for s in scored if s[3] == label][:k]:
            fitting = [s for s in scored if s[3] != label and least * -p <= 100 * -s[0] <= 100 * -p][:k]
            found += [(i, j, n, s[2], -p, -s[0]) for n, s in enumerate(fitting, 1)]
    return sorted(found, key=str)


COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


@pytest.mark.parametrize("sizes", [{}, {"LEAST_BLOCK": 16, "BLOCKS": 1000, "TILE": 4}])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, sizes):
    for name, value in sizes.items():
        monkeypatch.setattr(negatives, name, value)
    rows = cloud(1, 260, 4) + BROKEN + [(None, [0.3, 0.1, -0.2, 0.4], 1), (40, [0.0] * 4, 2), (6, [0.5, 0.5, 0.1, 0.1], 0)]
    rows += [rows[10], rows[10], rows[20], (30, [0.25, 0.25, 0.0, 0.5], 1)]
    found = negatives.hard_negatives(frame(spark, rows), F.col("vec_id") % 10 == 0)
    assert found.columns == COLUMNS
    got = sorted((tuple(r) for r in found.collect()), key=str)
    assert got == mined(rows, lambda i: i % 10 == 0) and len(got) > 100


def test_hard_negatives_of_nothing(spark):
    assert negatives.hard_negatives(frame(spark, BROKEN), F.col("vec_id") > 0).collect() == []
    assert negatives.hard_negatives(frame(spark, cloud(2, 9, 4)), F.lit(None).cast("boolean")).collect() == []
    assert negatives.hard_negatives(spark.createDataFrame([], SCHEMA), F.col("vec_id") > 0).collect() == []
    with pytest.raises(ValueError, match="components"):
        negatives.hard_negatives(frame(spark, [(1, [0.1], 1), (2, [0.1, 0.2], 1)]), F.col("vec_id") > 0)


@pytest.mark.parametrize("seed", range(6))
def test_threshold_search_equals_sorting(seed):
    rng = np.random.default_rng(seed)
    vectors = rng.integers(-6, 7, size=(300, 1 + seed))
    lists = negatives.Lists(vectors)
    for anchor in [*rng.integers(-5, 6, size=(20, 1 + seed)), np.zeros(1 + seed, int)]:
        allowed = rng.random(300) < 0.6
        scores = vectors @ anchor
        windows = [negatives.UNBOUNDED, (3, 20), (int(scores.max()), int(scores.max())), (9, 8), (-40, -20)]
        for (low, high), (rows, found) in zip(windows, lists.best(anchor, allowed, windows, 4)):
            order = sorted((i for i in range(300) if allowed[i] and low <= scores[i] <= high), key=lambda i: (-scores[i], i))
            assert rows.tolist() == order[:4] and found.tolist() == scores[order[:4]].tolist()


def test_threshold_search_stops_early(monkeypatch):
    """Where few components matter only the heads of the lists are scored."""
    scored = []
    monkeypatch.setattr(negatives, "products", lambda a, b: scored.append(len(a)) or products(a, b))
    vectors = np.random.default_rng(3).integers(-1000, 1000, size=(20_000, 2))
    negatives.Lists(vectors).best(np.array([7, -5]), np.ones(20_000, bool), [negatives.UNBOUNDED], 5)
    assert sum(scored) < 4000


def test_products_are_exact():
    big = np.array([[LIMIT - 1, 3], [1 - LIMIT, LIMIT - 1]])
    assert (products(big * 64, big.T * 64) == big * 64 @ (big.T * 64)).all()


def quantised(rows, parts, entries, rounds):
    kept = sorted(((i, whole(v), label) for i, v, label in rows if usable(v)), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // parts
    cut = [[tuple(v[p * width : (p + 1) * width]) for p in range(parts)] for _, v, _ in kept]
    books = [[row[p] for row in cut[:entries]] for p in range(parts)]

    def assigned(p):
        return [min((sum((a - b) ** 2 for a, b in zip(row[p], c)), e) for e, c in enumerate(books[p])) for row in cut]

    for _ in range(rounds):
        for p in range(parts):
            held = defaultdict(list)
            for (_, e), row in zip(assigned(p), cut):
                held[e].append(row[p])
            for e, members in held.items():
                books[p][e] = tuple(sum(x) // len(members) for x in zip(*members))
    found = [assigned(p) for p in range(parts)]
    result = [(i, "".join(f"{f[n][1]:02x}" for f in found), sum(f[n][0] for f in found), label) for n, (i, _, label) in enumerate(kept)]
    return result, np.array(books)


@pytest.mark.parametrize("options", [dict(parts=2, entries=9, rounds=2), dict(parts=4, entries=40, rounds=4), dict(parts=1, entries=3, rounds=1)])
def test_vector_codes_equal_brute_force(spark, monkeypatch, options):
    monkeypatch.setattr(codes, "OWNED", 50)
    rows = cloud(4, 250, 4) + BROKEN + [(None, [0.3, 0.1, -0.2, 0.4], 1), (7, [300.0, -300.0, 0.2, 0.1], 2)] + cloud(4, 3, 4)
    wanted, books = quantised(rows, **options)
    found = codes.vector_codes(frame(spark, rows, 5), **options)
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    by_label = defaultdict(int)
    for _, _, error, label in wanted:
        by_label[label] += error
    expected = sorted(((i, code, error, by_label[label], codes.digest(books)) for i, code, error, label in wanted), key=str)
    assert sorted((tuple(r) for r in found.collect()), key=str) == expected


def test_only_movers_are_shuffled_again(spark):
    rows = cloud(5, 600, 8)
    df = frame(spark, rows)
    kept = df.select("vec_id", codes.floored("embedding").alias("v"))
    first = np.array([whole(v) for _, v, _ in rows[:10]]).reshape(10, 2, 4).transpose(1, 0, 2).copy()
    residents = codes.settle(codes.deal(kept, first, 4).repartition("position", "entry", "salt"), "residents")
    books = codes.updated(residents, first)
    found = codes.reassigned(residents, books)
    plan = found.filter("NOT moved")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    counts = {r.moved: r.n for r in found.groupBy("moved").agg(F.sum("members").alias("n")).collect()}
    assert counts[True] + counts[False] == 2 * 600 and 0 < counts[True] < counts[False]


def test_vector_codes_of_nothing(spark):
    assert codes.vector_codes(frame(spark, BROKEN)).collect() == []
    assert codes.vector_codes(spark.createDataFrame([], SCHEMA)).collect() == []
    with pytest.raises(ValueError, match="components"):
        codes.vector_codes(frame(spark, [(1, [0.1] * 6, 1)]), parts=4)
