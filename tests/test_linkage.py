import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from refrain.plans import linkage, lookup

SCHEMA = "track_id string, song_title string, artist_name string, name_key_1 string"


def brute_force(left, right):
    """Best match per left record, scored record by record in plain Python."""
    blocks = {}
    for side, rows in (("l", left), ("r", right)):
        for r in rows:
            blocks.setdefault(r[3], {"l": [], "r": []})[side].append(r)
    best = {}
    for block in blocks.values():
        rows = block["l"] + block["r"]
        idf = []
        for f in (1, 2):
            df = Counter(c for r in rows for c in set(r[f]))
            idf.append({c: math.log((len(rows) + 1) / (n + 1)) for c, n in df.items()})

        def weigh(text, f):
            w = {c: n * idf[f - 1][c] for c, n in Counter(text).items()}
            return w, math.sqrt(sum(x * x for x in w.values()))

        def score(a, b, f):
            (x, nx), (y, ny) = weigh(a[f], f), weigh(b[f], f)
            return -1.0 if nx * ny == 0 else sum(w * y.get(c, 0.0) for c, w in x.items()) / (nx * ny)

        for a in block["l"]:
            scored = [(score(a, b, 1), score(a, b, 2), b[0]) for b in block["r"]]
            if scored:
                best[a[0]] = min(scored, key=lambda s: (-round(s[0] + s[1], 9), s[2]))
    return best


def names(rng, rows, mark, letters="abcdeq"):
    out = []
    for i in range(rows):
        title = "".join(rng.choice(letters) for _ in range(rng.randint(1, 6)))
        artist = rng.choice(["abba", "baab", "q", "cde", "edc1", title])
        block = rng.choice(["a", "a", "b", "others", mark])
        out.append((f"{mark}{i}", title, artist, block))
    # Many copies of one record, and a block in which every character is everywhere and so weighs nothing.
    out += [(f"{mark}c{i}", "same", "song", "a") for i in range(rows // 3)]
    out += [(f"{mark}z{i}", "xx" if i else "xy", "w", "z") for i in range(4)]
    return out


@pytest.mark.parametrize("search", [{}, {"prune": False}, {"root": 1.0, "cell_items": 4, "tile_queries": 16}])
def test_link_equals_brute_force(spark, search):
    rng = random.Random(11)
    left, right = names(rng, 90, "m"), names(rng, 120, "t")
    l, r = spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA)
    expected = brute_force(left, right)
    rows = linkage.link(l, r, **search).collect()
    assert len(rows) == len(expected) == len({x.music_track_id for x in rows})
    for row in rows:
        title, artist, match = expected[row.music_track_id]
        assert row.video_track_id == match
        assert row.title_simi == pytest.approx(title, abs=1e-9)
        assert row.artist_simi == pytest.approx(artist, abs=1e-9)
        assert row.total_simi == pytest.approx(title + artist, abs=1e-9)


def test_a_field_without_weight_scores_minus_one(spark):
    left = [("m1", "abc", "xyz", "a"), ("m2", "abd", "xyz", "a")]
    right = [("t1", "abc", "xyz", "a"), ("t2", "abe", "xyz", "a")]
    rows = linkage.link(spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA)).collect()
    found = {r.music_track_id: (r.video_track_id, r.title_simi, r.artist_simi) for r in rows}
    assert found["m1"][0] == "t1" and found["m1"][1] == pytest.approx(1.0)
    assert all(f[2] == -1.0 for f in found.values())


def test_pairs_across_blocks_are_not_scored(spark):
    rows = [("1", "abc", "x", "a"), ("2", "bcd", "y", "b"), ("3", "abd", "y", "a")]
    df = spark.createDataFrame(rows, SCHEMA)
    pairs = spark.createDataFrame([("1", "2"), ("1", "3")], "music_track_id string, video_track_id string")
    scored = linkage.score_pairs(pairs, df, df).collect()
    assert [(r.music_track_id, r.video_track_id) for r in scored] == [("1", "3")]


def test_result_does_not_depend_on_partitions(spark):
    rng = random.Random(5)
    l, r = (spark.createDataFrame(names(rng, 60, m), SCHEMA) for m in "mt")
    one = {tuple(x) for x in linkage.link(l.coalesce(1), r.coalesce(1)).collect()}
    many = {tuple(x) for x in linkage.link(l.repartition(7), r.repartition(5)).collect()}
    assert {(x[0], x[1]) for x in one} == {(x[0], x[1]) for x in many}


def test_lookup_prunes_stored_tables_at_run_time(spark, tmp_path):
    rows = [(f"m{i}", f"t{i}", "abcd"[i % 4]) for i in range(400)]
    pairs = spark.createDataFrame(rows, "music_track_id string, video_track_id string, name_key_1 string")
    clips = pairs.select(F.col("video_track_id").alias("track_id"), "name_key_1", F.lit("u").alias("video_url"))
    lookup.store(pairs, str(tmp_path / "pairs"), "music_track_id")
    lookup.store(clips, str(tmp_path / "clips"), "track_id")
    songs = spark.createDataFrame([("m1", "b"), ("m5", "b"), ("m2", "c"), ("m3", None), ("m4", "b")], "track_id string, name_key_1 string")
    stored = [spark.read.parquet(str(tmp_path / x)) for x in ("pairs", "clips")]
    found = lookup.videos_of_songs(songs, *stored)
    assert sorted(r.video_track_id for r in found.collect()) == ["t1", "t2", "t5"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "dynamicpruning" in plan
    metrics = [line for line in plan.splitlines() if "dynamicpruning" in line]
    assert any("name_key_1" in line and "part" in line for line in metrics)


@pytest.mark.parametrize("search", [{}, {"root": 1.0, "cell_items": 2}])
def test_link_finds_several(spark, search):
    """Copies on both sides count each for itself."""
    left = [("m1", "abc", "x", "a"), ("m2", "abc", "x", "a"), ("m3", "bbd", "y", "a"), ("m4", "c", "z", "b")]
    right = [("t3", "abc", "x", "a"), ("t1", "abc", "x", "a"), ("t2", "abc", "x", "a"), ("t5", "bd", "y", "a"), ("t9", "c", "q", "b")]
    l, r = spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA)
    found = {}
    for row in linkage.link(l, r, k=2, **search).collect():
        found.setdefault(row.music_track_id, set()).add(row.video_track_id)
    assert found == {"m1": {"t1", "t2"}, "m2": {"t1", "t2"}, "m3": {"t5", "t1"}, "m4": {"t9"}}


def test_link_of_some_records_equals_the_rest(spark):
    left = spark.createDataFrame([(f"m{i}", f"name {i % 7} x{i}", "artist", "n") for i in range(30)], "track_id string, song_title string, artist_name string, name_key_1 string")
    right = spark.createDataFrame([(f"t{i}", f"name {i % 5} y{i}", "artist", "n") for i in range(30)], left.schema)
    every = {r.music_track_id: r for r in linkage.link(left, right).collect()}
    some = linkage.link(left, right, only=left.limit(4).select("track_id")).collect()
    assert len(some) == 4 and all(every[r.music_track_id].video_track_id == r.video_track_id for r in some)
