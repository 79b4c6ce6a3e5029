"""One row per key: ties, missing keys, digests that collide, keys that are long texts."""

import random

import pytest
from pyspark.sql import functions as F

from refrain.operators import relational

SCHEMA = "id long, title string, artist string, score double"


def rows():
    chooser = random.Random(2)
    out = [(i, chooser.choice(["a", "b", None, "", "x" * 5000]), chooser.choice(["p", "q", None]), chooser.choice([1.0, 2.0, None])) for i in range(300)]
    return out + [(i, "tie", "t", 5.0) for i in (903, 901, 902)]


@pytest.fixture(params=["digests", "one digest for all"])
def digests(request, monkeypatch):
    if request.param != "digests":
        monkeypatch.setattr(F, "xxhash64", lambda *columns: F.lit(7).cast("long"))


def test_names_go_to_the_smallest_id(spark, digests):
    df = spark.createDataFrame(rows(), SCHEMA).repartition(5)
    found = {(r.title, r.artist): (r.id, r.score) for r in relational.distinct_names(df, ["title", "artist"], "id").collect()}
    wanted = {}
    for i, title, artist, score in sorted(rows()):
        wanted.setdefault((title, artist), (i, score))
    assert found == wanted


def test_best_scores_with_ties(spark, digests):
    df = spark.createDataFrame(rows(), SCHEMA).repartition(5)
    found = {r.title: r.id for r in relational.best_match(df, "title", "id", "score").collect()}
    wanted = {}
    for i, title, _, score in rows():
        rank = (score is None, -(score or 0), i)
        wanted[title] = min(wanted.get(title, rank), rank)
    assert found == {k: v[2] for k, v in wanted.items()} and found["tie"] == 901


def test_last_rows(spark, digests):
    df = spark.createDataFrame(rows(), SCHEMA).where("title IS NOT NULL").repartition(5)
    found = {r.title: r.id for r in relational.last_per_key(df, ["title"], ["id"]).collect()}
    assert found == {t: max(i for i, x, *_ in rows() if x == t) for t in {r[1] for r in rows()} - {None}}


def test_rows_are_sorted_by_the_digest_first(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    plan = relational.distinct_names(df, ["title", "artist"], "id")._jdf.queryExecution().executedPlan().toString()
    assert "Sort [__digest" in plan and "SortAggregate(key=[__digest" in plan
