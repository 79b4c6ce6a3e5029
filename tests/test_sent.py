"""How much is sent and how many tasks there are, whatever the parameters."""

import random

from pyspark.sql import functions as F

from refrain.operators import cells, neighbours
from refrain.sources import records


def test_small_ranges_are_read_by_few_tasks(spark):
    files = spark.createDataFrame([("a", 5 << 20), ("b", 3 << 20)], "path string, length long")
    assert records._tasks(files, 1 << 10) == spark.sparkContext.defaultParallelism
    assert records._tasks(spark.createDataFrame([("a", 100 << 30)], files.schema), 1 << 10) == 3200


def test_a_query_is_sent_once_per_block_and_round(spark, monkeypatch):
    """However small cells and tiles are: vectors without structure, of which every query visits all regions."""
    rng = random.Random(4)
    n = 600
    points = [(1, i, [rng.gauss(0, 1) for _ in range(24)]) for i in range(n)]
    items = spark.createDataFrame(points, "g int, i int, v array<double>").coalesce(2)
    sent = {"queries": 0, "cells": 0}
    dealt = cells._dealt

    def counted(rows, by, others, parts, key):
        if len(key) == 2:  # queries and cells
            sent["queries"] += rows.count()
            sent["cells"] += others.join(parts, key).agg(F.sum("parts")).first()[0]
        return dealt(rows, by, others, parts, key)

    monkeypatch.setattr(cells, "_dealt", counted)
    found = neighbours.nearest(items.withColumnRenamed("i", "q"), items, "g", "q", "i", "v", k=2, prune=True, root=2.0, cell_items=8, tile_queries=8)
    assert found.count() == 2 * n
    rounds = len(cells.FIRST_VISITS) + 1
    assert sent["queries"] <= rounds * n and sent["cells"] <= rounds * n / 2
