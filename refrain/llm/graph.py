"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from refrain.sources.scratch import settle


def components(links: DataFrame) -> DataFrame:
    """``node``, ``label`` of every node in ``links`` (``a``, ``b``): the smallest node that can be reached.

    In each round a node, and the node that stands for it, takes the smallest label seen across a link, then the
    label of its label; the number of rounds grows with the logarithm of a component's width. A node with very many
    links is only ever a key of joins against written tables and of partial minima. Each round is written, so
    a lost executor costs its own tasks.
    """
    both = links.select("a", "b").union(links.select("b", "a")).filter("a <> b").distinct()
    both = settle(both, "links")
    labels = settle(both.select(F.col("a").alias("node")).distinct().withColumn("label", F.col("node")), "labels")
    while True:
        at = labels.toDF("a", "label_a")
        to = labels.toDF("b", "label_b")
        across = both.join(at, "a").join(to, "b").filter("label_b < label_a")
        offers = across.select(
            F.explode(F.array_distinct(F.array("a", "label_a"))).alias("node"), F.col("label_b").alias("offer")
        )
        best = offers.groupBy("node").agg(F.min("offer").alias("offer"))
        taken = labels.join(best, "node", "left").select("node", F.least("label", "offer").alias("label"), F.col("offer").isNotNull().alias("new"))
        taken = settle(taken, "labels")
        if taken.filter("new").isEmpty():
            return labels
        above = taken.select(F.col("node").alias("label"), F.col("label").alias("above"))
        labels = settle(taken.join(above, "label").select("node", F.col("above").alias("label")), "labels")


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (of ``components``) after more ``links``; only what these join is worked on."""
    own = labels.select("node", "label")
    at = links.select("a", "b").join(own.toDF("a", "label_a"), "a", "left").join(own.toDF("b", "label_b"), "b", "left")
    between = at.select(F.coalesce("label_a", "a").alias("a"), F.coalesce("label_b", "b").alias("b"))
    joined = components(between)
    moved = own.join(joined.toDF("label", "to"), "label", "left").select("node", F.coalesce("to", "label").alias("label"))
    return settle(moved.union(joined.join(own.select("node"), "node", "left_anti").select("node", "label")), "labels")
