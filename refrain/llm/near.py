"""Near-duplicate documents by min-max hashing: candidates from bands, links confirmed on whole shingle sets."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from refrain.llm.common import LOWER_CASE, as_bytes, content_key, map_rows, mixed, shingle_hashes, with_columns, word_hashes
from refrain.llm.graph import components, merged
from refrain.sources.scratch import settle

#: Words of a shingle, and the similarity from which documents are linked, in per cent.
WIDTH, PERCENT = 5, 80
#: A band is the minimum and the maximum under each of two permutations. A pair of similarity 0.8 misses all bands
#: with a chance below 2 in a million.
BANDS, PER_BAND = 26, 2
#: Shingles that are put through all permutations at a time.
CHUNK = 2048

_seeds = mixed(np.arange(1, 2 * BANDS * PER_BAND + 1, dtype=np.uint64))
_FACTORS = (_seeds[::2] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_SHIFTS = (_seeds[1::2] >> np.uint64(32)).astype(np.uint32)


def shingle_set(data: bytes, width: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text."""
    return np.unique(shingle_hashes(word_hashes(data.translate(LOWER_CASE)), width))


def band_hashes(shingles: np.ndarray) -> np.ndarray:
    """A hash for each band of a set; one evaluation of a permutation gives both its minimum and its maximum."""
    values = shingles.astype(np.uint32)
    least = np.full(len(_FACTORS), 0xFFFFFFFF, np.uint32)
    most = np.zeros(len(_FACTORS), np.uint32)
    for i in range(0, len(values), CHUNK):
        permuted = values[i : i + CHUNK, None] * _FACTORS + _SHIFTS
        np.minimum(least, permuted.min(axis=0), out=least)
        np.maximum(most, permuted.max(axis=0), out=most)
    out = np.arange(1, BANDS + 1, dtype=np.uint64)
    for j in range(PER_BAND):
        for part in (least[j::PER_BAND], most[j::PER_BAND]):
            out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + part)
    return out.view(np.int64)


def sign(docs: DataFrame, text: str, id: str, width: int) -> DataFrame:
    """``id``, the key of the row, ``n_shingles``, ``node`` (digest of the set; null if empty) and ``bands``."""
    chosen = docs.select(
        F.col(id).alias("id"), *content_key(F.col(id), F.col(text)), F.coalesce(F.col(text), F.lit("")).alias("text")
    )

    def rows(batch: dict[str, pa.Array]) -> dict[str, object]:
        sizes, nodes, bands = [], [], []
        for data in as_bytes(batch["text"]):
            found = shingle_set(data, width)
            sizes.append(len(found))
            nodes.append(xxhash.xxh3_128_digest(found) if len(found) else None)
            bands.append(band_hashes(found) if len(found) else None)
        return batch | {"n_shingles": sizes, "node": nodes, "bands": bands}

    return map_rows(chosen, with_columns(chosen.drop("text"), "n_shingles long, node binary, bands array<long>"), rows)


def shared_buckets(signed: DataFrame) -> DataFrame:
    """``bucket``, ``node``, ``n`` of every bucket that different sets share; equal sets are one node."""
    sized = signed.filter("node IS NOT NULL").select("node", F.col("n_shingles").alias("n"), "bands")
    distinct = settle(sized.dropDuplicates(["node"]), "distinct-sets")
    spread = distinct.select("node", "n", F.explode("bands").alias("bucket"))
    shared = spread.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).filter("members > 1").select("bucket")
    return settle(spread.join(settle(shared, "shared-buckets"), "bucket"), "members")


def sets_of(docs: DataFrame, signed: DataFrame, members: DataFrame, text: str, id: str, width: int) -> DataFrame:
    """``node``, ``shingles`` (the whole set, as bytes) of the nodes in ``members``."""
    nodes = members.select("node").distinct()
    rows_of = signed.join(nodes, "node", "left_semi").groupBy("node").agg(F.min(F.struct("key_1", "key_2")).alias("key"))
    keyed = docs.select(*content_key(F.col(id), F.col(text)), F.col(text).alias("text"))
    met = keyed.join(rows_of.select("node", F.col("key.key_1").alias("key_1"), F.col("key.key_2").alias("key_2")), ["key_1", "key_2"])
    met = met.select("node", "text").dropDuplicates(["node"])

    def rows(batch: dict[str, pa.Array]) -> dict[str, object]:
        return {"node": batch["node"], "shingles": [shingle_set(x, width).tobytes() for x in as_bytes(batch["text"])]}

    return settle(map_rows(met, "node binary, shingles binary", rows), "sets")


def with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    return pairs.join(sets.toDF("node", "set"), "node").join(sets.toDF("head", "head_set"), "head")


def common(one: np.ndarray, two: np.ndarray) -> int:
    """Number of shared members of two sorted sets."""
    both = np.concatenate((one, two))
    both.sort(kind="stable")
    return int((both[1:] == both[:-1]).sum())


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``head``, ``node`` and ``linked`` of the given pairs, from their whole sets."""

    def rows(batch: dict[str, pa.Array]) -> dict[str, object]:
        linked = []
        for x, y in zip(batch["head_set"], batch["set"]):
            one, two = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
            likely = 100 * min(len(one), len(two)) >= percent * max(len(one), len(two))
            shared = common(one, two) if likely else 0
            linked.append(likely and 100 * shared >= percent * (len(one) + len(two) - shared))
        return {"head": batch["head"], "node": batch["node"], "linked": linked}

    met = with_sets(pairs.select("head", "node"), sets).select("head", "node", "head_set", "set")
    return map_rows(met, "head binary, node binary, linked boolean", rows)


def head_pairs(members: DataFrame, round_: int) -> DataFrame:
    """Every member of a bucket with one head of it, drawn by hash anew for each bucket and round, if labels differ."""
    order = F.struct(F.xxhash64(F.lit(round_), "bucket", "node").alias("draw"), "node", "label")
    heads = members.groupBy("bucket").agg(F.min(order).alias("head"))
    heads = settle(heads.select("bucket", F.col("head.node").alias("head"), F.col("head.label").alias("head_label")), "heads")
    met = members.select("bucket", "node", "label").join(heads, "bucket").filter("label <> head_label")
    return met.select(F.least("head", "node").alias("head"), F.greatest("head", "node").alias("node")).distinct()


def open_members(members: DataFrame, labels: DataFrame) -> DataFrame:
    """The members of buckets with several components, with their ``label``."""
    own = members.drop("label").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    own = settle(own.select("bucket", "node", "n", "label"), "labelled")
    several = own.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high")
    return settle(own.join(settle(several.select("bucket"), "open"), "bucket"), "open-members")


def across(nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of ``nodes`` (``node``, ``n``, ``label``) of different labels that may be similar enough; none is left out.

    A prefix filter. Shingles that sets of only one label have can't be shared across labels; a set in which fewer
    than ``percent`` of the shingles are left has no partner. The others are put in order, the rarest first. Two
    partners then share one of their first shingles, as many as a set can be without; and from the first shared one
    on, both must have as many shingles left as similar sets of their sizes share. Near-copies whose edits are their
    own fail these tests without ever meeting, however many there are.
    """
    held = nodes.join(sets, "node")

    def rows(batch: dict[str, pa.Array]) -> dict[str, object]:
        tokens = [np.frombuffer(x.as_buffer(), np.int64) for x in batch["shingles"]]
        return {c: batch[c] for c in ("node", "n", "label")} | {"tokens": tokens}

    found = map_rows(held, "node binary, n long, label binary, tokens array<long>", rows)
    spread = settle(found.select("node", "n", "label", F.explode("tokens").alias("token")), "shingles")
    shared = spread.groupBy("token").agg(
        F.count(F.lit(1)).alias("sets"), F.min("label").alias("low"), F.max("label").alias("high")
    )
    shared = settle(shared.filter("low <> high").select("token", "sets"), "shared-shingles")
    own = spread.join(shared, "token").groupBy("node", "n", "label").agg(
        F.sort_array(F.collect_list(F.struct("sets", "token"))).alias("tokens")
    )
    must = F.ceil(F.col("n") * percent / 100)
    spare = F.size("tokens") - must
    first = F.slice("tokens", F.lit(1), F.greatest(spare + 1, F.lit(0)).cast("int"))
    left = own.withColumn("size", F.size("tokens")).filter(spare >= 0)
    left = left.select("node", "n", "label", "size", F.posexplode(first).alias("place", "first"))
    left = settle(
        left.select("node", "n", "label", F.col("first.token").alias("token"), (F.col("size") - F.col("place")).alias("rest")),
        "first-shingles",
    )
    other = left.select(*[F.col(c).alias(f"other_{c}" if c != "token" else c) for c in left.columns])
    needed = (F.col("n") + F.col("other_n")) * percent / (100 + percent)
    met = left.join(other, "token").filter(
        (F.col("node") < F.col("other_node"))
        & (F.col("label") != F.col("other_label"))
        & (100 * F.least("n", "other_n") >= percent * F.greatest("n", "other_n"))
        & (F.least("rest", "other_rest") >= needed)
    )
    return met.select(F.col("node").alias("head"), F.col("other_node").alias("node")).distinct()


def links(members: DataFrame, sets: DataFrame, percent: int, rounds: int = 2) -> DataFrame | None:
    """``node``, ``label`` of the components of all nodes that have links; None if there are none.

    A bucket is never turned into all its pairs. In each round its members meet one head of it, unless they are in its
    component already. That joins most of what belongs together; then the members of buckets that still hold several
    components meet across these as the prefix filter of ``across`` lets them, so that no pair of a bucket that is similar
    enough is left out.
    """
    tried = labels = None
    waiting = members.withColumn("label", F.col("node"))
    for round_ in range(rounds + 1):
        if round_ < rounds:
            pairs = head_pairs(waiting, round_)
        else:
            pairs = across(waiting.select("node", "n", "label").distinct(), sets, percent)
        if tried is not None:
            pairs = pairs.join(tried.select("head", "node"), ["head", "node"], "left_anti")
        new = settle(confirmed(settle(pairs, "pairs"), sets, percent), "confirmed")
        tried = new if tried is None else tried.union(new)
        linked = new.filter("linked").toDF("a", "b", "linked")
        if not linked.isEmpty():
            labels = components(linked) if labels is None else merged(labels, linked)
            if round_ < rounds:
                waiting = open_members(waiting, labels)
    return labels


def near_duplicates(docs: DataFrame, text: str = "text", id: str = "doc_id", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: id, ``key_1``, ``key_2``, ``n_shingles``, ``component_id``, ``kept``, ``stays``.

    A document's set holds its distinct shingles of ``width`` words (between ASCII white space, A-Z lowered), or all
    its words as one if there are fewer. Documents are linked if their sets' similarity is ``percent`` or more;
    ``component_id`` is the smallest id that can be reached, ``kept`` says that the id is that one, and ``stays`` is
    true for one row content of each component.

    Texts that are null or have no words have an empty set, no links, and stay. Null ids come last among the ids of a
    component. Rows that agree in id and text have the same key and result. An empty table gives no rows. Other
    columns are ignored; ``key_1`` and ``key_2`` are those of ``content_key(id, text)``.
    """
    signed = settle(sign(docs, text, id, width), "signed")
    members = shared_buckets(signed)
    labels = links(members, sets_of(docs, signed, members, text, id, width), percent)
    first = F.struct(F.col("id").isNull().alias("none"), "id", "key_1", "key_2")
    classes = signed.filter("node IS NOT NULL").groupBy("node").agg(F.min(first).alias("first"))
    if labels is None:
        classes = classes.withColumn("label", F.col("node"))
    else:
        classes = classes.join(labels, "node", "left").select("node", F.coalesce("label", "node").alias("label"), "first")
    classes = settle(classes, "classes")
    firsts = settle(classes.groupBy("label").agg(F.min("first").alias("first")), "firsts")
    of_node = classes.select("node", "label").join(firsts, "label").select("node", "first")
    met = signed.drop("bands").join(settle(of_node, "components"), "node", "left")
    alone = F.col("node").isNull()
    component = F.when(alone, F.col("id")).otherwise(F.col("first.id"))
    stays = alone | ((F.col("key_1") == F.col("first.key_1")) & (F.col("key_2") == F.col("first.key_2")))
    return met.select(
        F.col("id").alias(id),
        "key_1",
        "key_2",
        "n_shingles",
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
        stays.alias("stays"),
    )


def drop_near_duplicates(docs: DataFrame, text: str = "text", id: str = "doc_id", **options) -> DataFrame:
    """``docs`` with one document of each component; see ``near_duplicates``. Rows equal in id and text are one document."""
    found = near_duplicates(docs, text, id, **options).filter("stays")
    stay = found.select(F.col("key_1").alias("of_1"), F.col("key_2").alias("of_2"))
    rows = docs.select(F.struct("*").alias("row"), *content_key(F.col(id), F.col(text)))
    met = rows.join(stay, (F.col("key_1") == F.col("of_1")) & (F.col("key_2") == F.col("of_2")), "left_semi")
    return met.dropDuplicates(["key_1", "key_2"]).select("row.*")
