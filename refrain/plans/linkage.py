"""Link the records of two catalogues by the names of title and artist."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from refrain.functions.vectors import NO_WEIGHT, dot
from refrain.operators.neighbours import nearest
from refrain.operators.relational import first_k_per_key, union_sides
from refrain.operators.weights import SLOTS, char_idf, unit_weights, with_char_counts
from refrain.sources.scratch import settle

TITLE, ARTIST, BLOCK = "song_title", "artist_name", "name_key_1"

# A field without weight scores NO_WEIGHT against anything, which is a squared distance of 4. Two extra
# coordinates, one pair for each side, put such a field at just that distance from every other vector.
_LEFT_EMPTY = (math.sqrt(3.0), 0.0)
_RIGHT_EMPTY = (math.sqrt(3.0) / 3.0, math.sqrt(3.0) * math.sqrt(8.0) / 3.0)


def _is_empty(unit: Column) -> Column:
    return ~F.exists(unit, lambda w: w != 0.0)


def _placed(unit: Column, empty: tuple[float, float]) -> Column:
    """Unit vector as a point such that score = 1 - squared distance / 2, also for empty fields."""
    here, elsewhere = F.array(*map(F.lit, empty)), F.array(F.lit(0.0), F.lit(0.0))
    return F.concat(unit, F.when(_is_empty(unit), here).otherwise(elsewhere))


def _from_distance(squared: Column) -> Column:
    """Cosine from the squared distance of unit vectors; weights are never negative, so above 2 a field was empty."""
    return F.when(squared > 3.0, F.lit(NO_WEIGHT)).otherwise(1.0 - squared / 2.0)


def field_score(left: Column, right: Column) -> Column:
    """Cosine of two unit vectors, ``NO_WEIGHT`` where either has no weight."""
    return F.when(_is_empty(left) | _is_empty(right), F.lit(NO_WEIGHT)).otherwise(dot(left, right))


def count_sides(left: DataFrame, right: DataFrame, id_column: str, block: str, fields: Sequence[str]) -> DataFrame:
    """Character counts of both sides, written once: texts do not survive the scan."""
    columns = [id_column, block, *fields]
    both = union_sides({"left": left.select(columns), "right": right.select(columns)})
    return settle(with_char_counts(both, fields), "counts")


def settled_idf(counts: DataFrame, block: str, fields: Sequence[str]) -> DataFrame:
    """IDF per block, written first: with its size known a small one is broadcast, and no record moves for it."""
    return settle(char_idf(counts, block, fields), "idf")


def _scores(pairs: DataFrame, title: str, artist: str) -> DataFrame:
    scored = pairs.withColumns(
        {
            "title_simi": field_score(F.col(f"l_{title}"), F.col(f"r_{title}")),
            "artist_simi": field_score(F.col(f"l_{artist}"), F.col(f"r_{artist}")),
        }
    )
    return scored.withColumn("total_simi", F.col("title_simi") + F.col("artist_simi"))


def score_pairs(
    pairs: DataFrame,
    left: DataFrame,
    right: DataFrame,
    left_id: str = "music_track_id",
    right_id: str = "video_track_id",
    id_column: str = "track_id",
    block: str = BLOCK,
    title: str = TITLE,
    artist: str = ARTIST,
) -> DataFrame:
    """Scores of given id pairs whose members share a block: title, artist and their sum."""
    fields = [title, artist]
    counts = count_sides(left, right, id_column, block, fields)
    weighted = unit_weights(counts, settled_idf(counts, block, fields), block, fields)

    def side(name: str, mark: str, pair_id: str) -> DataFrame:
        return weighted.where(F.col("side") == name).select(
            F.col(id_column).alias(pair_id), F.col(block).alias(f"{mark}block"), *[F.col(f).alias(mark + f) for f in fields]
        )

    joined = pairs.join(side("left", "l_", left_id), left_id).join(side("right", "r_", right_id), right_id)
    same = joined.where(F.col("l_block") == F.col("r_block")).withColumn(block, F.col("l_block"))
    return _scores(same, title, artist).select(left_id, right_id, block, "title_simi", "artist_simi", "total_simi")


def link(
    left: DataFrame,
    right: DataFrame,
    left_id: str = "music_track_id",
    right_id: str = "video_track_id",
    id_column: str = "track_id",
    block: str = BLOCK,
    title: str = TITLE,
    artist: str = ARTIST,
    only: DataFrame | None = None,
    k: int = 1,
    prune: bool = True,
    **search,
) -> DataFrame:
    """The best right record, or the ``k`` best, of every left one that has any in its block.

    The best total score counts, equal ones (to 9 places) go to the smallest right id. Records with the
    same vectors are searched once. The sum of two cosines is two minus half the squared distance of the
    joined unit vectors, so the search is an exact nearest-neighbour search and forms no pairs. ``prune`` and ``search``
    go to ``nearest``.

    ``only``, a table with the column ``id_column``, restricts the left records that are searched; weights come from all
    records all the same. Counts, weights and the search run, and are written, when this is called.
    """
    fields = [title, artist]
    # The digest leads the grouping, so that sorting and joining compare a number before they compare arrays.
    counts = count_sides(left, right, id_column, block, fields).withColumn("digest", F.xxhash64(*fields))
    idf = settled_idf(counts, block, fields)
    if only is not None:
        wanted = counts.where(F.col("side") == "left").join(only.select(id_column).distinct(), id_column, "left_semi")
        counts = settle(counts.where(F.col("side") == "right").unionByName(wanted), "wanted")
    same = ["digest", "side", block, *fields]
    alike = counts.groupBy(*same).agg(F.min(id_column).alias("first_id"))
    if k > 1:  # copies of a right record may all be among the best
        copies = first_k_per_key(counts.where(F.col("side") == "right"), same, [F.col(id_column)], k)
        alike = alike.where(F.col("side") == "left").unionByName(copies.select(*same, F.col(id_column).alias("first_id")))
    alike = settle(alike, "alike")

    def points(side: str, empty: tuple[float, float], id_name: str) -> DataFrame:
        units = unit_weights(alike.where(F.col("side") == side), idf, block, fields)
        vector = F.concat(*[_placed(F.col(f), empty) for f in fields])
        return units.select(block, F.col("first_id").alias(id_name), vector.alias("v"))

    width = SLOTS + 2
    found = nearest(
        points("left", _LEFT_EMPTY, "l_first"),
        points("right", _RIGHT_EMPTY, "r_first"),
        group=block,
        query_id="l_first",
        item_id="r_first",
        vector="v",
        k=k,
        spans=[(0, width), (width, 2 * width)],
        quantum=2e-9,
        clean=True,
        prune=prune,
        **search,
    )

    # Which distinct left record each left one is, by 128 bits of its counts; only ids go on from here.
    digest = ["digest", F.xxhash64(F.lit(1), *fields).alias("digest_2"), block]
    first = alike.where(F.col("side") == "left").select(*digest, F.col("first_id").alias("l_first"))
    members = counts.where(F.col("side") == "left").select(*digest, F.col(id_column).alias(left_id))
    known = members.join(first, ["digest", "digest_2", block]).select(left_id, block, "l_first")

    scored = found.select(
        "l_first",
        F.col("r_first").alias(right_id),
        _from_distance(F.col("parts")[0]).alias("title_simi"),
        _from_distance(F.col("parts")[1]).alias("artist_simi"),
    ).withColumn("total_simi", F.col("title_simi") + F.col("artist_simi"))
    return known.join(scored, "l_first").select(left_id, right_id, "title_simi", "artist_simi", "total_simi", block)
