"""From a query vector to the videos that use similar music, over tables that are stored once for many lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from refrain.functions.text import tagged_id
from refrain.operators.neighbours import nearest_to_point
from refrain.operators.relational import last_per_key
from refrain.sources.scratch import settle
from refrain.sources.tables import append_partitioned

#: Parts by the hash of an id that a table is stored in, so that a lookup of few ids reads few of them.
PARTS = 16


def part_of(id_column: Column, parts: int = PARTS) -> Column:
    return F.pmod(F.xxhash64(id_column.cast("string")), F.lit(parts)).cast("int")


def store(df: DataFrame, path: str, id_column: str, block: str | None = "name_key_1", parts: int = PARTS) -> None:
    """``df`` as a table for lookups by ``id_column``: partitioned by ``block``, if it has one, and by ``part`` of the id."""
    append_partitioned(df.withColumn("part", part_of(F.col(id_column), parts)), path, [*([block] if block else []), "part"])


def found_by(few: DataFrame, stored: DataFrame, id_column: str, block: str | None = "name_key_1", parts: int = PARTS) -> DataFrame:
    """The rows of a ``stored`` table (see ``store``) for the ids, and blocks, of ``few`` rows.

    ``few`` is written first, so that Spark knows its size. While that is small enough to be broadcast, the join prunes
    the partitions of the stored table at run time; a larger one is shuffled against all of it, with the same result.
    """
    known = settle(few.withColumn("part", part_of(F.col(id_column), parts)), "looked-up")
    keys = [*([block] if block else []), "part", id_column]
    # Rows without a key match nothing; that Spark sees them filtered is also what makes it prune the other side.
    return known.where(F.col("part") >= 0).join(stored, keys).drop("part")


def similar_songs(
    vectors: DataFrame, music: DataFrame, genre: str, point: Sequence[float], k: int = 5
) -> DataFrame:
    """The ``k`` songs of a genre nearest to ``point``, with their original names and blocking key.

    ``music`` may be stored by ``store`` without a block; then only the parts of these songs are read.
    """
    hits = nearest_to_point(vectors, point, "track_id", "features", k, group=("genre", genre))
    marked = hits.select(tagged_id(F.col("track_id"), "music").alias("track_id"), "distance")
    columns = ["track_id", "original_song_title", "original_artist_name", "name_key_1"]
    if "part" in music.columns:
        return found_by(marked, music.select(*columns, "part"), "track_id", block=None)
    return marked.join(music.select(columns), "track_id")


def videos_of_songs(songs: DataFrame, pairs: DataFrame, videos: DataFrame, block: str = "name_key_1") -> DataFrame:
    """All videos of the best match of each song.

    ``pairs`` are stored by ``music_track_id`` and ``videos`` by ``track_id`` (see ``store``), both by ``block`` too. ``songs``
    are the few hits of a search; they and their matches are written when this is called, and only the partitions they
    lie in are read.
    """
    asked = songs.select(F.col("track_id").alias("music_track_id"), block)
    matched = found_by(asked, pairs, "music_track_id", block).withColumnRenamed("video_track_id", "track_id")
    return found_by(matched, videos, "track_id", block).withColumnRenamed("track_id", "video_track_id")


def covers_by_url(videos: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per video url and ``keys``: the last one under ``order``."""
    return last_per_key(videos, [*keys, "video_url"], order)
