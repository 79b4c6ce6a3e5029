"""Build the searchable name tables of both catalogues."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from refrain.functions.text import first_listed
from refrain.operators.relational import add_name_key, distinct_names, remove_noise
from refrain.sources.grouped_csv import select_group


def split_tracks(tracks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Track names with their first genre, and artist names, out of a two-level-header table."""
    songs = select_group(tracks, "track").select("track_id", "title", "genres")
    return with_first_genre(songs), select_group(tracks, "artist").select("track_id", "name")


def with_first_genre(songs: DataFrame) -> DataFrame:
    return songs.withColumn("genre_1", first_listed(F.col("genres")))


def clean_music_table(songs: DataFrame, artists: DataFrame, genres: DataFrame) -> DataFrame:
    """One cleaned and keyed row per (title, artist), with the genre of the track where it has one.

    Inputs: ``songs (track_id, title, genre_1)``, ``artists (track_id, name)``,
    ``genres (genre_id, title, top_level)``. Of equal (title, artist) the smallest track id stays, which
    is decided before the genres are joined, so that join sees the surviving rows only.
    """
    named = (
        remove_noise(songs.select("track_id", "title", "genre_1"), "title")
        .join(remove_noise(artists.select("track_id", "name"), "name"), "track_id")
        .select(
            "track_id",
            F.col("title").alias("song_title"),
            F.col("name").alias("artist_name"),
            F.col("original_title").alias("original_song_title"),
            F.col("original_name").alias("original_artist_name"),
            "genre_1",
        )
    )
    kept = distinct_names(named, ["song_title", "artist_name"], "track_id")
    dimension = genres.select(F.col("genre_id").alias("genre_1"), F.col("title").alias("subgenre_name"), "top_level")
    return add_name_key(kept.join(dimension, "genre_1", "left"), "music")


def video_name_table(videos: DataFrame) -> DataFrame:
    """Flat video rows with cleaned names, marked track ids and blocking keys."""
    named = videos.withColumnsRenamed(
        {"music_id": "track_id", "music_song": "song_title", "music_artist": "artist_name"}
    )
    return add_name_key(remove_noise(remove_noise(named, "song_title"), "artist_name"), "video")


def top_genres(genres: DataFrame) -> DataFrame:
    """Genres that are the top level of some genre."""
    tops = genres.select(F.col("top_level").alias("genre_id")).distinct()
    return genres.join(tops, "genre_id", "left_semi").select("genre_id", "title")


def vectors_by_genre(vectors: DataFrame, music: DataFrame) -> DataFrame:
    """Vectors with the top genre of their track, ``'None'`` for a track without one; ids are bare in ``vectors``."""
    genre_of = music.select(
        F.col("track_id").alias("marked"), F.coalesce(F.col("top_level").cast("string"), F.lit("None")).alias("genre")
    )
    marked = vectors.withColumn("marked", F.concat(F.lit("m"), F.col("track_id").cast("string")))
    return marked.join(genre_of, "marked").select("track_id", "genre", "features")
