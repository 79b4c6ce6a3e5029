"""Nested video records, one JSON object per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

CORRUPT = "corrupt_record"

# The fields of the records and the flat columns made of them.
VIDEO_SCHEMA = (
    "itemInfos struct<id: string, video: struct<urls: array<string>>, covers: array<string>>, "
    "musicInfos struct<musicId: string, authorName: string, musicName: string, playUrl: array<string>>"
)

FLAT_COLUMNS = {
    "video_id": "itemInfos.id",
    "video_url": "itemInfos.video.urls",
    "video_covers": "itemInfos.covers",
    "music_id": "musicInfos.musicId",
    "music_artist": "musicInfos.authorName",
    "music_song": "musicInfos.musicName",
    "music_url": "musicInfos.playUrl",
}
FIRST_OF_ARRAY = {"video_url", "video_covers", "music_url"}


def read_videos(spark: SparkSession, path: str) -> DataFrame:
    """Video records; a malformed line keeps its text in ``corrupt_record``."""
    return (
        spark.read.schema(f"{VIDEO_SCHEMA}, {CORRUPT} string")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )


def flatten_videos(videos: DataFrame) -> DataFrame:
    """The seven flat columns; of an array the first element, NULL where there is none.

    A malformed line stays a row of NULLs with its text in ``corrupt_record``, if ``videos`` has that column.
    """
    cells = []
    for name, source in FLAT_COLUMNS.items():
        value = F.col(source)
        cells.append((F.get(value, F.lit(0)) if name in FIRST_OF_ARRAY else value).alias(name))
    return videos.select(*cells, *[c for c in videos.columns if c == CORRUPT])
