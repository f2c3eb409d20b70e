"""Reporting views over the gold tables, as DataFrames, session views or catalog views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The columns of each report, in order, and where they come from.
USER_VIEW = {
    "album_artist_name": "album_artist_name",
    "track_name": "track_name",
    "track_id": "id",
    "album_name": "album_name",
    "seconds_played": "seconds_played",
    "activity_date": "to_date(ts)",
    "hour_of_day": "hour(ts)",
    "day_of_week": "date_format(ts, 'E')",
    "month_of_year": "month(ts)",
}
TRACK_MEASURES = [
    "energy", "loudness", "danceability", "speechiness", "acousticness", "instrumentalness", "liveness",
    "valence", "tempo",
]
TRACK_VIEW = {
    "track_id": "id",
    **{c: c for c in ["album_id", "year", "key", "mode", *TRACK_MEASURES]},
    # NULL, not an error, when there is no artist.
    "primary_artist_id": "get(artist_ids, 0)",
}
ARTIST_VIEW = {"artist": "artist", "artist_id": "artist_id"}


def _columns(view: dict[str, str]) -> list[str]:
    return [f"{source} AS {name}" for name, source in view.items()]


def user_view(plays: DataFrame) -> DataFrame:
    """Plays with the parts of their time."""
    return plays.selectExpr(*_columns(USER_VIEW))


def track_view(songs: DataFrame) -> DataFrame:
    """Tracks with their measures and first artist."""
    return songs.selectExpr(*_columns(TRACK_VIEW))


def artist_view(artists: DataFrame) -> DataFrame:
    """Artist names and ids, one row per song they appear on."""
    return artists.selectExpr(*_columns(ARTIST_VIEW))


def create_views(spark: SparkSession, songs: DataFrame, plays: DataFrame, artists: DataFrame) -> None:
    """(Re)create ``user_view``, ``track_view`` and ``artist_view`` for the session."""
    user_view(plays).createOrReplaceTempView("user_view")
    track_view(songs).createOrReplaceTempView("track_view")
    artist_view(artists).createOrReplaceTempView("artist_view")


def create_catalog_views(
    spark: SparkSession, song_table: str, play_table: str, artist_table: str, suffix: str = ""
) -> None:
    """(Re)create the three views in the catalog, over stored gold tables, for every session to see."""
    views = {
        "user_view": (USER_VIEW, play_table),
        "track_view": (TRACK_VIEW, song_table),
        "artist_view": (ARTIST_VIEW, artist_table),
    }
    for name, (view, table) in views.items():
        spark.sql(f"CREATE OR REPLACE VIEW {name}{suffix} AS SELECT {', '.join(_columns(view))} FROM {table}")
