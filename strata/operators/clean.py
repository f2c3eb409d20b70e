"""Cleaning projections: one ``select`` built from a table of column rules."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata import schemas
from strata.functions import numeric, temporal, text

# Output column -> (input column, rule). A rule of None gives a NULL of the declared type.
Rules = Mapping[str, tuple[str, Callable[[Column], Column] | None]]


def keep(c: Column) -> Column:
    return c


def song_rules(list_mode: str = "split") -> dict:
    rules: dict = {name: (name, keep) for name in schemas.SONG_COLUMNS}
    rules |= {name: (name, text.trimmed) for name in ("name", "album")}
    rules |= {name: (name, partial(text.list_items, mode=list_mode)) for name in schemas.SONG_LISTS}
    rules |= {name: (name, partial(numeric.rounded, digits=3)) for name in schemas.SONG_FEATURES_3}
    rules |= {name: (name, partial(numeric.rounded, digits=4)) for name in schemas.SONG_FEATURES_4}
    rules["explicit"] = ("explicit", text.to_boolean)
    rules["key"] = ("key", numeric.pitch_name)
    rules["mode"] = ("mode", numeric.mode_name)
    rules["duration_ms"] = ("duration_ms", numeric.whole_seconds)
    rules["release_date"] = ("release_date", temporal.to_day)
    return rules


def play_rules(uri_column: str) -> dict:
    return {
        "id": (uri_column, text.uri_id),
        "ts": ("ts", temporal.to_wall_clock),
        "platform": ("platform", text.platform),
        "seconds_played": ("ms_played", numeric.whole_seconds_int),
        "track_name": ("master_metadata_track_name", keep),
        "album_artist_name": ("master_metadata_album_artist_name", keep),
        "album_name": ("master_metadata_album_album_name", keep),
        "type": (uri_column, text.uri_type),
    }


def apply_rules(df: DataFrame, rules: Rules, schema=None) -> DataFrame:
    """Select one output column per rule, in the order of ``rules``."""
    types = {f.name: f.dataType for f in schema} if schema else {}
    cols = []
    for name, (source, rule) in rules.items():
        c = F.lit(None).cast(types.get(name, "string")) if rule is None else rule(F.col(source))
        cols.append(c.alias(name))
    return df.select(cols)


def clean_songs(df: DataFrame, list_mode: str = "split", overrides: Rules | None = None) -> DataFrame:
    """Raw songs to the 24 typed silver columns."""
    return apply_rules(df, song_rules(list_mode) | dict(overrides or {}), schemas.silver_song_schema())


def track_uri_column(df: DataFrame) -> str:
    """The track URI column, whatever prefix the exporting service gave it."""
    found = [c for c in df.columns if c.endswith("track_uri")]
    if len(found) != 1:
        raise ValueError(f"expected one column ending in track_uri, found {found}")
    return found[0]


def clean_plays(df: DataFrame, uri_column: str | None = None, overrides: Rules | None = None) -> DataFrame:
    """Raw listening history to the 8 gold columns."""
    rules = play_rules(uri_column or track_uri_column(df))
    return apply_rules(df, rules | dict(overrides or {}), schemas.gold_play_schema())
