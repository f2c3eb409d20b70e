"""The song catalogue: raw -> silver -> gold -> warehouse."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import SparkSession

from strata.operators.clean import clean_songs
from strata.operators.gate import GatePolicy, NullStats, null_gate, without
from strata.operators.nested import normalize_artists
from strata.plans.load import Run, gated_new_rows
from strata.sources.files import read_layer, write_parquet
from strata.staging import refuse_overlap


@dataclass(frozen=True)
class SongLoad:
    songs: NullStats
    artists: NullStats


def raw_to_silver(spark: SparkSession, raw: str, silver: str, list_mode: str = "split") -> None:
    """Clean raw songs. One scan, no shuffle."""
    refuse_overlap(spark, raw, silver)
    write_parquet(clean_songs(read_layer(spark, raw, "raw"), list_mode), silver)


def silver_to_gold(spark: SparkSession, silver: str, gold: str, policy: GatePolicy = GatePolicy()) -> NullStats:
    """Pass silver songs through the null gate. ``release_date`` is not counted, but rows without it are dropped."""
    refuse_overlap(spark, silver, gold)
    df = read_layer(spark, silver, "silver")
    result = null_gate(df, count_cols=without(df, "release_date"), policy=policy)
    write_parquet(result.kept, gold)
    return result.stats


def load_songs(
    spark: SparkSession,
    gold: str,
    song_table,
    artist_table,
    artist_keys: Sequence[str] = ("id",),
    policy: GatePolicy = GatePolicy(),
    salts: int | None = 1,
    rejects: str | None = None,
    run_id: str | None = None,
) -> SongLoad:
    """Append new gold songs and their artists to the warehouse; ``rejects`` is a folder for the rows gated out.

    Both gates decide before anything is appended; songs are appended first. A load that broke off is repeated under its own
    ``run_id``: what it had decided to append to either table is completed, whatever of it is stored already.
    """
    song_table.create(spark)
    artist_table.create(spark)
    songs = read_layer(spark, gold, "gold")
    artists = normalize_artists(songs)
    counted = without(songs, "release_date")
    gates = {
        "songs": lambda staging: gated_new_rows(songs, song_table, ["id"], staging, "song_keys", policy, counted, salts),
        "artists": lambda staging: gated_new_rows(artists, artist_table, artist_keys, staging, "artist_keys", policy, salts=salts),
    }
    run = Run(spark, run_id, rejects)
    stats = run.decide(gates, {"songs": song_table, "artists": artist_table})
    run.store("songs", song_table)
    run.store("artists", artist_table)
    run.close()
    return SongLoad(stats["songs"], stats["artists"])
