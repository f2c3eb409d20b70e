"""Filling gaps in the catalogue through a lookup service."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import schemas
from strata.functions import text
from strata.operators.enrich import distinct_keys, lookup, lookup_report, parsed
from strata.operators.incremental import missing_keys
from strata.operators.nested import track_popularity, track_to_raw_song
from strata.sources.files import write_csv, write_parquet
from strata.staging import Staging

log = logging.getLogger(__name__)
MANY_KEYS = 10_000


def as_uris(keys: DataFrame, prefix: str, key: str = "id") -> DataFrame:
    """Keys as resource identifiers, for services that want those."""
    return keys.select(text.build_uri(F.col(key), prefix).alias(key))


def _counts(report: DataFrame) -> dict[str, int]:
    # At most four statuses, so four rows.
    counts = {r["status"]: r["n"] for r in report.collect()}
    asked = sum(counts.values())
    if asked > MANY_KEYS:
        log.warning("%d keys were looked up, more than %d", asked, MANY_KEYS)
    return counts


def backfill_missing(
    spark: SparkSession,
    plays: DataFrame,
    songs: DataFrame,
    fetch: Callable[[list], list],
    out: str,
    mode: str = "overwrite",
    **options,
) -> dict[str, int]:
    """Look up played tracks that the catalogue lacks and write them as raw songs, ready for the song job.

    Returns the number of keys per lookup status. Keys and records stay in DataFrames; the replies are staged, so
    each key is asked for once. ``options`` go to :func:`strata.operators.enrich.lookup`.
    """
    with Staging(spark) as staging:
        wanted = missing_keys(plays, songs, drop_blank=True)
        replies = staging.put(lookup(wanted, "id", fetch, **options), "replies")
        write_parquet(track_to_raw_song(parsed(replies, schemas.track_schema())), out, mode)
        return _counts(lookup_report(replies))


def enrich_popularity(
    spark: SparkSession, rows: DataFrame, fetch: Callable[[list], list], out: str, key: str = "id", **options
) -> dict[str, int]:
    """Look up the popularity of all distinct keys and write ``id, popularity`` as CSV."""
    options = {"attempts": 5, "pause": (0.1, 0.1)} | options
    with Staging(spark) as staging:
        replies = staging.put(lookup(distinct_keys(rows, key), key, fetch, **options), "replies")
        write_csv(track_popularity(parsed(replies, schemas.track_schema())), out)
        return _counts(lookup_report(replies))
