"""Song, play and key-set inputs derived from the driver's ``part`` and ``events`` tables.

Every text runs unchanged in Spark SQL and in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.staging import spread

RAW_SONG = """
SELECT
  concat('trk', cast(p_partkey AS varchar(20))) AS id,
  CASE WHEN p_partkey % 97 = 0 THEN NULL ELSE concat('  ', p_name, ' ') END AS name,
  concat(' ', p_type, ' ') AS album,
  concat('alb', cast(p_size AS varchar(20))) AS album_id,
  CASE WHEN p_partkey % 50 = 1 THEN '[''Earth, Wind & Fire'']'
       WHEN p_partkey % 50 = 2 THEN '["D''Arc"]'
       WHEN p_partkey % 50 = 3 THEN '[]'
       ELSE concat('[''', p_brand, ''', ''', p_type, ''']') END AS artists,
  CASE WHEN p_partkey % 50 IN (1, 2) THEN concat('[''a', cast(p_size AS varchar(20)), ''']')
       WHEN p_partkey % 50 = 3 THEN '[]'
       ELSE concat('[''a', cast(p_size AS varchar(20)), ''', ''b', cast(p_size AS varchar(20)), ''']') END AS artist_ids,
  cast(1 + p_partkey % 15 AS int) AS track_number,
  cast(1 + p_partkey % 2 AS int) AS disc_number,
  CASE WHEN p_partkey % 101 = 0 THEN 'nan' WHEN p_partkey % 3 = 0 THEN 'True' ELSE ' FALSE ' END AS explicit,
  cast((p_partkey * 7919) % 100003 AS double) / 100003 AS danceability,
  cast((p_partkey * 6101) % 100003 AS double) / 100003 AS energy,
  cast(CASE WHEN p_partkey % 29 = 0 THEN -1 ELSE p_partkey % 12 END AS int) AS key,
  0 - cast((p_partkey * 4049) % 600011 AS double) / 10007 AS loudness,
  cast(p_partkey % 2 AS int) AS mode,
  cast((p_partkey * 3571) % 100003 AS double) / 100003 AS speechiness,
  cast((p_partkey * 2953) % 100003 AS double) / 100003 AS acousticness,
  cast((p_partkey * 2333) % 100003 AS double) / 100003 AS instrumentalness,
  cast((p_partkey * 1979) % 100003 AS double) / 100003 AS liveness,
  cast((p_partkey * 1607) % 100003 AS double) / 100003 AS valence,
  60 + cast((p_partkey * 1301) % 140009 AS double) / 1009 AS tempo,
  p_partkey * 137 AS duration_ms,
  cast(3 + p_partkey % 3 AS int) AS time_signature,
  cast(1950 + p_partkey % 70 AS int) AS year,
  CASE WHEN p_partkey % 5 = 0 THEN '1998'
       ELSE concat(cast(1950 + p_partkey % 70 AS varchar(10)), '-0', cast(1 + p_partkey % 9 AS varchar(10)), '-15') END AS release_date
FROM part
"""

RAW_PLAY = """
SELECT
  event_id,
  ts,
  CASE event_type WHEN 'view' THEN 'Android OS 9' WHEN 'click' THEN 'Windows 10' WHEN 'purchase' THEN 'iOS 13'
       WHEN 'signup' THEN ' WebPlayer windows ' ELSE 'OS X' END AS platform,
  cast(floor(value * 1000) AS bigint) AS ms_played,
  concat('Track ', cast(event_id % 2500 AS varchar(20))) AS master_metadata_track_name,
  concat('Artist ', cast(user_id AS varchar(20))) AS master_metadata_album_artist_name,
  concat('Album ', cast(event_id % 50 AS varchar(20))) AS master_metadata_album_album_name,
  CASE WHEN event_id % 20 = 0 THEN NULL
       WHEN event_id % 13 = 0 THEN concat('svc:track:new', cast(event_id % 700 AS varchar(20)))
       ELSE concat('svc:track:trk', cast(event_id % 2500 AS varchar(20))) END AS track_uri
FROM events
"""

GOLD_SONG_IDS = "SELECT concat('trk', cast(p_partkey AS varchar(20))) AS id FROM part WHERE p_partkey % 7 = 0"
GOLD_PLAY_IDS = "SELECT concat('trk', cast(p_partkey AS varchar(20))) AS id FROM part WHERE p_partkey % 9 = 0"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _derived(spark: SparkSession, source: DataFrame, sql: str, name: str) -> DataFrame:
    return spark.sql(sql.replace(f"FROM {name}", f"FROM {{{name}}}"), **{name: source})


def raw_songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw songs, many times as wide as the rows they are made of, which are dealt to all cores before."""
    return _derived(spark, spread(table(spark, sf_dir, "part")), RAW_SONG, "part")


def raw_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw plays, with their time as the text that a history export holds."""
    as_text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return _derived(spark, table(spark, sf_dir, "events"), RAW_PLAY, "events").withColumn("ts", as_text)


def gold_song_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derived(spark, table(spark, sf_dir, "part"), GOLD_SONG_IDS, "part")


def gold_play_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derived(spark, table(spark, sf_dir, "part"), GOLD_PLAY_IDS, "part")
