"""Declared schemas of every layer, target table definitions and type enforcement."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from strata.sql import literal, quoted

# Column names and order of the song layers.
SONG_TEXT = ["id", "name", "album", "album_id"]
SONG_LISTS = ["artists", "artist_ids"]
SONG_FEATURES_3 = ["danceability", "energy", "loudness", "liveness", "valence", "tempo"]
SONG_FEATURES_4 = ["speechiness", "acousticness", "instrumentalness"]
SONG_COLUMNS = [
    "id", "name", "album", "album_id", "artists", "artist_ids", "track_number", "disc_number", "explicit",
    "danceability", "energy", "key", "loudness", "mode", "speechiness", "acousticness", "instrumentalness",
    "liveness", "valence", "tempo", "duration_ms", "time_signature", "year", "release_date",
]

# Columns of a cleaned play, in the order the cleaning job writes them.
PLAY_COLUMNS = [
    "id", "ts", "platform", "seconds_played", "track_name", "album_artist_name", "album_name", "type",
]


def _struct(names: list[str], types: dict[str, str], default: str) -> T.StructType:
    return T.StructType([T.StructField(n, T._parse_datatype_string(types.get(n, default)), True) for n in names])


def raw_song_schema() -> T.StructType:
    ints = ["track_number", "disc_number", "key", "mode", "time_signature", "year"]
    types = dict.fromkeys(ints, "int") | dict.fromkeys(SONG_FEATURES_3 + SONG_FEATURES_4, "double")
    return _struct(SONG_COLUMNS, types | {"duration_ms": "bigint"}, "string")


def silver_song_schema() -> T.StructType:
    """What cleaning produces: pitch names in ``key`` and whole seconds, as a double, in ``duration_ms``."""
    ints = ["track_number", "disc_number", "time_signature", "year"]
    types = dict.fromkeys(ints, "int") | dict.fromkeys(SONG_FEATURES_3 + SONG_FEATURES_4, "double")
    types |= dict.fromkeys(SONG_LISTS, "array<string>")
    types |= {"explicit": "boolean", "duration_ms": "double", "release_date": "date"}
    return _struct(SONG_COLUMNS, types, "string")


def raw_play_schema(uri_prefix: str = "") -> T.StructType:
    """The listening-history export; its track and episode URI columns carry the exporting service's prefix."""
    names = [
        "ts", "platform", "ms_played", "conn_country", "master_metadata_track_name",
        "master_metadata_album_artist_name", "master_metadata_album_album_name", f"{uri_prefix}track_uri",
        "episode_name", "episode_show_name", f"{uri_prefix}episode_uri", "audiobook_title", "audiobook_uri",
        "audiobook_chapter_uri", "audiobook_chapter_title", "reason_start", "reason_end", "shuffle", "skipped",
        "offline", "offline_timestamp", "incognito_mode",
    ]
    types = dict.fromkeys(["shuffle", "skipped", "incognito_mode"], "boolean")
    return _struct(names, types | {"ms_played": "int", "offline_timestamp": "bigint"}, "string")


def gold_play_schema() -> T.StructType:
    return _struct(PLAY_COLUMNS, {"ts": "timestamp_ntz", "seconds_played": "int"}, "string")


def artist_schema() -> T.StructType:
    return _struct(["id", "name", "artist", "artist_id"], {}, "string")


def track_schema() -> T.StructType:
    """A nested catalogue record, as a lookup service returns it."""
    return T._parse_datatype_string(
        "id string, name string, album struct<id: string, name: string, release_date: string>, "
        "artists array<struct<id: string, name: string>>, track_number int, disc_number int, "
        "explicit boolean, duration_ms bigint, popularity int"
    )


SCHEMAS = {
    "raw": raw_song_schema,
    "silver": silver_song_schema,
    "gold": silver_song_schema,
    "raw_play": raw_play_schema,
    "gold_play": gold_play_schema,
    "artist": artist_schema,
}


def schema_for(kind: str) -> T.StructType:
    if kind not in SCHEMAS:
        raise ValueError(f"unknown data type {kind!r}, expected one of {sorted(SCHEMAS)}")
    return SCHEMAS[kind]()


def empty_frame(spark: SparkSession, kind: str) -> DataFrame:
    return spark.createDataFrame([], schema_for(kind))


def enforce(df: DataFrame, schema: T.StructType, missing: str = "error", misfit: str = "null") -> DataFrame:
    """Project ``df`` to ``schema`` by name. A value that does not fit its type becomes NULL, or with ``misfit='error'``
    fails the job.

    Whole numbers written as ``5.0`` (a column that once had gaps) read as 5; a fraction does not fit a whole number.
    ``missing='null'`` fills absent columns with typed NULLs.
    """
    if misfit not in ("null", "error"):
        raise ValueError(f"unknown treatment of values that do not fit: {misfit!r}")
    absent = [f.name for f in schema if f.name not in df.columns]
    if absent and missing != "null":
        raise ValueError(f"columns missing from the input: {absent}")
    have = {f.name: f.dataType for f in df.schema}
    fitted = [(f, _fit(f, have.get(f.name))) for f in schema]
    if misfit == "error":
        fitted = [(f, _or_error(f, e)) if f.name in have and have[f.name] != f.dataType else (f, e) for f, e in fitted]
    return df.selectExpr(*[f"{e} AS {quoted(f.name)}" for f, e in fitted])


def _or_error(field: T.StructField, fitted: str) -> str:
    c = quoted(field.name)
    told = f"concat({literal(f'{field.name} does not fit {field.dataType.simpleString()}: ')}, CAST({c} AS STRING))"
    return f"CASE WHEN {c} IS NOT NULL AND ({fitted}) IS NULL THEN raise_error({told}) ELSE {fitted} END"


def _fit(field: T.StructField, have: T.DataType | None) -> str:
    """SQL that brings a column to its declared type."""
    want, c = field.dataType.simpleString(), quoted(field.name)
    if have is None:
        return f"CAST(NULL AS {want})"
    if have == field.dataType:
        return c
    if isinstance(field.dataType, T.IntegralType) and isinstance(have, T.StringType):
        number = f"try_cast({c} AS DECIMAL(38, 6))"
        return f"coalesce(try_cast({c} AS {want}), {_whole(number, want)})"
    if isinstance(field.dataType, T.IntegralType) and isinstance(have, (T.FractionalType, T.DecimalType)):
        return _whole(c, want)
    if isinstance(have, (T.ArrayType, T.StructType)) or isinstance(field.dataType, (T.ArrayType, T.StructType)):
        return f"CAST({c} AS {want})"
    return f"try_cast({c} AS {want})"


def _whole(number: str, want: str) -> str:
    return f"CASE WHEN {number} % 1 = 0 THEN try_cast({number} AS {want}) END"


# Types and lengths of the warehouse tables.
GOLD_SONG_DDL = (
    "id VARCHAR(255), name STRING, album STRING, album_id VARCHAR(255), "
    "artists ARRAY<VARCHAR(255)>, artist_ids ARRAY<VARCHAR(255)>, track_number INT, disc_number INT, "
    "explicit BOOLEAN, danceability DOUBLE, energy DOUBLE, key VARCHAR(10), loudness DOUBLE, mode VARCHAR(5), "
    "speechiness DOUBLE, acousticness DOUBLE, instrumentalness DOUBLE, liveness DOUBLE, valence DOUBLE, "
    "tempo DOUBLE, duration_ms BIGINT, time_signature INT, year INT, release_date DATE"
)
GOLD_PLAY_DDL = (
    "ts TIMESTAMP_NTZ, id VARCHAR(255), platform VARCHAR(20), seconds_played INT, track_name VARCHAR(255), "
    "album_artist_name VARCHAR(255), album_name VARCHAR(255), type VARCHAR(20)"
)
GOLD_ARTIST_DDL = "id VARCHAR(255), name VARCHAR(255), artist VARCHAR(255), artist_id VARCHAR(255)"

SONG_KEY = ["id"]
ARTIST_KEY = ["id", "artist_id"]


def target_schema(ddl: str) -> T.StructType:
    """The Spark type of a table definition; bounded text reads back as plain strings."""
    return T._parse_datatype_string(_unbounded(ddl))


def length_limits(ddl: str) -> dict[str, int]:
    """Column to longest allowed text, taken from the VARCHAR(n) of a table definition."""
    limits = {}
    for part in ddl.split(", "):
        name, kind = part.split(" ", 1)
        if "VARCHAR(" in kind:
            limits[name] = int(kind.split("VARCHAR(")[1].split(")")[0])
    return limits


def _unbounded(ddl: str) -> str:
    for n in sorted(set(length_limits(ddl).values())):
        ddl = ddl.replace(f"VARCHAR({n})", "STRING")
    return ddl
