"""Nested data: list columns to bridge rows, structs to flat columns, catalogue records to raw songs."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import schemas
from strata.functions import text


def explode_zipped(df: DataFrame, keep: Sequence[str], lists: dict[str, str]) -> DataFrame:
    """One row per position of the zipped lists; shorter lists are padded with NULL, NULL lists give no row.

    ``lists`` maps each array column to the name of its element column.
    """
    return df.select(*keep, F.explode(F.arrays_zip(*lists)).alias("__item")).select(
        *keep, *[F.col(f"__item.{src}").alias(out) for src, out in lists.items()]
    )


def normalize_artists(songs: DataFrame) -> DataFrame:
    """The song-artist bridge: one row per song and artist."""
    return explode_zipped(songs, ["id", "name"], {"artists": "artist", "artist_ids": "artist_id"})


def flatten_struct(df: DataFrame, sep: str = ".") -> DataFrame:
    """Every struct field, at any depth, as a column named by its path. Lists stay lists."""

    def leaves(schema: T.StructType, parents: tuple[str, ...]):
        for f in schema:
            path = (*parents, f.name)
            if isinstance(f.dataType, T.StructType):
                yield from leaves(f.dataType, path)
            else:
                yield F.col(".".join(f"`{p}`" for p in path)).alias(sep.join(path))

    return df.select(list(leaves(df.schema, ())))


def flatten_variants(df: DataFrame, column: str = "v", sep: str = ".") -> DataFrame:
    """The records of a VARIANT column as flat columns named by their paths, found by one aggregate over all of them.

    Fields whose type is the same in all records, or a number in all of them, become columns of it, fractions as doubles; objects are
    flattened at any depth, and lists of one plain type stay lists. Where types clash, a number here and an object there, or in lists
    of clashing or nested items, values become text: a string as it is, anything else as JSON. Fields that are null everywhere are
    text, too. A record that lacks a field has NULL there. Records that are no objects make one column ``value``.
    """
    told = df.agg(F.schema_of_variant_agg(column)).first()[0]
    # The notation is that of types in SQL but for one word; names in backquotes are left as they are.
    told = re.sub(r"`(?:[^`]|``)*`|\bOBJECT<", lambda m: "STRUCT<" if m[0] == "OBJECT<" else m[0], told)
    kind = T.DataType.fromDDL(told)
    if not isinstance(kind, T.StructType):
        return df.select(_variant_leaf(column, "$", kind).alias("value"))

    def leaves(schema: T.StructType, at: str, parents: tuple[str, ...]):
        for f in schema:
            if "'" in f.name and '"' in f.name:
                raise ValueError(f"a field's name holds both kinds of quotes: {f.name}")
            quote = "'" if '"' in f.name else '"'
            inner, path = f"{at}[{quote}{f.name}{quote}]", (*parents, f.name)
            if isinstance(f.dataType, T.StructType) and len(f.dataType):
                yield from leaves(f.dataType, inner, path)
            else:
                yield _variant_leaf(column, inner, f.dataType).alias(sep.join(path))

    return df.select(list(leaves(kind, "$", ())))


def _variant_leaf(column: str, path: str, kind: T.DataType) -> Column:
    item = kind.elementType if isinstance(kind, T.ArrayType) else kind
    if isinstance(item, (T.DecimalType, T.FloatType)):
        item = T.DoubleType()
    if isinstance(item, (T.VariantType, T.StructType, T.ArrayType, T.NullType)):
        found = F.try_variant_get(column, path, "variant")
        is_text = F.schema_of_variant(found) == "STRING"
        return F.when(is_text, F.try_variant_get(column, path, "string")).when(~F.is_variant_null(found), F.to_json(found))
    plain = item.simpleString()
    return F.try_variant_get(column, path, f"array<{plain}>" if isinstance(kind, T.ArrayType) else plain)


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames; columns that a frame lacks are NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def track_to_raw_song(df: DataFrame, record: str = "record") -> DataFrame:
    """Nested catalogue records to the raw song columns; audio measures, which the record lacks, are NULL."""
    r = F.col(record)
    album = r["album"]
    given: dict[str, Column] = {
        "id": r["id"],
        "name": r["name"],
        "album": album["name"],
        "album_id": album["id"],
        "artists": text.list_text(F.col(f"{record}.artists.name")),
        "artist_ids": text.list_text(F.col(f"{record}.artists.id")),
        "track_number": r["track_number"],
        "disc_number": r["disc_number"],
        "explicit": r["explicit"],
        "duration_ms": r["duration_ms"],
        "year": F.substring(album["release_date"], 1, 4).try_cast("int"),
        "release_date": album["release_date"],
    }
    return df.filter(r.isNotNull()).select(
        [given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.raw_song_schema()]
    )


def track_popularity(df: DataFrame, record: str = "record") -> DataFrame:
    """``id, popularity`` of the records that were found."""
    r = F.col(record)
    return df.filter(r.isNotNull()).select(r["id"].alias("id"), r["popularity"].alias("popularity"))
