"""Bloom filters of stored keys, kept beside a table: one part for each load, merged by OR.

A filter is a table of blocks of 512 bits. A key's hash names one block, and a second hash a few bits in it, so that a filter is
built by one aggregate with partial results, merged by another, and asked by one join on the block's number. A key whose bits are
not all set was never stored: its rows are new and go on without a shuffle. The others, the stored ones and a small share of
false hits, go to the exact join.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.gate import any_null
from strata.operators.incremental import drop_existing, known_keys
from strata.staging import path_exists

#: Words of 64 bits in a block, and bits set by a key.
WORDS, PROBES = 8, 6
#: Bytes of a block as a row, about.
BLOCK_BYTES = 8 * WORDS + 16
_BLOCK, _MAYBE = "__block", "__maybe"
_BITS = [f"__w{i}" for i in range(WORDS)]
SCHEMA = T.StructType([T.StructField(_BLOCK, T.LongType()), *[T.StructField(w, T.LongType()) for w in _BITS]])


def _block(keys: Sequence[str], n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(0), *[F.col(k).cast("string") for k in keys]), F.lit(n_blocks))


def _words(keys: Sequence[str]) -> list[Column]:
    """The key's bits in each word of its block."""
    second = F.xxhash64(F.lit(1), *[F.col(k).cast("string") for k in keys])
    places = [F.pmod(F.shiftright(second, 9 * i), F.lit(64 * WORDS)) for i in range(PROBES)]
    bit = lambda place: F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(64)).cast("int"))
    none = F.lit(0).cast("long")
    inside = lambda place, w: F.when(place.between(64 * w, 64 * w + 63), bit(place)).otherwise(none)
    return [reduce(Column.bitwiseOR, [inside(place, w) for place in places]) for w in range(WORDS)]


def blocks_of(keys: DataFrame, names: Sequence[str], n_blocks: int) -> DataFrame:
    """The filter of a frame's keys; rows with a NULL key, which match nothing, set no bit. Rows may repeat."""
    marked = keys.filter(~any_null(names)).select(_block(names, n_blocks).alias(_BLOCK), *[w.alias(n) for w, n in zip(_words(names), _BITS)])
    return marked.groupBy(_BLOCK).agg(*[F.bit_or(n).alias(n) for n in _BITS])


class KeyFilter:
    """The filter of one table's keys in a folder, a sub-folder for each load.

    ``n_blocks`` is fixed for the folder: about one block for every 50 keys keeps false hits near one in a hundred, fewer blocks
    only send more rows to the exact join. Up to ``most_bytes`` the merged filter is broadcast; a larger one is not used, and
    rows are joined exactly, all of them. Keys are hashed as text, so that types of equal text agree. Every load has to be
    added before the next one asks, and :meth:`rebuild` makes the filter anew from a table that was written without.
    """

    def __init__(
        self, spark: SparkSession, folder: str, keys: Sequence[str] = ("id",), n_blocks: int = 1 << 17, most_bytes: int = 64 << 20
    ):
        self.spark, self.keys, self.n_blocks, self.most_bytes = spark, list(keys), n_blocks, most_bytes
        self.folder = f"{folder.rstrip('/')}/blocks={n_blocks}"

    @property
    def usable(self) -> bool:
        return self.n_blocks * BLOCK_BYTES <= self.most_bytes

    def add(self, stored: DataFrame, run_id: str) -> None:
        """Keep the keys of a load; repeated under its ``run_id`` it replaces its own part."""
        blocks_of(stored, self.keys, self.n_blocks).coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/run_id={run_id}")

    def rebuild(self, existing: DataFrame) -> None:
        """One part for all that is stored, instead of those there are; also makes many parts one."""
        whole = blocks_of(known_keys(existing, self.keys), self.keys, self.n_blocks)
        whole.withColumn("run_id", F.lit("rebuilt")).write.mode("overwrite").partitionBy("run_id").parquet(self.folder)

    def merged(self) -> DataFrame:
        """The blocks of all loads, each once; no loads give an empty filter."""
        if not path_exists(self.spark, self.folder):
            return self.spark.createDataFrame([], SCHEMA)
        parts = self.spark.read.schema(SCHEMA).parquet(self.folder)
        return parts.groupBy(_BLOCK).agg(*[F.bit_or(n).alias(n) for n in _BITS])

    def flagged(self, df: DataFrame) -> DataFrame:
        """``df`` with whether each row's key may be stored; false is certain."""
        asked = df.withColumn("__at", F.when(~any_null(self.keys), _block(self.keys, self.n_blocks)))
        merged = self.merged().select(F.col(_BLOCK).alias("__at"), *_BITS)
        met = asked.join(F.broadcast(merged), "__at", "left")
        own = _words(self.keys)
        maybe = reduce(Column.__and__, [F.col(n).bitwiseAND(w) == w for n, w in zip(_BITS, own)])
        return met.select(*[df[c] for c in df.columns], F.coalesce(maybe, F.lit(False)).alias(_MAYBE))


def drop_existing_filtered(df: DataFrame, existing: DataFrame, known: KeyFilter, salts: int | None = 1) -> DataFrame:
    """As :func:`strata.operators.incremental.drop_existing`; only rows that the filter does not rule out are joined.

    ``df`` is read twice, once for either kind of row, and so should be a plain or staged read.
    """
    if not known.usable:
        return drop_existing(df, existing, known.keys, salts)
    flagged = known.flagged(df)
    rest = flagged.filter(_MAYBE).select(df.columns)
    return flagged.filter(~F.col(_MAYBE)).select(df.columns).union(drop_existing(rest, existing, known.keys, salts))
