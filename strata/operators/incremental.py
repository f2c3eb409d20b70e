"""Incremental loading: what is new, what is missing, what dangles.

Lookup keys are reduced to distinct values before they are shuffled, so a key that fills a third of the stored
table costs one row per map task. Rows without a key can match nothing and are spread over all reducers.

A hot key on the other side is left to adaptive execution: the salt column makes both join inputs fresh shuffles, the
shape whose oversized partitions ``spark.sql.adaptive.skewJoin`` splits, down to a part of one map output. Where that
is switched off, ``salts`` spreads each key over that many reducers, at the price of as many copies of the lookup keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.gate import any_null, with_rate

_SALT = "__salt"


def known_keys(existing: DataFrame, keys: Sequence[str] = ("id",)) -> DataFrame:
    """The distinct keys of a stored table, without NULLs, which match nothing."""
    return existing.select(*keys).filter(~any_null(keys)).distinct()


def _probe(df: DataFrame, known: DataFrame, keys: Sequence[str], how: str, salts: int | None) -> DataFrame:
    if salts is None:
        return df.join(known, list(keys), how).select(df.columns)
    # The map partition number is the same in every attempt of a task, unlike rand(), and it also spreads copies of
    # one and the same row, unlike a hash of the row.
    part = F.spark_partition_id()
    salted = df.withColumn(_SALT, F.when(any_null(keys), part).otherwise(F.pmod(part, F.lit(salts))))
    spread = known.withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(spread, [*keys, _SALT], how).select(df.columns)


def drop_existing(
    df: DataFrame,
    existing: DataFrame,
    keys: Sequence[str] = ("id",),
    salts: int | None = 1,
    distinct: bool = False,
) -> DataFrame:
    """Rows of ``df`` whose key is not in ``existing``. Rows with a NULL key stay; copies within ``df`` stay.

    ``salts=None`` leaves the join unsalted, for tables bucketed by the key. ``distinct`` says that ``existing`` is a
    result of :func:`known_keys`, as one that was staged for several uses.
    """
    return _probe(df, existing if distinct else known_keys(existing, keys), keys, "left_anti", salts)


def keep_existing(
    df: DataFrame, existing: DataFrame, keys: Sequence[str] = ("id",), salts: int | None = 1
) -> DataFrame:
    """Rows of ``df`` whose key is in ``existing``."""
    return _probe(df, known_keys(existing, keys), keys, "left_semi", salts)


def new_row_stats(
    df: DataFrame, known: DataFrame, keys: Sequence[str] = ("id",), count_cols: Sequence[str] | None = None
) -> DataFrame:
    """:func:`strata.operators.gate.null_stats` of the rows that :func:`drop_existing` would leave.

    Rows are first counted per key, so two numbers per key are shuffled instead of whole rows, and a hot key is one
    row per map task. ``known`` is a result of :func:`known_keys`.
    """
    bad = any_null(count_cols or df.columns)
    per_key = df.groupBy(*keys).agg(F.count_if(bad).alias("__null"), F.count(F.lit(1)).alias("__rows"))
    fresh = per_key.join(known, list(keys), "left_anti")
    total = [F.coalesce(F.sum(c), F.lit(0)).alias(n) for c, n in (("__null", "n_null"), ("__rows", "n_rows"))]
    return with_rate(fresh.agg(*total))


def missing_keys(df: DataFrame, catalogue: DataFrame, key: str = "id", drop_blank: bool = False) -> DataFrame:
    """Distinct keys of ``df`` absent from ``catalogue``, the NULL key among them.

    ``drop_blank`` leaves out NULL and the empty string, which no lookup can resolve.
    """
    wanted = df.select(key)
    if drop_blank:
        wanted = wanted.filter(F.col(key).isNotNull() & (F.col(key) != ""))
    # Both sides come out of their distinct hashed by the key, so the join adds no shuffle.
    return wanted.distinct().join(catalogue.select(key).distinct(), key, "left_anti")


def fk_violations(
    child: DataFrame, parent: DataFrame, child_key: str = "id", parent_key: str = "id", salts: int | None = 1
) -> DataFrame:
    """Rows of ``child`` that refer to no row of ``parent``. A NULL reference is no violation."""
    refs = parent.select(F.col(parent_key).alias(child_key))
    children = child.filter(F.col(child_key).isNotNull())
    return drop_existing(children, refs, [child_key], salts)
