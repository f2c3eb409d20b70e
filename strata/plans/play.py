"""The listening history: raw -> gold -> warehouse."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from strata.operators.clean import clean_plays
from strata.operators.gate import GatePolicy, NullStats
from strata.plans.load import Run, gated_new_rows
from strata.sources.files import read_layer, read_plays, write_parquet
from strata.staging import refuse_overlap


def load_plays(
    spark: SparkSession,
    raw: str,
    gold: str,
    play_table,
    keys: Sequence[str] = ("id",),
    policy: GatePolicy = GatePolicy(),
    uri_prefix: str = "",
    salts: int | None = 1,
    rejects: str | None = None,
    run_id: str | None = None,
) -> NullStats:
    """Clean raw plays to ``gold`` and append the new ones to the warehouse; ``rejects`` receives the rows gated out.

    ``gold`` receives all cleaned rows; only the append is deduplicated and gated. By default any play of a track
    that is already stored is skipped; ``keys=("ts", "id")`` skips only the same play. A load that broke off is repeated
    under its own ``run_id``: what it had decided to append is completed, whatever of it is stored already.
    """
    refuse_overlap(spark, raw, gold)
    play_table.create(spark)
    run = Run(spark, run_id, rejects)
    if not run.repeated:
        write_parquet(clean_plays(read_plays(spark, raw, uri_prefix)), gold)
    plays = read_layer(spark, gold, "gold_play")
    gate = lambda staging: gated_new_rows(plays, play_table, keys, staging, "play_keys", policy, salts=salts)
    stats = run.decide({"plays": gate}, {"plays": play_table})
    run.store("plays", play_table)
    run.close()
    return stats["plays"]
