"""The jobs as commands: ``spark-submit strata/__main__.py JOB ...`` or ``python -m strata JOB ...``.

Cluster, storage and memory settings are spark-submit's business.
"""

from __future__ import annotations

import argparse
import importlib
import sys

from pyspark.sql import SparkSession

from strata import schemas
from strata.operators.gate import GatePolicy
from strata.operators.quality import Suite, flag_rows, unique_violations, validate
from strata.plans import backfill as backfill_jobs
from strata.plans import play, prepare, song
from strata.sources import files, tables, zones
from strata.streaming.plays import stream_plays


def table(name: str, ddl: str, a: argparse.Namespace):
    """A database table with ``--jdbc-url``, else a folder when the name looks like a path, else a catalog table."""
    if a.jdbc_url:
        properties = dict(p.split("=", 1) for p in a.jdbc_property)
        return tables.JdbcTable(a.jdbc_url, name, ddl, properties, a.jdbc_reads, a.jdbc_create)
    return tables.ParquetTable(name, ddl) if "/" in name else tables.ManagedTable(name, ddl)


def policy(a) -> GatePolicy:
    return GatePolicy(a.max_rate, a.few, a.on_exceed)


def ingest(spark, a):
    schema = schemas.schema_for(a.schema) if a.schema else None
    print(zones.ingest_csv(spark, a.source, a.target, schema, a.drop, a.multi_line, a.block))


def raw_to_silver(spark, a):
    song.raw_to_silver(spark, a.source, a.target, a.list_mode)


def silver_to_gold(spark, a):
    print(song.silver_to_gold(spark, a.source, a.target, policy(a)))


def load_songs(spark, a):
    songs, artists = table(a.songs, schemas.GOLD_SONG_DDL, a), table(a.artists, schemas.GOLD_ARTIST_DDL, a)
    done = song.load_songs(spark, a.source, songs, artists, a.artist_keys, policy(a), rejects=a.rejects, run_id=a.run_id)
    print(done)


def load_plays(spark, a):
    plays = table(a.plays, schemas.GOLD_PLAY_DDL, a)
    done = play.load_plays(
        spark, a.source, a.gold, plays, a.keys, policy(a), a.uri_prefix, rejects=a.rejects, run_id=a.run_id
    )
    print(done)


def follow_plays(spark, a):
    plays = table(a.plays, schemas.GOLD_PLAY_DDL, a)
    done = stream_plays(
        spark, a.source, a.gold, plays, a.checkpoint, a.keys, policy(a), a.uri_prefix, rejects=a.rejects
    )
    print(done)


def archive(spark, a):
    print(zones.archive_zone(spark, a.source, a.target, a.run_id, a.rename))


def split(spark, a):
    print(prepare.split_csv(spark, files.read_csv(spark, a.source), a.target, a.min_rows, a.max_rows, a.seed))


def named_function(name: str):
    """The function that ``module:function`` names."""
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def backfill(spark, a):
    """Look up played tracks that the catalogue lacks; ``--songs`` is a silver song layer."""
    plays = files.read_layer(spark, a.source, "gold_play")
    songs = files.read_layer(spark, a.songs, "silver")
    print(backfill_jobs.backfill_missing(spark, plays, songs, named_function(a.fetch), a.target))


def popularity(spark, a):
    """Look up the popularity of all songs of a silver layer."""
    songs = files.read_layer(spark, a.source, "silver")
    print(backfill_jobs.enrich_popularity(spark, songs, named_function(a.fetch), a.target))


def json_to_csv(spark, a):
    prepare.json_to_csv(spark, a.source, a.target, lines=a.lines)


def filter_csv(spark, a):
    prepare.filter_csv_to_parquet(spark, a.source, a.target, a.condition)


def check(spark, a):
    """Write the result of a suite, and the rows that break it; exit with 1 when a rule fails."""
    df, suite = spark.read.parquet(a.source), Suite.load(a.suite)
    parameters = {k: float(v) for k, v in (p.split("=", 1) for p in a.parameter)}
    files.write_parquet(validate(df, suite, parameters), f"{a.target}/result")
    files.write_parquet(flag_rows(df, suite, parameters), f"{a.target}/rows")
    files.write_parquet(unique_violations(df, suite), f"{a.target}/duplicates")
    failed = spark.read.parquet(f"{a.target}/result").filter("NOT success").count()
    print(f"{failed} of {len(suite.rules)} rules failed")
    return 1 if failed else 0


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="strata", description=__doc__)
    jobs = top.add_subparsers(required=True)

    def into_tables(p):
        p.add_argument("--rejects")
        p.add_argument("--run-id", help="repeat a load that broke off under its id")
        p.add_argument("--jdbc-url", help="tables are a database's")
        p.add_argument("--jdbc-property", nargs="*", default=[], help="name=value")
        p.add_argument("--jdbc-reads", type=int, default=1, help="tasks that read stored keys")
        p.add_argument("--jdbc-create", action="store_true", help="create tables that are missing")

    def job(run, *names, gate=False, target=True):
        p = jobs.add_parser(run.__name__.replace("_", "-"), help=run.__doc__)
        p.set_defaults(run=run)
        p.add_argument("--source", required=True)
        for name in (["target"] if target else []) + list(names):
            p.add_argument(f"--{name}", required=True)
        if gate:
            p.add_argument("--max-rate", type=float, default=0.1)
            p.add_argument("--few", type=int, default=10)
            p.add_argument("--on-exceed", default="error", choices=["error", "keep", "quarantine"])
        return p

    p = job(ingest)
    p.add_argument("--schema", choices=sorted(schemas.SCHEMAS))
    p.add_argument("--drop", nargs="*", default=[])
    p.add_argument("--single-line", dest="multi_line", action="store_false", help="no line breaks inside quotes")
    p.add_argument("--block", type=int, help="cut files among tasks in blocks of so many bytes, at the ends of records")
    job(raw_to_silver).add_argument("--list-mode", default="split", choices=["split", "literal"])
    job(silver_to_gold, gate=True)
    p = job(load_songs, "songs", "artists", gate=True, target=False)
    p.add_argument("--artist-keys", nargs="+", default=["id"])
    into_tables(p)
    p = job(load_plays, "gold", "plays", gate=True, target=False)
    p.add_argument("--keys", nargs="+", default=["id"])
    p.add_argument("--uri-prefix", default="")
    into_tables(p)
    p = job(follow_plays, "gold", "plays", "checkpoint", gate=True, target=False)
    p.add_argument("--keys", nargs="+", default=["id"])
    p.add_argument("--uri-prefix", default="")
    into_tables(p)
    job(archive, "run-id").add_argument("--rename", action="store_true")
    p = job(split)
    p.add_argument("--min-rows", type=int, default=10_000)
    p.add_argument("--max-rows", type=int, default=200_000)
    p.add_argument("--seed", type=int, default=0)
    job(backfill, "songs", "fetch")
    job(popularity, "fetch")
    job(json_to_csv).add_argument("--lines", action="store_true")
    job(filter_csv, "condition")
    job(check, "suite").add_argument("--parameter", nargs="*", default=[], help="name=number")
    return top


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"strata {a.run.__name__}").getOrCreate()
    return a.run(spark, a) or 0


if __name__ == "__main__":
    sys.exit(main())
