"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query runs once to warm up and three times for the record; the reported time is the median. With --shapes the
same results are also computed the step-by-step way (an action per metric, a job per rule, a pass per count), to
measure what the one-pass plans save.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
import uuid

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from strata import schemas  # noqa: E402
from strata.operators import gate, incremental, nested, quality  # noqa: E402
from strata.plans import play, prepare, song  # noqa: E402
from strata.sources import files, tables  # noqa: E402
from strata.staging import shared_dir  # noqa: E402
from workload import fixtures as fx  # noqa: E402
from workload import queries as q  # noqa: E402

HEADLINE = [
    "song_silver", "null_gate_song", "artist_normalized", "song_incremental", "play_clean", "play_incremental",
    "missing_ids", "dq_song_suite", "dq_play_suite", "dq_unique_violations", "track_view", "user_view",
    "profile_columns", "split_chunk_sizes", "lookup_status",
]
RUNS = 3


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("strata-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df) -> None:
    """Compute every row, write none."""
    df.write.format("noop").mode("overwrite").save()


class Jobs:
    """Whole jobs over files prepared once; each run writes to a new folder."""

    def __init__(self, spark, d):
        self.spark, self.d = spark, d
        self.root = f"{shared_dir(spark)}/bench/{uuid.uuid4().hex}"
        self.raw_song, self.raw_play = f"{self.root}/raw_song", f"{self.root}/raw_play"
        self.gold_song, self.silver_song = f"{self.root}/gold", f"{self.root}/silver"
        files.write_parquet(fx.raw_songs(spark, d), self.raw_song)
        files.write_parquet(fx.raw_plays(spark, d).drop("event_id"), self.raw_play)
        song.raw_to_silver(spark, self.raw_song, self.silver_song)
        song.silver_to_gold(spark, self.silver_song, self.gold_song)

    def new(self) -> str:
        return f"{self.root}/{uuid.uuid4().hex}"

    def song_raw_to_silver(self):
        song.raw_to_silver(self.spark, self.raw_song, self.new())

    def song_silver_to_gold(self):
        song.silver_to_gold(self.spark, self.silver_song, self.new())

    def song_load(self):
        songs = tables.ParquetTable(self.new(), schemas.GOLD_SONG_DDL)
        artists = tables.ParquetTable(self.new(), schemas.GOLD_ARTIST_DDL)
        song.load_songs(self.spark, self.gold_song, songs, artists)

    def play_load(self):
        table = tables.ParquetTable(self.new(), schemas.GOLD_PLAY_DDL)
        play.load_plays(self.spark, self.raw_play, self.new(), table)

    def split_csv(self):
        prepare.split_csv(self.spark, fx.table(self.spark, self.d, "lineitem"), self.new())

    # --- the same results, step by step ---

    def stepwise_raw_to_silver(self):
        df = files.read_layer(self.spark, self.raw_song, "raw")
        df.count()
        df.limit(5).collect()
        cleaned = q.clean.clean_songs(df)
        cleaned.limit(5).collect()
        cleaned.count()
        files.write_parquet(cleaned, self.new())

    def _two_pass_gate(self, df, cols):
        n_null, n_rows = df.filter(gate.any_null(cols)).count(), df.count()
        assert not n_rows or n_null / n_rows < 0.1 or n_null <= 10
        return df.dropna()

    def stepwise_silver_to_gold(self):
        df = files.read_layer(self.spark, self.silver_song, "silver")
        files.write_parquet(self._two_pass_gate(df, gate.without(df, "release_date")), self.new())

    def stepwise_song_load(self):
        songs = tables.ParquetTable(self.new(), schemas.GOLD_SONG_DDL)
        artists = tables.ParquetTable(self.new(), schemas.GOLD_ARTIST_DDL)
        songs.create(self.spark)
        artists.create(self.spark)
        df = files.read_layer(self.spark, self.gold_song, "gold")
        df.limit(10).collect()
        bridge = nested.normalize_artists(df)
        bridge.limit(50).collect()
        df = df.join(songs.read(self.spark, ["id"]), "id", "left_anti")
        df = self._two_pass_gate(df, gate.without(df, "release_date"))
        bridge = bridge.join(artists.read(self.spark, ["id"]), "id", "left_anti")
        bridge = self._two_pass_gate(bridge, bridge.columns)
        df.count()
        songs.append(df)
        artists.append(bridge)

    def stepwise_play_load(self):
        table = tables.ParquetTable(self.new(), schemas.GOLD_PLAY_DDL)
        table.create(self.spark)
        raw = files.read_plays(self.spark, self.raw_play)
        raw.count()
        df = q.clean.clean_plays(raw)
        df.limit(5).collect()
        df.count()
        files.write_parquet(df, self.new())
        df = df.join(table.read(self.spark, ["id"]), "id", "left_anti")
        df = self._two_pass_gate(df, df.columns)
        raw.count()
        table.append(df)

    def _rule_by_rule(self, df, suite):
        for rule in suite.rules:
            quality.validate(df, quality.Suite("one", [rule])).collect()

    def stepwise_song_suite(self):
        self._rule_by_rule(q.silver(self.spark, self.d), quality.song_suite(2025))

    def stepwise_play_suite(self):
        self._rule_by_rule(q.plays(self.spark, self.d), quality.play_suite())

    def stepwise_missing_ids(self):
        # All ids through the driver.
        found = incremental.missing_keys(q.plays(self.spark, self.d), q.silver(self.spark, self.d))
        ids = [r["id"] for r in found.collect()]
        self.spark.createDataFrame([(i,) for i in ids], "id string").agg(F.count("id")).collect()


def timed(action) -> tuple[float, float]:
    """First run and median of the later runs."""
    spent = []
    for _ in range(RUNS + 1):
        began = time.perf_counter()
        action()
        spent.append(time.perf_counter() - began)
    return round(spent[0], 3), round(statistics.median(spent[1:]), 3)


def main() -> None:
    d = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(cpus)
    jobs = Jobs(spark, d)
    actions = {name: (lambda f=q.all_queries()[name]: run(f(spark, d))) for name in HEADLINE}
    actions |= {
        f"job_{f.__name__}": f
        for f in (jobs.song_raw_to_silver, jobs.song_silver_to_gold, jobs.song_load, jobs.play_load, jobs.split_csv)
    }
    result, first = {}, {}
    for name, action in actions.items():
        first[name], result[name] = timed(action)
    report = {
        "metric": "sum of median query times",
        "value": round(sum(result.values()), 3),
        "unit": "sec",
        "queries": result,
        "first_run": first,
        "sf": os.path.basename(d.rstrip("/")).removeprefix("sf"),
        "cpus": cpus,
    }
    if "--shapes" in sys.argv:
        steps = [n for n in dir(jobs) if n.startswith("stepwise_")]
        report["stepwise"] = {n.removeprefix("stepwise_"): timed(getattr(jobs, n))[1] for n in steps}
    print(json.dumps(report))


if __name__ == "__main__":
    main()
