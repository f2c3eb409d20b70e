import pytest
from pyspark.sql import functions as F

from strata import schemas
from strata.operators import gate
from strata.plans import play
from strata.sources import files, tables
from strata.streaming.plays import stream_plays
from workload import fixtures as fx
from workload import queries

SF = "/root/testdata/sf0.001"
HalfTable = queries.HalfTable
ASIDE = gate.GatePolicy(on_exceed="quarantine")


def play_table(path):
    return tables.ParquetTable(str(path), schemas.GOLD_PLAY_DDL)


def rows(df):
    return sorted(map(str, df.collect()))


def test_stream_loads_what_the_batch_job_loads(spark, tmp_path):
    raw = str(tmp_path / "raw")
    files.write_parquet(fx.raw_plays(spark, SF).drop("event_id"), raw)
    by_job, by_stream = play_table(tmp_path / "job"), play_table(tmp_path / "stream")
    play.load_plays(spark, raw, str(tmp_path / "gold_job"), by_job, policy=ASIDE)

    def run():
        return stream_plays(
            spark, raw, str(tmp_path / "gold"), by_stream, str(tmp_path / "checkpoint"), policy=ASIDE
        )

    run()
    assert rows(by_stream.read(spark)) == rows(by_job.read(spark))
    assert spark.read.parquet(str(tmp_path / "gold")).count() == 1000
    # Nothing new, nothing done.
    assert run() is None
    assert by_stream.read(spark).count() == by_job.read(spark).count()
    # One more file with tracks that were never played.
    later = spark.read.parquet(raw).withColumn("track_uri", F.concat(F.lit("svc:track:later"), F.col("ms_played")))
    later.write.mode("append").parquet(raw)
    run()
    assert by_stream.read(spark).filter("id like 'later%'").count() == 1000


def test_replayed_batch_adds_nothing(spark, tmp_path):
    raw = str(tmp_path / "raw")
    files.write_parquet(fx.raw_plays(spark, SF).drop("event_id"), raw)
    table = play_table(tmp_path / "table")
    for checkpoint in ("first", "lost and made anew"):
        stream_plays(spark, raw, str(tmp_path / "gold"), table, str(tmp_path / checkpoint), policy=ASIDE)
    assert table.read(spark).count() == 950


def test_files_dealt_one_by_one_change_nothing(spark, tmp_path):
    raw = str(tmp_path / "raw")
    plays = fx.raw_plays(spark, SF).drop("event_id").filter("track_uri IS NOT NULL")
    for _ in range(5):
        plays.limit(40).coalesce(1).write.mode("append").parquet(raw)
    whole, single = play_table(tmp_path / "whole"), play_table(tmp_path / "single")
    play.load_plays(spark, raw, str(tmp_path / "gold_job"), whole)
    stats = stream_plays(spark, raw, str(tmp_path / "gold"), single, str(tmp_path / "cp"), max_files=1)
    assert stats.n_rows == 200 and rows(single.read(spark)) == rows(whole.read(spark))
    assert len(list((tmp_path / "gold").glob("batch_id=*"))) == 5


def test_empty_zone(spark, tmp_path):
    table = play_table(tmp_path / "t")
    assert stream_plays(spark, str(tmp_path / "raw"), str(tmp_path / "gold"), table, str(tmp_path / "cp")) is None


def test_a_run_that_broke_off_while_loading_is_completed(spark, tmp_path):
    raw = str(tmp_path / "raw")
    files.write_parquet(fx.raw_plays(spark, SF).drop("event_id"), raw)
    table, whole = HalfTable(str(tmp_path / "t"), schemas.GOLD_PLAY_DDL), play_table(tmp_path / "whole")
    play.load_plays(spark, raw, str(tmp_path / "gold_job"), whole, policy=ASIDE)
    args = (spark, raw, str(tmp_path / "gold"), table, str(tmp_path / "cp"))
    with pytest.raises(OSError):
        stream_plays(*args, policy=ASIDE)
    assert 0 < table.read(spark).count() < whole.read(spark).count()
    assert stream_plays(*args, policy=ASIDE) is None
    assert rows(table.read(spark)) == rows(whole.read(spark))
