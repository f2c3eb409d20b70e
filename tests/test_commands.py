"""The jobs as commands, one after the other over one lake."""

import pytest

from strata.__main__ import main
from strata.operators import quality
from strata.sources import files
from workload import fixtures as fx

SF = "/root/testdata/sf0.001"


def run(*args):
    return main([str(a) for a in args])


def test_songs(spark, tmp_path, capsys):
    files.write_csv(fx.raw_songs(spark, SF), str(tmp_path / "landing"))
    run("ingest", "--source", tmp_path / "landing", "--target", tmp_path / "raw", "--schema", "raw")
    run("raw-to-silver", "--source", tmp_path / "raw", "--target", tmp_path / "silver")
    run("silver-to-gold", "--source", tmp_path / "silver", "--target", tmp_path / "gold")
    assert "n_rows=200" in capsys.readouterr().out
    tables = ["--songs", tmp_path / "gold_song", "--artists", "gold_artist_by_command"]
    run("load-songs", "--source", tmp_path / "gold", *tables)
    assert spark.read.parquet(str(tmp_path / "gold_song")).count() == 152
    assert spark.table("gold_artist_by_command").count() > 152
    run("archive", "--source", tmp_path / "raw", "--target", tmp_path / "archive", "--run-id", "r1")
    assert spark.read.parquet(str(tmp_path / "archive")).count() == 200

    quality.song_suite({"$PARAMETER": "this_year"}).save(str(tmp_path / "suite.json"))
    args = ["--suite", tmp_path / "suite.json", "--parameter", "this_year=2025"]
    assert run("check", "--source", tmp_path / "silver", "--target", tmp_path / "checked", *args) == 1
    assert "2 of 41 rules failed" in capsys.readouterr().out
    assert spark.read.parquet(str(tmp_path / "checked/rows")).filter("key IS NOT NULL").count() == 0


@pytest.mark.parametrize("job", ["load-plays", "follow-plays"])
def test_plays(spark, tmp_path, job):
    files.write_parquet(fx.raw_plays(spark, SF).drop("event_id"), str(tmp_path / "raw"))
    args = ["--source", tmp_path / "raw", "--gold", tmp_path / "gold", "--plays", tmp_path / "gold_play"]
    if job == "follow-plays":
        args += ["--checkpoint", tmp_path / "checkpoint"]
    run(job, *args, "--keys", "ts", "id")
    assert spark.read.parquet(str(tmp_path / "gold_play")).count() == 950


def test_files(spark, tmp_path):
    numbers = spark.range(2000).selectExpr("id", "id % 20 AS some_column", "named_struct('a', id) AS s")
    numbers.write.json(str(tmp_path / "json"))
    run("json-to-csv", "--source", tmp_path / "json", "--target", tmp_path / "csv", "--lines")
    filtered = ["--target", tmp_path / "parquet", "--condition", "some_column > 10"]
    run("filter-csv", "--source", tmp_path / "csv", *filtered)
    assert spark.read.parquet(str(tmp_path / "parquet")).count() == 900
    sizes = ["--min-rows", 100, "--max-rows", 300]
    run("split", "--source", tmp_path / "csv", "--target", tmp_path / "chunks", *sizes)
    assert files.read_csv(spark, str(tmp_path / "chunks")).select("id").distinct().count() == 2000


def test_arguments_are_checked():
    with pytest.raises(SystemExit):
        run("load-songs", "--source", "x")


def fetch(keys):
    return [{"id": k, "name": f"name of {k}", "popularity": 7, "artists": [{"id": "a", "name": None}]} for k in keys]


def test_lookups(spark, tmp_path):
    from strata.operators.clean import clean_plays, clean_songs

    files.write_parquet(clean_plays(fx.raw_plays(spark, SF)), str(tmp_path / "plays"))
    files.write_parquet(clean_songs(fx.raw_songs(spark, SF)), str(tmp_path / "songs"))
    named = ["--fetch", "tests.test_commands:fetch"]
    run("backfill", "--source", tmp_path / "plays", "--songs", tmp_path / "songs", "--target", tmp_path / "raw", *named)
    rows = files.read_layer(spark, str(tmp_path / "raw"), "raw")
    assert rows.count() > 0 and rows.filter("artists <> '[None]'").count() == 0
    run("popularity", "--source", tmp_path / "songs", "--target", tmp_path / "popularity", *named)
    assert files.read_csv(spark, str(tmp_path / "popularity")).filter("popularity = '7'").count() == 200


def test_check_writes_rows_that_are_not_unique(spark, tmp_path):
    spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "e")], "id int, v string").write.parquet(str(tmp_path / "t"))
    quality.Suite("u").expect(quality.UNIQUE, column="id").save(str(tmp_path / "suite.json"))
    assert run("check", "--source", tmp_path / "t", "--target", tmp_path / "out", "--suite", tmp_path / "suite.json") == 1
    found = spark.read.parquet(str(tmp_path / "out/duplicates")).collect()
    assert sorted((r.id, r.v, r.rule_no) for r in found) == [(1, "a", 1), (1, "b", 1)]
