import pytest

from strata import schemas
from strata.operators import clean, nested
from strata.plans import prepare
from strata.sources import files, tables, zones
from strata.staging import refuse_overlap


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def test_csv_quotes_blanks_and_null_tokens(spark, tmp_path):
    write(tmp_path / "a.csv", 'id,name,artists\n1," spaced ","[""D\'Arc"", \'x\']"\n2,nan,\n3,"","None"\n4,nano,"a,b"\n')
    write(tmp_path / "notes.txt", "id,name,artists\n9,x,y\n")
    got = [tuple(r) for r in files.read_csv(spark, str(tmp_path)).orderBy("id").collect()]
    assert got == [("1", " spaced ", "[\"D'Arc\", 'x']"), ("2", None, None), ("3", None, None), ("4", "nano", "a,b")]


def test_csv_types_fit_by_name(spark, tmp_path):
    write(tmp_path / "a.csv", "tempo,id,year\n1.5,x,1999.0\nbad,y,\n")
    got = files.read_csv(spark, str(tmp_path), schemas.raw_song_schema()).orderBy("id").collect()
    assert [(r["id"], r["tempo"], r["year"], r["mode"]) for r in got] == [("x", 1.5, 1999, None), ("y", None, None, None)]


def test_csv_inference(spark, tmp_path):
    write(tmp_path / "a.csv", "n,x,s\n1,1.5,a\n2,2.5,b\n")
    kinds = [f.dataType.simpleString() for f in files.read_csv(spark, str(tmp_path), infer=True).schema]
    assert kinds == ["int", "double", "string"]


def test_csv_headers_must_agree(spark, tmp_path):
    write(tmp_path / "a.csv", "id,name\n1,x\n")
    write(tmp_path / "b.csv", "name,id\nx,1\n")
    with pytest.raises(Exception, match="header"):
        files.read_csv(spark, str(tmp_path)).collect()


def test_csv_line_breaks_inside_quotes(spark, tmp_path):
    write(tmp_path / "a.csv", 'id,name\n1,"two\nlines"\n')
    assert files.read_csv(spark, str(tmp_path), multi_line=True).first()["name"] == "two\nlines"


def test_csv_holds_lists_as_text(spark, tmp_path):
    df = spark.sql("select 1 as i, array('A', 'B') as l, named_struct('a', 1) as s")
    files.write_csv(df, str(tmp_path / "out"))
    row = files.read_csv(spark, str(tmp_path / "out")).first()
    assert tuple(row) == ("1", "['A', 'B']", '{"a":1}')


def test_json_arrays_of_several_files(spark, tmp_path):
    write(tmp_path / "in" / "a.json", '[{"a": 1, "b": {"c": "x", "l": ["p", "q"]}}, {"a": 2}]')
    write(tmp_path / "in" / "b.json", '[{"a": 3, "d": true}]')
    write(tmp_path / "in" / "c.txt", "nonsense")
    prepare.json_to_csv(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    df = files.read_csv(spark, str(tmp_path / "out"))
    assert sorted(df.columns) == ["a", "b.c", "b.l", "d"]
    got = {tuple(r) for r in df.select("a", "`b.c`", "`b.l`", "d").collect()}
    assert got == {("1", "x", "['p', 'q']", None), ("2", None, None, None), ("3", None, None, "true")}


def test_json_lines_with_schema(spark, tmp_path):
    write(tmp_path / "a.json", '{"a": 1}\n{"a": 2}\n')
    df = files.read_json(spark, str(tmp_path), schemas.target_schema("a INT"), lines=True)
    assert sorted(r["a"] for r in df.collect()) == [1, 2]


def test_filter_csv_to_parquet(spark, tmp_path):
    write(tmp_path / "in" / "a.csv", "some_column,x\n5,a\n11,b\n10,c\n")
    prepare.filter_csv_to_parquet(spark, str(tmp_path / "in"), str(tmp_path / "out"), "some_column > 10")
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [(11, "b")]


def test_footer_types_become_declared_types(spark, tmp_path):
    raw = spark.createDataFrame([], schemas.raw_song_schema())
    odd = spark.sql("select 'x' as id, 0.0D as key, 1.0D as mode, true as explicit, 5L as year")
    files.write_parquet(nested.union_by_name([odd, raw.drop("id", "key", "mode", "explicit", "year")]), str(tmp_path))
    row = files.read_layer(spark, str(tmp_path), "raw").first()
    assert (row["key"], row["mode"], row["explicit"], row["year"]) == (0, 1, "true", 5)


def test_ingest(spark, tmp_path):
    land, zone = tmp_path / "land", str(tmp_path / "zone")
    write(land / "one.csv", "id,ip_addr\na,10.0.0.1\n")
    write(land / "two+2 x.csv", "id,ip_addr\nb,10.0.0.2\n")
    assert zones.ingest_csv(spark, str(land), zone, drop=["ip_addr", "not_there"]) == 2
    df = spark.read.parquet(zone)
    assert {tuple(r) for r in df.collect()} == {("a", "one"), ("b", "two+2 x")}
    # The same name again replaces that file's rows and leaves the others.
    (land / "two+2 x.csv").unlink()
    write(land / "one.csv", "id,ip_addr\nc,10.0.0.1\nd,10.0.0.1\n")
    assert zones.ingest_csv(spark, str(land), zone, drop=["ip_addr"]) == 1
    assert {r["id"] for r in zones.read_zone(spark, zone).collect()} == {"b", "c", "d"}
    assert zones.read_zone(spark, zone).columns == ["id"]


def test_ingest_finds_types_but_leaves_times_to_cleaning(spark, tmp_path):
    write(tmp_path / "land" / "a.csv", "ts,ms_played,day,track_uri\n2024-03-31T02:30:00Z,1500,2024-03-31,s:track:x\n")
    zones.ingest_csv(spark, str(tmp_path / "land"), str(tmp_path / "zone"))
    kinds = {f.name: f.dataType.simpleString() for f in zones.read_zone(spark, str(tmp_path / "zone")).schema}
    assert kinds == {"ts": "string", "ms_played": "int", "day": "string", "track_uri": "string"}


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_play_times_stored_as_timestamps(spark, tmp_path, kind):
    files.write_parquet(spark.sql(f"select {kind}'2024-03-31 02:30:00' as ts, 's:track:x' as track_uri"), str(tmp_path))
    plays = clean.clean_plays(files.read_plays(spark, str(tmp_path)))
    assert str(plays.first()["ts"]) == "2024-03-31 02:30:00"


def test_ingest_without_files(spark, tmp_path, caplog):
    (tmp_path / "land").mkdir()
    assert zones.ingest_csv(spark, str(tmp_path / "land"), str(tmp_path / "zone")) == 0
    assert "no CSV files" in caplog.text
    with pytest.raises(FileNotFoundError):
        zones.ingest_csv(spark, str(tmp_path / "gone"), str(tmp_path / "zone"))


@pytest.mark.parametrize("rename", [False, True])
def test_archive(spark, tmp_path, rename):
    latest, archive = str(tmp_path / "latest"), str(tmp_path / "archive")
    for run in range(2):
        spark.range(run * 10, run * 10 + 10).write.mode("append").parquet(latest)
        assert zones.archive_zone(spark, latest, archive, f"r{run}", rename) == 10
        assert zones.data_files(spark, latest) == []
    assert sorted(r["id"] for r in zones.read_zone(spark, archive).collect()) == list(range(20))
    assert spark.read.parquet(archive).filter("run_id = 'r1'").count() == 10
    assert zones.archive_zone(spark, latest, archive, "r9", rename) == 0
    assert zones.archive_zone(spark, str(tmp_path / "gone"), archive, "r9", rename) == 0


def test_archive_leaves_files_that_arrive_meanwhile(spark, tmp_path, monkeypatch):
    latest, archive = str(tmp_path / "latest"), str(tmp_path / "archive")
    spark.range(10).write.parquet(latest)
    listing = zones.list_files

    def list_then_more_arrives(s, folder):
        found = s.createDataFrame(listing(s, folder).collect(), "path string, length long")
        spark.range(100, 105).write.mode("append").parquet(latest)
        return found

    monkeypatch.setattr(zones, "list_files", list_then_more_arrives)
    assert zones.archive_zone(spark, latest, archive, "r") == 10
    assert sorted(r["id"] for r in spark.read.parquet(latest).collect()) == list(range(100, 105))


def test_archive_that_broke_off_can_be_repeated(spark, tmp_path, monkeypatch):
    latest, archive = str(tmp_path / "latest"), str(tmp_path / "archive")
    spark.range(0, 30, 1, 3).write.parquet(latest)
    really_delete = zones._delete

    def delete_one(path, length):
        if "part-00000" not in path:
            raise OSError("lost")
        return really_delete(path, length)

    (tmp_path / "latest" / "_SUCCESS").unlink()
    monkeypatch.setattr(zones, "_delete", delete_one)
    with pytest.raises(Exception, match="lost"):
        zones.archive_zone(spark, latest, archive, "r")
    monkeypatch.setattr(zones, "_delete", really_delete)
    assert len(zones.data_files(spark, latest)) in (2, 3)
    spark.range(100, 105).coalesce(1).write.mode("append").parquet(latest)
    assert zones.archive_zone(spark, latest, archive, "r") == 30
    assert sorted(r["id"] for r in zones.read_zone(spark, archive).collect()) == list(range(30))
    assert sorted(r["id"] for r in spark.read.parquet(latest).collect()) == list(range(100, 105))
    # The next run takes what came later.
    assert zones.archive_zone(spark, latest, archive, "r2") == 5
    assert zones.read_zone(spark, archive).count() == 35


def test_archive_copy_that_broke_off_is_made_anew(spark, tmp_path, monkeypatch):
    latest, archive = str(tmp_path / "latest"), str(tmp_path / "archive")
    spark.range(0, 30, 1, 3).write.parquet(latest)
    # Half a copy from an earlier attempt.
    spark.range(0, 10).write.parquet(f"{archive}/run_id=r")
    assert zones.archive_zone(spark, latest, archive, "r") == 30
    assert zones.read_zone(spark, archive).count() == 30 and zones.data_files(spark, latest) == []


def test_rename_never_lands_in_an_older_run(spark, tmp_path):
    latest, archive = str(tmp_path / "latest"), str(tmp_path / "archive")
    for run in range(2):
        spark.range(5).write.mode("append").parquet(latest)
        if run == 0:
            assert zones.archive_zone(spark, latest, archive, "r", rename=True) == 5
    with pytest.raises(zones.ArchiveIncomplete):
        zones.archive_zone(spark, latest, archive, "r", rename=True)
    assert spark.read.parquet(latest).count() == 5


def test_archive_of_partitioned_zone_keeps_the_partition_column(spark, tmp_path):
    latest, archive = str(tmp_path / "latest"), str(tmp_path / "archive")
    spark.sql("select 1 as id, 'f' as source_file").write.partitionBy("source_file").parquet(latest)
    zones.archive_zone(spark, latest, archive, "r")
    assert spark.read.parquet(archive).first()["source_file"] == "f"


def test_overlapping_paths_are_refused(spark, tmp_path):
    for a, b in [("x", "x"), ("x", "x/y"), ("x/y", "x")]:
        with pytest.raises(ValueError, match="overlap"):
            refuse_overlap(spark, str(tmp_path / a), str(tmp_path / b))
    refuse_overlap(spark, str(tmp_path / "x"), str(tmp_path / "xy"))


def test_managed_table_enforces_lengths(spark):
    table = tables.ManagedTable("short_text", "id VARCHAR(3), n BIGINT")
    table.create(spark)
    table.create(spark)
    table.append(spark.createDataFrame([(1.0, "abc")], "n double, id string"))
    assert [tuple(r) for r in table.read(spark).collect()] == [("abc", 1)]
    with pytest.raises(Exception, match="(?i)length"):
        table.append(spark.createDataFrame([(1.0, "abcd")], "n double, id string"))
    assert table.read(spark, ["id"]).columns == ["id"]


def test_parquet_table_reads_empty_before_the_first_append(spark, tmp_path):
    table = tables.ParquetTable(str(tmp_path / "t"), schemas.GOLD_ARTIST_DDL)
    assert table.read(spark, ["id"]).count() == 0
    table.create(spark)
    assert table.read(spark).count() == 0
    plan = table.read(spark, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:string>" in plan


def test_jdbc_options():
    table = tables.JdbcTable("jdbc:x://h/db", "gold_artist", schemas.GOLD_ARTIST_DDL, {"user": "u"}, reads=2)
    assert table.options(["id"]) == {"url": "jdbc:x://h/db", "dbtable": "(SELECT id FROM gold_artist) t", "user": "u"}
    assert table.predicates(["id"]) == [
        "(hashtext(CAST(id AS text)) & 2147483647) % 2 = 0 OR id IS NULL", "(hashtext(CAST(id AS text)) & 2147483647) % 2 = 1",
    ]
    assert table.create_sql() == (
        "CREATE TABLE IF NOT EXISTS gold_artist "
        "(id VARCHAR(255), name VARCHAR(255), artist VARCHAR(255), artist_id VARCHAR(255))"
    )
    plays = tables.JdbcTable("jdbc:x://h/db", "p", schemas.GOLD_PLAY_DDL).create_sql()
    assert "ts TIMESTAMP," in plays and "seconds_played INTEGER" in plays
    songs = tables.JdbcTable("jdbc:x://h/db", "s", schemas.GOLD_SONG_DDL).create_sql()
    assert "artists TEXT" in songs and "tempo DOUBLE PRECISION" in songs


def test_ingest_cuts_large_files_without_being_told(spark, tmp_path, monkeypatch):
    from strata.sources import csv_blocks

    rows = [(str(i), f'line {i}\nand, "more"') for i in range(400)]
    files.write_csv(spark.createDataFrame(rows, "id string, note string").coalesce(1), str(tmp_path / "in"))
    monkeypatch.setattr(csv_blocks, "BLOCK", 1 << 10)
    monkeypatch.setattr(zones, "LARGE", 4 << 10)
    zones.ingest_csv(spark, str(tmp_path / "in"), str(tmp_path / "zone"))
    stored = spark.read.parquet(str(tmp_path / "zone"))
    assert len(stored.inputFiles()) > 1  # more than one task wrote the file's partition
    assert sorted((str(r.id), r.note) for r in zones.read_zone(spark, str(tmp_path / "zone")).collect()) == sorted(rows)
