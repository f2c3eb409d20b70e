"""Whole jobs on files."""

import pytest
from pyspark.sql import functions as F

from strata import schemas
from strata.operators import gate, views
from strata.operators.clean import clean_plays, clean_songs
from strata.plans import backfill, play, song
from strata.sources import files, tables
from strata.staging import shared_dir
from workload import fixtures as fx
from workload.queries import catalogue_fetch

SF = "/root/testdata/sf0.001"


@pytest.fixture(params=["few keys", "many keys"])
def key_paths(request, setting):
    """Loads give the same result whether the stored keys are broadcast or shuffled."""
    if request.param == "many keys":
        setting("spark.sql.autoBroadcastJoinThreshold", "-1")


@pytest.fixture
def lake(spark, tmp_path):
    files.write_parquet(fx.raw_songs(spark, SF), str(tmp_path / "song/raw"))
    plays = fx.raw_plays(spark, SF).drop("event_id").withColumnRenamed("track_uri", "any_track_uri")
    files.write_parquet(plays, str(tmp_path / "play/raw"))
    return tmp_path


def song_tables(lake):
    return (
        tables.ParquetTable(str(lake / "gold_song"), schemas.GOLD_SONG_DDL),
        tables.ParquetTable(str(lake / "gold_artist"), schemas.GOLD_ARTIST_DDL),
    )


def gold_songs(spark, lake):
    song.raw_to_silver(spark, str(lake / "song/raw"), str(lake / "song/silver"))
    return song.silver_to_gold(spark, str(lake / "song/silver"), str(lake / "song/gold"))


def staged_folders(spark):
    import os

    root = f"{shared_dir(spark)}/staged"
    return os.listdir(root) if os.path.isdir(root) else []


def test_songs_end_to_end(spark, lake, key_paths):
    stats = gold_songs(spark, lake)
    assert (stats.n_null, stats.n_rows) == (10, 200)
    songs, artists = song_tables(lake)
    before = staged_folders(spark)
    first = song.load_songs(spark, str(lake / "song/gold"), songs, artists, rejects=str(lake / "rejects"))
    n_songs, n_artists = songs.read(spark).count(), artists.read(spark).count()
    assert n_songs == 152 == first.songs.n_rows
    assert n_artists == first.artists.n_rows - first.artists.n_null
    assert spark.read.parquet(str(lake / "rejects/artists")).count() == first.artists.n_null > 0
    assert spark.read.parquet(str(lake / "rejects/songs")).count() == 0
    # A second run adds nothing.
    second = song.load_songs(spark, str(lake / "song/gold"), songs, artists)
    assert (second.songs.n_rows, second.artists.n_rows) == (0, 0)
    assert (songs.read(spark).count(), artists.read(spark).count()) == (n_songs, n_artists)
    assert staged_folders(spark) == before


def test_part_written_artists_are_completed(spark, lake):
    gold_songs(spark, lake)
    songs, artists = song_tables(lake)
    song.load_songs(spark, str(lake / "song/gold"), songs, artists)
    whole = artists.read(spark)
    part = tables.ParquetTable(str(lake / "part_artist"), schemas.GOLD_ARTIST_DDL)
    part.append(whole.filter(F.col("artist_id").startswith("a")))
    # The bridge key finds the artists that are missing; the padded rows without an id fail no gate here.
    song.load_songs(
        spark, str(lake / "song/gold"), songs, part, artist_keys=("id", "artist_id"),
        policy=gate.GatePolicy(max_rate=0.2),
    )
    assert sorted(map(str, part.read(spark).collect())) == sorted(map(str, whole.collect()))


def test_failing_gate_appends_nothing(spark, lake):
    gold_songs(spark, lake)
    songs, artists = song_tables(lake)
    strict = gate.GatePolicy(max_rate=0.0, few=0)
    before = staged_folders(spark)
    with pytest.raises(gate.NullRateExceeded):
        song.load_songs(spark, str(lake / "song/gold"), songs, artists, policy=strict)
    assert songs.read(spark).count() == 0 and artists.read(spark).count() == 0
    assert staged_folders(spark) == before


def test_plays_end_to_end(spark, lake, key_paths):
    table = tables.ParquetTable(str(lake / "gold_play"), schemas.GOLD_PLAY_DDL)
    args = (spark, str(lake / "play/raw"), str(lake / "play/gold"), table)
    stats = play.load_plays(*args, uri_prefix="any_")
    assert (stats.n_null, stats.n_rows) == (50, 1000)
    # The gold layer keeps what the gate drops.
    assert files.read_layer(spark, str(lake / "play/gold"), "gold_play").count() == 1000
    assert table.read(spark).count() == 950
    # Plays without an id are never known, so a repeated batch holds nothing but bad rows and fails its gate ...
    with pytest.raises(gate.NullRateExceeded):
        play.load_plays(*args, uri_prefix="any_")
    # ... unless those are set aside. Nothing is added either way.
    aside = str(lake / "rejects")
    play.load_plays(*args, uri_prefix="any_", policy=gate.GatePolicy(on_exceed="quarantine"), rejects=aside)
    assert table.read(spark).count() == 950
    assert spark.read.parquet(aside).filter("id is null").count() == 50


def test_dedupe_key_decides_about_repeat_plays(spark, lake, key_paths):
    table = tables.ParquetTable(str(lake / "gold_play"), schemas.GOLD_PLAY_DDL)
    raw = spark.read.parquet(str(lake / "play/raw"))
    aside = gate.GatePolicy(on_exceed="quarantine")
    play.load_plays(spark, str(lake / "play/raw"), str(lake / "play/gold"), table, uri_prefix="any_", policy=aside)
    files.write_parquet(raw.withColumn("ts", F.lit("2030-01-01T00:00:00Z")), str(lake / "later"))
    for keys, added in ((("id",), 0), (("ts", "id"), 950)):
        before = table.read(spark).count()
        play.load_plays(
            spark, str(lake / "later"), str(lake / "later_gold"), table, keys, uri_prefix="any_", policy=aside
        )
        assert table.read(spark).count() - before == added


def test_raw_must_not_be_overwritten(spark, lake):
    with pytest.raises(ValueError, match="overlap"):
        song.raw_to_silver(spark, str(lake / "song/raw"), str(lake / "song/raw"))


def test_backfill_reenters_the_song_job(spark, lake):
    gold_songs(spark, lake)
    songs = files.read_layer(spark, str(lake / "song/gold"), "gold")
    plays = clean_plays(spark.read.parquet(str(lake / "play/raw")))
    out = str(lake / "backfill/raw")
    counts = backfill.backfill_missing(spark, plays, songs, catalogue_fetch(), out, pause=(0, 0))
    found = files.read_layer(spark, out, "raw")
    assert found.count() == counts["found"] and counts["absent"] > 0
    song.raw_to_silver(spark, out, str(lake / "backfill/silver"))
    silver = files.read_layer(spark, str(lake / "backfill/silver"), "silver")
    assert silver.filter("size(artists) = 1 and year = 1999").count() == counts["found"]


def test_backfill_fetches_every_key_once(spark, lake, tmp_path):
    log = tmp_path / "asked"
    log.mkdir()

    def fetch(batch, folder=str(log)):
        import uuid

        with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
            f.write("\n".join(batch))
        return [None for _ in batch]

    plays = spark.createDataFrame([("a",), ("a",), ("b",), (None,), ("",)], "id string")
    songs = spark.createDataFrame([("b",)], "id string")
    counts = backfill.backfill_missing(spark, plays, songs, fetch, str(tmp_path / "out"), pause=(0, 0))
    assert counts == {"absent": 1}
    assert [p.read_text() for p in log.iterdir()] == ["a"]


def test_many_keys_warn(spark, tmp_path, caplog):
    plays = spark.range(10_001).select(F.col("id").cast("string").alias("id"))
    songs = spark.createDataFrame([], "id string")

    def fetch(batch):
        return [None] * len(batch)

    backfill.backfill_missing(spark, plays, songs, fetch, str(tmp_path / "out"), pause=(0, 0), batch_size=1000)
    assert "10001 keys" in caplog.text


def test_uris_for_services(spark):
    df = spark.createDataFrame([("a",)], "id string")
    assert backfill.as_uris(df, "svc:track:").first()["id"] == "svc:track:a"


def test_session_views(spark, lake):
    gold_songs(spark, lake)
    songs, artists = song_tables(lake)
    song.load_songs(spark, str(lake / "song/gold"), songs, artists)
    plays = clean_plays(spark.read.parquet(str(lake / "play/raw")))
    views.create_views(spark, songs.read(spark), plays, artists.read(spark))
    assert spark.table("track_view").columns[-1] == "primary_artist_id"
    assert spark.sql("select count(*) from user_view where day_of_week = 'Mon'").first()[0] > 0
    assert spark.table("artist_view").count() == artists.read(spark).count()


def test_empty_artist_list_has_no_primary_artist(spark):
    df = spark.createDataFrame([], schemas.silver_song_schema())
    row = spark.sql("select 'x' as id, array() as artist_ids")
    full = df.drop("id", "artist_ids").unionByName(row, allowMissingColumns=True)
    assert views.track_view(full).first()["primary_artist_id"] is None


@pytest.mark.parametrize("parts", [1, 3, 13])
def test_cleaning_is_stable_under_repartitioning(spark, lake, parts):
    raw = spark.read.parquet(str(lake / "song/raw"))
    moved = clean_songs(raw.repartition(parts, "album_id"))
    assert sorted(map(str, moved.collect())) == sorted(map(str, clean_songs(raw).collect()))


def test_songs_of_one_small_file_are_written_by_all_cores(spark, tmp_path):
    files.write_parquet(fx.raw_songs(spark, SF), str(tmp_path / "raw"))
    written = spark.read.parquet(str(tmp_path / "raw"))
    assert len(written.inputFiles()) >= spark.sparkContext.defaultParallelism
    assert written.count() == fx.table(spark, SF, "part").count()
