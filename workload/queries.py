"""One registered query per operator. Each takes (spark, sf_dir), reads whole tables and returns a DataFrame.

Queries on files and jobs write to new folders in the shared scratch space, which stay for the result to be read from.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata import schemas
from strata.functions import numeric, temporal, text
from strata.operators import clean, enrich, gate, incremental, keyfilter, nested, quality, sketches, split, views
from strata.operators.suite_state import SuiteStates
from strata.plans import backfill, play, prepare, song
from strata.sources import files, tables, zones
from strata.staging import file_system, make_folder, open_store, path_exists, shared_dir
from strata.streaming.plays import stream_plays
from workload import fixtures as fx

MAX_YEAR = 2025


def _folder(spark: SparkSession, name: str) -> str:
    """A new folder for what a query writes, in the shared scratch space, deleted when the session's JVM ends."""
    path = f"{shared_dir(spark)}/queries/{name}-{uuid.uuid4().hex}"
    fs, p = file_system(spark, path)
    fs.deleteOnExit(p)
    return path


def _lists_as_text(df: DataFrame) -> DataFrame:
    """Results are compared as flat values."""
    return df.withColumns({c: F.array_join(c, "|", "~") for c in schemas.SONG_LISTS if c in df.columns})


def silver(spark: SparkSession, d: str) -> DataFrame:
    return clean.clean_songs(fx.raw_songs(spark, d))


def plays(spark: SparkSession, d: str) -> DataFrame:
    return clean.clean_plays(fx.raw_plays(spark, d))


# --- cleaning rules ---


def song_clean_text(spark, d):
    return silver(spark, d).select("id", "name", "album")


def song_clean_explicit(spark, d):
    return silver(spark, d).select("id", "explicit")


def song_null_tokens(spark, d):
    folded = text.folded(F.col("explicit"))
    return fx.raw_songs(spark, d).select("id", folded.alias("folded"), text.scrubbed(folded).alias("scrubbed"))


def song_clean_features(spark, d):
    return silver(spark, d).select("id", *schemas.SONG_FEATURES_3, *schemas.SONG_FEATURES_4)


def song_decode_key_mode(spark, d):
    return silver(spark, d).select("id", "key", "mode")


def song_decode_double_key(spark, d):
    """Codes that a file with gaps stored as doubles."""
    raw = fx.raw_songs(spark, d)
    return raw.select(
        "id",
        numeric.pitch_name(F.col("key").cast("double")).alias("key"),
        numeric.mode_name(F.col("mode").cast("double")).alias("mode"),
    )


def song_duration_seconds(spark, d):
    return silver(spark, d).select("id", "duration_ms")


def song_release_date(spark, d):
    return silver(spark, d).select("id", "release_date")


def song_parse_lists(spark, d):
    return _lists_as_text(silver(spark, d).select("id", *schemas.SONG_LISTS))


def song_parse_lists_literal(spark, d):
    parsed = clean.clean_songs(fx.raw_songs(spark, d), list_mode="literal")
    return _lists_as_text(parsed.select("id", *schemas.SONG_LISTS))


def song_silver(spark, d):
    return _lists_as_text(silver(spark, d))


def song_schema_enforced(spark, d):
    """Raw songs that arrive as text only, fitted back to their declared types."""
    as_text = fx.raw_songs(spark, d).select([F.col(c).cast("string").alias(c) for c in schemas.SONG_COLUMNS])
    return schemas.enforce(as_text, schemas.raw_song_schema()).select(
        "id", "track_number", "disc_number", "key", "mode", "duration_ms", "time_signature", "year"
    )


def play_clean(spark, d):
    return plays(spark, d)


def play_uri_parts(spark, d):
    return fx.raw_plays(spark, d).select(
        "event_id",
        text.uri_id(F.col("track_uri")).alias("id"),
        text.uri_type(F.col("track_uri")).alias("type"),
        text.build_uri(text.uri_id(F.col("track_uri")), "svc:track:").alias("rebuilt"),
    )


def play_platform(spark, d):
    return fx.raw_plays(spark, d).select("event_id", text.platform(F.col("platform")).alias("platform"))


def play_timestamp_parse(spark, d):
    return fx.raw_plays(spark, d).select("event_id", temporal.to_wall_clock(F.col("ts")).alias("ts"))


# --- gate and metrics ---


def null_stats(spark, d):
    df = silver(spark, d)
    return gate.null_stats(df, gate.without(df, "release_date"))


def null_gate_song(spark, d):
    df = silver(spark, d)
    return _lists_as_text(gate.null_gate(df, count_cols=gate.without(df, "release_date")).kept)


def null_gate_quarantine(spark, d):
    """Plays without complete values, set aside: here the gate would otherwise fail."""
    policy = gate.GatePolicy(max_rate=0.01, few=0, on_exceed="quarantine")
    result = gate.null_gate(plays(spark, d), policy=policy)
    return result.kept.withColumn("rejected", F.lit(False)).unionByName(
        result.rejected.withColumn("rejected", F.lit(True))
    )


def duplicates_by_key(spark, d):
    return gate.duplicates(silver(spark, d), ["album_id", "mode"])


def profile_columns(spark, d):
    return gate.profile(fx.raw_songs(spark, d))


def numeric_filter(spark, d):
    return fx.table(spark, d, "lineitem").filter("l_quantity > 10")


# --- normalization and incremental loads ---


def artist_normalized(spark, d):
    return nested.normalize_artists(silver(spark, d))


def artist_gated(spark, d):
    return gate.null_gate(artist_normalized(spark, d)).kept


def song_incremental(spark, d):
    return _lists_as_text(incremental.drop_existing(silver(spark, d), fx.gold_song_ids(spark, d)))


def artist_incremental(spark, d):
    return incremental.drop_existing(artist_normalized(spark, d), fx.gold_song_ids(spark, d))


def play_incremental(spark, d):
    return incremental.drop_existing(plays(spark, d), fx.gold_play_ids(spark, d))


def play_incremental_filtered(spark, d):
    """The same by way of a key filter, which two loads have each added their keys to."""
    stored = fx.gold_play_ids(spark, d)
    known = keyfilter.KeyFilter(spark, _folder(spark, "filter"), n_blocks=1 << 12)
    for run in range(2):
        known.add(stored.filter(F.pmod(F.hash("id"), F.lit(2)) == run), str(run))
    return keyfilter.drop_existing_filtered(plays(spark, d), stored, known)


def play_incremental_by_time(spark, d):
    """Only a play already stored, at the same time, is skipped."""
    stored = incremental.keep_existing(plays(spark, d), fx.gold_play_ids(spark, d))
    return incremental.drop_existing(plays(spark, d), stored, ["ts", "id"])


def missing_ids(spark, d):
    return incremental.missing_keys(plays(spark, d), silver(spark, d))


def missing_ids_resolvable(spark, d):
    return incremental.missing_keys(plays(spark, d), silver(spark, d), drop_blank=True)


def fk_violations(spark, d):
    return incremental.fk_violations(plays(spark, d).select("id", "ts"), silver(spark, d))


def fk_violations_bucketed(spark, d):
    """The same against a table bucketed by its key, stored in two loads; the stored side is not shuffled."""
    songs = silver(spark, d).select("id", "name")
    stored = tables.ManagedTable(f"songs_{uuid.uuid4().hex}", "id STRING, name STRING", _folder(spark, "bucketed"), buckets=8)
    stored.create(spark)
    for part in range(2):
        stored.append(songs.filter(F.pmod(F.hash("id"), F.lit(2)) == part))
    found = incremental.fk_violations(plays(spark, d).select("id", "ts"), stored.read(spark), salts=None)
    files.write_parquet(found, f"{stored.location}_found")
    spark.sql(f"DROP TABLE {stored.name}")
    return spark.read.parquet(f"{stored.location}_found")


# --- reports ---


def user_view(spark, d):
    return views.user_view(plays(spark, d))


def track_view(spark, d):
    df = silver(spark, d)
    return views.track_view(gate.null_gate(df, count_cols=gate.without(df, "release_date")).kept)


def artist_view(spark, d):
    return views.artist_view(artist_gated(spark, d))


# --- data quality ---


def dq_song_suite(spark, d):
    suite = quality.song_suite({"$PARAMETER": "this_year"})
    return quality.validate(silver(spark, d), suite, {"this_year": MAX_YEAR})


def dq_suite_from_file(spark, d):
    """A suite stored as a file, replaced there by a second one, and read back."""
    path = f"{_folder(spark, 'suite')}.json"
    quality.play_suite().save(path)
    quality.song_suite({"$PARAMETER": "this_year"}).save(path)
    return quality.validate(silver(spark, d), quality.Suite.load(path), {"this_year": MAX_YEAR})


def dq_incremental(spark, d):
    """Three loads, the second one stored twice, measured one by one; the result is that of the suite over all of them."""
    states = SuiteStates(_folder(spark, "states"), quality.song_suite({"$PARAMETER": "this_year"}), {"this_year": MAX_YEAR})
    songs = silver(spark, d)
    for part in (0, 1, 1, 2):
        states.add(songs.where(F.coalesce(F.pmod(F.xxhash64("id"), F.lit(3)), F.lit(0)) == part), f"load{part}")
    return states.result(spark)


def song_missing_rule(spark, d):
    """A column without a rule is NULL in its declared type, the others are as ever."""
    df = clean.clean_songs(fx.raw_songs(spark, d), overrides={"tempo": ("tempo", None)})
    return df.select("id", "name", "tempo")


def empty_layers(spark, d):
    """Empty frames of two layers beside the rows of a third: they add columns of their types and no rows."""
    plays_, songs = schemas.empty_frame(spark, "gold_play"), schemas.empty_frame(spark, "raw")
    rows = plays(spark, d).select("id", "seconds_played")
    rows = rows.unionByName(plays_.select("id", "seconds_played"))
    told = {"play_columns": F.lit(len(plays_.columns)), "song_columns": F.lit(len(songs.columns))}
    return rows.agg(F.count("*").alias("n"), F.sum("seconds_played").cast("bigint").alias("seconds")).withColumns(told)


def dq_play_suite(spark, d):
    return quality.validate(plays(spark, d), quality.play_suite())


def dq_flagged_rows(spark, d):
    suite = quality.song_suite(MAX_YEAR)
    flagged = quality.flag_rows(silver(spark, d), suite)
    return flagged.select("id", "key", F.array_join("violations", ",").alias("violations"))


def dq_unique_violations(spark, d):
    return quality.duplicate_rows(plays(spark, d).select("id", "ts", "album_artist_name"), ["id"])


def dq_within_record(spark, d):
    columns = ["platform", "type", "id"]
    suite = quality.Suite("within").expect(quality.DIFFER_IN_RECORD, column_list=columns)
    return quality.flag_rows(plays(spark, d), suite).select("ts", *columns)


def dq_max_between(spark, d):
    suite = quality.Suite("maxima")
    for c in ("year", "track_number"):
        bounds = {"min_value": {"$PARAMETER": f"{c}_above"}, "max_value": {"$PARAMETER": f"{c}_below"}}
        suite.expect(quality.MAX_BETWEEN, column=c, **bounds)
    known = {"year_above": 1900, "year_below": MAX_YEAR, "track_number_above": 1, "track_number_below": 10}
    return quality.validate(silver(spark, d), suite, known)


def dq_lengths(spark, d):
    return quality.validate(silver(spark, d), quality.length_suite("lengths", schemas.GOLD_SONG_DDL))


def dq_primary_key(spark, d):
    return quality.validate(artist_normalized(spark, d), quality.primary_key_suite("key", schemas.ARTIST_KEY))


# --- nested data ---


def json_flatten(spark, d):
    props = F.from_json("props", "k bigint")
    who = F.struct(F.col("user_id").alias("id"), props.alias("props")).alias("user")
    return nested.flatten_struct(fx.table(spark, d, "events").select("event_id", who), sep="_")


def json_variant_flatten(spark, d):
    """Files of clashing records: a field is a number in one, an object or a text in the others."""
    source = _folder(spark, "json")
    who = F.struct(F.col("user_id").alias("id"), F.array("event_type").alias("kinds")).alias("who")
    number, name = F.col("event_id").alias("id"), F.col("event_type")
    whats = [F.col("user_id"), F.struct(name.alias("type"), F.col("user_id").alias("n")), name]
    for i, what in enumerate(whats):
        rows = fx.table(spark, d, "events").where(F.col("event_id") % 3 == i)
        rows.select(F.to_json(F.struct(number, what.alias("what"), *([who] if i else []))).alias("value")).write.mode("append").text(source)
    df = nested.flatten_variants(files.read_variants(spark, source, lines=True, pattern="*.txt"))
    return df.select("id", "what", F.col("`who.id`").alias("who_id"), F.array_join("`who.kinds`", "|").alias("kinds"))


def union_missing_columns(spark, d):
    events = fx.table(spark, d, "events")
    halves = [events.select("event_id", "user_id", "value"), events.select("event_id", "event_type")]
    return nested.union_by_name(halves)


def _catalogue(spark, d):
    """Nested records over all parts, as JSON text, the way a service would send them."""
    album = F.struct(
        F.concat(F.lit("alb"), F.col("p_size").cast("string")).alias("id"),
        F.col("p_type").alias("name"),
        F.when(F.col("p_size") > 25, F.lit("2001-02-03")).otherwise(F.lit("2001")).alias("release_date"),
    )
    artist = F.struct(F.lower("p_brand").alias("id"), F.col("p_brand").alias("name"))
    other = F.struct(F.lit("x").alias("id"), F.col("p_type").alias("name"))
    record = F.struct(
        F.concat(F.lit("trk"), F.col("p_partkey").cast("string")).alias("id"),
        F.col("p_name").alias("name"),
        album.alias("album"),
        F.array(artist, other).alias("artists"),
        F.col("p_size").alias("track_number"),
        F.lit(1).alias("disc_number"),
        (F.col("p_size") > 10).alias("explicit"),
        (F.col("p_partkey") * 1000).alias("duration_ms"),
        (F.col("p_size") * 2).alias("popularity"),
    )
    # Some replies hold no record.
    sent = F.when(F.col("p_size") != 7, F.to_json(record)).alias("record")
    return enrich.parsed(fx.table(spark, d, "part").select(sent), schemas.track_schema())


def track_flatten(spark, d):
    return nested.track_to_raw_song(_catalogue(spark, d))


def track_popularity(spark, d):
    return nested.track_popularity(_catalogue(spark, d))


# --- batched lookups ---


def distinct_keys(spark, d):
    return enrich.distinct_keys(plays(spark, d), "id")


def catalogue_fetch():
    """A lookup function that derives the record from the key; every eleventh key has none."""

    def fetch(keys):
        import re

        reply = []
        for key in keys:
            n = int(re.sub(r"\D", "", key))
            reply.append(
                None
                if n % 11 == 0
                else {
                    "id": key,
                    "name": f"Name {n}",
                    "album": {"id": f"alb{n % 50}", "name": f"Album {n % 50}", "release_date": "1999-12-31"},
                    "artists": [{"id": f"a{n % 9}", "name": f"Artist {n % 9}"}],
                    "track_number": n % 15,
                    "disc_number": 1,
                    "explicit": n % 2 == 0,
                    "duration_ms": n * 1000,
                    "popularity": n % 101,
                }
            )
        return reply

    return fetch


def lookup_status(spark, d):
    keys = incremental.missing_keys(plays(spark, d), silver(spark, d), drop_blank=True)
    found = enrich.lookup(keys, "id", catalogue_fetch(), pause=(0, 0))
    return found.select("key", "status", "attempts")


def profile_sketches(spark, d):
    """Sketches of two loads, merged: exact counts, and whether distinct counts, quantiles and frequent values are within bounds."""
    rows = plays(spark, d).select("id", "platform", "seconds_played")
    store = sketches.ProfileStore(spark, _folder(spark, "profile"))
    for run in range(2):
        store.add(rows.filter(F.pmod(F.xxhash64("id"), F.lit(2)) == run) if run else rows.filter("id IS NULL OR pmod(xxhash64(id), 2L) = 0"), str(run))
    report = store.report((0.25, 0.5, 0.9), 1)
    exact = rows.agg(*[F.count_distinct(F.col(c)).alias(c) for c in rows.columns])
    exact = exact.select(F.inline(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("n_distinct")) for c in rows.columns])))
    place = report.filter("column_name = 'seconds_played'").select(F.posexplode("quantiles").alias("i", "q"))
    places = rows.join(F.broadcast(place)).groupBy("i").agg(
        (F.count_if(F.col("seconds_played") <= F.col("q")) / F.count("seconds_played")).alias("upto"),
        (F.count_if(F.col("seconds_played") < F.col("q")) / F.count("seconds_played")).alias("below"),
    )
    asked = F.element_at(F.array(*map(F.lit, (0.25, 0.5, 0.9))), F.col("i") + 1)
    fits = places.agg(F.bool_and((F.col("below") <= asked + sketches.RANK_ERROR) & (F.col("upto") >= asked - sketches.RANK_ERROR)).alias("fit"))
    often = rows.groupBy("platform").count().filter("platform IS NOT NULL").agg(F.max("count").alias("most"))
    joined = report.join(exact, F.col("column_name") == F.col("name")).join(fits).join(often)
    near = F.abs(F.col("approx_distinct") - F.col("n_distinct")) <= sketches.DISTINCT_ERROR * F.col("n_distinct") + 0.5
    return joined.select(
        "column_name", "rows", "nulls", near.alias("distinct_fits"),
        F.when(F.col("column_name") == "seconds_played", F.col("fit")).alias("quantiles_fit"),
        F.when(F.col("column_name") == "platform", F.col("top")[0]["count"] == F.col("most")).alias("top_fits"),
    )


def lookup_rate_limited(spark, d):
    """Tasks that share one budget and one pause; the service refuses the first request of each worker for a moment."""
    plain, calls = catalogue_fetch(), []

    def fetch(batch):
        calls.append(1)
        if len(calls) == 1:
            error = RuntimeError("too many requests")
            error.http_status, error.headers = 429, {"Retry-After": "0"}
            raise error
        return plain(batch)

    keys = incremental.missing_keys(plays(spark, d), silver(spark, d), drop_blank=True)
    found = enrich.lookup_limited(keys, "id", fetch, per_period=64, period=0.05, concurrency=4)
    return found.select("key", "status", F.lit(True).alias("asked"))


def backfill_rows(spark, d):
    out = _folder(spark, "backfill")
    songs = silver(spark, d)
    backfill.backfill_missing(spark, plays(spark, d), songs, catalogue_fetch(), out, pause=(0, 0), concurrency=8)
    return files.read_layer(spark, out, "raw")


def backfilled_silver(spark, d):
    """The backfilled rows go through song cleaning like any others."""
    return _lists_as_text(clean.clean_songs(backfill_rows(spark, d)))


def popularity_rows(spark, d):
    out = _folder(spark, "popularity")
    backfill.enrich_popularity(spark, fx.raw_songs(spark, d), catalogue_fetch(), out, pause=(0, 0))
    return files.read_csv(spark, out).select("id", F.col("popularity").try_cast("int").alias("popularity"))


# --- files and zones ---


def split_chunk_sizes(spark, d):
    """What must hold of a random split: all rows, sizes in range, chunks that follow one another in the order."""
    lines = fx.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    out, low, high = _folder(spark, "split"), 1_000, 5_000
    files.write_parquet(split.shuffle_key(lines, seed=7), f"{out}/ordered")
    ordered = spark.read.parquet(f"{out}/ordered")
    n = ordered.count()
    files.write_parquet(split.chunk_starts(ordered, n, low, high, seed=7), f"{out}/starts")
    starts = spark.read.parquet(f"{out}/starts")
    chunks = split.split_chunks(ordered, starts, n)
    sizes = chunks.groupBy(split.CHUNK).agg(
        F.count(F.lit(1)).alias("size"), F.min(split.ORDER).alias("lo"), F.max(split.ORDER).alias("hi")
    )
    after = sizes.select((F.col(split.CHUNK) - 1).alias(split.CHUNK), F.col("lo").alias("next_lo"))
    last = F.col("next_lo").isNull()
    return sizes.join(after, split.CHUNK, "left").agg(
        F.sum("size").alias("n_rows"),
        F.count_if((F.col("size") > high) | (F.col("size") < low) & ~last).alias("sizes_out_of_range"),
        F.count_if(F.col("hi") >= F.col("next_lo")).alias("overlaps"),
        F.count_if(last).alias("last_chunks"),
        F.min(split.CHUNK).alias("first_chunk"),
    )


def split_csv_files(spark, d):
    """A table cut into random chunk files holds the rows it held before."""
    out = _folder(spark, "split")
    orders = fx.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    prepare.split_csv(spark, orders, out, min_rows=500, max_rows=2_000, seed=3)
    return files.read_csv(spark, out, orders.schema)


def split_csv_permuted(spark, d):
    """Chunk files of a table: all rows, each once, sizes in range, chunks numbered without gaps, one file each."""
    out, low, high = _folder(spark, "split"), 1_000, 5_000
    prepare.split_csv(spark, fx.table(spark, d, "lineitem"), out, low, high, seed=7)
    number = F.regexp_extract(F.col("_metadata.file_path"), "chunk=([0-9]+)/", 1).cast("bigint")
    columns = ("l_orderkey", "l_linenumber", "l_partkey")
    back = spark.read.option("header", True).csv(out)
    back = back.select(*[F.col(c).cast("bigint") for c in columns], number.alias("chunk"), F.col("_metadata.file_path").alias("file"))
    of_chunk = [F.sum("l_partkey").alias("s"), F.min("file").alias("f"), F.max("file").alias("g")]
    sizes = back.groupBy("chunk").agg(F.count("*").alias("n"), *of_chunk)
    last = F.max("chunk").over(Window.partitionBy())
    sizes = sizes.withColumn("last", last).agg(
        F.sum("n").alias("n_rows"),
        F.sum("s").alias("sum_partkey"),
        F.count_if(F.col("n").between(low, high) | (F.col("chunk") == F.col("last")) & (F.col("n") <= high)).alias("fit"),
        F.count_if(F.col("f") == F.col("g")).alias("one_file"),
        F.max("chunk").alias("n_chunks"),
    )
    whole = (F.col("fit") == F.col("n_chunks")) & (F.col("one_file") == F.col("n_chunks"))
    return sizes.select("n_rows", "sum_partkey", whole.alias("chunks_fit"))


def csv_parquet_roundtrip(spark, d):
    landing, zone = _folder(spark, "landing"), _folder(spark, "zone")
    files.write_csv(fx.raw_songs(spark, d), landing)
    zones.ingest_csv(spark, landing, zone, schemas.raw_song_schema())
    return schemas.enforce(zones.read_zone(spark, zone), schemas.raw_song_schema())


def ingest_without_personal_data(spark, d):
    landing, zone = _folder(spark, "landing"), _folder(spark, "zone")
    address = F.concat(F.lit("10.0.0."), (F.col("event_id") % 250).cast("string")).alias("ip_addr")
    files.write_csv(fx.raw_plays(spark, d).select("ts", "platform", "ms_played", "track_uri", address), landing)
    zones.ingest_csv(spark, landing, zone, drop=["ip_addr"])
    return zones.read_zone(spark, zone).withColumn("ms_played", F.col("ms_played").try_cast("bigint"))


def archive_roundtrip(spark, d):
    latest, archive = _folder(spark, "latest"), _folder(spark, "archive")
    files.write_parquet(plays(spark, d), latest)
    zones.archive_zone(spark, latest, archive, run_id="run1")
    return zones.read_zone(spark, archive)


def json_to_csv(spark, d):
    source, target = _folder(spark, "json"), _folder(spark, "csv")
    who = F.struct(F.col("user_id").alias("id"), F.col("event_type").alias("kind")).alias("who")
    records = fx.table(spark, d, "events").select("event_id", who, F.expr("event_id div 1000").alias("file_no"))
    # One array of at most a thousand records per file.
    arrays = records.groupBy("file_no").agg(F.to_json(F.collect_list(F.struct("event_id", "who"))).alias("value"))
    arrays.repartition("file_no").write.partitionBy("file_no").text(source)
    prepare.json_to_csv(spark, source, target, pattern="*.txt")
    df = files.read_csv(spark, target)
    return df.select(
        F.col("event_id").try_cast("bigint").alias("event_id"),
        F.col("`who.id`").try_cast("bigint").alias("who_id"),
        F.col("`who.kind`").alias("who_kind"),
    )


def filter_csv(spark, d):
    source, target = _folder(spark, "numbers"), _folder(spark, "filtered")
    files.write_csv(fx.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity"), source)
    prepare.filter_csv_to_parquet(spark, source, target, "l_quantity > 10")
    return spark.read.parquet(target).select(
        F.col("l_orderkey").cast("bigint").alias("l_orderkey"), "l_linenumber", "l_quantity"
    )


# --- whole jobs ---


def _stored_songs(spark, d):
    return incremental.keep_existing(silver(spark, d), fx.gold_song_ids(spark, d)).dropna()


def _song_load(spark, d):
    root = _folder(spark, "songs")
    files.write_parquet(fx.raw_songs(spark, d), f"{root}/raw")
    song.raw_to_silver(spark, f"{root}/raw", f"{root}/silver")
    song.silver_to_gold(spark, f"{root}/silver", f"{root}/gold")
    songs = tables.ParquetTable(f"{root}/gold_song", schemas.GOLD_SONG_DDL)
    artists = tables.ParquetTable(f"{root}/gold_artist", schemas.GOLD_ARTIST_DDL)
    songs.append(_stored_songs(spark, d))
    artists.append(nested.normalize_artists(_stored_songs(spark, d)).dropna())
    # The second load must add nothing.
    for _ in range(2):
        song.load_songs(spark, f"{root}/gold", songs, artists)
    return songs, artists


def song_load(spark, d):
    songs, _ = _song_load(spark, d)
    return _lists_as_text(songs.read(spark))


def artist_load(spark, d):
    _, artists = _song_load(spark, d)
    return artists.read(spark)


class HalfTable(tables.ParquetTable):
    """A table whose first append stores half of the rows and then breaks off."""

    def append(self, df):
        broken = f"{self.path}_broken"
        if path_exists(df.sparkSession, broken):
            return super().append(df)
        make_folder(df.sparkSession, broken)
        super().append(df.filter(F.pmod(F.xxhash64(*df.columns), F.lit(2)) == 0))
        raise OSError("broken off")


def _play_load(spark, d):
    root = _folder(spark, "plays")
    files.write_parquet(fx.raw_plays(spark, d).drop("event_id"), f"{root}/raw")
    table = tables.ParquetTable(f"{root}/gold_play", schemas.GOLD_PLAY_DDL)
    table.append(incremental.keep_existing(plays(spark, d), fx.gold_play_ids(spark, d)).dropna())
    play.load_plays(spark, f"{root}/raw", f"{root}/gold", table)
    return root, table


def play_load(spark, d):
    _, table = _play_load(spark, d)
    return table.read(spark)


def play_gold_layer(spark, d):
    """The gold layer holds all cleaned plays, before deduplication and gate."""
    root, _ = _play_load(spark, d)
    return files.read_layer(spark, f"{root}/gold", "gold_play")


def play_stream_load(spark, d):
    """The play load as a stream over the raw zone, run until it has seen every file."""
    root = _folder(spark, "stream")
    files.write_parquet(fx.raw_plays(spark, d).drop("event_id"), f"{root}/raw")
    table = tables.ParquetTable(f"{root}/gold_play", schemas.GOLD_PLAY_DDL)
    table.append(incremental.keep_existing(plays(spark, d), fx.gold_play_ids(spark, d)).dropna())
    stream_plays(spark, f"{root}/raw", f"{root}/gold", table, f"{root}/checkpoint")
    return table.read(spark)


def _catalog_views(spark, d):
    """Gold tables in the catalog, filled and reported on."""
    root, tag = _folder(spark, "catalog"), f"_{uuid.uuid4().hex}"
    gold = [
        tables.ManagedTable(f"gold_song{tag}", schemas.GOLD_SONG_DDL, f"{root}/song"),
        tables.ManagedTable(f"gold_play{tag}", schemas.GOLD_PLAY_DDL, f"{root}/play"),
        tables.ManagedTable(f"gold_artist{tag}", schemas.GOLD_ARTIST_DDL, f"{root}/artist"),
    ]
    rows = [silver(spark, d), plays(spark, d), artist_normalized(spark, d)]
    for table, df in zip(gold, rows):
        table.create(spark)
        table.append(df)
    views.create_catalog_views(spark, *[t.name for t in gold], suffix=tag)
    return tag


def catalog_user_view(spark, d):
    return spark.table(f"user_view{_catalog_views(spark, d)}")


def catalog_track_view(spark, d):
    return spark.table(f"track_view{_catalog_views(spark, d)}")


def catalog_artist_view(spark, d):
    return spark.table(f"artist_view{_catalog_views(spark, d)}")


# --- real inputs: files that differ, values that do not fit, jobs that break off ---


def play_stream_many_files(spark, d):
    """Plays of the same tracks in many files, one file a micro-batch: the batch job's result."""
    root = _folder(spark, "stream")
    raw = fx.raw_plays(spark, d).withColumn("file", F.col("event_id") % 6).drop("event_id")
    raw.repartition("file").write.partitionBy("file").parquet(f"{root}/raw")
    table = tables.ParquetTable(f"{root}/gold_play", schemas.GOLD_PLAY_DDL)
    table.append(incremental.keep_existing(plays(spark, d), fx.gold_play_ids(spark, d)).dropna())
    stream_plays(spark, f"{root}/raw", f"{root}/gold", table, f"{root}/checkpoint", max_files=1)
    return table.read(spark)


def _resumed(load):
    """A load that breaks off at its first append, and its repetition under the same id."""
    run_id = uuid.uuid4().hex
    try:
        load(run_id)
    except OSError:
        load(run_id)


def play_load_resumed(spark, d):
    root = _folder(spark, "plays")
    files.write_parquet(fx.raw_plays(spark, d).drop("event_id"), f"{root}/raw")
    stored = incremental.keep_existing(plays(spark, d), fx.gold_play_ids(spark, d)).dropna()
    tables.ParquetTable(f"{root}/gold_play", schemas.GOLD_PLAY_DDL).append(stored)
    table = HalfTable(f"{root}/gold_play", schemas.GOLD_PLAY_DDL)
    _resumed(lambda run: play.load_plays(spark, f"{root}/raw", f"{root}/gold", table, run_id=run))
    return table.read(spark)


def _song_load_resumed(spark, d):
    root = _folder(spark, "songs")
    files.write_parquet(fx.raw_songs(spark, d), f"{root}/raw")
    song.raw_to_silver(spark, f"{root}/raw", f"{root}/silver")
    song.silver_to_gold(spark, f"{root}/silver", f"{root}/gold")
    kinds = {"gold_song": schemas.GOLD_SONG_DDL, "gold_artist": schemas.GOLD_ARTIST_DDL}
    rows = {"gold_song": _stored_songs(spark, d), "gold_artist": nested.normalize_artists(_stored_songs(spark, d)).dropna()}
    for name, ddl in kinds.items():
        tables.ParquetTable(f"{root}/{name}", ddl).append(rows[name])
    songs, artists = (HalfTable(f"{root}/{name}", ddl) for name, ddl in kinds.items())
    run_id = uuid.uuid4().hex
    for _ in range(3):  # broken off in the songs, then in the artists
        try:
            song.load_songs(spark, f"{root}/gold", songs, artists, run_id=run_id)
            break
        except OSError:
            pass
    return songs, artists


def song_load_resumed(spark, d):
    return _lists_as_text(_song_load_resumed(spark, d)[0].read(spark))


def artist_load_resumed(spark, d):
    return _song_load_resumed(spark, d)[1].read(spark)


def play_load_prefixed(spark, d):
    """The exporting service's own name for the URI column, and default arguments."""
    root = _folder(spark, "plays")
    raw = fx.raw_plays(spark, d).drop("event_id").withColumnRenamed("track_uri", "svc_track_uri")
    files.write_parquet(raw, f"{root}/raw")
    table = tables.ParquetTable(f"{root}/gold_play", schemas.GOLD_PLAY_DDL)
    table.append(incremental.keep_existing(plays(spark, d), fx.gold_play_ids(spark, d)).dropna())
    play.load_plays(spark, f"{root}/raw", f"{root}/gold", table)
    return table.read(spark)


def archive_mixed_schemas(spark, d):
    """Files of different columns, a partition value with zeros, and a file that is still being written."""
    root = _folder(spark, "latest")
    rows = fx.raw_plays(spark, d).select("event_id", "platform")
    even, odd = rows.filter("event_id % 2 = 0"), rows.filter("event_id % 2 = 1").withColumn("note", F.lit("noted"))
    files.write_parquet(even, f"{root}/latest/source_file=007")
    files.write_parquet(odd, f"{root}/latest/source_file=b")
    files.write_parquet(even, f"{root}/latest/_temporary/0")
    zones.archive_zone(spark, f"{root}/latest", f"{root}/archive", run_id="1")
    files.write_parquet(zones.read_zone(spark, f"{root}/archive"), f"{root}/read")
    left = spark.read.parquet(f"{root}/latest/_temporary/0").count()
    names = [f.rpartition("source_file=")[2].split("/")[0] for f in zones.data_files(spark, f"{root}/archive")]
    told = {"names": F.lit(",".join(sorted(set(names)))), "unfinished": F.lit(left).cast("bigint")}
    return spark.read.parquet(f"{root}/read").withColumns(told)


def mixed_footers_song(spark, d):
    """One file lacks the album, and one has its whole numbers as doubles."""
    root = _folder(spark, "songs")
    raw = fx.raw_songs(spark, d).withColumn("n", F.col("duration_ms") / 137 % 3)
    files.write_parquet(raw.filter("n = 0").drop("n", "album"), f"{root}/a")
    doubles = {c: F.col(c).cast("double") for c in ("key", "mode", "year")}
    files.write_parquet(raw.filter("n = 1").drop("n").withColumns(doubles), f"{root}/b")
    files.write_parquet(raw.filter("n = 2").drop("n"), f"{root}/c")
    return files.read_layer(spark, root, "raw").select("id", "album", "key", "mode", "year")


def mixed_columns_play(spark, d):
    """Exports with other names and types of columns, and one without albums."""
    root = _folder(spark, "plays")
    raw = fx.raw_plays(spark, d)
    even = raw.filter("event_id % 2 = 0").drop("event_id", "master_metadata_album_album_name")
    odd = raw.filter("event_id % 2 = 1").drop("event_id").withColumnRenamed("track_uri", "svc_track_uri")
    files.write_parquet(even.withColumn("ms_played", F.col("ms_played").cast("double")), f"{root}/a")
    files.write_parquet(odd, f"{root}/b")
    return clean.clean_plays(files.read_plays(spark, root))


def ingest_unequal_headers(spark, d):
    """Each file by its own header: other order, a missing column, types of its own."""
    landing, zone = _folder(spark, "landing"), _folder(spark, "zone")
    orders = fx.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    for part, df in enumerate((
        orders.filter("o_orderkey % 3 = 0"),
        orders.filter("o_orderkey % 3 = 1").select("o_orderstatus", "o_orderkey"),
        orders.filter("o_orderkey % 3 = 2").withColumn("o_custkey", F.col("o_custkey") + F.lit(0.5)),
    )):
        files.write_csv(df, f"{landing}_{part}")
    files.gather(spark, [f"{landing}_{part}" for part in range(3)], landing)
    zones.ingest_csv(spark, landing, zone)
    df = zones.read_zone(spark, zone)
    return df.select(F.col("o_orderkey").cast("bigint"), F.col("o_custkey").cast("double"), "o_orderstatus")


def csv_line_breaks(spark, d):
    source = _folder(spark, "csv")
    text_ = F.concat(F.lit('two "'), F.col("o_orderstatus"), F.lit('"\n lines, '), F.col("o_orderkey").cast("string"))
    rows = fx.table(spark, d, "orders").select("o_orderkey", text_.alias("note"))
    files.write_csv(rows, source)
    return files.read_csv(spark, source).withColumn("o_orderkey", F.col("o_orderkey").cast("bigint"))


def csv_malformed(spark, d):
    """Rows with too many fields are set aside, whole; rows with too few are filled."""
    source = _folder(spark, "csv")
    key, fields = F.col("o_orderkey"), "o_orderkey,o_custkey,o_orderstatus"
    line = F.when(key % 5 == 0, F.concat_ws(",", key, "o_custkey", F.lit('"a,b"'), F.lit("more")))
    line = line.when(key % 5 == 1, F.concat_ws(",", key, "o_custkey"))
    line = line.otherwise(F.concat_ws(",", key, "o_custkey", F.concat(F.lit('"x,'), F.col("o_orderstatus"), F.lit('"'))))
    rows = fx.table(spark, d, "orders").select(line.alias(fields))
    rows.write.option("header", True).option("sep", "\u0001").option("quote", "\u0002").csv(source)
    good = files.read_csv(spark, source, malformed="aside").select(
        F.col("o_orderkey").cast("bigint").alias("o_orderkey"), "o_orderstatus", F.lit(None).cast("string").alias("line")
    )
    aside = files.malformed_csv(spark, source)
    number = F.split("line", ",")[0].cast("bigint").alias("o_orderkey")
    return good.union(aside.select(number, F.lit(None).cast("string").alias("o_orderstatus"), "line"))


def csv_stray_quotes(spark, d):
    """Quotes in the middle of a field are characters: no row is cut, and one with a comma too many is set aside whole."""
    source = _folder(spark, "csv")
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    line = F.when(key % 5 == 0, F.concat_ws(",", key, F.lit('a "b, c" d'), status))
    line = line.when(key % 5 == 1, F.concat_ws(",", key, F.lit('5" disc'), status))
    line = line.when(key % 5 == 2, F.concat_ws(",", key, F.lit('"say ""hi, you"""'), status))
    line = line.when(key % 5 == 3, F.concat_ws(",", key, F.lit('x"y""z'), status)).otherwise(F.concat_ws(",", key, F.lit('"a"b'), status))
    rows = fx.table(spark, d, "orders").select(line.alias("o_orderkey,said,o_orderstatus"))
    rows.write.option("header", True).option("sep", "\u0001").option("quote", "\u0002").csv(source)
    number = F.col("o_orderkey").cast("bigint").alias("o_orderkey")
    good = files.read_csv(spark, source, malformed="aside").select(number, "said", "o_orderstatus", F.lit(None).cast("string").alias("line"))
    none = F.lit(None).cast("string")
    aside = files.malformed_csv(spark, source).withColumn("o_orderkey", F.split("line", ",")[0])
    return good.union(aside.select(number, none, none, "line"))


def csv_split_quotes(spark, d):
    """One file with line breaks, commas and quotes in its fields, cut among tasks; rows with a field too many are set aside."""
    source = _folder(spark, "csv")
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    line = F.when(key % 7 == 0, F.concat_ws(",", key, F.lit('"a, b","c\nd"'), F.lit("more")))
    line = line.when(key % 7 < 3, F.concat_ws(",", key, F.lit('"two ""lines"",\n\n, here"'), status))
    line = line.when(key % 7 == 3, F.concat_ws(",", key, F.lit('5" disc'), status)).otherwise(F.concat_ws(",", key, F.date_format("o_orderdate", "yyyy-MM-dd"), status))

    def write(batches):  # Spark's writer would quote fields with line breaks anew
        fs, root = open_store(source)
        fs.create_dir(root, recursive=True)
        with fs.open_output_stream(f"{root}/orders.csv") as f:
            f.write(b"o_orderkey,said,o_orderstatus\n")
            for batch in batches:
                f.write("".join(f"{line}\n" for line in batch.column("line").to_pylist()).encode())
                yield batch

    fx.table(spark, d, "orders").select(line.alias("line")).coalesce(1).mapInArrow(write, "line string").count()
    number, block = F.col("o_orderkey").cast("bigint").alias("o_orderkey"), 16 << 10
    good = files.read_csv(spark, source, malformed="aside", block=block)
    good = good.select(number, "said", "o_orderstatus", F.lit(None).cast("string").alias("line"))
    none = F.lit(None).cast("string")
    aside = files.malformed_csv(spark, source, block=block).withColumn("o_orderkey", F.split("line", ",")[0])
    return good.union(aside.select(number, none, none, "line"))


def _nested_landing(spark, d, same_headers):
    """Files of one name at two depths, with one header or two, an empty one, and one that is still being written."""
    landing = _folder(spark, "landing")
    orders = fx.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    for place, kept in (("", 0), ("sub", 1), ("sub/year=1/deep", 2), ("_draft", 3)):
        part = orders.filter(f"o_orderkey % 3 = {kept % 3}")
        part = part if same_headers or kept != 1 else part.select("o_orderstatus", "o_orderkey")
        files.write_csv(part.coalesce(1), f"{landing}_{kept}")
        fs, p = file_system(spark, f"{landing}/{place}/orders.csv")
        make_folder(spark, f"{landing}/{place}")
        (written,) = fs.globStatus(file_system(spark, f"{landing}_{kept}/part-*.csv")[1])
        fs.rename(written.getPath(), p)
    fs, p = file_system(spark, f"{landing}/sub/nothing.csv")
    fs.create(p).close()
    return landing


def ingest_nested(spark, d):
    """Files in sub-folders are ingested like others, each under its path, and files of one name stay apart."""
    landing, zone = _nested_landing(spark, d, True), _folder(spark, "zone")
    zones.ingest_csv(spark, landing, zone)
    rows = spark.read.parquet(zone).select("o_orderkey", "o_custkey", "o_orderstatus", "source_file")
    return rows.withColumns({c: F.col(c).cast("bigint") for c in ("o_orderkey", "o_custkey")})


def ingest_nested_headers(spark, d):
    """The same with a file of another header among them: nothing appears or vanishes."""
    landing, zone = _nested_landing(spark, d, False), _folder(spark, "zone")
    zones.ingest_csv(spark, landing, zone)
    df = zones.read_zone(spark, zone)
    return df.select(F.col("o_orderkey").cast("bigint"), F.col("o_custkey").cast("bigint"), "o_orderstatus")


def archive_nested(spark, d):
    """A zone with plain sub-folders moves whole: rows and count as before, nothing is left but what is being written."""
    root = _folder(spark, "latest")
    rows = fx.raw_plays(spark, d).select("event_id", "platform")
    for place, kept in (("", 0), ("/sub", 1), ("/sub/deep", 2), ("/_temporary/0", 3)):
        files.write_parquet(rows.filter(f"event_id % 3 = {kept % 3}"), f"{root}/latest{place}", "append")
    moved = zones.archive_zone(spark, f"{root}/latest", f"{root}/archive", run_id="1")
    again = zones.archive_zone(spark, f"{root}/latest", f"{root}/archive", run_id="1")
    files.write_parquet(zones.read_zone(spark, f"{root}/archive"), f"{root}/read")
    left = zones.list_files(spark, f"{root}/latest").count()
    told = {"moved": F.lit(moved).cast("bigint"), "again": F.lit(again).cast("bigint"), "left_over": F.lit(left).cast("bigint")}
    return spark.read.parquet(f"{root}/read").withColumns(told)


def backfill_odd_names(spark, d):
    """Artists whose names are missing or hold commas, quotes and backslashes keep their ids."""
    out = _folder(spark, "backfill")

    def fetch(keys):
        import re

        names = [None, "Earth, Wind & Fire", "D'Arc", 'The "X"', "back\\slash", "None", ""]
        reply = []
        for key in keys:
            n = int(re.sub(r"\D", "", key))
            artists = [{"id": f"a{n}-{i}", "name": names[(n + i) % len(names)]} for i in range(3)]
            reply.append({"id": key, "name": "x", "album": None, "artists": artists})
        return reply

    songs = silver(spark, d)
    backfill.backfill_missing(spark, plays(spark, d), songs, fetch, out, pause=(0, 0), concurrency=8)
    rows = clean.clean_songs(files.read_layer(spark, out, "raw"), list_mode="literal")
    return nested.normalize_artists(rows).select("id", "artist", "artist_id")


def lookup_errors(spark, d):
    """A service that refuses some keys, is busy once for others, and fails for the rest."""

    def fetch(keys):
        import re

        class Answer(Exception):
            def __init__(self, status):
                self.http_status = status

        (key,) = keys
        n = int(re.sub(r"\D", "", key))
        busy = fetch.__dict__.setdefault("busy", set())
        if n % 4 == 0:
            raise Answer(404)
        if n % 4 == 1:
            raise OSError("no answer")
        if n % 4 == 2 and key not in busy:
            busy.add(key)
            raise Answer(429)
        return [{"id": "somebody else's"}, {"id": key}] if n % 3 else [None]

    keys = incremental.missing_keys(plays(spark, d), silver(spark, d), drop_blank=True)
    found = enrich.lookup(keys, "id", fetch, batch_size=1, attempts=2, base_delay=0, pause=(0, 0))
    return found.select("key", "status", "attempts")


def enforce_fractions(spark, d):
    """Fractions do not fit whole numbers; whole numbers written as fractions do."""
    raw = fx.raw_songs(spark, d).select(
        "id",
        F.concat(F.col("year").cast("string"), F.when(F.col("year") % 2 == 0, ".0").otherwise(".5")).alias("year"),
        (F.col("key") + F.when(F.col("year") % 2 == 0, 0.0).otherwise(0.25)).alias("key"),
    )
    schema = schemas.target_schema("id STRING, year INT, key INT")
    return schemas.enforce(raw, schema)


def play_incremental_partly_stored(spark, d):
    """Of a stored track only some plays are stored; the others are new by time and track."""
    stored = plays(spark, d).filter("seconds_played % 2 = 0").select("ts", "id")
    return incremental.drop_existing(plays(spark, d), stored, ["ts", "id"])


def dq_out_of_range(spark, d):
    """Values outside of a set and of a range."""
    df = silver(spark, d).select("id", "mode", "energy").withColumns({
        "mode": F.when(F.col("energy") > 0.9, "Dorian").otherwise(F.col("mode")),
        "energy": F.when(F.col("energy") < 0.1, F.col("energy") - 1).otherwise(F.col("energy")),
    })
    suite = quality.Suite("odd").expect(quality.IN_SET, column="mode", value_set=["Minor", "Major"])
    suite = suite.expect(quality.BETWEEN, column="energy", min_value=0.0, max_value=1.0)
    flagged = quality.flag_rows(df, suite)
    return flagged.select("id", "mode", F.array_join("violations", ",").alias("violations"))


def dq_unique_rows(spark, d):
    """The whole rows that break the uniqueness rules of a suite."""
    suite = quality.Suite("u").expect(quality.NOT_NULL, column="ts").expect(quality.UNIQUE, column="id")
    return quality.unique_violations(plays(spark, d).select("id", "ts"), suite)


def all_queries() -> dict:
    chosen = [
        song_clean_text, song_clean_explicit, song_null_tokens, song_clean_features, song_decode_key_mode,
        song_decode_double_key, song_duration_seconds, song_release_date, song_parse_lists,
        song_parse_lists_literal, song_silver, song_schema_enforced, play_clean, play_uri_parts, play_platform,
        play_timestamp_parse, null_stats, null_gate_song, null_gate_quarantine, duplicates_by_key,
        profile_columns, numeric_filter, artist_normalized, artist_gated, song_incremental, artist_incremental,
        play_incremental, play_incremental_by_time, missing_ids, missing_ids_resolvable, fk_violations,
        user_view, track_view, artist_view, dq_song_suite, dq_incremental, dq_play_suite, dq_flagged_rows, dq_unique_violations,
        dq_within_record, dq_max_between, dq_lengths, dq_primary_key, json_flatten, union_missing_columns,
        track_flatten, track_popularity, distinct_keys, lookup_status, backfill_rows, backfilled_silver, popularity_rows,
        play_incremental_filtered, lookup_rate_limited, profile_sketches, fk_violations_bucketed, dq_suite_from_file,
        song_missing_rule, empty_layers, csv_stray_quotes, ingest_nested, ingest_nested_headers, archive_nested,
        split_chunk_sizes, split_csv_files, split_csv_permuted, csv_parquet_roundtrip, ingest_without_personal_data,
        archive_roundtrip, json_to_csv, filter_csv, song_load, artist_load, play_load, play_gold_layer, play_stream_load,
        catalog_user_view, catalog_track_view, catalog_artist_view,
        play_stream_many_files, play_load_resumed, song_load_resumed, artist_load_resumed, play_load_prefixed,
        archive_mixed_schemas, mixed_footers_song, mixed_columns_play, ingest_unequal_headers, csv_line_breaks,
        csv_malformed, csv_split_quotes, json_variant_flatten, backfill_odd_names, lookup_errors, enforce_fractions, play_incremental_partly_stored,
        dq_out_of_range, dq_unique_rows,
    ]
    return {f.__name__: f for f in chosen}
