"""The expected result of each registered query, as SQL over the driver's tables."""

from __future__ import annotations

from workload import fixtures as fx

# Fixed values, stated here apart from the library so that the check is independent of it.
PITCHES = ["C", "C♯/D♭", "D", "D♯/E♭", "E", "F", "F♯/G♭", "G", "G♯/A♭", "A", "A♯/B♭", "B"]
MEASURES = [
    "danceability", "energy", "loudness", "speechiness", "acousticness", "instrumentalness", "liveness",
    "valence", "tempo",
]
SONG_COLUMNS = [
    "id", "name", "album", "album_id", "artists", "artist_ids", "track_number", "disc_number", "explicit",
    "danceability", "energy", "key", "loudness", "mode", "speechiness", "acousticness", "instrumentalness",
    "liveness", "valence", "tempo", "duration_ms", "time_signature", "year", "release_date",
]
PLAY_COLUMNS = [
    "id", "ts", "platform", "seconds_played", "track_name", "album_artist_name", "album_name", "type",
]
MAX_YEAR = 2025


def _items(c):
    strip = r"^\[''|''\]$|^''|''$|^\[|\]$"
    return f"list_transform(string_split({c}, ','), lambda x: regexp_replace(trim(x), '{strip}', '', 'g'))"


def _round(c):
    return f"round({c}, {4 if c in ('speechiness', 'acousticness', 'instrumentalness') else 3}) AS {c}"


def _pitch(c):
    cases = " ".join(f"WHEN {i} THEN '{p}'" for i, p in enumerate(PITCHES))
    return f"CASE {c} {cases} END"


SILVER = f"""
SELECT id, trim(name) AS name, trim(album) AS album, album_id,
  {_items("artists")} AS artists, {_items("artist_ids")} AS artist_ids,
  track_number, disc_number,
  CASE lower(trim(explicit)) WHEN 'true' THEN TRUE WHEN 'false' THEN FALSE END AS explicit,
  {_round("danceability")}, {_round("energy")}, {_pitch("key")} AS key, {_round("loudness")},
  CASE mode WHEN 0 THEN 'Minor' WHEN 1 THEN 'Major' END AS mode,
  {", ".join(_round(c) for c in MEASURES[3:])},
  round(cast(duration_ms AS double) / 1000, 0) AS duration_ms, time_signature, year,
  CASE WHEN regexp_full_match(release_date, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}')
       THEN cast(try_strptime(release_date, '%Y-%m-%d') AS date) END AS release_date
FROM raw_song"""

PLAYS = r"""
SELECT regexp_extract(track_uri, '\w*:\w*:(\w*)', 1) AS id,
  date_trunc('second', ts) AS ts,
  regexp_extract(lower(trim(platform)), '(android|windows|ios|web)', 1) AS platform,
  cast(round(cast(ms_played AS double) / 1000, 0) AS int) AS seconds_played,
  master_metadata_track_name AS track_name, master_metadata_album_artist_name AS album_artist_name,
  master_metadata_album_album_name AS album_name,
  regexp_extract(track_uri, '\w*:(\w*):', 1) AS type
FROM raw_play"""


def _any_null(columns):
    return "(" + " OR ".join(f"{c} IS NULL" for c in columns) + ")"


def _gated(source, counted, columns):
    """The null gate: complete rows when few are incomplete, and no rows when the gate would fail."""
    return f"""
SELECT * FROM {source}
WHERE NOT {_any_null(columns)} AND (SELECT
  count(*) FILTER (WHERE {_any_null(counted)}) <= 10 OR
  count(*) FILTER (WHERE {_any_null(counted)}) < 0.1 * count(*) FROM {source})"""


COUNTED = [c for c in SONG_COLUMNS if c != "release_date"]
ARTIST_COLUMNS = ["id", "name", "artist", "artist_id"]
ARTISTS = """
SELECT id, name, artists[i] AS artist, artist_ids[i] AS artist_id
FROM (SELECT *, unnest(range(1, greatest(len(artists), len(artist_ids)) + 1)) AS i FROM silver)"""

# Each step may refer to the ones before it.
STEPS = {
    "raw_song": fx.RAW_SONG,
    "raw_play": fx.RAW_PLAY,
    "gold_song_ids": fx.GOLD_SONG_IDS,
    "gold_play_ids": fx.GOLD_PLAY_IDS,
    "silver": SILVER,
    "plays": PLAYS,
    "gated_song": _gated("silver", COUNTED, SONG_COLUMNS),
    "artist": ARTISTS,
    "gated_artist": _gated("artist", ARTIST_COLUMNS, ARTIST_COLUMNS),
    "missing": "SELECT DISTINCT p.id FROM plays p WHERE NOT EXISTS (SELECT 1 FROM silver s WHERE s.id = p.id)",
    "wanted": "SELECT id, cast(regexp_extract(id, '([0-9]+)', 1) AS bigint) AS n FROM missing "
    "WHERE id IS NOT NULL AND id <> ''",
    "backfilled": """
SELECT id, concat('Name ', n) AS name, concat('Album ', n % 50) AS album, concat('alb', n % 50) AS album_id,
  concat('[''Artist ', n % 9, ''']') AS artists, concat('[''a', n % 9, ''']') AS artist_ids,
  cast(n % 15 AS int) AS track_number, cast(1 AS int) AS disc_number,
  CASE WHEN n % 2 = 0 THEN 'true' ELSE 'false' END AS explicit,
  cast(NULL AS double) AS danceability, cast(NULL AS double) AS energy, cast(NULL AS int) AS key,
  cast(NULL AS double) AS loudness, cast(NULL AS int) AS mode, cast(NULL AS double) AS speechiness,
  cast(NULL AS double) AS acousticness, cast(NULL AS double) AS instrumentalness,
  cast(NULL AS double) AS liveness, cast(NULL AS double) AS valence, cast(NULL AS double) AS tempo,
  n * 1000 AS duration_ms, cast(NULL AS int) AS time_signature, cast(1999 AS int) AS year,
  '1999-12-31' AS release_date
FROM wanted WHERE n % 11 <> 0""",
}


def _q(body: str) -> str:
    """A query with the steps it needs, found by name, as common table expressions."""
    needed: list[str] = []

    def need(text):
        for name in STEPS:
            if name in text.replace("(", " ").replace(")", " ").split() and name not in needed:
                need(STEPS[name])
                needed.append(name)

    need(body)
    ctes = ",\n".join(f"{name} AS ({STEPS[name]})" for name in needed)
    return f"WITH {ctes}\n{body}" if ctes else body


def _flat(prefix=""):
    """All song columns, lists as text."""
    as_text = "list_aggregate(list_transform({0}, lambda x: coalesce(x, '~')), 'string_agg', '|') AS {1}"
    return ", ".join(
        as_text.format(prefix + c, c) if c in ("artists", "artist_ids") else prefix + c for c in SONG_COLUMNS
    )


NULLS = "cast(NULL AS bigint) AS {0}"


def _static(no, rule, column, ok, observed):
    return (
        f"SELECT {no} AS rule_no, '{rule}' AS expectation, '{column}' AS column_name, {ok} AS success, "
        f"{', '.join(NULLS.format(c) for c in ('element_count', 'missing_count', 'unexpected_count'))}, "
        f"cast(NULL AS double) AS unexpected_percent, {observed} AS observed FROM (SELECT 1)"
    )


def _counted(no, rule, column, source, missing, bad, all_rows=False):
    base = "n" if all_rows else "n - m"
    return (
        f"SELECT {no} AS rule_no, '{rule}' AS expectation, '{column}' AS column_name, u = 0 AS success, "
        "n AS element_count, m AS missing_count, u AS unexpected_count, "
        f"CASE WHEN {base} > 0 THEN u * cast(100 AS double) / ({base}) ELSE cast(0 AS double) END "
        "AS unexpected_percent, cast(NULL AS varchar) AS observed FROM "
        f"(SELECT count(*) AS n, count(*) FILTER (WHERE {missing}) AS m, "
        f"count(*) FILTER (WHERE {bad}) AS u FROM {source})"
    )


def _not_null(no, column, source):
    gap = f"{column} IS NULL"
    return _counted(no, "expect_column_values_to_not_be_null", column, source, gap, gap, all_rows=True)


def _values(no, rule, column, source, bad):
    return _counted(no, rule, column, source, f"{column} IS NULL", bad)


def _unique(no, rule, columns, source):
    listed = ", ".join(columns)
    none = " AND ".join(f"{c} IS NULL" for c in columns)
    windowed = f"(SELECT *, count(*) OVER (PARTITION BY {listed}) AS copies FROM {source})"
    return _counted(no, rule, ",".join(columns), windowed, f"({none})", f"copies > 1 AND NOT ({none})")


def _song_suite():
    rules = []

    def add(f, *args):
        rules.append(f(len(rules) + 1, *args))

    ordered = ",".join(SONG_COLUMNS)
    add(_static, "expect_table_columns_to_match_ordered_list", ordered, "TRUE", f"'{ordered}'")
    for c in ["id", "album_id", "artists", "artist_ids", "danceability", "energy", "key", *MEASURES[2:]]:
        add(_not_null, c, "silver")
    of_type = "expect_column_values_to_be_of_type"
    for c in ["track_number", "disc_number", "duration_ms", "time_signature", "year"]:
        kind = "double" if c == "duration_ms" else "int"
        add(_static, of_type, c, "FALSE" if c == "duration_ms" else "TRUE", f"'{kind}'")
    for c in MEASURES:
        add(_static, of_type, c, "TRUE", "'double'")
    between = "expect_column_values_to_be_between"
    for c in MEASURES:
        if c not in ("loudness", "tempo"):
            add(_values, between, c, "silver", f"{c} < 0 OR {c} > 1")
    add(_static, of_type, "explicit", "TRUE", "'boolean'")
    in_set = "expect_column_values_to_be_in_set"
    add(_values, in_set, "mode", "silver", "mode NOT IN ('Major', 'Minor')")
    listed = ", ".join(f"'{p}'" for p in PITCHES)
    add(_values, in_set, "key", "silver", f"key NOT IN ({listed})")
    add(_values, between, "year", "silver", f"year < 1800 OR year > {MAX_YEAR}")
    add(_unique, "expect_column_values_to_be_unique", ["id"], "silver")
    return "\nUNION ALL ".join(rules)


def _play_suite():
    order = ["ts", "id", *[c for c in PLAY_COLUMNS if c not in ("ts", "id")]]
    listed = ",".join(order)
    texts = ", ".join(f"coalesce(cast({c} AS varchar), '<null>')" for c in order)
    none = " AND ".join(f"{c} IS NULL" for c in order)
    rules = [
        _static(1, "expect_table_columns_to_match_ordered_list", listed, "FALSE", f"'{','.join(PLAY_COLUMNS)}'"),
        _counted(
            2,
            "expect_select_column_values_to_be_unique_within_record",
            listed,
            "plays",
            f"({none})",
            f"len(list_distinct([{texts}])) < 8 AND NOT ({none})",
        ),
    ]
    for i, c in enumerate(["ts", "id", "seconds_played", "track_name", "album_artist_name"], start=3):
        rules.append(_not_null(i, c, "plays"))
    rules.append(_values(8, "expect_column_values_to_be_between", "seconds_played", "plays", "seconds_played < 0"))
    return "\nUNION ALL ".join(rules)


def _maxima():
    line = (
        "SELECT {no} AS rule_no, 'expect_column_max_to_be_between' AS expectation, '{c}' AS column_name, "
        "max({c}) BETWEEN {low} AND {high} AS success, "
        "cast(NULL AS bigint) AS element_count, cast(NULL AS bigint) AS missing_count, "
        "cast(NULL AS bigint) AS unexpected_count, cast(NULL AS double) AS unexpected_percent, "
        "cast(max({c}) AS varchar) AS observed FROM silver "
    )
    year = line.format(no=1, c="year", low=1900, high=MAX_YEAR)
    return year + " UNION ALL " + line.format(no=2, c="track_number", low=1, high=10)


def _lengths():
    limits = {"id": 255, "album_id": 255, "artists": 255, "artist_ids": 255, "key": 10, "mode": 5}
    rules = []
    for no, (c, n) in enumerate(limits.items(), start=1):
        bad = f"length({c}) > {n}"
        if c in ("artists", "artist_ids"):
            bad = f"len(list_filter({c}, lambda x: length(x) > {n})) > 0"
        rules.append(_values(no, "expect_column_value_lengths_to_be_between", c, "silver", bad))
    return "\nUNION ALL ".join(rules)


def _primary_key():
    rules = [_not_null(1, "id", "artist"), _not_null(2, "artist_id", "artist")]
    rules.append(_unique(3, "expect_compound_columns_to_be_unique", ["id", "artist_id"], "artist"))
    return "\nUNION ALL ".join(rules)


def _profile():
    types = dict.fromkeys(["track_number", "disc_number", "key", "mode", "time_signature", "year"], "int")
    types |= dict.fromkeys(MEASURES, "double") | {"duration_ms": "bigint"}
    return "\nUNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS column_name, '{types.get(c, 'string')}' AS column_type, "
        f'count(*) AS "rows", count(*) - count({c}) AS nulls FROM raw_song '
        for i, c in enumerate(SONG_COLUMNS)
    )


def _quoted_items(c):
    """Quote-aware list items, for the quoting that occurs in the input."""
    double = f"""regexp_extract_all({c}, '"([^"]*)"', 1)"""
    single = f"regexp_extract_all({c}, '''([^'']*)''', 1)"
    return f"CASE WHEN contains({c}, '\"') THEN {double} ELSE {single} END"


def _quoted_text(c):
    joined = f"list_aggregate({_quoted_items(c)}, 'string_agg', '|')"
    return f"CASE WHEN {c} = '[]' THEN '' ELSE {joined} END AS {c}"


TRACKS = """
SELECT concat('trk', p_partkey) AS id, p_name AS name, p_type AS album, concat('alb', p_size) AS album_id,
  concat('[''', p_brand, ''', ''', p_type, ''']') AS artists, concat('[''', lower(p_brand), ''', ''x'']') AS artist_ids,
  p_size AS track_number, cast(1 AS int) AS disc_number,
  CASE WHEN p_size > 10 THEN 'true' ELSE 'false' END AS explicit,
  cast(NULL AS double) AS danceability, cast(NULL AS double) AS energy, cast(NULL AS int) AS key,
  cast(NULL AS double) AS loudness, cast(NULL AS int) AS mode, cast(NULL AS double) AS speechiness,
  cast(NULL AS double) AS acousticness, cast(NULL AS double) AS instrumentalness,
  cast(NULL AS double) AS liveness, cast(NULL AS double) AS valence, cast(NULL AS double) AS tempo,
  p_partkey * 1000 AS duration_ms, cast(NULL AS int) AS time_signature, cast(2001 AS int) AS year,
  CASE WHEN p_size > 25 THEN '2001-02-03' ELSE '2001' END AS release_date
FROM part WHERE p_size <> 7"""

# The stored target first, then the new rows that pass the gate.
STORED_SONGS = f"SELECT * FROM silver WHERE id IN (SELECT id FROM gold_song_ids ) AND NOT {_any_null(SONG_COLUMNS)}"
STORED_PLAYS = f"SELECT * FROM plays WHERE id IN (SELECT id FROM gold_play_ids ) AND NOT {_any_null(PLAY_COLUMNS)}"
NEW_PLAYS = "SELECT * FROM plays WHERE NOT EXISTS (SELECT 1 FROM stored_plays t WHERE t.id = plays.id )"
ARTIST_OF_GATED = """
SELECT id, name, artists[i] AS artist, artist_ids[i] AS artist_id
FROM (SELECT *, unnest(range(1, greatest(len(artists), len(artist_ids)) + 1)) AS i FROM gated_song )"""
STEPS |= {
    "stored_songs": STORED_SONGS,
    "new_songs": "SELECT * FROM gated_song WHERE id NOT IN (SELECT id FROM stored_songs )",
    "loaded_songs": f"SELECT * FROM stored_songs UNION ALL ({_gated('new_songs', COUNTED, SONG_COLUMNS)})",
    "all_artists": ARTIST_OF_GATED,
    "stored_artists": """
SELECT * FROM (SELECT id, name, artists[i] AS artist, artist_ids[i] AS artist_id
  FROM (SELECT *, unnest(range(1, greatest(len(artists), len(artist_ids)) + 1)) AS i FROM stored_songs ))
WHERE artist IS NOT NULL AND artist_id IS NOT NULL""",
    "new_artists": "SELECT * FROM all_artists WHERE id NOT IN (SELECT id FROM stored_artists )",
    "loaded_artists": "SELECT * FROM stored_artists UNION ALL "
    f"({_gated('new_artists', ARTIST_COLUMNS, ARTIST_COLUMNS)})",
    "stored_plays": STORED_PLAYS,
    "new_plays": NEW_PLAYS,
    "loaded_plays": f"SELECT * FROM stored_plays UNION ALL ({_gated('new_plays', PLAY_COLUMNS, PLAY_COLUMNS)})",
}


def all_oracles() -> dict[str, str]:
    measures = ", ".join(MEASURES)
    play_columns = ", ".join(PLAY_COLUMNS)
    raw = ", ".join(c for c in SONG_COLUMNS if c != "explicit")
    track = ["energy", "loudness", "danceability", *MEASURES[3:]]
    bodies = {
        "song_clean_text": "SELECT id, name, album FROM silver",
        "song_clean_explicit": "SELECT id, explicit FROM silver",
        "song_null_tokens": "SELECT id, lower(trim(explicit)) AS folded, CASE WHEN lower(trim(explicit)) "
        "IN ('nan', 'null', '') THEN '' ELSE lower(trim(explicit)) END AS scrubbed FROM raw_song",
        "song_clean_features": f"SELECT id, {measures} FROM silver",
        "song_decode_key_mode": "SELECT id, key, mode FROM silver",
        "song_decode_double_key": "SELECT id, key, mode FROM silver",
        "song_duration_seconds": "SELECT id, duration_ms FROM silver",
        "song_release_date": "SELECT id, release_date FROM silver",
        "song_parse_lists": "SELECT id, array_to_string(artists, '|') AS artists, "
        "array_to_string(artist_ids, '|') AS artist_ids FROM silver",
        "song_parse_lists_literal": f"SELECT id, {_quoted_text('artists')}, {_quoted_text('artist_ids')} FROM raw_song",
        "song_silver": f"SELECT {_flat()} FROM silver",
        "song_schema_enforced": "SELECT id, track_number, disc_number, key, mode, duration_ms, time_signature, "
        "year FROM raw_song",
        "play_clean": f"SELECT {play_columns} FROM plays",
        "play_uri_parts": r"SELECT event_id, regexp_extract(track_uri, '\w*:\w*:(\w*)', 1) AS id, "
        r"regexp_extract(track_uri, '\w*:(\w*):', 1) AS type, "
        r"'svc:track:' || regexp_extract(track_uri, '\w*:\w*:(\w*)', 1) AS rebuilt FROM raw_play",
        "play_platform": "SELECT event_id, regexp_extract(lower(trim(platform)), '(android|windows|ios|web)', 1) "
        "AS platform FROM raw_play",
        "play_timestamp_parse": "SELECT event_id, strptime(strftime(ts, '%Y-%m-%dT%H:%M:%SZ'), "
        "'%Y-%m-%dT%H:%M:%SZ') AS ts FROM raw_play",
        "null_stats": "SELECT cast(n_null AS double) / n_rows AS rate, n_null, n_rows FROM (SELECT "
        f"count(*) FILTER (WHERE {_any_null(COUNTED)}) AS n_null, count(*) AS n_rows FROM silver )",
        "null_gate_song": f"SELECT {_flat()} FROM gated_song",
        "null_gate_quarantine": f"SELECT {play_columns}, {_any_null(PLAY_COLUMNS)} AS rejected FROM plays",
        "duplicates_by_key": "SELECT album_id, mode, count(*) AS n FROM silver GROUP BY album_id, mode "
        "HAVING count(*) > 1",
        "profile_columns": _profile(),
        "numeric_filter": "SELECT * FROM lineitem WHERE l_quantity > 10",
        "artist_normalized": "SELECT * FROM artist",
        "artist_gated": "SELECT * FROM gated_artist",
        "song_incremental": f"SELECT {_flat('s.')} FROM silver s WHERE NOT EXISTS "
        "(SELECT 1 FROM gold_song_ids g WHERE g.id = s.id)",
        "artist_incremental": "SELECT * FROM artist a WHERE NOT EXISTS "
        "(SELECT 1 FROM gold_song_ids g WHERE g.id = a.id)",
        "play_incremental": "SELECT * FROM plays p WHERE NOT EXISTS "
        "(SELECT 1 FROM gold_play_ids g WHERE g.id = p.id)",
        "play_incremental_filtered": "SELECT * FROM plays p WHERE NOT EXISTS "
        "(SELECT 1 FROM gold_play_ids g WHERE g.id = p.id)",
        "play_incremental_by_time": "SELECT * FROM plays p WHERE NOT EXISTS (SELECT 1 FROM plays q WHERE "
        "q.id = p.id AND q.ts = p.ts AND q.id IN (SELECT id FROM gold_play_ids ))",
        "missing_ids": "SELECT id FROM missing",
        "missing_ids_resolvable": "SELECT id FROM wanted",
        "fk_violations": "SELECT id, ts FROM plays p WHERE id IS NOT NULL AND NOT EXISTS "
        "(SELECT 1 FROM silver s WHERE s.id = p.id)",
        "user_view": "SELECT album_artist_name, track_name, id AS track_id, album_name, seconds_played, "
        "cast(ts AS date) AS activity_date, cast(extract(hour FROM ts) AS int) AS hour_of_day, "
        "strftime(ts, '%a') AS day_of_week, cast(extract(month FROM ts) AS int) AS month_of_year FROM plays",
        "track_view": f"SELECT id AS track_id, album_id, year, key, mode, {', '.join(track)}, "
        "artist_ids[1] AS primary_artist_id FROM gated_song",
        "artist_view": "SELECT artist, artist_id FROM gated_artist",
        "dq_song_suite": _song_suite(),
        "dq_suite_from_file": _song_suite(),
        "dq_incremental": _song_suite(),
        "song_missing_rule": "SELECT id, name, cast(NULL AS double) AS tempo FROM silver",
        "empty_layers": "SELECT count(*) AS n, cast(sum(seconds_played) AS bigint) AS seconds, cast(8 AS int) AS play_columns, "
        "cast(24 AS int) AS song_columns FROM plays",
        "fk_violations_bucketed": "SELECT id, ts FROM plays p WHERE id IS NOT NULL AND NOT EXISTS "
        "(SELECT 1 FROM silver s WHERE s.id = p.id)",
        "dq_play_suite": _play_suite(),
        "dq_flagged_rows": "SELECT id, key, '8' AS violations FROM silver WHERE key IS NULL",
        "dq_unique_violations": "SELECT id, ts, album_artist_name FROM plays WHERE id IN "
        "(SELECT id FROM plays GROUP BY id HAVING count(*) > 1)",
        "dq_within_record": "SELECT ts, platform, type, id FROM plays WHERE len(list_distinct([coalesce(platform, "
        "'<null>'), coalesce(type, '<null>'), coalesce(id, '<null>')])) < 3",
        "dq_max_between": _maxima(),
        "dq_lengths": _lengths(),
        "dq_primary_key": _primary_key(),
        "json_flatten": "SELECT event_id, user_id, cast(regexp_extract(props, '\"k\": ?(-?[0-9]+)', 1) "
        "AS bigint) AS user_props_k FROM events",
        "union_missing_columns": "SELECT event_id, user_id, value, cast(NULL AS varchar) AS event_type FROM events "
        "UNION ALL SELECT event_id, NULL, NULL, event_type FROM events",
        "track_flatten": TRACKS,
        "track_popularity": "SELECT concat('trk', p_partkey) AS id, cast(p_size * 2 AS int) AS popularity FROM part "
        "WHERE p_size <> 7",
        "distinct_keys": "SELECT DISTINCT id FROM plays WHERE id IS NOT NULL",
        "lookup_status": "SELECT id AS key, CASE WHEN n % 11 = 0 THEN 'absent' ELSE 'found' END AS status, "
        "cast(1 AS int) AS attempts FROM wanted",
        "profile_sketches": " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) AS rows, count(*) - count({c}) AS nulls, true AS distinct_fits, "
            f"cast({q} AS boolean) AS quantiles_fit, cast({t} AS boolean) AS top_fits FROM plays"
            for c, q, t in (("id", "NULL", "NULL"), ("platform", "NULL", "true"), ("seconds_played", "true", "NULL"))
        ),
        "lookup_rate_limited": "SELECT id AS key, CASE WHEN n % 11 = 0 THEN 'absent' ELSE 'found' END AS status, true AS asked "
        "FROM wanted",
        "backfill_rows": "SELECT * FROM backfilled",
        "backfilled_silver": f"SELECT {_flat()} FROM ({SILVER.replace('raw_song', 'backfilled ')})",
        "popularity_rows": "SELECT id, cast(n % 101 AS int) AS popularity FROM (SELECT DISTINCT id, "
        "cast(regexp_extract(id, '([0-9]+)', 1) AS bigint) AS n FROM raw_song ) WHERE n % 11 <> 0",
        "split_chunk_sizes": "SELECT count(*) AS n_rows, cast(0 AS bigint) AS sizes_out_of_range, "
        "cast(0 AS bigint) AS overlaps, cast(1 AS bigint) AS last_chunks, cast(1 AS bigint) AS first_chunk "
        "FROM lineitem",
        "split_csv_files": "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders",
        "csv_stray_quotes": "SELECT o_orderkey, CASE o_orderkey % 5 WHEN 1 THEN '5\" disc' WHEN 2 THEN 'say \"hi, you\"' "
        "WHEN 3 THEN 'x\"y\"\"z' WHEN 4 THEN '\"a\"b' END AS said, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderstatus END "
        "AS o_orderstatus, CASE WHEN o_orderkey % 5 = 0 THEN concat(o_orderkey, ',a \"b, c\" d,', o_orderstatus) END AS line "
        "FROM orders",
        "json_variant_flatten": "SELECT event_id AS id, CASE event_id % 3 WHEN 0 THEN cast(user_id AS varchar) WHEN 1 THEN "
        "concat('{\"n\":', user_id, ',\"type\":\"', event_type, '\"}') ELSE event_type END AS what, "
        "CASE WHEN event_id % 3 > 0 THEN user_id END AS who_id, CASE WHEN event_id % 3 > 0 THEN event_type END AS kinds FROM events",
        "csv_split_quotes": "SELECT o_orderkey, CASE WHEN o_orderkey % 7 IN (1, 2) THEN 'two \"lines\",' || chr(10) || chr(10) || ', here' "
        "WHEN o_orderkey % 7 = 3 THEN '5\" disc' WHEN o_orderkey % 7 > 3 THEN strftime(o_orderdate, '%Y-%m-%d') END AS said, "
        "CASE WHEN o_orderkey % 7 <> 0 THEN o_orderstatus END AS o_orderstatus, CASE WHEN o_orderkey % 7 = 0 THEN "
        "concat(o_orderkey, ',\"a, b\",\"c', chr(10), 'd\",more') END AS line FROM orders",
        "ingest_nested": "SELECT o_orderkey, o_custkey, o_orderstatus, CASE o_orderkey % 3 WHEN 0 THEN 'orders' "
        "WHEN 1 THEN 'sub/orders' ELSE 'sub/year=1/deep/orders' END AS source_file FROM orders",
        "ingest_nested_headers": "SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 1 THEN o_custkey END AS o_custkey, "
        "o_orderstatus FROM orders",
        "archive_nested": "SELECT event_id, platform, (SELECT count(*) FROM raw_play) AS moved, "
        "(SELECT count(*) FROM raw_play) AS again, cast(0 AS bigint) AS left_over FROM raw_play",
        "split_csv_permuted": "SELECT count(*) AS n_rows, cast(sum(l_partkey) AS bigint) AS sum_partkey, true AS chunks_fit "
        "FROM lineitem",
        "csv_parquet_roundtrip": f"SELECT {raw}, nullif(explicit, 'nan') AS explicit FROM raw_song",
        "ingest_without_personal_data": "SELECT strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS ts, platform, ms_played, "
        "track_uri FROM raw_play",
        "archive_roundtrip": f"SELECT {play_columns} FROM plays",
        "json_to_csv": "SELECT event_id, user_id AS who_id, event_type AS who_kind FROM events",
        "filter_csv": "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 10",
        "song_load": "SELECT " + _flat().replace("duration_ms", "cast(duration_ms AS bigint) AS duration_ms")
        + " FROM loaded_songs",
        "artist_load": "SELECT * FROM loaded_artists",
        "play_load": f"SELECT {play_columns} FROM loaded_plays",
        "play_gold_layer": f"SELECT {play_columns} FROM plays",
    }
    for name in ("play_stream_load", "play_stream_many_files", "play_load_resumed", "play_load_prefixed"):
        bodies[name] = bodies["play_load"]
    bodies["song_load_resumed"] = bodies["song_load"]
    bodies["artist_load_resumed"] = bodies["artist_load"]
    bodies |= {
        "archive_mixed_schemas": "SELECT event_id, platform, CASE WHEN event_id % 2 = 1 THEN 'noted' END AS note, "
        "'007,b' AS names, (SELECT count(*) FROM raw_play WHERE event_id % 2 = 0) AS unfinished FROM raw_play",
        "mixed_footers_song": "SELECT id, CASE WHEN (duration_ms // 137) % 3 <> 0 THEN album END AS album, key, mode, "
        "year FROM raw_song",
        "ingest_unequal_headers": "SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN cast(o_custkey AS double) "
        "WHEN 2 THEN o_custkey + 0.5 END AS o_custkey, o_orderstatus FROM orders",
        "csv_line_breaks": "SELECT o_orderkey, 'two \"' || o_orderstatus || '\"' || chr(10) || ' lines, ' || o_orderkey "
        "AS note FROM orders",
        "csv_malformed": "SELECT o_orderkey, CASE WHEN o_orderkey % 5 > 1 THEN 'x,' || o_orderstatus END AS o_orderstatus, "
        "CASE WHEN o_orderkey % 5 = 0 THEN o_orderkey || ',' || o_custkey || ',\"a,b\",more' END AS line FROM orders",
        "backfill_odd_names": "SELECT id, nullif([NULL, 'Earth, Wind & Fire', 'D''Arc', 'The \"X\"', 'back\\slash', "
        "'None', ''][(n + i) % 7 + 1], '<none>') AS artist, 'a' || n || '-' || i AS artist_id FROM range(3) r(i), wanted",
        "lookup_errors": "SELECT id AS key, CASE n % 4 WHEN 0 THEN 'refused' WHEN 1 THEN 'failed' "
        "ELSE CASE WHEN n % 3 = 0 THEN 'absent' ELSE 'found' END END AS status, "
        "cast(CASE WHEN n % 4 IN (1, 2) THEN 2 ELSE 1 END AS int) AS attempts FROM wanted",
        "enforce_fractions": "SELECT id, CASE WHEN year % 2 = 0 THEN year END AS year, "
        "CASE WHEN year % 2 = 0 THEN key END AS key FROM raw_song",
        "play_incremental_partly_stored": "SELECT * FROM plays p WHERE NOT EXISTS (SELECT 1 FROM plays q WHERE "
        "q.id = p.id AND q.ts = p.ts AND q.seconds_played % 2 = 0)",
        "dq_out_of_range": "SELECT id, CASE WHEN energy > 0.9 THEN 'Dorian' ELSE mode END AS mode, "
        "CASE WHEN energy > 0.9 THEN '1' ELSE '2' END AS violations FROM silver WHERE energy > 0.9 OR energy < 0.1",
        "dq_unique_rows": "SELECT id, ts, cast(2 AS int) AS rule_no FROM plays WHERE id IN "
        "(SELECT id FROM plays GROUP BY id HAVING count(*) > 1)",
    }
    no_album = "CASE WHEN event_id % 2 = 1 THEN master_metadata_album_album_name END AS master_metadata_album_album_name"
    mixed = f"SELECT * REPLACE ({no_album}) FROM raw_play"
    bodies["mixed_columns_play"] = f"SELECT {play_columns} FROM ({PLAYS.replace('FROM raw_play', f'FROM ({mixed} )')})"
    bodies["catalog_user_view"] = bodies["user_view"]
    bodies["catalog_track_view"] = bodies["track_view"].replace("gated_song", "silver")
    bodies["catalog_artist_view"] = bodies["artist_view"].replace("gated_artist", "artist")
    return {name: _q(body) for name, body in bodies.items()}
