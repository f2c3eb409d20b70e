"""Scalar rules on hand-made values, in both ANSI modes."""

import datetime

import pytest
from pyspark.sql import functions as F

from strata import schemas
from strata.functions import numeric, temporal, text
from strata.operators import clean, views


def values(spark, rule, given, kind="string"):
    rows = [(i, v) for i, v in enumerate(given)]
    df = spark.createDataFrame(rows, f"i int, x {kind}").select("i", rule(F.col("x")).alias("y"))
    return [r["y"] for r in df.orderBy("i").collect()]


def test_boolean_parse(both_modes):
    given = ["True", " FALSE ", "nan", "", "  ", "null", None, "1", "yes", "maybe", "\ttrue"]
    want = [True, False, None, None, None, None, None, True, True, None, True]
    assert values(both_modes, text.to_boolean, given) == want
    assert values(both_modes, text.to_boolean, [True, None], "boolean") == [True, None]


def test_null_tokens_become_empty(both_modes):
    given = ["", "  ", " nan ", "null\t", "nano", "a null", None]
    assert values(both_modes, text.scrubbed, given) == ["", "", "", "", "nano", "a null", None]


def test_list_text_split(both_modes):
    given = ["['A', 'B']", "['Earth, Wind & Fire']", '["D\'Arc"]', "[]", "", None, "A"]
    want = [["A", "B"], ["Earth", "Wind & Fire"], ['"D\'Arc"'], [""], [""], None, ["A"]]
    assert values(both_modes, text.list_items, given) == want


def test_list_text_literal(both_modes):
    given = ["['A', 'B']", "['Earth, Wind & Fire']", '["D\'Arc", \'x\']', "[]", None, r"['it\'s']"]
    want = [["A", "B"], ["Earth, Wind & Fire"], ["D'Arc", "x"], [], None, ["it's"]]
    assert values(both_modes, lambda c: text.list_items(c, "literal"), given) == want


def test_list_mode_is_checked():
    with pytest.raises(ValueError):
        text.list_items(None, "other")


def test_list_text_is_the_inverse(both_modes):
    given = [["A", "B"], ["one"], [], None]
    back = values(both_modes, lambda c: text.list_items(text.list_text(c)), given, "array<string>")
    assert back == [["A", "B"], ["one"], [""], None]


def test_rounding_is_half_up(both_modes):
    assert values(both_modes, lambda c: numeric.rounded(c, 3), [0.0005, 0.1234, -0.0005, None], "double") == [
        0.001, 0.123, -0.001, None,
    ]


def test_measures_as_text(both_modes):
    assert values(both_modes, lambda c: numeric.rounded(c, 1), ["0.25", "n/a", None]) == [0.3, None, None]
    assert values(both_modes, numeric.whole_seconds, ["1500", "soon"]) == [2.0, None]


def test_seconds(both_modes):
    assert values(both_modes, numeric.whole_seconds, [1499, 1500, 2500, 0, None], "bigint") == [1.0, 2.0, 3.0, 0.0, None]
    assert values(both_modes, numeric.whole_seconds_int, [1499, 1500, None], "int") == [1, 2, None]
    assert values(both_modes, numeric.whole_seconds_int, [10**18], "bigint") == [None]


@pytest.mark.parametrize("kind", ["int", "double", "string"])
def test_codes_in_any_type(both_modes, kind):
    convert = {"int": int, "double": float, "string": str}[kind]
    given = [convert(v) for v in (0, 1, 11, 12, -1)] + [None]
    assert values(both_modes, numeric.pitch_name, given, kind) == ["C", "C♯/D♭", "B", None, None, None]
    assert values(both_modes, numeric.mode_name, given, kind) == ["Minor", "Major", None, None, None, None]


def test_fractional_codes_have_no_name(both_modes):
    assert values(both_modes, numeric.mode_name, [0.5, float("nan"), float("inf")], "double") == [None, None, None]


def test_days(both_modes):
    given = ["1998-05-06", "1998", "1998-05", "1998-5-6", "1998-02-31", "", None, "x", " 1998-05-06", "1998-05-06\n", "0000-01-01"]
    want = [datetime.date(1998, 5, 6)] + [None] * 10
    assert values(both_modes, temporal.to_day, given) == want


def test_wall_clock(both_modes):
    given = ["2024-03-31T02:30:00Z", "2024-03-31 02:30:00", "2024-02-30T00:00:00Z", "2024-03-31T02:30:00", "", None, "2024-03-31T02:30:00Z\n"]
    want = [datetime.datetime(2024, 3, 31, 2, 30)] + [None] * 6
    assert values(both_modes, temporal.to_wall_clock, given) == want


def test_wall_clock_ignores_the_session_zone(spark, setting):
    setting("spark.sql.session.timeZone", "Europe/Berlin")
    # This local time does not exist in that zone.
    df = spark.createDataFrame([("2024-03-31T02:30:00Z",)], "x string")
    ts = temporal.to_wall_clock(F.col("x"))
    row = df.select(ts.cast("string").alias("t"), F.hour(ts).alias("h")).first()
    assert (row["t"], row["h"]) == ("2024-03-31 02:30:00", 2)


def test_parts_of_a_play_time(spark):
    play = [("t", datetime.datetime(2024, 1, 1, 23, 59))]
    df = spark.createDataFrame([], schemas.gold_play_schema()).drop("id", "ts")
    rows = spark.createDataFrame(play, "id string, ts timestamp_ntz").unionByName(df, allowMissingColumns=True)
    r = views.user_view(rows).first()
    parts = (str(r["activity_date"]), r["hour_of_day"], r["day_of_week"], r["month_of_year"])
    assert parts == ("2024-01-01", 23, "Mon", 1)


def test_platform(both_modes):
    given = ["Android OS 9", " WebPlayer windows ", "iOS 13", "OS X", "", None]
    assert values(both_modes, text.platform, given) == ["android", "web", "ios", "", "", None]


def test_uri_parts(both_modes):
    given = ["svc:track:abc", "svc:episode:a-b", "nothing", None, "svc:track:"]
    assert values(both_modes, text.uri_id, given) == ["abc", "a", "", None, ""]
    assert values(both_modes, text.uri_type, given) == ["track", "episode", "", None, "track"]
    assert values(both_modes, lambda c: text.build_uri(c, "svc:track:"), ["x", None]) == ["svc:track:x", None]


def test_cleaning_is_narrow_and_pruned(spark, tmp_path):
    """Cleaning adds no shuffle, and a report over it reads only the columns it needs."""
    from workload import fixtures as fx

    raw = str(tmp_path / "raw")
    fx.raw_songs(spark, "/root/testdata/sf0.001").write.parquet(raw)
    df = clean.clean_songs(spark.read.parquet(raw)).select("id", "tempo")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert "ReadSchema: struct<id:string,tempo:double>" in plan


def test_clean_schema_is_the_declared_one(spark):
    raw = spark.createDataFrame([], schemas.raw_song_schema())
    got = {f.name: f.dataType.simpleString() for f in clean.clean_songs(raw).schema}
    assert got == {f.name: f.dataType.simpleString() for f in schemas.silver_song_schema()}
    plays = spark.createDataFrame([], schemas.raw_play_schema("any_"))
    got = {f.name: f.dataType.simpleString() for f in clean.clean_plays(plays).schema}
    assert got == {f.name: f.dataType.simpleString() for f in schemas.gold_play_schema()}


def test_missing_rule_gives_typed_null(spark):
    raw = spark.createDataFrame([], schemas.raw_song_schema())
    df = clean.clean_songs(raw, overrides={"tempo": ("tempo", None)})
    assert df.schema["tempo"].dataType.simpleString() == "double"


def test_track_uri_column_must_be_unambiguous(spark):
    df = spark.createDataFrame([("a", "b")], "a_track_uri string, b_track_uri string")
    with pytest.raises(ValueError):
        clean.track_uri_column(df)


def test_enforce_types(both_modes):
    df = both_modes.createDataFrame([("5.0", "7", "x", None)], "a string, b string, c string, d string")
    schema = "a int, b bigint, c double, d int"
    from pyspark.sql.types import _parse_datatype_string

    row = schemas.enforce(df, _parse_datatype_string(schema)).first()
    assert tuple(row) == (5, 7, None, None)
    doubles = both_modes.createDataFrame([(5.0,), (None,)], "a double")
    assert [r["a"] for r in schemas.enforce(doubles, _parse_datatype_string("a int")).collect()] == [5, None]


def test_enforce_reports_missing_columns(spark):
    df = spark.createDataFrame([("x",)], "id string")
    with pytest.raises(ValueError, match="missing"):
        schemas.enforce(df, schemas.artist_schema())
    assert schemas.enforce(df, schemas.artist_schema(), missing="null").columns == ["id", "name", "artist", "artist_id"]


def test_unknown_schema(spark):
    with pytest.raises(ValueError):
        schemas.schema_for("bronze")
    assert schemas.empty_frame(spark, "silver").count() == 0


def test_length_limits():
    assert schemas.length_limits(schemas.GOLD_PLAY_DDL)["platform"] == 20
    assert schemas.length_limits(schemas.GOLD_SONG_DDL)["artists"] == 255
    assert "name" not in schemas.length_limits(schemas.GOLD_SONG_DDL)
