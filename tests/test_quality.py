import pytest

from strata import schemas
from strata.operators import quality as q


def result(spark, df, suite, **parameters):
    got = q.validate(df, suite, parameters).orderBy("rule_no").collect()
    assert [r["rule_no"] for r in got] == list(range(1, len(suite.rules) + 1))
    return got


def one(spark, df, rule, **kwargs):
    return result(spark, df, q.Suite("s").expect(rule, **kwargs))[0]


@pytest.fixture
def numbers(spark):
    return spark.createDataFrame(
        [(1, 0.5, "a"), (1, 1.5, "b"), (2, None, None), (None, -0.1, "abc")], "n int, x double, s string"
    )


def test_between(spark, numbers):
    r = one(spark, numbers, q.BETWEEN, column="x", min_value=0.0, max_value=1.0)
    assert (r["success"], r["element_count"], r["missing_count"], r["unexpected_count"]) == (False, 4, 1, 2)
    assert r["unexpected_percent"] == pytest.approx(200 / 3)
    assert one(spark, numbers, q.BETWEEN, column="x", min_value=-1.0)["success"]
    assert one(spark, numbers, q.BETWEEN, column="x", max_value=1.5)["success"]
    assert one(spark, numbers, q.BETWEEN, column="x", min_value=-0.1, max_value=1.5)["success"]


def test_not_null(spark, numbers):
    r = one(spark, numbers, q.NOT_NULL, column="n")
    assert (r["success"], r["unexpected_count"], r["unexpected_percent"]) == (False, 1, 25.0)


def test_in_set(spark, numbers):
    assert one(spark, numbers, q.IN_SET, column="s", value_set=["a", "b"])["unexpected_count"] == 1
    assert one(spark, numbers, q.IN_SET, column="s", value_set=["a", "b", "abc"])["success"]


def test_types(spark, numbers):
    assert one(spark, numbers, q.OF_TYPE, column="n", type_="int")["success"]
    r = one(spark, numbers, q.OF_TYPE, column="x", type_="int")
    assert (r["success"], r["observed"]) == (False, "double")
    assert one(spark, numbers, q.OF_TYPE, column="x", type_="float")["success"]


def test_unique_counts_every_member(spark, numbers):
    r = one(spark, numbers, q.UNIQUE, column="n")
    assert (r["success"], r["element_count"], r["missing_count"], r["unexpected_count"]) == (False, 4, 1, 2)
    assert one(spark, numbers, q.UNIQUE, column="s")["success"]
    assert one(spark, numbers, q.COMPOUND_UNIQUE, column_list=["n", "s"])["success"]


def test_ordered_columns(spark, numbers):
    assert one(spark, numbers, q.ORDERED_COLUMNS, column_list=["n", "x", "s"])["success"]
    assert not one(spark, numbers, q.ORDERED_COLUMNS, column_list=["x", "n", "s"])["success"]


def test_differ_within_record(spark):
    df = spark.createDataFrame(
        [("a", "b"), ("a", "a"), (None, None), ("a", None), ("1", "1")], "x string, y string"
    )
    r = one(spark, df, q.DIFFER_IN_RECORD, column_list=["x", "y"])
    assert (r["missing_count"], r["unexpected_count"]) == (1, 2)


def test_two_nulls_are_equal_within_a_record(spark):
    df = spark.createDataFrame([("a", None, None)], "x string, y string, z string")
    assert one(spark, df, q.DIFFER_IN_RECORD, column_list=["x", "y", "z"])["unexpected_count"] == 1


def test_maximum_with_parameters(spark, numbers):
    suite = q.Suite("s").expect(
        q.MAX_BETWEEN, column="x", min_value={"$PARAMETER": "above"}, max_value={"$PARAMETER": "below"}
    )
    assert result(spark, numbers, suite, above=1, below=2)[0]["success"]
    bad = result(spark, numbers, suite, above=2, below=3)[0]
    assert (bad["success"], bad["observed"]) == (False, "1.5")
    with pytest.raises(ValueError, match="above"):
        q.validate(numbers, suite)
    assert not one(spark, numbers.limit(0), q.MAX_BETWEEN, column="x", min_value=0)["success"]


def test_lengths(spark, numbers):
    assert one(spark, numbers, q.LENGTHS, column="s", max_value=2)["unexpected_count"] == 1
    lists = spark.createDataFrame([(["a", "abc"],), (["a"],), ([],), (None,)], "l array<string>")
    r = one(spark, lists, q.LENGTHS, column="l", max_value=2)
    assert (r["missing_count"], r["unexpected_count"]) == (1, 1)


def test_missing_column_fails_the_rule(spark, numbers):
    r = one(spark, numbers, q.NOT_NULL, column="gone")
    assert (r["success"], r["observed"]) == (False, "no column gone")


def test_empty_input(spark, numbers):
    suite = q.Suite("s").expect(q.NOT_NULL, column="n").expect(q.UNIQUE, column="n")
    assert all(r["success"] and r["element_count"] == 0 for r in result(spark, numbers.limit(0), suite))


def test_unknown_rules_and_options_are_refused():
    with pytest.raises(ValueError, match="unknown rule"):
        q.Suite("s").expect("expect_magic", column="n")
    with pytest.raises(ValueError, match="mostly"):
        q.Suite("s").expect(q.NOT_NULL, column="n", mostly=0.9)


def test_flagged_rows_are_whole_and_complete(spark, numbers):
    suite = q.Suite("s").expect(q.NOT_NULL, column="n").expect(q.BETWEEN, column="x", min_value=0, max_value=1)
    got = {(r["s"], tuple(r["violations"])) for r in q.flag_rows(numbers, suite).collect()}
    assert got == {("b", (2,)), ("abc", (1, 2))}
    assert q.flag_rows(numbers, q.Suite("none")).count() == 0


def test_duplicate_rows(spark, numbers):
    assert q.duplicate_rows(numbers, ["n"]).count() == 2


def test_suite_sizes():
    assert len(q.song_suite(2025).rules) == 41
    assert len(q.play_suite().rules) == 8


def test_suite_file_round_trip(tmp_path):
    suite = q.song_suite(2025)
    suite.save(str(tmp_path / "suite.json"))
    again = q.Suite.load(str(tmp_path / "suite.json"))
    assert (again.name, again.rules) == (suite.name, suite.rules)
    suite.expect(q.NOT_NULL, column="name").save(str(tmp_path / "suite.json"))
    assert len(q.Suite.load(str(tmp_path / "suite.json")).rules) == 42


def test_suite_file_in_a_folder_that_is_not_there_yet(tmp_path):
    path = f"{tmp_path}/queries/of a run/suite.json"
    for _ in range(2):
        q.play_suite().save(f"file:{path}")
    assert q.Suite.load(path).rules == q.play_suite().rules


def test_suite_file_of_the_stored_layout():
    text = (
        '{"name": "s", "id": "1", "notes": null, "meta": {"v": "1"}, "expectations": [{"id": "2", "meta": {}, '
        '"type": "expect_column_values_to_not_be_null", "kwargs": {"column": "a", "result_format": "COMPLETE"}}]}'
    )
    suite = q.Suite.from_json(text)
    assert suite.rules[0].columns == ["a"] and suite.meta == {"v": "1"}


def test_song_suite_needs_one_aggregate(spark):
    df = spark.createDataFrame([], schemas.silver_song_schema())
    suite = q.song_suite(2025)
    plan = q.validate(df, suite)._jdf.queryExecution().optimizedPlan().toString()
    # One for all row rules; a grouped one with its total for uniqueness.
    assert plan.count("Aggregate") == 3


def test_cleaned_durations_are_not_whole_numbers(spark):
    df = spark.createDataFrame([], schemas.silver_song_schema())
    failed = [(r["expectation"], r["column_name"]) for r in result(spark, df, q.song_suite(2025)) if not r["success"]]
    assert failed == [(q.OF_TYPE, "duration_ms")]


def test_primary_key_suite(spark):
    df = spark.createDataFrame([("a", "1"), ("a", "1"), ("a", None)], "id string, artist_id string")
    got = [r["unexpected_count"] for r in result(spark, df, q.primary_key_suite("pk", ["id", "artist_id"]))]
    assert got == [0, 1, 2]
    assert [r.type for r in q.primary_key_suite("pk", ["id"]).rules] == [q.NOT_NULL, q.UNIQUE]


def test_odd_names_and_values(spark):
    import datetime

    df = spark.createDataFrame(
        [("it's", datetime.date(2024, 1, 1)), ("back\\slash", datetime.date(2025, 1, 1))], "`a``b c` string, d date"
    )
    column = df.columns[0]
    r = one(spark, df, q.IN_SET, column=column, value_set=["it's", "back\\slash"])
    assert r["success"] and r["column_name"] == column
    assert one(spark, df, q.BETWEEN, column="d", max_value=datetime.date(2024, 6, 1))["unexpected_count"] == 1
    assert not one(spark, df, q.ORDERED_COLUMNS, column_list=["it's"])["success"]


def test_infinite_bounds(spark):
    df = spark.createDataFrame([(1e308,), (float("nan"),)], "x double")
    # NaN sorts above every number.
    assert one(spark, df, q.BETWEEN, column="x", max_value=float("inf"))["unexpected_count"] == 1
