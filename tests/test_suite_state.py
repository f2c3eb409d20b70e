import pytest

from strata.operators import quality
from strata.operators.suite_state import SuiteStates

DDL = "id long, name string, day date, n double"


def suite():
    s = quality.Suite("s").expect(quality.ORDERED_COLUMNS, column_list=["id", "name", "day", "n"])
    s.expect(quality.NOT_NULL, column="name").expect(quality.OF_TYPE, column="id", type_="int")
    s.expect(quality.BETWEEN, column="n", min_value=0.0, max_value={"$PARAMETER": "top"})
    s.expect(quality.IN_SET, column="name", value_set=["a", "b"]).expect(quality.LENGTHS, column="name", max_value=1)
    s.expect(quality.MAX_BETWEEN, column="day", min_value="2020-01-01", max_value="2024-01-01")
    s.expect(quality.MAX_BETWEEN, column="n", max_value=9.0)
    s.expect(quality.UNIQUE, column="id").expect(quality.COMPOUND_UNIQUE, column_list=["name", "day"])
    return s.expect(quality.DIFFER_IN_RECORD, column_list=["id", "n"])


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, name string, day string, n double").selectExpr("id", "name", "cast(day as date) day", "n")


def rows(df):
    return sorted(map(repr, df.collect()))


LOADS = [
    [(1, "a", "2020-01-01", 1.0), (2, None, "2021-01-01", 2.5), (3, "b", None, 3.0), (None, None, None, None)],
    [(1, "b", "2020-01-01", -1.0), (4, "c", "2023-01-01", None), (None, None, None, 7.5)],
    [],
    [(5, "a", "2020-01-01", 5.0), (5, "long", "2022-01-01", 10.5)],
]


def test_states_add_up_to_the_suite_over_all_loads(spark, tmp_path):
    states = SuiteStates(str(tmp_path / "s"), suite(), {"top": 8.0})
    with pytest.raises(FileNotFoundError):
        states.result(spark)
    for i, load in enumerate(LOADS):
        states.add(frame(spark, load), f"l{i}")
        whole = frame(spark, sum(LOADS[: i + 1], []))
        want = quality.validate(whole, suite(), {"top": 8.0})
        assert rows(states.result(spark)) == rows(want.select(states.result(spark).columns))
    again = rows(states.result(spark))
    states.add(frame(spark, LOADS[1]), "l1")
    assert rows(states.result(spark)) == again


def test_a_load_that_broke_off_does_not_count(spark, tmp_path, monkeypatch):
    states = SuiteStates(str(tmp_path / "s"), suite(), {"top": 8.0})
    states.add(frame(spark, LOADS[0]), "1")
    before = rows(states.result(spark))
    frame(spark, LOADS[0]).groupBy("id").count().withColumnRenamed("count", "__n").write.parquet(f"{tmp_path}/s/keys/rule=9/load=2")
    assert rows(states.result(spark)) == before
    states.add(frame(spark, LOADS[3]), "2")
    assert {r.rule_no: r.unexpected_count for r in states.result(spark).collect()}[9] == 2


def test_results_read_no_load(spark, tmp_path):
    source = str(tmp_path / "in")
    frame(spark, LOADS[0]).write.parquet(source)
    states = SuiteStates(str(tmp_path / "s"), suite(), {"top": 8.0})
    states.add(spark.read.parquet(source), "1")
    assert not [f for f in states.result(spark).inputFiles() if f.startswith(f"file://{source}")]


def test_columns_that_a_load_lacks(spark, tmp_path):
    states = SuiteStates(str(tmp_path / "s"), suite(), {"top": 8.0})
    states.add(frame(spark, LOADS[0]), "a")
    states.add(frame(spark, LOADS[3]).drop("name", "id"), "b")
    got = {r.rule_no: r for r in states.result(spark).collect()}
    assert len(got) == len(suite().rules)
    assert (got[1].success, got[1].observed) == (False, "day,n")
    assert (got[2].success, got[2].observed, got[2].unexpected_count) == (False, "no column name", 2)
    assert (got[9].success, got[9].observed, got[9].unexpected_count) == (False, "no column id", 0)
    assert got[8].observed == "10.5" and not got[8].success


def test_a_folder_belongs_to_one_suite(spark, tmp_path):
    states = SuiteStates(str(tmp_path / "s"), suite(), {"top": 8.0})
    states.add(frame(spark, LOADS[0]), "a")
    other = SuiteStates(str(tmp_path / "s"), suite(), {"top": 7.0})
    with pytest.raises(ValueError, match="other rules"):
        other.add(frame(spark, LOADS[0]), "b")
    with pytest.raises(ValueError, match="name of a load"):
        states.add(frame(spark, LOADS[0]), "../x")
