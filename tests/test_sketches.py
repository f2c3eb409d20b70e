import random

import pytest

from strata.operators.sketches import DISTINCT_ERROR, RANK_ERROR, ProfileStore, sketched


@pytest.fixture
def loads(spark):
    rng = random.Random(1)
    rows = [
        (i, rng.gauss(0, 1) if i % 10 else None, f"v{min(int(rng.expovariate(0.5)), 40)}" if i % 7 else None, float("nan") if i % 3 else 1.0)
        for i in range(20_000)
    ]
    frame = lambda part: spark.createDataFrame(part, "id long, x double, v string, `odd``name` double")
    return rows, [frame(rows[:3000]), frame(rows[3000:])]


def test_loads_add_up(spark, tmp_path, loads):
    rows, frames = loads
    store = ProfileStore(spark, str(tmp_path / "p"))
    for i, df in enumerate(frames):
        store.add(df, str(i))
    store.add(frames[1], "1")  # repeated
    got = {r["column_name"]: r for r in store.report((0.1, 0.5, 0.9), 3).collect()}
    assert list(got) == ["id", "x", "v", "odd`name"] and {r["rows"] for r in got.values()} == {20_000}
    for i, name in enumerate(got):
        values = [r[i] for r in rows if r[i] is not None]
        assert got[name]["nulls"] == 20_000 - len(values)
        exact = len(set(map(str, values)))
        assert abs(got[name]["approx_distinct"] - exact) <= max(DISTINCT_ERROR * exact, 0.5)
    xs = sorted(r[1] for r in rows if r[1] is not None)
    for q, value in zip((0.1, 0.5, 0.9), got["x"]["quantiles"]):
        rank = sum(x <= value for x in xs) / len(xs)
        assert abs(rank - q) <= RANK_ERROR
    assert got["v"]["quantiles"] is None and got["odd`name"]["quantiles"] == [1.0, 1.0, 1.0]
    counts = {v: sum(r[2] == v for r in rows) for v in ("v0", "v1", "v2")}
    assert {t["item"]: t["count"] for t in got["v"]["top"]} == counts


def test_no_scan_of_the_data_to_merge(spark, tmp_path, loads):
    store = ProfileStore(spark, str(tmp_path / "p"))
    store.add(loads[1][0], "0")
    assert all("run_id=" in f for f in store.merged().inputFiles())
    plan = sketched(loads[1][0])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1  # one aggregate for all columns


def test_empty_loads_and_other_columns(spark, tmp_path):
    store = ProfileStore(spark, str(tmp_path / "p"))
    with pytest.raises(FileNotFoundError):
        store.merged()
    store.add(spark.createDataFrame([], "a int, b string"), "0")
    store.add(spark.createDataFrame([(1, "x")], "a int, c string"), "1")
    got = {r["column_name"]: r for r in store.report().collect()}
    assert got["a"]["rows"] == 1 and got["a"]["quantiles"] == [1.0] * 5 and got["b"]["rows"] == 0 and got["b"]["approx_distinct"] == 0
    assert [t["item"] for t in got["c"]["top"]] == ["x"] and got["b"]["top"] == []
