import pytest
from pyspark.sql import functions as F

from strata.operators import permute, split
from strata.plans.prepare import split_csv
from strata.staging import Staging


@pytest.mark.parametrize("n", [1, 2, 3, 5, 7, 10, 12, 17, 50, 97, 1000, 4097, 100_003])
def test_positions_are_a_permutation(spark, n):
    for seed in (0, 1) if n < 1000 else (3,):
        got = spark.range(n).select(permute.position(spark, F.col("id"), n, seed).alias("p"))
        assert sorted(r.p for r in got.collect()) == list(range(n))


def test_order_is_mixed_and_named_by_the_seed(spark):
    n = 50_000
    one, two = ([r.p for r in spark.range(0, n, 1, 4).select(permute.position(spark, F.col("id"), n, s).alias("p")).collect()] for s in (1, 2))
    assert one != two and sum(a < b for a, b in zip(one, one[1:])) == pytest.approx(n / 2, rel=0.03)
    quarter = sum(p < n / 4 for p in one[: n // 4])  # of the first quarter, a quarter stays in it
    assert quarter == pytest.approx(n / 16, rel=0.06)


@pytest.mark.parametrize("n", [2, 10, 11, 1000, 10**6 + 3, 10**12 + 39, (1 << 62) + 1])
def test_shape_is_tight(n):
    a, b = permute.shape(n)
    assert n <= a * b < n + a and abs(a - b) <= a // 2 + 1


def test_large_numbers_stay_in_range(spark):
    n = 10**12 + 39
    x = spark.range(0, 2000).select((F.col("id") * 500_000_019 + 7).alias("x"))
    got = [r.p for r in x.select(permute.once(F.col("x"), n, 5).alias("p")).collect()]
    a, b = permute.shape(n)
    assert len(set(got)) == 2000 and all(0 <= p < a * b for p in got)


def test_rows_of_many_files_are_numbered_in_place(spark, tmp_path):
    for i, rows in enumerate((5, 0, 300, 1)):
        spark.range(i * 1000, i * 1000 + rows, 1, 2).selectExpr("id", "'x' AS __v").write.mode("append").parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    with Staging(spark) as staging:
        rows, n = permute.numbered(table.selectExpr("id", "id + 1 AS next"), staging)
        assert n == 306 and sorted(r[permute.ROW] for r in rows.collect()) == list(range(306))
        assert rows.columns == ["id", "next", permute.ROW]
        assert not (tmp_path / "rows").exists() and "/rows" not in "".join(rows.inputFiles())
    for other in (table.where("id > 3"), table.union(table), table.join(table.select("id"), "id"), spark.range(9), table.limit(4), table.distinct()):
        with Staging(spark) as staging:
            want = other.count()
            rows, n = permute.numbered(other, staging)
            assert n == want and sorted(r[permute.ROW] for r in rows.collect()) == list(range(n))


def test_one_shuffle_and_no_sampling(spark, tmp_path, monkeypatch):
    """Rows of Parquet files go to their chunk's task in one exchange, under no sort of the whole."""
    spark.range(0, 30_000, 1, 4).selectExpr("id", "'text' AS v").write.parquet(str(tmp_path / "t"))
    table, plans = spark.read.parquet(str(tmp_path / "t")), []
    kind = type(table)
    before = kind.sortWithinPartitions
    monkeypatch.setattr(kind, "sortWithinPartitions", lambda self, *c: plans.append(before(self, *c)) or plans[-1])
    assert split_csv(spark, table, str(tmp_path / "out"), 500, 1500, seed=2) == 30_000
    plan = plans[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") - plan.count("BroadcastExchange ") == 1 and "rangepartitioning" not in plan
    sizes = {p.name: sum(1 for f in p.glob("*.csv") for _ in open(f)) - 1 for p in (tmp_path / "out").glob("chunk=*")}
    assert sum(sizes.values()) == 30_000 and set(sizes) == {f"chunk={i}" for i in range(1, len(sizes) + 1)}
    assert all(500 <= n <= 1500 for c, n in sizes.items() if c != f"chunk={len(sizes)}")
    assert all(len(list(p.glob("*.csv"))) == 1 for p in (tmp_path / "out").glob("chunk=*"))


def test_copies_and_bounds(spark, tmp_path):
    same = spark.range(0, 4000, 1, 4).select(F.lit("same").alias("v"), F.lit(1).alias(split.CHUNK + "s"))
    assert split_csv(spark, same, str(tmp_path / "out"), 100, 300) == 4000
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).where("v = 'same'").count() == 4000
    with pytest.raises(ValueError):
        split_csv(spark, same, str(tmp_path / "none"), 5, 4)
