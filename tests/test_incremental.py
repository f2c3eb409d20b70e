import random

import pytest
from pyspark.sql import functions as F

from strata.operators import incremental


def rows(df):
    return sorted(df.collect(), key=str)


@pytest.mark.parametrize("salts", [None, 1, 7])
def test_against_brute_force(spark, salts):
    rnd = random.Random(5)
    # A third of the rows hold one key, and a fifth none.
    keys = [rnd.choice(["hot", None if rnd.random() < 0.6 else "hot", f"k{rnd.randrange(40)}"]) for _ in range(3000)]
    left = [(k, i % 4) for i, k in enumerate(keys)]
    stored = {f"k{i}" for i in range(0, 40, 3)}
    df = spark.createDataFrame(left, "id string, v int").repartition(5)
    known = spark.createDataFrame([(k,) for k in [*stored, *stored, None]], "id string")
    got = rows(incremental.drop_existing(df, known, salts=salts))
    assert [tuple(r) for r in got] == [tuple(r) for r in sorted(
        spark.createDataFrame([r for r in left if r[0] not in stored], "id string, v int").collect(), key=str
    )]
    got = incremental.keep_existing(df, known, salts=salts).groupBy("id").count().collect()
    want = {k: sum(1 for r in left if r[0] == k) for k in stored if any(r[0] == k for r in left)}
    assert {r["id"]: r["count"] for r in got} == want


@pytest.mark.parametrize("salts", [None, 1, 3])
def test_composite_key_with_nulls(spark, salts):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", None), (None, 1)], "id string, n int")
    known = spark.createDataFrame([("a", 1), ("a", None), (None, 1)], "id string, n int")
    got = incremental.drop_existing(df, known, ["id", "n"], salts)
    assert {tuple(r) for r in got.collect()} == {("a", 2), ("a", None), (None, 1)}


def test_copies_within_the_batch_stay(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "id string")
    assert incremental.drop_existing(df, spark.createDataFrame([("b",)], "id string")).count() == 2


def test_nan_keys_match(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "id double")
    assert incremental.drop_existing(df, df).count() == 0


def test_hot_key_partitions_are_split(spark, setting, tmp_path):
    """A key that holds a third of the rows does not end in one task."""
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    setting("spark.sql.shuffle.partitions", "32")
    setting("spark.sql.adaptive.coalescePartitions.enabled", "false")
    setting("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "200KB")
    setting("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100KB")
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id").cast("string")))
    spark.range(0, 1_500_000, 1, 8).select(key.alias("id"), F.col("id").alias("v")).write.parquet(str(tmp_path / "rows"))
    df = spark.read.parquet(str(tmp_path / "rows"))
    known = spark.range(0, 300_000, 1, 4).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("id"))
    fresh = incremental.drop_existing(df, known)
    assert fresh.toArrow().num_rows == 1_500_000 - 200_000
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in plan


def test_lookup_keys_combine_before_the_shuffle(spark, setting):
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    df = spark.range(10).select(F.col("id").cast("string").alias("id"), F.lit(1).alias("v"))
    plan = incremental.drop_existing(df, df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2 and "Cartesian" not in plan and "NestedLoop" not in plan


def test_missing_keys(spark):
    plays = spark.createDataFrame([("a",), ("a",), ("b",), ("",), (None,)], "id string")
    songs = spark.createDataFrame([("b",), ("b",)], "id string")
    assert {r["id"] for r in incremental.missing_keys(plays, songs).collect()} == {"a", "", None}
    assert {r["id"] for r in incremental.missing_keys(plays, songs, drop_blank=True).collect()} == {"a"}


def test_missing_keys_shuffle_each_side_once(spark, setting):
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    plays = spark.range(100).select(F.col("id").cast("string").alias("id"))
    plan = incremental.missing_keys(plays, plays)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2


def test_fk_violations(spark):
    child = spark.createDataFrame([("a", 1), ("x", 2), (None, 3)], "ref string, n int")
    parent = spark.createDataFrame([("a",), (None,)], "id string")
    assert [r["n"] for r in incremental.fk_violations(child, parent, "ref", "id").collect()] == [2]
