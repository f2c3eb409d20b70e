from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.operators import split
from strata.plans.prepare import split_csv
from strata.sources.files import read_csv


def chunks(spark, n, low, high, seed, bucket_rows):
    # A range is read in the same order every time, so it needs no staging.
    ordered = split.shuffle_key(spark.range(0, n, 1, 4), seed)
    starts = split.chunk_starts(ordered, n, low, high, seed, bucket_rows)
    return split.split_chunks(ordered, starts, n, bucket_rows)


@pytest.mark.parametrize("group", [split.GROUP, 3], ids=["one group", "groups"])
@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    n=st.integers(1, 3000), low=st.integers(1, 50), extra=st.integers(0, 200), seed=st.integers(0, 9),
    bucket_rows=st.sampled_from([20, 100, 1000, 10**6]),
)
def test_chunks_partition_the_input(spark, group, n, low, extra, seed, bucket_rows):
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(split, "GROUP", group)
        rows = chunks(spark, n, low, low + extra, seed, bucket_rows).collect()
    assert sorted(r["id"] for r in rows) == list(range(n))
    # Brute force: sort by the hash, number the rows, cut by the numbers.
    rows.sort(key=lambda r: r[split.ORDER])
    numbers = spark.range(0, n, 1, 1).select(split.chunk_of(F.col("id"), low, low + extra, seed).alias("c")).collect()
    assert [r[split.CHUNK] for r in rows] == [r["c"] for r in numbers]
    sizes = list(Counter(r[split.CHUNK] for r in rows).values())
    assert all(low <= s <= low + extra for s in sizes[:-1]) and 1 <= sizes[-1] <= low + extra
    assert {r[split.CHUNK] for r in rows} == set(range(1, len(sizes) + 1))


def test_hashes_differ_and_shuffle(spark):
    rows = split.shuffle_key(spark.range(0, 50_000, 1, 4), 1).orderBy(split.ORDER).collect()
    assert len({r[split.ORDER] for r in rows}) == 50_000
    assert sum(a["id"] < b["id"] for a, b in zip(rows, rows[1:])) < 30_000


def test_joins_without_broadcast(spark, setting):
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    rows = chunks(spark, 3000, 10, 50, 2, 20).collect()
    rows.sort(key=lambda r: r[split.ORDER])
    numbers = spark.range(0, 3000, 1, 1).select(split.chunk_of(F.col("id"), 10, 50, 2).alias("c")).collect()
    assert [r[split.CHUNK] for r in rows] == [r["c"] for r in numbers]


def test_whole_rows_move_once(spark, tmp_path):
    """Only the hash is read and shuffled to find where chunks start; then rows meet a small table."""
    spark.range(100).selectExpr("id", "'long text' AS v").write.parquet(str(tmp_path / "rows"))
    split.shuffle_key(spark.read.parquet(str(tmp_path / "rows"))).write.parquet(str(tmp_path / "ordered"))
    ordered = spark.read.parquet(str(tmp_path / "ordered"))
    starts = split.chunk_starts(ordered, 100, 10, 20)
    plan = starts._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<__order:bigint>" in plan and "v#" not in plan
    starts.write.parquet(str(tmp_path / "starts"))
    rows = split.split_chunks(ordered, spark.read.parquet(str(tmp_path / "starts")), 100)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_same_seed_same_chunks(spark):
    def ids(seed):
        return {(r["id"], r["chunk"]) for r in chunks(spark, 500, 10, 50, seed, 100).collect()}

    assert ids(1) == ids(1) != ids(2)


def test_sizes_vary(spark):
    sizes = {r["count"] for r in chunks(spark, 20_000, 10, 200, 0, 1000).groupBy("chunk").count().collect()}
    assert len(sizes) > 50


def test_buckets_are_even(spark):
    """Copies of one row spread like any others, because rows are numbered as they are read."""
    same = spark.range(0, 40_000, 1, 4).select(F.lit("same").alias("v"))
    buckets = split.shuffle_key(same, 3).groupBy(split.bucket_of(F.col(split.ORDER), 10).alias("b")).count()
    counts = {r["b"]: r["count"] for r in buckets.collect()}
    assert sorted(counts) == list(range(10)) and max(counts.values()) < 1.2 * min(counts.values())


def test_bounds_are_checked(spark):
    with pytest.raises(ValueError):
        split.chunk_starts(split.shuffle_key(spark.range(1)), 1, 5, 4)


def test_csv_files(spark, tmp_path):
    rows = [(i // 3, f"a, \"{i // 3}\" ", None if i % 2 else "x") for i in range(600)]
    df = spark.createDataFrame(rows, "n int, s string, t string")
    assert split_csv(spark, df, str(tmp_path / "out"), 50, 100, seed=1) == 600
    files = sorted((tmp_path / "out").glob("chunk=*/*.csv"))
    names = sorted(p.name for p in (tmp_path / "out").glob("chunk=*"))
    # One file per chunk, numbered without gaps.
    assert len(files) == len(names) and names == sorted(f"chunk={i}" for i in range(1, len(names) + 1))
    back = read_csv(spark, str(tmp_path / "out"), df.schema)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_empty_input_writes_nothing(spark, tmp_path):
    df = spark.createDataFrame([], "n int")
    assert split_csv(spark, df, str(tmp_path / "out")) == 0
    assert not (tmp_path / "out").exists()


def test_permuted_split_is_read_back_once(spark, tmp_path):
    from workload import queries

    n = 7_000
    spark.range(n).selectExpr("id AS l_orderkey", "1 AS l_linenumber", "id % 9 AS l_partkey").write.parquet(f"{tmp_path}/lineitem.parquet")
    df = queries.split_csv_permuted(spark, str(tmp_path))
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 1
    assert [tuple(r) for r in df.collect()] == [(n, sum(i % 9 for i in range(n)), True)]
