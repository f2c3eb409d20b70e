import pytest
from pyspark.sql import functions as F

from strata.operators.incremental import drop_existing
from strata.operators.keyfilter import KeyFilter, blocks_of, drop_existing_filtered


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture
def known(spark, tmp_path):
    return KeyFilter(spark, str(tmp_path / "filter"), n_blocks=1 << 10)


def test_no_stored_key_is_called_new_and_few_new_ones_stored(spark, known):
    stored = spark.range(50_000).select(F.concat(F.lit("k"), "id").alias("id"))
    known.add(stored, "1")
    asked = spark.range(100_000).select(F.concat(F.lit("k"), "id").alias("id"), F.col("id").alias("n"))
    flagged = known.flagged(asked)
    assert flagged.filter("n < 50000 AND NOT __maybe").count() == 0
    assert flagged.filter("n >= 50000 AND __maybe").count() < 50_000 * 0.03


def test_loads_merge_as_one_filter(spark, known):
    parts = [spark.range(i * 1000, i * 1000 + 1500).select(F.col("id").cast("string")) for i in range(4)]
    for i, part in enumerate(parts):
        known.add(part, str(i))
    known.add(parts[2], "2")  # repeated
    whole = blocks_of(spark.range(0, 4500).select(F.col("id").cast("string")), ["id"], known.n_blocks)
    assert rows(known.merged()) == rows(whole)
    known.rebuild(spark.range(0, 4500).select(F.col("id").cast("string")))
    assert rows(known.merged()) == rows(whole)


@pytest.mark.parametrize("how", ["filter", "empty filter", "too large"])
def test_same_rows_as_the_exact_join(spark, tmp_path, how):
    keys = ("id", "ts")
    most = 1 if how == "too large" else 64 << 20
    known = KeyFilter(spark, str(tmp_path / "f"), keys, n_blocks=64, most_bytes=most)  # crowded: many false hits
    stored = spark.createDataFrame([(f"k{i}", i % 7) for i in range(3000)] + [(None, 1), ("x", None)], "id string, ts int")
    if how != "empty filter":
        known.add(stored, "1")
    else:
        stored = stored.limit(0)
    df = spark.createDataFrame(
        [(f"k{i}", i % 5, "v") for i in range(5000)] * 2 + [(None, 1, "v"), ("x", None, "v"), ("", 0, None)], "id string, ts int, v string"
    )
    assert rows(drop_existing_filtered(df, stored, known)) == rows(drop_existing(df, stored, keys))
    assert rows(drop_existing_filtered(df.limit(0), stored, known)) == []


def test_new_rows_are_not_shuffled(spark, known, tmp_path):
    known.add(spark.range(100).select(F.col("id").cast("string")), "1")
    spark.range(1000).selectExpr("string(id) AS id", "'wide' AS v").write.parquet(str(tmp_path / "t"))
    stored = spark.range(100).select(F.col("id").cast("string"))
    df = drop_existing_filtered(spark.read.parquet(str(tmp_path / "t")), stored, known)
    new = df._jdf.queryExecution().optimizedPlan().children().head()
    plan = spark._jsparkSession.sessionState().executePlan(new, spark._jvm.org.apache.spark.sql.execution.CommandExecutionMode.SKIP())
    text = plan.executedPlan().toString()
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text and "NestedLoop" not in text
    assert df.count() == 900
