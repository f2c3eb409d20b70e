from pyspark.sql import functions as F

from strata.operators.gate import duplicates
from strata.operators.incremental import drop_existing, fk_violations
from strata.sources.tables import ManagedTable


def test_stored_side_is_not_shuffled(spark, tmp_path, setting):
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    setting("spark.sql.shuffle.partitions", "4")
    table = ManagedTable("bucketed_songs", "id STRING, n BIGINT", str(tmp_path / "t"), buckets=4)
    table.create(spark)
    for part in range(2):
        table.append(spark.range(part * 500, part * 500 + 600).select(F.concat(F.lit("k"), "id").alias("id"), F.col("id").alias("n")))
    asked = spark.range(899, 1300).select(F.when(F.col("id") > 899, F.concat(F.lit("k"), "id")).alias("id"))
    found = fk_violations(asked, table.read(spark), salts=None)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "SortMergeJoin" in plan and "Bucketed: true" in plan
    assert plan.index("Exchange") < plan.index("Scan parquet")  # on the side that asks
    assert sorted(r["id"] for r in found.collect()) == sorted(f"k{i}" for i in range(1100, 1300))
    assert drop_existing(asked, table.read(spark), salts=None).count() == 201
    counts = duplicates(table.read(spark), ["id"])
    assert "Exchange" not in counts._jdf.queryExecution().executedPlan().toString()
    assert counts.count() == 100
    spark.sql("DROP TABLE bucketed_songs")
