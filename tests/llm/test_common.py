import glob
import os
import time

from pyspark.sql import functions as F

from strata.llm import common, substrings

SHUFFLED = "/**/shuffle_*.data"


def tables(spark):
    folder = spark.conf.get("spark.checkpoint.dir") + "/llm"
    return {f for f in os.listdir(folder)} if os.path.isdir(folder) else set()


def documents(spark):
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(i, " ".join([*(f"w{i * j % 97}" for j in range(30)), passage, f"end{i}"])) for i in range(1, 30)]
    return spark.createDataFrame(rows + [(100 + i, t) for i, t in rows[:5]], "doc_id long, text string")


def test_shuffle_files_of_a_staged_table_go_at_once(spark):
    store = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    folders = [str(f) for f in store.localDirs()]
    shuffled = lambda: {f for d in folders for f in glob.glob(d + SHUFFLED, recursive=True)}
    before, setting = shuffled(), spark.conf.get(common.CLEANUP)
    df = spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).count()
    found = common.staged(df, "counts")
    for _ in range(50):
        if shuffled() <= before:
            break
        time.sleep(0.2)
    assert shuffled() <= before
    assert spark.conf.get(common.CLEANUP) == setting
    assert found.count() == 100 and df.count() == 100


def test_settled_keeps_its_result_alone(spark):
    before = tables(spark)

    def inner():
        return common.settled(lambda: common.staged(spark.range(5), "a"), "b").join(common.staged(spark.range(3), "c"), "id")

    found = common.settled(inner, "d")
    assert found.count() == 3
    assert {t.split("-")[0] for t in tables(spark) - before} == {"d"}


def test_repeats_are_all_that_is_left(spark):
    docs = documents(spark)
    before = tables(spark)
    assert substrings.remove_repeats(docs).count() == 34
    assert {t.split("-")[0] for t in tables(spark) - before} == {"repeats"}
