"""A random order of a table's rows by arithmetic: a keyed permutation of row numbers.

Rows are numbered by their file and their place in it, which Parquet tells without a shuffle. A Feistel network over pairs
(number mod a, number div a) permutes the numbers below a * b, which is the number of rows or a little more; numbers that leave
the table's range are permuted again until they are back. So each row works out its position alone: nothing is sorted, and no
hash, bucket or offset is stored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.staging import Staging

ROW, POSITION = "__row", "__position"
_FILE, _N, _OFFSET = "__file", "__n", "__offset"
ROUNDS = 6


def _only_a_scan(df: DataFrame) -> bool:
    """Whether a frame has every row of its Parquet files once: columns chosen or worked out, and nothing else."""
    if "_metadata" in df.columns:
        return False
    plan = df._jdf.queryExecution().optimizedPlan()
    while plan.getClass().getSimpleName() == "Project":
        plan = plan.children().head()
    return plan.getClass().getSimpleName() == "LogicalRelation" and plan.relation().toString() == "parquet"


def numbered(df: DataFrame, staging: Staging) -> tuple[DataFrame, int]:
    """``df`` with the rows' numbers from 0, and how many rows there are.

    A plain read of Parquet files is numbered where it lies; anything else, such as CSV, is written once before, so that a
    task that runs again numbers its rows alike. Totals run over the files, a row each, as many as the driver lists for the scan.
    """
    if not _only_a_scan(df):
        df = staging.put(df, "rows")
    file = F.col("_metadata.file_path")
    sizes = df.groupBy(file.alias(_FILE)).agg(F.count(F.lit(1)).alias(_N))
    before = F.sum(_N).over(Window.orderBy(_FILE).rowsBetween(Window.unboundedPreceding, -1))
    offsets = staging.put(sizes.select(_FILE, _N, F.coalesce(before, F.lit(0)).alias(_OFFSET)), "offsets")
    n_rows = offsets.agg(F.sum(_N)).first()[0] or 0
    placed = df.select("*", file.alias(_FILE), F.col("_metadata.row_index").alias(ROW)).join(offsets.drop(_N), _FILE)
    return placed.withColumn(ROW, F.col(ROW) + F.col(_OFFSET)).drop(_FILE, _OFFSET), n_rows


def shape(n: int) -> tuple[int, int]:
    """a and b with n <= a * b < n + a, both about the root of n."""
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    return a, max(1, -(-n // a))


def once(x: Column, n: int, seed: int) -> Column:
    """The network: a permutation of the numbers below a * b."""
    a, b = shape(n)
    left, right = F.pmod(x, F.lit(a)), F.call_function("div", x, F.lit(a).cast("long"))
    for i in range(ROUNDS):
        if i % 2:
            right = F.pmod(right + F.pmod(F.xxhash64(F.lit(seed), F.lit(i), left), F.lit(b)), F.lit(b))
        else:
            left = F.pmod(left + F.pmod(F.xxhash64(F.lit(seed), F.lit(i), right), F.lit(a)), F.lit(a))
    return right * F.lit(a) + left


def walk(spark: SparkSession, n: int, seed: int) -> int:
    """How often at most a number from below n has to be permuted again.

    Numbers outside take 1, 2, .. steps back, all of them up to the most on the way from a number inside, so that the first
    count of steps that none takes ends the search. Fewer than a numbers are outside, about the root of n.
    """
    a, b = shape(n)
    most = 16
    while a * b > n:
        start = F.struct(F.col("id").alias("x"), F.lit(0).alias("t"))

        def step(s: Column, _: Column) -> Column:
            return F.when(s["x"] < n, s).otherwise(F.struct(once(s["x"], n, seed).alias("x"), (s["t"] + 1).alias("t")))

        steps = F.aggregate(F.sequence(F.lit(1), F.lit(most)), start, step).alias("s")
        longest = spark.range(n, a * b).select(steps).where(F.col("s.x") < n).agg(F.max("s.t")).first()[0] or 0
        if longest < most:
            return longest
        most *= 4
    return 0


def position(spark: SparkSession, x: Column, n: int, seed: int = 0) -> Column:
    """Where the row number ``x`` stands in the random order of n rows that the seed names; a permutation of 0 .. n - 1."""
    again, first = walk(spark, n, seed), once(x, n, seed)
    if not again:
        return first
    back = F.aggregate(
        F.sequence(F.lit(1), F.lit(again)), first, lambda y, _: F.when(y < n, y).otherwise(once(y, n, seed))
    )
    return F.when(first < n, first).otherwise(back)
