"""Random split of a table into chunks of random size.

Rows are ordered by a random hash and cut into chunks by their position in that order. Positions are worked out on the
hash column alone; whole rows find their chunk by comparing their hash with the hashes at which chunks begin, and move
once, to the chunk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

ORDER, CHUNK = "__order", "chunk"
_BUCKET, _OFFSET, _N, _BASE, _STARTS, _GROUP = (
    "__bucket", "__offset", "__n", "__base", "__starts", "__group"
)
# Rows a bucket of the hash range holds, about, and buckets of which one running total is made at a time.
BUCKET_ROWS = 10_000
GROUP = 4096
# Rows a task should get.
TASK_ROWS = 1_000_000


def shuffle_key(df: DataFrame, seed: int = 0) -> DataFrame:
    """Add the hash that orders rows at random. Stage the result before using it twice.

    It is a hash of the row's number as it is read, not of its values, so that copies of one row spread as well.
    Different numbers have different hashes.
    """
    return df.withColumn(ORDER, F.xxhash64(F.lit(seed), F.monotonically_increasing_id()))


def n_buckets(n_rows: int, bucket_rows: int = BUCKET_ROWS) -> int:
    return max(1, -(-n_rows // bucket_rows))


def n_tasks(df: DataFrame, n_rows: int, most: int) -> int:
    """Tasks for a shuffle of ``n_rows`` that go to at most ``most`` places."""
    return min(most, max(df.sparkSession.sparkContext.defaultParallelism, -(-n_rows // TASK_ROWS)))


def bucket_of(order: Column, buckets: int) -> Column:
    """Which of ``buckets`` equal parts of the hash range a hash falls in; the parts are in hash order."""
    # The top 31 bits, with the sign turned so that they rise with the hash, scaled to the number of buckets.
    high = F.shiftrightunsigned(order.bitwiseXOR(F.lit(-(2**63))), 33)
    return F.shiftright(high * F.lit(buckets), 31)


def bucket_offsets(ordered: DataFrame, n_rows: int, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Rows of each bucket, and the position of its first row.

    Running totals are made in two steps, over groups of buckets and within each group, so that none sees all buckets.
    """
    bucket = bucket_of(F.col(ORDER), n_buckets(n_rows, bucket_rows))
    sizes = ordered.groupBy(bucket.alias(_BUCKET)).agg(F.count(F.lit(1)).alias(_N))
    sizes = sizes.withColumn(_GROUP, F.floor(F.col(_BUCKET) / GROUP))
    upto = (W.Window.unboundedPreceding, -1)
    groups = sizes.groupBy(_GROUP).agg(F.sum(_N).alias(_N))
    before = F.coalesce(F.sum(_N).over(W.Window.orderBy(_GROUP).rowsBetween(*upto)), F.lit(0))
    within = F.coalesce(F.sum(_N).over(W.Window.partitionBy(_GROUP).orderBy(_BUCKET).rowsBetween(*upto)), F.lit(0))
    placed = sizes.withColumn(_OFFSET, within).join(groups.select(_GROUP, before.alias(_BASE)), _GROUP)
    return placed.select(_BUCKET, _N, (F.col(_OFFSET) + F.col(_BASE)).alias(_OFFSET))


def chunk_of(position: Column, min_rows: int, max_rows: int, seed: int = 0) -> Column:
    """Number, from 1, of the chunk that holds a position, by arithmetic alone.

    Sizes are drawn in pairs: the first of a pair is uniform in [min_rows, max_rows], the second is what is left of
    min_rows + max_rows, so uniform as well. Each pair then covers the same number of rows, and a position finds its
    chunk without a running total of sizes.
    """
    pair_rows = min_rows + max_rows
    into_pair = F.pmod(position, F.lit(pair_rows))
    pair = ((position - into_pair) / F.lit(pair_rows)).cast("bigint")
    first = F.lit(min_rows) + F.pmod(F.xxhash64(F.lit(seed), pair), F.lit(max_rows - min_rows + 1))
    second_half = F.when(into_pair >= first, 1).otherwise(0)
    return pair * 2 + second_half + 1


def chunk_starts(
    ordered: DataFrame,
    n_rows: int,
    min_rows: int = 10_000,
    max_rows: int = 200_000,
    seed: int = 0,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """One row per bucket: the chunk that is under way when it begins, and the hashes at which chunks start in it.

    Reads the hash column only, and sorts only the buckets in which a chunk starts.
    """
    if not 0 < min_rows <= max_rows:
        raise ValueError("expected 0 < min_rows <= max_rows")

    def chunk_at(position: Column) -> Column:
        return F.when(position < 0, 0).otherwise(chunk_of(position, min_rows, max_rows, seed))

    buckets = n_buckets(n_rows, bucket_rows)
    offsets = bucket_offsets(ordered, n_rows, bucket_rows).withColumn(_BASE, chunk_at(F.col(_OFFSET) - 1))
    crossed = offsets.filter(chunk_at(F.col(_OFFSET) + F.col(_N) - 1) != F.col(_BASE)).select(_BUCKET, _OFFSET)
    hashes = ordered.select(ORDER, bucket_of(F.col(ORDER), buckets).alias(_BUCKET))
    within = W.Window.partitionBy(_BUCKET).orderBy(ORDER)
    placed = hashes.join(crossed, _BUCKET).repartition(n_tasks(ordered, n_rows, buckets), _BUCKET)
    position = F.col(_OFFSET) + F.row_number().over(within) - 1
    numbered = placed.select(_BUCKET, ORDER, position.alias("__position"))
    starting = numbered.filter(chunk_at(F.col("__position")) != chunk_at(F.col("__position") - 1))
    starts = starting.groupBy(_BUCKET).agg(F.sort_array(F.collect_list(ORDER)).alias(_STARTS))
    return offsets.select(_BUCKET, _BASE).join(starts, _BUCKET, "left")


def split_chunks(ordered: DataFrame, starts: DataFrame, n_rows: int, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Rows of an ordered frame (see :func:`shuffle_key`) with the number of their chunk; the last one is shorter.

    ``starts`` is a staged result of :func:`chunk_starts` for the same numbers.
    """
    bucket = bucket_of(F.col(ORDER), n_buckets(n_rows, bucket_rows))
    found = ordered.withColumn(_BUCKET, bucket).join(starts, _BUCKET)
    begun = F.when(F.col(_STARTS).isNull(), 0).otherwise(F.size(F.filter(_STARTS, lambda s: s <= F.col(ORDER))))
    return found.withColumn(CHUNK, F.col(_BASE) + begun).drop(_BUCKET, _BASE, _STARTS)


def expected_chunks(n_rows: int, min_rows: int, max_rows: int) -> int:
    """The number of chunks, up to one: two of them always hold min_rows + max_rows."""
    return -(-2 * n_rows // (min_rows + max_rows))
