"""Preparation jobs on plain files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators import permute, split
from strata.operators.nested import flatten_struct
from strata.sources import files
from strata.staging import Staging, refuse_overlap


def filter_csv_to_parquet(
    spark: SparkSession, source: str, target: str, condition: str, schema: T.StructType | None = None
) -> None:
    """Rows of CSV files that meet a SQL condition, as Parquet. Types are inferred without a schema."""
    refuse_overlap(spark, source, target)
    df = files.read_csv(spark, source, schema, infer=schema is None)
    files.write_parquet(df.filter(condition), target)


def json_to_csv(
    spark: SparkSession, source: str, target: str, schema: T.StructType | None = None, **options
) -> None:
    """A folder of JSON record files to CSV, nested objects as dotted columns. ``options`` go to ``read_json``."""
    refuse_overlap(spark, source, target)
    files.write_csv(flatten_struct(files.read_json(spark, source, schema, **options)), target)


def split_csv(
    spark: SparkSession, df: DataFrame, target: str, min_rows: int = 10_000, max_rows: int = 200_000, seed: int = 0
) -> int:
    """Shuffle the rows and write them as CSV chunks of random size; returns the number of rows.

    Every chunk is one file in a folder ``chunk=1``, ``chunk=2`` and so on; an empty input writes nothing. A row's position comes
    from its number by a keyed permutation, its chunk and task from its position, so rows of Parquet files move once, to the
    task of their chunk, and are neither staged nor sampled. The same seed over the same files gives the same chunks.
    """
    if not 0 < min_rows <= max_rows:
        raise ValueError("expected 0 < min_rows <= max_rows")
    with Staging(spark) as staging:
        rows, n_rows = permute.numbered(df, staging)
        if n_rows:
            place = permute.position(spark, F.col(permute.ROW), n_rows, seed).alias(permute.POSITION)
            rows = rows.select(*map(files.named, df.columns), place)
            chunk = split.chunk_of(F.col(permute.POSITION), min_rows, max_rows, seed)
            pairs = -(-n_rows // (min_rows + max_rows))
            tasks = split.n_tasks(df, n_rows, pairs)
            # Both chunks of a pair go to one task, neighbouring pairs to the same one.
            pair = F.call_function("div", F.col(permute.POSITION), F.lit(min_rows + max_rows).cast("long"))
            task = F.call_function("div", pair * tasks, F.lit(pairs).cast("long")).cast("int")
            (
                files.csv_ready(rows.withColumn(split.CHUNK, chunk))
                .repartitionById(tasks, task)
                .sortWithinPartitions(split.CHUNK, permute.POSITION)
                .drop(permute.POSITION)
                .write.mode("overwrite")
                .options(**files.CSV_OUT)
                .partitionBy(split.CHUNK)
                .csv(target)
            )
    return n_rows
