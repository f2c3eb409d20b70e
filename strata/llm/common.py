"""What the operators share: scratch folders, words of texts, and Arrow batches of a bounded size."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.staging import delete_path, file_system, shared_dir

#: Characters between words, as a Java pattern; ``bytes.split()`` cuts at the same six.
BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, deleted when the session's JVM ends."""
    path = f"{shared_dir(spark)}/llm/{label}-{uuid.uuid4().hex}"
    fs, p = file_system(spark, path)
    fs.deleteOnExit(p)
    return path


#: With it, a query's shuffle files go when the query ends, not when the driver next collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: ``paths``: the folders staged within the ``settled`` that is under way in this thread.
_steps = threading.local()


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, label)
    if getattr(_steps, "paths", None) is not None:
        _steps.paths.append(path)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.select("*").write.parquet(path)  # a frame takes the setting when it is made
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def settled(make: Callable[[], DataFrame], label: str) -> DataFrame:
    """What ``make`` returns, staged; the tables that it staged on the way are deleted then.

    Else they would all stay until the session ends, and disk would grow with the number of steps.
    """
    outer, _steps.paths = getattr(_steps, "paths", None), []
    try:
        made = make()
    finally:
        passed, _steps.paths = _steps.paths, outer
    df = staged(made, label)
    for path in passed:
        delete_path(df.sparkSession, path)
    return df


def word_array(text: Column) -> Column:
    """The words of a text; none for NULL."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANKS), lambda w: w != "")


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def pieces(batches: Iterator[pa.RecordBatch], column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of ``column``; a longer text is a batch of its own."""
    for batch in batches:
        sizes = np.diff(_offsets(batch.column(column)))
        start, held = 0, 0
        for i, size in enumerate(sizes.tolist()):
            if i > start and held + size > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if batch.num_rows > start:
            yield batch.slice(start)


def _offsets(values: pa.Array) -> np.ndarray:
    wide = pa.types.is_large_string(values.type) or pa.types.is_large_binary(values.type)
    raw = np.frombuffer(values.buffers()[1], np.int64 if wide else np.int32)
    return raw[values.offset : values.offset + len(values) + 1]


def texts(values: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text, NULL as empty."""
    wide = pa.types.is_large_string(values.type)
    return [b or b"" for b in values.cast(pa.large_binary() if wide else pa.binary()).to_pylist()]
