"""Lake zones: landing CSV files as Parquet, and moving what was processed to the archive."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sources import csv_blocks, files
from strata.staging import (
    Staging,
    delete_path,
    file_system,
    make_folder,
    open_store,
    path_exists,
    qualified,
    refuse_overlap,
)

log = logging.getLogger(__name__)
SOURCE_FILE = "source_file"
#: Bytes of a CSV file that one task still reads whole.
LARGE = 4 * csv_blocks.BLOCK


def ingest_csv(
    spark: SparkSession,
    folder: str,
    zone: str,
    schema: T.StructType | None = None,
    drop: Sequence[str] = (),
    multi_line: bool = True,
    block: int | None = None,
) -> int:
    """Convert every CSV file below ``folder`` to Parquet in ``zone`` and return the number of files.

    Each file lands in a partition of its own name, its path below ``folder``: ingesting it again replaces it and leaves the
    others alone. Files in sub-folders count like others, as they do for reads and the archive.
    Files may have different headers, each is read by its own. Without a ``schema`` the types are found by a scan of the
    files with the same header. Columns in ``drop``, such as personal data, never reach the zone; absent ones are ignored.
    ``block`` cuts files among tasks, see :func:`strata.sources.files.read_csv`; without it, files are cut where one of them is so
    large that its task would read more than ``LARGE`` bytes.
    """
    files.require_folder(spark, folder)
    found, largest = files.listed(spark, folder, "*.csv").agg(F.count("*"), F.max("length")).first()
    if not found:
        log.warning("no CSV files in %s", folder)
        return 0
    if block is None and multi_line and largest > LARGE:
        block = csv_blocks.BLOCK
    for group in files.csv_groups(spark, folder):
        fitted = schema or files.inferred_schema(spark, group, multi_line, block)
        below = qualified(spark, folder)
        df = files.read_csv(
            spark, group, fitted, multi_line=multi_line, source_column=SOURCE_FILE, source_folder=below, block=block
        )
        (
            df.drop(*drop)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(SOURCE_FILE)
            .parquet(zone)
        )
    log.info("%d CSV files of %s are in %s", found, folder, zone)
    return found


def read_zone(spark: SparkSession, zone: str) -> DataFrame:
    """All rows of a zone, without the bookkeeping columns.

    Files may have different columns and types: a column is NULL where a file lacks it, whole numbers beside fractions are
    doubles, and other types that differ become text.
    """
    frames = [df.drop(SOURCE_FILE, "run_id") for df in files.parquet_groups(spark, zone)]
    if not frames:
        raise FileNotFoundError(f"no Parquet files in {zone}")
    kinds: dict[str, set] = {}
    for df in frames:
        for f in df.schema:
            kinds.setdefault(f.name, set()).add(f.dataType)
    common = T.StructType([T.StructField(name, _common(found)) for name, found in kinds.items()])
    return files.declared(frames, common, spark)


def _common(kinds: set) -> T.DataType:
    if len(kinds) == 1:
        return next(iter(kinds))
    if all(isinstance(k, T.IntegralType) for k in kinds):
        return T.LongType()
    return T.DoubleType() if all(isinstance(k, T.NumericType) for k in kinds) else T.StringType()


class ArchiveIncomplete(RuntimeError):
    """The archive does not hold what the source does; the source was left as it is."""


def archive_zone(spark: SparkSession, latest: str, archive: str, run_id: str, rename: bool = False) -> int:
    """Move the files of ``latest`` to ``archive/run_id=...``, byte for byte; returns the rows of the Parquet files there.

    All finished files go, whatever they hold, to the same path below the archive; files in folders that begin with ``_`` or
    ``.``, which a writer is still at work on, stay. The files are listed once. Tasks copy them; when every copy has its
    source's size, the list is stored with the copies, and exactly the listed files are deleted, by tasks, too: a file
    that arrives meanwhile stays. A run that broke off is repeated under its own ``run_id``. Without a stored list nothing
    was deleted yet and the copies are made anew; with one, only the deletions are finished.

    ``rename`` moves the folder as a whole instead, where the file system does that in one step and without copying.
    """
    if not path_exists(spark, latest):
        return 0
    refuse_overlap(spark, latest, archive)
    target = f"{archive}/run_id={run_id}"
    moved = f"{target}/_moved"
    if not path_exists(spark, f"{moved}/_SUCCESS"):
        if rename:
            return _rename_zone(spark, latest, archive, target) if list_files(spark, latest).head(1) else 0
        with Staging(spark) as staging:
            found = staging.put(list_files(spark, latest), "listed")
            if not found.head(1):
                return 0
            delete_path(spark, target)
            copies = staging.put(_in_tasks(found, _copier(qualified(spark, latest), qualified(spark, target))), "copies")
            wrong = found.join(copies, ["path", "length"], "left_anti").count()
            if wrong:
                raise ArchiveIncomplete(f"{wrong} files of {latest} have no whole copy in {target}")
            found.write.mode("overwrite").parquet(moved)
    stored, rows = spark.read.parquet(moved), _rows(spark, target)
    _in_tasks(stored, _delete).agg({"length": "sum"}).collect()
    return rows


def _rows(spark: SparkSession, folder: str) -> int:
    """Rows of the Parquet files below a folder, from their footers."""
    return sum(df.count() for df in files.parquet_groups(spark, folder))


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, length) of the finished files below a folder."""
    return files.listed(spark, folder)


def _in_tasks(found: DataFrame, work: Callable[[str, int], int]) -> DataFrame:
    """(path, length) with the length that ``work`` reports; files are dealt evenly to tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, lengths = (batch.column(c).to_pylist() for c in ("path", "length"))
            done = [work(path, length) for path, length in zip(paths, lengths)]
            yield pa.RecordBatch.from_pydict({"path": paths, "length": pa.array(done, pa.int64())})

    tasks = found.sparkSession.sparkContext.defaultParallelism * 4
    return found.repartition(tasks).mapInArrow(run, "path string, length long")


def _copier(base: str, target: str) -> Callable[[str, int], int]:
    def copy(path: str, length: int) -> int:
        fs, source = open_store(path)
        out, root = open_store(target)
        place = f"{root}/{source[len(open_store(base)[1].rstrip('/')) + 1 :]}"
        out.create_dir(place.rpartition("/")[0], recursive=True)
        with fs.open_input_stream(source) as a, out.open_output_stream(place) as b:
            while block := a.read(8 << 20):
                b.write(block)
        return out.get_file_info(place).size

    return copy


def _delete(path: str, length: int) -> int:
    fs, at = open_store(path)
    if fs.get_file_info(at).type != pafs.FileType.NotFound:
        fs.delete_file(at)
    return length


def _rename_zone(spark: SparkSession, latest: str, archive: str, target: str) -> int:
    if path_exists(spark, target):
        raise ArchiveIncomplete(f"{target} exists already")
    make_folder(spark, archive)
    fs, p = file_system(spark, latest)
    if not fs.rename(p, file_system(spark, target)[1]):
        raise ArchiveIncomplete(f"{latest} could not be renamed to {target}")
    make_folder(spark, latest)
    return _rows(spark, target)


def data_files(spark: SparkSession, folder: str) -> list[str]:
    """Paths of the Parquet files below a folder."""
    return sorted(r.path for r in files.listed(spark, folder, "*.parquet").toLocalIterator())
