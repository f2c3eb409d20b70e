"""Shared scratch space: rows written once as a table, so that later steps read them back.

A staged table cuts the lineage, survives the loss of executors and keeps column pruning for its readers.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from urllib.parse import quote

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as ``spark.checkpoint.dir`` names it.

    Only a session that runs in one process, without the setting, gets a temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="strata-")
    return _LOCAL_DIRS[app]


def file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def open_store(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path and the path in it, for tasks, which have no access to the JVM's."""
    scheme, place, rest = re.match(r"(?:([a-zA-Z][\w+.-]*):)?(//[^/]*)?(.*)", path, re.S).groups()
    if scheme in (None, "file"):
        return pafs.LocalFileSystem(), rest
    return pafs.FileSystem.from_uri(f"{scheme}:{place or '//'}{quote(rest)}")


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.exists(p)


def make_folder(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.mkdirs(p)


def delete_path(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.delete(p, True)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with scheme and authority, without a trailing slash, to compare two of them."""
    fs, p = file_system(spark, path)
    return fs.makeQualified(p).toString().rstrip("/")


def refuse_overlap(spark: SparkSession, source: str, target: str) -> None:
    """Overwriting a folder while reading from it loses the input, so it is an error."""
    a, b = qualified(spark, source), qualified(spark, target)
    if a == b or a.startswith(b + "/") or b.startswith(a + "/"):
        raise ValueError(f"input {source} and output {target} overlap")


def spread(df: DataFrame) -> DataFrame:
    """The rows of ``df`` dealt evenly to as many tasks as there are cores.

    For narrow rows of which much is made: a scan has no more tasks than its files have row groups and pieces of some MB, so that
    millions of short rows, and every wide layer written from them, would else be the work of one or two tasks.
    """
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


class Staging:
    """Staged tables of one run, removed at the end of the ``with`` block."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/staged/{uuid.uuid4().hex}"

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *exc) -> None:
        delete_path(self.spark, self.root)

    def put(self, df: DataFrame, label: str) -> DataFrame:
        """Write ``df`` once and return a DataFrame that scans what was written."""
        path = f"{self.root}/{label}"
        df.write.mode("errorifexists").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)
