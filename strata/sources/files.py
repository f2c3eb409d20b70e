"""CSV, JSON and Parquet files."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.parquet as pq
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import schemas
from strata.functions import text
from strata.sources.csv_blocks import csv_records
from strata.sql import quoted
from strata.staging import open_store, path_exists

# Whole fields that mean "no value" in a CSV file.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Headers, doubled quotes, and blanks written as they are; the writer would trim them by default.
CSV_OUT = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def listed(spark: SparkSession, folder: str | list[str], pattern: str | None = None) -> DataFrame:
    """(path, length) of the finished files below a folder, or of a list of files, listed by tasks where there are many.

    Files and folders whose name begins with ``_`` or ``.`` are work in progress and not listed.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    reader = reader.option("pathGlobFilter", pattern) if pattern else reader
    return reader.load(folder).select("path", "length")


def gather(spark: SparkSession, folders: list[str], target: str, pattern: str = "*.csv") -> None:
    """Copy the files of several folders into one, by tasks, under names that tell them apart."""
    found = reduce(DataFrame.union, [listed(spark, f, pattern).withColumn("no", F.lit(i)) for i, f in enumerate(folders)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_store(target)
        fs.create_dir(root, recursive=True)
        for batch in batches:
            for row in batch.to_pylist():
                source, at = open_store(row["path"])
                with source.open_input_stream(at) as a, fs.open_output_stream(f"{root}/{row['no']}-{at.rpartition('/')[2]}") as b:
                    while block := a.read(8 << 20):
                        b.write(block)
            yield pa.RecordBatch.from_arrays([batch.column("path")], ["path"])

    found.repartition(spark.sparkContext.defaultParallelism).mapInArrow(run, "path string").count()


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kinds = []
        for path in batch.column("path").to_pylist():
            fs, at = open_store(path)
            kinds.append(str(pq.read_schema(at, filesystem=fs).remove_metadata()))
        yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(kinds, pa.string())], ["path", "kind"])


def parquet_groups(spark: SparkSession, source: str | list[str], merge: bool = True) -> list[DataFrame]:
    """The Parquet files below a folder, or of a list of files, as frames that together hold all their rows.

    Where the files' types agree, Spark merges their footers, in tasks, to one frame with the columns of all, NULL where a file
    lacks one. Where types differ, or with ``merge=False``, there is a frame for each schema that files were written with;
    footers are then grouped by schema in tasks, and only then file names reach the driver. Sub-folders named like
    ``column=value`` give a column, unless other sub-folders hold files as well. No files give no frame.
    """
    files = listed(spark, source, "*.parquet").select("path")
    plain = F.lit(False)
    if isinstance(source, str):
        below = F.substring(F.regexp_replace("path", r"^[A-Za-z][\w+.-]*:/*|^/*", "/"), len(_plain_path(source)) + 1, 1 << 20)
        plain = below.rlike(r"^/(.*/)?[^/=]+/[^/]*$")
    n, plain = files.agg(F.count("*"), F.bool_or(plain)).first()
    if not n:
        return []
    reader = spark.read.option("recursiveFileLookup", True) if plain else spark.read
    paths = [source] if isinstance(source, str) else source
    if merge:
        try:
            return [reader.option("mergeSchema", True).parquet(*paths)]
        except (PySparkException, Py4JJavaError) as e:
            if "CANNOT_MERGE" not in str(e):
                raise
    kinds = files.repartition(spark.sparkContext.defaultParallelism).mapInArrow(_footers, "path string, kind string").persist()
    try:
        if kinds.select("kind").distinct().count() == 1:
            return [reader.parquet(*paths)]
        groups: dict[str, list[str]] = {}
        for r in kinds.toLocalIterator():
            groups.setdefault(r.kind, []).append(r.path)
    finally:
        kinds.unpersist()
    if isinstance(source, str) and not plain:
        reader = reader.option("basePath", source)
    return [reader.parquet(*sorted(found)) for _, found in sorted(groups.items())]


def declared(frames: list[DataFrame], schema: T.StructType, spark: SparkSession) -> DataFrame:
    """The rows of all frames in declared types, by name. A column must be in one of them; NULL where another lacks it."""
    if not frames:
        return spark.createDataFrame([], schema)
    absent = [f.name for f in schema if all(f.name not in df.columns for df in frames)]
    if absent:
        raise ValueError(f"columns missing from the input: {absent}")
    return reduce(DataFrame.unionByName, [schemas.enforce(df, schema, missing="null") for df in frames])


def read_layer(spark: SparkSession, path: str | list[str], kind: str) -> DataFrame:
    """A Parquet layer in its declared types, whatever types each of its files was written with."""
    return declared(parquet_groups(spark, path), schemas.schema_for(kind), spark)


def declared_plays(df: DataFrame, uri_prefix: str = "") -> DataFrame:
    """Raw plays in their declared types; columns that an export lacks are NULL, but not the time and the track's URI.

    The URI's column is the one that ends in ``track_uri``, whatever the exporting service put before it.
    """
    wanted = f"{uri_prefix}track_uri"
    found = [c for c in df.columns if c.endswith("track_uri")]
    if wanted not in df.columns and len(found) == 1:
        df = df.withColumnRenamed(found[0], wanted)
    required = [c for c in ("ts", wanted) if c not in df.columns]
    if required:
        raise ValueError(f"columns missing from the input: {required}, columns that end in track_uri: {found}")
    if isinstance(df.schema["ts"].dataType, (T.TimestampType, T.TimestampNTZType)):
        df = df.withColumn("ts", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return schemas.enforce(df, schemas.raw_play_schema(uri_prefix), missing="null")


def read_plays(spark: SparkSession, path: str | list[str], uri_prefix: str = "") -> DataFrame:
    """Raw plays of files of any schemas that hold them."""
    frames = parquet_groups(spark, path)
    if frames and sum(c.endswith("track_uri") for c in frames[0].columns) > 1:
        frames = parquet_groups(spark, path, merge=False)  # files of several exports, each with its own prefix
    frames = [declared_plays(df, uri_prefix) for df in frames]
    if not frames:
        return spark.createDataFrame([], schemas.raw_play_schema(uri_prefix))
    return reduce(DataFrame.unionByName, frames)


class MalformedCsv(ValueError):
    """Rows with more fields than their file's header."""


_RAW, _FIELDS, _PATH = "__raw_line", "__fields", "__path"


def _csv_reader(spark: SparkSession, multi_line: bool):
    return (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("pathGlobFilter", "*.csv")
        .option("recursiveFileLookup", True)
    )


def named(name: str) -> Column:
    """A column by its name as it is, whatever characters it holds."""
    return F.col(quoted(name))


def _plain_path(path: str) -> str:
    """A path without its scheme, and with one slash at its start, to compare two ways of writing it."""
    return re.sub(r"^[A-Za-z][\w+.-]*:/*|^/*", "/", path).rstrip("/")


def _told_path() -> Column:
    """The path of a row's file. Spark tells it percent-encoded, and a plus sign in it is just that."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def _source_name(told: Column, folder: str | None) -> Column:
    """A path below a folder, the file's name alone without one, both without ``.csv``."""
    if not folder:
        told = F.substring_index(told, "/", -1)
    else:
        bare = F.regexp_replace(told, r"^[A-Za-z][\w+.-]*:/*|^/*", "/")
        told = F.substring(bare, len(_plain_path(folder)) + 2, 1 << 20)
    return F.regexp_replace(told, r"\.csv$", "")


def _too_long(n: int) -> Column:
    """Whether the raw text of a row that does not fit has more than ``n`` fields; fewer are filled with NULL."""
    # As the parser has it, a quote opens a field only where the field begins with it; others are characters.
    bare = F.regexp_replace(_RAW, r'(^|,)"(?:[^"]|"")*"', "$1")
    return F.coalesce(F.regexp_count(bare, F.lit(",")) >= n, F.lit(False))


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    infer: bool = False,
    multi_line: bool = True,
    na_tokens: list[str] | None = NA_TOKENS,
    source_column: str | None = None,
    malformed: str = "error",
    source_folder: str | None = None,
    block: int | None = None,
) -> DataFrame:
    """All ``*.csv`` files below a folder, or a list of files, with a header each and quotes doubled inside quoted fields.

    Files in sub-folders count like others, but for folders whose name begins with ``_`` or ``.``. A quote in the middle of a
    field is a character like any other.

    Fields are read as text and then fitted to ``schema``, by name. Types are inferred, in a second scan, only with
    ``infer``. Files whose header differs from the first one's are an error instead of shifted columns; see
    :func:`csv_groups`. Line breaks inside quotes belong to the field; ``multi_line=False`` is for files known to have none,
    which can then be split among tasks. With ``block`` files are cut among tasks in blocks of so many bytes, at the true ends of their
    records (:mod:`strata.sources.csv_blocks`), whatever their fields hold; the rows are the same. ``source_column`` adds the file name without its suffix, or with ``source_folder`` its
    path below that folder.

    A row with fewer fields than the header ends in NULLs. One with more fails the job, or with ``malformed="aside"`` is left
    out, to be had from :func:`malformed_csv`.
    """
    names = _header(spark, path, multi_line)
    n = len(names)
    if not n:  # nothing but empty files
        columns = [*(schema or []), *([T.StructField(source_column, T.StringType())] if source_column else [])]
        return spark.createDataFrame([], T.StructType(columns))
    if malformed not in ("error", "aside"):
        raise ValueError(f"unknown treatment of malformed rows {malformed!r}")
    if block:
        df, long, told = _records(spark, path, names, block), F.col(_FIELDS) > n, F.col(_PATH)
    else:
        df, long, told = _with_raw_lines(spark, path, names, multi_line), _too_long(n), _told_path()
    if malformed == "error":
        seen = F.concat(F.lit(f"more than {n} fields: "), F.col(_RAW))
        df = df.filter(F.when(long, F.raise_error(seen).cast("boolean")).otherwise(True))
    else:
        df = df.filter(~long)
    if infer and block:
        kinds = _inferred(df, names)
    else:
        kinds = _csv_reader(spark, multi_line).option("inferSchema", True).csv(path).schema if infer else None
    cols = []
    for name in names:
        c = named(name)
        if na_tokens and not (kinds and not isinstance(kinds[name].dataType, T.StringType)):
            c = text.blank_if_token(c, na_tokens)
        cols.append((c.try_cast(kinds[name].dataType) if kinds else c).alias(name))
    if source_column:
        cols.append(_source_name(told, source_folder).alias(source_column))
        schema = T.StructType([*schema, T.StructField(source_column, T.StringType())]) if schema else None
    df = df.select(cols)
    return schemas.enforce(df, schema, missing="null") if schema else df


def _header(spark: SparkSession, path: str | list[str], multi_line: bool) -> list[str]:
    return _csv_reader(spark, multi_line).option("inferSchema", False).csv(path).columns


def _with_raw_lines(spark: SparkSession, path: str | list[str], names: list[str], multi_line: bool) -> DataFrame:
    """All columns as text, and the raw text of rows whose number of fields is not the header's."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, _RAW]])
    reader = _csv_reader(spark, multi_line).option("inferSchema", False)
    return reader.option("columnNameOfCorruptRecord", _RAW).option("columnPruning", False).schema(schema).csv(path)


def _records(spark: SparkSession, path: str | list[str], names: list[str], block: int) -> DataFrame:
    """All columns as text, each record's raw text, its number of fields and its file, from files cut among tasks."""
    found = csv_records(spark, listed(spark, path, "*.csv"), block)
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))])
    options = {"quote": '"', "escape": '"', "multiLine": "true"}
    row = F.from_csv("line", schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), options)
    # A header field without a text has a name that the reader made up.
    want = F.array(*[F.lit("" if name == f"_c{i}" else name.lower()) for i, name in enumerate(names)])
    has = F.array(*[F.lower(F.coalesce(F.col("row")[f"c{i}"], F.lit(""))) for i in range(len(names))])
    told = F.concat(F.lit("another header in "), "path", F.lit(": "), "line")
    differs = F.col("header") & ((F.col("fields") != len(names)) | (has != want))
    rows = found.withColumn("row", row).filter(F.when(differs, F.raise_error(told).cast("boolean")).otherwise(~F.col("header")))
    cols = [F.col("row")[f"c{i}"].alias(name) for i, name in enumerate(names)]
    return rows.select(*cols, F.col("line").alias(_RAW), F.col("fields").alias(_FIELDS), F.col("path").alias(_PATH))


def _inferred(df: DataFrame, names: list[str]) -> T.StructType:
    """The narrowest of int, long, double, boolean and string that holds all of a column's texts, from one aggregate.

    Whole numbers beyond a long are doubles here. Columns without any text are strings.
    """
    kinds = [T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType()]
    whole, number = r"^[+-]?\d+$", r"^([+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|NaN|-?Inf|-?Infinity)$"
    aggs = []
    for i, name in enumerate(names):
        c = F.nullif(named(name), F.lit(""))
        fits = [c.rlike(whole) & c.try_cast(kinds[0]).isNotNull(), c.rlike(whole) & c.try_cast(kinds[1]).isNotNull(), c.rlike(number)]
        fits.append(F.lower(c).isin("true", "false"))
        aggs += [F.bool_and(c.isNull() | f).alias(f"f{i}_{k}") for k, f in enumerate(fits)]
        aggs.append(F.count(c).alias(f"n{i}"))
    seen = df.agg(*aggs).first()
    narrowest = lambda i: next((k for j, k in enumerate(kinds) if seen[f"n{i}"] and seen[f"f{i}_{j}"]), T.StringType())
    return T.StructType([T.StructField(name, narrowest(i)) for i, name in enumerate(names)])


def malformed_csv(spark: SparkSession, path: str | list[str], multi_line: bool = True, block: int | None = None) -> DataFrame:
    """(file, line): the rows with more fields than the header, as they are in the file; ``block`` as for :func:`read_csv`."""
    names = _header(spark, path, multi_line)
    if not names:
        return spark.createDataFrame([], "file string, line string")
    name, line = lambda told: F.substring_index(told, "/", -1).alias("file"), F.col(_RAW).alias("line")
    if block:
        return _records(spark, path, names, block).filter(F.col(_FIELDS) > len(names)).select(name(F.col(_PATH)), line)
    df = _with_raw_lines(spark, path, names, multi_line)
    # Spark does not read raw lines alone, so the filter names a field as well.
    held = F.length(F.concat_ws("", named(names[0]))) >= 0
    return df.filter(_too_long(len(names)) & held).select(name(_told_path()), line)


def _headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lines = []
        for path in batch.column("path").to_pylist():
            fs, at = open_store(path)
            with fs.open_input_stream(at) as f:
                head = b""
                while b"\n" not in head and (more := f.read(1 << 16)):
                    head += more
            lines.append(head.split(b"\n")[0].decode("utf-8-sig", "replace").strip())
        yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(lines, pa.string())], ["path", "header"])


def csv_groups(spark: SparkSession, folder: str) -> list[str | list[str]]:
    """The CSV files below a folder by their header: the folder where all agree, else a list of files for each header.

    Headers are read in tasks. Files without a byte have neither header nor rows and are left out.
    """
    found = listed(spark, folder, "*.csv").where("length > 0").select("path")
    found = found.repartition(spark.sparkContext.defaultParallelism)
    heads = found.mapInArrow(_headers, "path string, header string").persist()
    try:
        kinds = heads.select("header").distinct().count()
        if kinds <= 1:
            return [folder] * kinds
        groups: dict[str, list[str]] = {}
        for r in heads.toLocalIterator():
            groups.setdefault(r.header, []).append(r.path)
    finally:
        heads.unpersist()
    return [sorted(paths) for _, paths in sorted(groups.items())]


def inferred_schema(
    spark: SparkSession, path: str | list[str], multi_line: bool = True, block: int | None = None
) -> T.StructType:
    """Column types found by a scan of the CSV files. Dates and times stay text, for the cleaning rules to judge.

    With ``block`` files are cut among tasks, see :func:`read_csv`; rows with too many fields then do not count.
    """
    if block:
        names = _header(spark, path, multi_line)
        return _inferred(_records(spark, path, names, block).filter(F.col(_FIELDS) <= len(names)), names) if names else T.StructType([])
    times = (T.DateType, T.TimestampType, T.TimestampNTZType)
    found = _csv_reader(spark, multi_line).option("inferSchema", True).csv(path).schema
    return T.StructType(
        [T.StructField(f.name, T.StringType() if isinstance(f.dataType, times) else f.dataType) for f in found]
    )


def read_json(
    spark: SparkSession, path: str, schema: T.StructType | None = None, lines: bool = False, pattern: str = "*.json"
) -> DataFrame:
    """All record files of a folder, columns united by name; a schema saves the inference scan.

    Each file is one array of records, read whole by one task, or with ``lines`` one record per line, which Spark can
    split.
    """
    reader = spark.read.option("multiLine", not lines).option("pathGlobFilter", pattern)
    return (reader.schema(schema) if schema else reader).json(path)


def read_variants(spark: SparkSession, path: str, lines: bool = False, pattern: str = "*.json") -> DataFrame:
    """All records of a folder as one VARIANT column ``v``, whatever types their fields have; files as for :func:`read_json`.

    :func:`strata.operators.nested.flatten_variants` makes columns of them.
    """
    reader = spark.read.option("multiLine", not lines).option("pathGlobFilter", pattern).option("singleVariantColumn", "v")
    return reader.json(path).selectExpr("explode(coalesce(try_variant_get(v, '$', 'array<variant>'), array(v))) AS v")


def csv_ready(df: DataFrame) -> DataFrame:
    """CSV holds no lists: arrays of strings become list text, other arrays and maps become JSON."""

    def field(f: T.StructField):
        c = named(f.name)
        if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StringType):
            c = text.list_text(c)
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            c = F.to_json(c)
        return c.alias(f.name)

    return df.select([field(f) for f in df.schema])


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    csv_ready(df).write.mode(mode).options(**CSV_OUT).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def require_folder(spark: SparkSession, path: str) -> None:
    if not path_exists(spark, path):
        raise FileNotFoundError(f"folder {path} does not exist")
