"""Target tables: a managed table, a Parquet folder or a JDBC table, with one interface."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from strata import schemas
from strata.sql import quoted
from strata.staging import make_folder, path_exists


@dataclass(frozen=True)
class ManagedTable:
    """A catalog table, created from its definition when it is not there yet, at ``location`` if one is given.

    Text longer than its VARCHAR(n) fails the append. With ``buckets`` the rows of each load are dealt to that many files by
    their ``keys`` and sorted by them, so that anti-joins against the table (``salts=None``), duplicate counts and uniqueness
    rules on these keys read it bucket by bucket, without a shuffle of what is stored. A key that holds a large part of the rows
    then fills one bucket; such a table is better left unbucketed.
    """

    name: str
    ddl: str
    location: str | None = None
    buckets: int = 0
    keys: Sequence[str] = ("id",)

    def create(self, spark: SparkSession) -> None:
        place = f" LOCATION '{self.location}'" if self.location else ""
        by = ", ".join(map(quoted, self.keys))
        dealt = f" CLUSTERED BY ({by}) SORTED BY ({by}) INTO {self.buckets} BUCKETS" if self.buckets else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({self.ddl}) USING parquet{dealt}{place}")

    def read(self, spark: SparkSession, columns: Sequence[str] | None = None) -> DataFrame:
        df = spark.read.table(self.name)
        return df.select(*columns) if columns else df

    def append(self, df: DataFrame) -> None:
        aligned(df, self.ddl).write.mode("append").insertInto(self.name)


@dataclass(frozen=True)
class ParquetTable:
    """A folder of Parquet files; a folder that is not there yet is an empty table."""

    path: str
    ddl: str

    def create(self, spark: SparkSession) -> None:
        make_folder(spark, self.path)

    def read(self, spark: SparkSession, columns: Sequence[str] | None = None) -> DataFrame:
        schema = schemas.target_schema(self.ddl)
        if path_exists(spark, self.path):
            df = spark.read.schema(schema).parquet(self.path)
        else:
            df = spark.createDataFrame([], schema)
        return df.select(*columns) if columns else df

    def append(self, df: DataFrame) -> None:
        aligned(df, self.ddl).write.mode("append").parquet(self.path)


@dataclass(frozen=True)
class JdbcTable:
    """A table in a database. Each task appends in a transaction of its own; a load repeated under its run id completes it.

    ``reads`` is the number of tasks that read the table, each the rows whose key hashes to its number: ``hashed`` is SQL for
    that hash over the first of the columns read, so the key need not be a number or be read itself. ``creates`` makes the
    table from its definition where it is missing, lists as JSON text; else the database's owner creates it.
    """

    url: str
    name: str
    ddl: str
    properties: dict = field(default_factory=dict)
    reads: int = 1
    creates: bool = False
    #: PostgreSQL's; others have one as well.
    hashed: str = "(hashtext(CAST({column} AS text)) & 2147483647)"

    def options(self, columns: Sequence[str] | None = None) -> dict[str, str]:
        what = ", ".join(columns) if columns else "*"
        source = {"url": self.url, "dbtable": f"(SELECT {what} FROM {self.name}) t"}
        return source | {k: str(v) for k, v in self.properties.items()}

    def predicates(self, columns: Sequence[str] | None = None) -> list[str]:
        """One condition a task. NULL keys go with the first one."""
        column = (columns or [self.ddl.split()[0]])[0]
        part = f"{self.hashed.format(column=column)} % {self.reads}"
        return [f"{part} = {i}" + (f" OR {column} IS NULL" if i == 0 else "") for i in range(self.reads)]

    def create_sql(self) -> str:
        kinds = {"STRING": "TEXT", "DOUBLE": "DOUBLE PRECISION", "TIMESTAMP_NTZ": "TIMESTAMP", "INT": "INTEGER"}
        columns = []
        for part in self.ddl.split(", "):
            name, kind = part.split(" ", 1)
            columns.append(f"{name} {'TEXT' if kind.startswith('ARRAY') else kinds.get(kind, kind)}")
        return f"CREATE TABLE IF NOT EXISTS {self.name} ({', '.join(columns)})"

    def create(self, spark: SparkSession) -> None:
        """Run the definition through the driver's JDBC connection, if the table is to be created here."""
        if not self.creates:
            return
        jvm = spark.sparkContext._jvm
        properties = jvm.java.util.Properties()
        for k, v in self.properties.items():
            properties.setProperty(k, str(v))
        connection = jvm.java.sql.DriverManager.getConnection(self.url, properties)
        try:
            connection.createStatement().execute(self.create_sql())
        finally:
            connection.close()

    def read(self, spark: SparkSession, columns: Sequence[str] | None = None) -> DataFrame:
        if self.reads == 1:
            return spark.read.format("jdbc").options(**self.options(columns)).load()
        source = self.options(columns)["dbtable"]
        given = {k: str(v) for k, v in self.properties.items()}
        return spark.read.jdbc(self.url, source, predicates=self.predicates(columns), properties=given)

    def append(self, df: DataFrame) -> None:
        aligned(df, self.ddl).write.jdbc(self.url, self.name, mode="append", properties=self.properties)


def aligned(df: DataFrame, ddl: str) -> DataFrame:
    """Columns in the order and types of a table definition. A value that does not fit fails the append."""
    return schemas.enforce(df, schemas.target_schema(ddl), misfit="error")
