"""Profiles that add up: sketches of each column, stored for each load and merged later without a scan of the data.

Distinct counts come from HyperLogLog, quantiles from KLL, frequent values from a frequent-items sketch, all of them Spark's own
aggregates. A sketch has a bounded size whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sources.files import named
from strata.sql import quoted
from strata.staging import path_exists

#: log2 of the registers of a distinct count, the size of a quantile sketch, and values that a frequent-items sketch tracks.
REGISTERS, QUANTILES, TRACKED = 14, 400, 2048
#: Error bounds that go with them: relative for distinct counts (about three deviations), of the rank for quantiles.
DISTINCT_ERROR, RANK_ERROR = 0.03, 0.01


def _number(name: str) -> Column:
    value = named(name).cast("double")
    return F.when(~F.isnan(value), value)


def sketched(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: position, name, type, rows, nulls, and its sketches, by one aggregate over the input.

    Quantiles are of numeric columns only, without NaN; values are counted by their text. NULL is in ``nulls`` alone. An empty
    input gives rows with zero counts.
    """
    fields = [f for f in df.schema if columns is None or f.name in columns]
    aggs, lines = [F.count(F.lit(1)).alias("rows")], []
    for i, f in enumerate(fields):
        # Distinct counts pass over empty text, and frequent items count NULL.
        text = F.concat(F.lit("="), named(f.name).cast("string"))
        aggs += [F.count_if(named(f.name).isNull()).alias(f"n{i}"), F.hll_sketch_agg(text, REGISTERS).alias(f"d{i}")]
        column = quoted(f.name)
        top = f"approx_top_k_accumulate(string({column}), {TRACKED}) FILTER (WHERE {column} IS NOT NULL)"
        aggs.append(F.expr(top).alias(f"t{i}"))
        quantiles = F.lit(None).cast("binary")
        if isinstance(f.dataType, T.NumericType):
            aggs.append(F.call_function("kll_sketch_agg_double", _number(f.name), F.lit(QUANTILES)).alias(f"q{i}"))
            quantiles = F.col(f"q{i}")
        told = {"position": F.lit(i), "column_name": F.lit(f.name), "column_type": F.lit(f.dataType.simpleString())}
        told |= {"rows": F.col("rows"), "nulls": F.col(f"n{i}"), "distinct": F.col(f"d{i}"), "quantiles": quantiles, "top": F.col(f"t{i}")}
        lines.append(F.struct(*[c.alias(n) for n, c in told.items()]))
    return df.agg(*aggs).select(F.inline(F.array(*lines)))


class ProfileStore:
    """The sketches of a table's loads in a folder, a sub-folder for each load."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def add(self, df: DataFrame, run_id: str, columns: Sequence[str] | None = None) -> None:
        """Scan a load once and keep its sketches; repeated under its ``run_id`` it replaces its own."""
        sketched(df, columns).coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/run_id={run_id}")

    def merged(self) -> DataFrame:
        """One row per column over all loads, as :func:`sketched` of them together would be within the sketches' errors.

        Loads may have different columns; a column's type is that of most bytes of text, where loads differ.
        """
        if not path_exists(self.spark, self.folder):
            raise FileNotFoundError(f"no profile in {self.folder}")
        stored = self.spark.read.parquet(self.folder)
        return stored.groupBy("column_name").agg(
            F.min("position").alias("position"),
            F.max("column_type").alias("column_type"),
            F.sum("rows").alias("rows"),
            F.sum("nulls").alias("nulls"),
            F.hll_union_agg("distinct").alias("distinct"),
            F.call_function("kll_merge_agg_double", "quantiles").alias("quantiles"),
            F.call_function("approx_top_k_combine", F.col("top"), F.lit(TRACKED)).alias("top"),
        )

    def report(self, at: Sequence[float] = (0.01, 0.25, 0.5, 0.75, 0.99), k: int = 5) -> DataFrame:
        """column_name, column_type, rows, nulls, approx_distinct, the quantiles at ``at`` (NULL where there are none), and the ``k``
        most frequent values with their counts."""
        merged = self.merged()
        some = F.coalesce(F.call_function("kll_sketch_get_n_double", F.col("quantiles")), F.lit(0)) > 0
        ranks = F.array(*[F.lit(float(q)) for q in at])
        return merged.orderBy("position", "column_name").select(
            "column_name",
            "column_type",
            "rows",
            "nulls",
            F.hll_sketch_estimate("distinct").alias("approx_distinct"),
            F.when(some, F.call_function("kll_sketch_get_quantile_double", F.col("quantiles"), ranks)).alias("quantiles"),
            F.call_function("approx_top_k_estimate", F.col("top"), F.lit(k)).alias("top"),
        )
