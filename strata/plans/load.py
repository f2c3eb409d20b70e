"""The step all loads share: rows that are new to a table and pass the null gate, stored once whatever breaks off."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from strata.operators.gate import GatePolicy, GateResult, NullStats, null_gate
from strata.operators.incremental import drop_existing, known_keys, new_row_stats
from strata.sources.files import write_parquet
from strata.sources.tables import aligned
from strata.staging import Staging, delete_path, path_exists, shared_dir


def gated_new_rows(
    df: DataFrame,
    table,
    keys: Sequence[str],
    staging: Staging,
    label: str,
    policy: GatePolicy,
    count_cols: Sequence[str] | None = None,
    salts: int | None = 1,
) -> GateResult:
    """Rows of ``df`` whose key is not in ``table``, gated. Only the gate's counts run here.

    The stored keys are staged: both steps see the same ones. The gate counts rows per key, and whole rows are shuffled
    once, on their way out; adaptive execution broadcasts the keys instead where their bytes are few.
    """
    known = staging.put(known_keys(table.read(df.sparkSession, keys), keys), label)
    stats = new_row_stats(df, known, keys, count_cols)
    new = drop_existing(df, known, keys, salts, distinct=True)
    return null_gate(new, count_cols, policy=policy, stats=stats)


class Run:
    """What one load has decided to append, kept under its id until it is stored.

    New rows and gate counts are worked out once and written before the first append. A run repeated under its id takes them
    from there and appends what the tables lack, so rows that a broken append has left behind are neither doubled nor
    taken for rows of earlier runs. Without an id a run is one of its own.
    """

    def __init__(self, spark: SparkSession, run_id: str | None, rejects: str | None = None):
        self.spark, self.rejects = spark, rejects
        self.root = f"{shared_dir(spark)}/runs/{run_id or uuid.uuid4().hex}"
        self.repeated = path_exists(spark, f"{self.root}/decided")

    def decide(self, parts: dict[str, Callable[[Staging], GateResult]], tables: dict) -> dict[str, NullStats]:
        """Gate all parts before anything is appended, and keep what they let through."""
        if not self.repeated:
            with Staging(self.spark) as staging:
                results = {label: gate(staging) for label, gate in parts.items()}
                for label, result in results.items():
                    write_parquet(aligned(result.kept, tables[label].ddl), f"{self.root}/{label}")
                    if self.rejects:
                        write_parquet(result.rejected, f"{self.rejects}/{label}" if len(parts) > 1 else self.rejects)
                counts = [(label, r.stats.rate, r.stats.n_null, r.stats.n_rows) for label, r in results.items()]
                schema = "label string, rate double, n_null long, n_rows long"
                write_parquet(self.spark.createDataFrame(counts, schema).coalesce(1), f"{self.root}/decided")
        stored = self.spark.read.parquet(f"{self.root}/decided").collect()
        return {r.label: NullStats(r.rate, r.n_null, r.n_rows) for r in stored}

    def store(self, label: str, table) -> None:
        """Append the part's rows, those only that the table does not hold where the run is repeated."""
        rows = self.spark.read.parquet(f"{self.root}/{label}")
        if self.repeated:
            rows = rows.exceptAll(aligned(table.read(self.spark), table.ddl))
        table.append(rows)

    def close(self) -> None:
        delete_path(self.spark, self.root)
