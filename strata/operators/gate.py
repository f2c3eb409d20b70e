"""The null-rate gate and the row metrics it rests on."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.sql import literal, quoted


class NullRateExceeded(RuntimeError):
    """Too many rows hold a NULL for them to be dropped silently."""


@dataclass(frozen=True)
class NullStats:
    rate: float
    n_null: int
    n_rows: int


@dataclass(frozen=True)
class GatePolicy:
    """Rows with NULLs are dropped below ``max_rate``, or when there are at most ``few``. Otherwise ``on_exceed``:

    ``error`` raises, ``keep`` passes every row on, ``quarantine`` drops the rows and hands them over as rejected.
    """

    max_rate: float = 0.1
    few: int = 10
    on_exceed: str = "error"

    def __post_init__(self):
        if self.on_exceed not in ("error", "keep", "quarantine"):
            raise ValueError(f"unknown on_exceed {self.on_exceed!r}")

    def passes(self, stats: NullStats) -> bool:
        return stats.rate < self.max_rate or stats.n_null <= self.few

    def drops(self, stats: NullStats) -> bool:
        """Whether rows with NULLs leave the result; raises when the policy says so."""
        if self.passes(stats):
            return True
        if self.on_exceed == "error":
            raise NullRateExceeded(f"{stats.n_null} of {stats.n_rows} rows ({stats.rate:.2%}) hold a NULL")
        return self.on_exceed == "quarantine"


@dataclass(frozen=True)
class GateResult:
    """The rows to go on with, the counts, and where the rows that were dropped can be read from, if any were."""

    kept: DataFrame
    stats: NullStats
    source: DataFrame
    dropped: Sequence[str] | None

    @property
    def rejected(self) -> DataFrame:
        """The dropped rows, whole."""
        if self.dropped is None:
            return self.source.limit(0)
        return self.source.filter(incomplete(self.source, self.dropped))


def any_null(cols: str | Sequence[str]) -> Column:
    """True when one of the columns is NULL. NaN is a value here."""
    names = [cols] if isinstance(cols, str) else list(cols)
    return F.expr(" OR ".join(f"{quoted(n)} IS NULL" for n in names))


def incomplete(df: DataFrame, cols: Sequence[str] | None = None) -> Column:
    """True when one of the columns is NULL or NaN: the rows that ``dropna`` removes."""
    floating = {f.name for f in df.schema if f.dataType.typeName() in ("double", "float")}
    names = list(cols or df.columns)
    tests = [f"{quoted(n)} IS NULL" for n in names] + [f"isnan({quoted(n)})" for n in names if n in floating]
    return F.expr(" OR ".join(tests))


def with_rate(counted: DataFrame) -> DataFrame:
    """``rate, n_null, n_rows`` from counts of rows with a NULL and of all rows; no rows at all give rate 0."""
    rate = F.when(F.col("n_rows") > 0, F.col("n_null") / F.col("n_rows")).otherwise(F.lit(0.0))
    return counted.select(rate.alias("rate"), "n_null", "n_rows")


def null_stats(df: DataFrame, cols: str | Sequence[str] | None = None) -> DataFrame:
    """One row ``rate, n_null, n_rows`` from a single aggregate."""
    bad = any_null(cols or df.columns)
    return with_rate(df.agg(F.count_if(bad).alias("n_null"), F.count(F.lit(1)).alias("n_rows")))


def without(df: DataFrame, *names: str) -> list[str]:
    """The column list minus some names."""
    return [c for c in df.columns if c not in names]


def stats_of(counted: DataFrame) -> NullStats:
    """Run a statistics frame; it holds one row."""
    row = counted.first()
    return NullStats(row["rate"], row["n_null"], row["n_rows"])


def null_gate(
    df: DataFrame,
    count_cols: Sequence[str] | None = None,
    drop_cols: Sequence[str] | None = None,
    policy: GatePolicy = GatePolicy(),
    stats: DataFrame | None = None,
) -> GateResult:
    """Count rows with a NULL in ``count_cols``; when the policy allows, drop rows incomplete in ``drop_cols``.

    Runs one aggregate; the returned rows are lazy. ``stats`` replaces that aggregate where the same counts are to be
    had for less, such as after an anti-join: see :func:`strata.operators.incremental.new_row_stats`.
    """
    found = stats_of(null_stats(df, count_cols) if stats is None else stats)
    if not policy.drops(found):
        return GateResult(df, found, df, None)
    return GateResult(df.dropna(subset=drop_cols), found, df, drop_cols or df.columns)


def duplicates(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Value combinations that occur more than once, with their count. Counts combine before the shuffle."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def profile(df: DataFrame, distinct: bool = False) -> DataFrame:
    """One row per column: position, name, type, rows, nulls and, on request, the approximate distinct count.

    A single aggregate over the input, whatever the number of columns.
    """
    aggs, lines = ["count(1) AS rows"], []
    for i, f in enumerate(df.schema):
        name, kind = literal(f.name), literal(f.dataType.simpleString())
        aggs.append(f"count_if({quoted(f.name)} IS NULL) AS n{i}")
        line = f"'position', {i}, 'column_name', {name}, 'column_type', {kind}, 'rows', rows, 'nulls', n{i}"
        if distinct:
            aggs.append(f"approx_count_distinct({quoted(f.name)}) AS d{i}")
            line += f", 'approx_distinct', d{i}"
        lines.append(f"named_struct({line})")
    return df.agg(*map(F.expr, aggs)).selectExpr(f"inline(array({', '.join(lines)}))")
