"""Quality suites brought up to date: what a load adds is scanned once, results of all loads come from stored counts."""

from __future__ import annotations

import json
import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import quality
from strata.operators.quality import Rule, Suite
from strata.sql import literal, quoted
from strata.staging import path_exists

_GROUPED = (quality.UNIQUE, quality.COMPOUND_UNIQUE)


class SuiteStates:
    """The states of a suite's rules in a folder, one for each load, which add up to the suite's result over all loads.

    A load's state is one row of counts and extremes, and for each uniqueness rule the load's distinct keys with their counts. Adding a
    load scans that load alone; the result reads the states and never a load's rows. Columns keep one type over all loads. The rules
    are part of what is stored: a folder belongs to one suite.
    """

    def __init__(self, root: str, suite: Suite, parameters: dict | None = None):
        self.root, self.suite = root.rstrip("/"), suite.bind(parameters or {})

    @property
    def _rules(self) -> list[tuple[int, Rule]]:
        return list(enumerate(self.suite.rules, start=1))

    def add(self, df: DataFrame, load: str) -> None:
        """Store the state of a load's rows. The same name again replaces that load; one that broke off does not count."""
        if not re.fullmatch(r"[A-Za-z0-9][\w.-]*", load):
            raise ValueError(f"not a name of a load: {load!r}")
        self._refuse_other_suite(df.sparkSession)
        exprs = [F.count(F.lit(1)).alias("n"), F.lit(self._mark()).alias("suite")]
        for no, rule in self._rules:
            exprs += _state(df, no, rule)
            if rule.type in _GROUPED and not quality._absent(rule, df):
                keys = df.groupBy(*rule.columns).agg(F.count(F.lit(1)).alias("__n"))
                keys.write.mode("overwrite").parquet(f"{self.root}/keys/rule={no}/load={load}")
        # Written last: keys without this row belong to a load that broke off.
        df.agg(*exprs).write.mode("overwrite").parquet(f"{self.root}/counts/load={load}")

    def _mark(self) -> str:
        return json.dumps([[r.type, r.kwargs] for r in self.suite.rules], default=str)

    def _counts(self, spark: SparkSession) -> DataFrame | None:
        path = f"{self.root}/counts"
        if not path_exists(spark, path):
            return None
        return spark.read.option("mergeSchema", True).parquet(path).withColumn("load", F.col("load").cast("string"))

    def _refuse_other_suite(self, spark: SparkSession) -> None:
        counts = self._counts(spark)
        if counts is not None and counts.where(F.col("suite") != self._mark()).head(1):
            raise ValueError(f"{self.root} holds states of other rules")

    def result(self, spark: SparkSession) -> DataFrame:
        """One result row per rule, as :func:`strata.operators.quality.validate` gives it over the rows of all loads.

        A rule on a table's columns or types holds if it does in every load; ``observed`` is that of the first load, by name, that
        breaks it. So it is for a column that a load lacks: its rule fails, with the counts of the loads that have it.
        """
        self._refuse_other_suite(spark)
        counts = self._counts(spark)
        if counts is None:
            raise FileNotFoundError(f"no states in {self.root}")
        has = set(counts.columns)
        aggs, lines, frames = [F.sum("n").alias("n")], [], []
        for no, rule in self._rules:
            ok, seen = F.col(f"ok{no}"), F.col(f"seen{no}")
            aggs += [F.bool_and(ok).alias(ok_ := f"ok{no}"), F.min_by(seen, F.struct(ok, "load")).alias(seen_ := f"seen{no}")]
            aggs += [F.sum(c).alias(c) for c in (f"m{no}", f"u{no}") if c in has]
            aggs += [F.max(c).alias(c) for c in (f"x{no}",) if c in has]
            known = f"keys/rule={no}"
            if rule.type in _GROUPED and path_exists(spark, f"{self.root}/{known}"):
                frames.append(self._uniqueness(spark, counts, no, rule))
            elif f"x{no}" in has:
                fits = f"coalesce({ok_} AND x{no} IS NOT NULL AND NOT {quality._outside(f'x{no}', rule)}, FALSE)"
                lines.append(quality._line(no, rule, fits, seen=f"coalesce({seen_}, CAST(x{no} AS STRING))"))
            elif f"u{no}" in has:
                m, u = f"coalesce(m{no}, 0)", f"coalesce(u{no}, 0)"
                base = "n" if rule.type == quality.NOT_NULL else f"n - {m}"
                lines.append(quality._line(no, rule, f"{ok_} AND {u} = 0", ("n", m, u), base, seen_))
            else:
                lines.append(quality._line(no, rule, ok_, seen=seen_))
        if lines:
            frames.append(counts.agg(*aggs).selectExpr(f"inline(array({', '.join(lines)}))"))
        return reduce(DataFrame.unionByName, frames)

    def _uniqueness(self, spark: SparkSession, counts: DataFrame, no: int, rule: Rule) -> DataFrame:
        path = f"{self.root}/keys/rule={no}"
        keys = spark.read.parquet(path).withColumn("load", F.col("load").cast("string"))
        whole = counts.where(f"ok{no}").select("load")
        sizes = keys.join(whole, "load", "left_semi").groupBy(*rule.columns).agg(F.sum("__n").alias("__n"))
        found = quality._uniqueness_of(sizes, no, rule)
        lacking = counts.where(f"NOT ok{no}").agg(F.min_by(f"seen{no}", "load").alias("lacking"))
        both = found.join(lacking)  # one row each
        return both.withColumn("success", F.expr("success AND lacking IS NULL")).withColumn("observed", F.col("lacking")).drop("lacking")


def _state(df: DataFrame, no: int, rule: Rule) -> list:
    """A rule's part of the row: ``ok`` and ``seen`` for what the schema tells, counts ``m`` and ``u``, a maximum ``x``."""
    ok, seen, counts = True, None, []
    absent = quality._absent(rule, df)
    if rule.type == quality.ORDERED_COLUMNS:
        ok, seen = df.columns == rule.columns, ",".join(df.columns)
    elif absent:
        ok, seen = False, f"no column {','.join(absent)}"
    elif rule.type == quality.OF_TYPE:
        kind = df.schema[rule.columns[0]].dataType
        ok, seen = isinstance(kind, quality.TYPE_FAMILIES[rule.kwargs["type_"]]), kind.simpleString()
    elif rule.type == quality.MAX_BETWEEN:
        counts = [F.expr(f"max({quoted(rule.columns[0])}) AS x{no}")]
    elif rule.type not in _GROUPED:
        counts = [F.expr(f"count_if({quality._missing(rule)}) AS m{no}"), F.expr(f"count_if({quality._unexpected(rule, df)}) AS u{no}")]
    return [F.expr(f"{literal(ok)} AS ok{no}"), F.lit(seen).cast("string").alias(f"seen{no}"), *counts]
