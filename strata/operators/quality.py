"""Declarative data-quality suites, evaluated in one aggregate."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import schemas
from strata.functions.numeric import MODES, PITCHES
from strata.operators.incremental import keep_existing
from strata.sql import literal, quoted
from strata.staging import open_store

# Rule names of the stored suite format.
ORDERED_COLUMNS = "expect_table_columns_to_match_ordered_list"
NOT_NULL = "expect_column_values_to_not_be_null"
OF_TYPE = "expect_column_values_to_be_of_type"
BETWEEN = "expect_column_values_to_be_between"
IN_SET = "expect_column_values_to_be_in_set"
UNIQUE = "expect_column_values_to_be_unique"
COMPOUND_UNIQUE = "expect_compound_columns_to_be_unique"
DIFFER_IN_RECORD = "expect_select_column_values_to_be_unique_within_record"
MAX_BETWEEN = "expect_column_max_to_be_between"
LENGTHS = "expect_column_value_lengths_to_be_between"

# What each rule understands; anything else in a suite would change its meaning and is refused.
RULE_KWARGS = {
    ORDERED_COLUMNS: {"column_list"},
    NOT_NULL: {"column"},
    OF_TYPE: {"column", "type_"},
    BETWEEN: {"column", "min_value", "max_value"},
    IN_SET: {"column", "value_set"},
    UNIQUE: {"column"},
    COMPOUND_UNIQUE: {"column_list"},
    DIFFER_IN_RECORD: {"column_list"},
    MAX_BETWEEN: {"column", "min_value", "max_value"},
    LENGTHS: {"column", "min_value", "max_value"},
}
# Results are always complete, so the requested result format makes no difference.
IGNORED_KWARGS = {"result_format"}

TYPE_FAMILIES = {
    "int": (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    "float": (T.FloatType, T.DoubleType),
    "bool": (T.BooleanType,),
    "str": (T.StringType,),
    "date": (T.DateType,),
    "timestamp": (T.TimestampType, T.TimestampNTZType),
}

RESULT_COLUMNS = [
    "rule_no", "expectation", "column_name", "success", "element_count", "missing_count", "unexpected_count",
    "unexpected_percent", "observed",
]


@dataclass(frozen=True)
class Rule:
    type: str
    kwargs: dict
    meta: dict = field(default_factory=dict)

    def __post_init__(self):
        if self.type not in RULE_KWARGS:
            raise ValueError(f"unknown rule {self.type!r}")
        odd = set(self.kwargs) - RULE_KWARGS[self.type] - IGNORED_KWARGS
        if odd:
            raise ValueError(f"{self.type} does not take {sorted(odd)}")

    @property
    def columns(self) -> list[str]:
        if "column" in self.kwargs:
            return [self.kwargs["column"]]
        return list(self.kwargs.get("column_list", []))


@dataclass
class Suite:
    name: str
    rules: list[Rule] = field(default_factory=list)
    meta: dict = field(default_factory=dict)

    def expect(self, type: str, **kwargs) -> Suite:
        self.rules.append(Rule(type, kwargs))
        return self

    def bind(self, parameters: dict) -> Suite:
        """Fill in ``{"$PARAMETER": name}`` values that are only known when the suite runs."""

        def value(v):
            if isinstance(v, dict) and "$PARAMETER" in v:
                if v["$PARAMETER"] not in parameters:
                    raise ValueError(f"no value given for parameter {v['$PARAMETER']!r}")
                return parameters[v["$PARAMETER"]]
            return v

        rules = [Rule(r.type, {k: value(v) for k, v in r.kwargs.items()}, r.meta) for r in self.rules]
        return Suite(self.name, rules, self.meta)

    def to_json(self) -> str:
        rules = [{"type": r.type, "kwargs": r.kwargs, "meta": r.meta} for r in self.rules]
        return json.dumps({"name": self.name, "expectations": rules, "meta": self.meta}, indent=2)

    @staticmethod
    def from_json(text: str) -> Suite:
        doc = json.loads(text)
        rules = [Rule(r["type"], r["kwargs"], r.get("meta") or {}) for r in doc["expectations"]]
        return Suite(doc["name"], rules, doc.get("meta") or {})

    def save(self, path: str) -> None:
        """Add the suite file, or replace the one there; on any file system that :func:`open_store` reaches. Folders that lack are made."""
        fs, at = open_store(path)
        if folder := at.rpartition("/")[0]:
            fs.create_dir(folder, recursive=True)
        with fs.open_output_stream(at) as f:
            f.write(self.to_json().encode())

    @staticmethod
    def load(path: str) -> Suite:
        fs, at = open_store(path)
        with fs.open_input_stream(at) as f:
            return Suite.from_json(f.read().decode())


# --- rules as SQL conditions, so that a suite of any size becomes one short expression tree ---


def _missing(rule: Rule) -> str:
    return " AND ".join(f"{quoted(c)} IS NULL" for c in rule.columns)


def _outside(value: str, rule: Rule) -> str:
    low, high = rule.kwargs.get("min_value"), rule.kwargs.get("max_value")
    bounds = [f"{value} < {literal(low)}"] if low is not None else []
    bounds += [f"{value} > {literal(high)}"] if high is not None else []
    return f"({' OR '.join(bounds) or 'FALSE'})"


def _unexpected(rule: Rule, df: DataFrame) -> str | None:
    """True on unexpected rows, False or NULL on the others; None for a rule that does not look at single rows."""
    if rule.type == DIFFER_IN_RECORD:
        texts = ", ".join(f"CAST({quoted(c)} AS STRING)" for c in rule.columns)
        return f"size(array_distinct(array({texts}))) < {len(rule.columns)} AND NOT ({_missing(rule)})"
    if rule.type in (NOT_NULL, BETWEEN, IN_SET, LENGTHS):
        column = rule.columns[0]
        if rule.type == NOT_NULL:
            return _missing(rule)
        if rule.type == BETWEEN:
            return _outside(quoted(column), rule)
        if rule.type == IN_SET:
            return f"{quoted(column)} NOT IN ({', '.join(map(literal, rule.kwargs['value_set']))})"
        if isinstance(df.schema[column].dataType, T.ArrayType):
            return f"exists({quoted(column)}, x -> {_outside('length(x)', rule)})"
        return _outside(f"length({quoted(column)})", rule)
    return None


def _line(no: int, rule: Rule, success, counts=("NULL", "NULL", "NULL"), base="NULL", seen="NULL") -> str:
    """One result row as a struct, from SQL over the aggregated counts."""
    elements, missing, unexpected = counts
    percent = "NULL" if base == "NULL" else f"CASE WHEN {base} > 0 THEN {unexpected} * 100.0D / ({base}) ELSE 0.0D END"
    values = [
        str(no), literal(rule.type), literal(",".join(rule.columns)), success, f"CAST({elements} AS BIGINT)",
        f"CAST({missing} AS BIGINT)", f"CAST({unexpected} AS BIGINT)", f"CAST({percent} AS DOUBLE)",
        f"CAST({seen} AS STRING)",
    ]
    return "named_struct(" + ", ".join(f"'{n}', {v}" for n, v in zip(RESULT_COLUMNS, values)) + ")"


def _absent(rule: Rule, df: DataFrame) -> list[str]:
    return [c for c in rule.columns if c not in df.columns]


def _uniqueness(df: DataFrame, no: int, rule: Rule) -> DataFrame:
    """Every member of a duplicate group is unexpected; rows without any of the values are missing."""
    return _uniqueness_of(df.groupBy(*rule.columns).agg(F.count(F.lit(1)).alias("__n")), no, rule)


def _uniqueness_of(sizes: DataFrame, no: int, rule: Rule) -> DataFrame:
    """The result row from ``__n``, the rows of each combination of values."""
    none = _missing(rule)
    total = sizes.agg(
        F.expr("coalesce(sum(__n), 0) AS n"),
        F.expr(f"coalesce(sum(__n) FILTER (WHERE {none}), 0) AS m"),
        F.expr(f"coalesce(sum(__n) FILTER (WHERE __n > 1 AND NOT ({none})), 0) AS u"),
    )
    return total.selectExpr(f"inline(array({_line(no, rule, 'u = 0', ('n', 'm', 'u'), 'n - m')}))")


def validate(df: DataFrame, suite: Suite, parameters: dict | None = None) -> DataFrame:
    """One result row per rule, lazily.

    All row and maximum rules share one aggregate over the columns they name; each uniqueness rule adds one grouped
    count. The table is never collected.
    """
    suite = suite.bind(parameters or {})
    aggs = {"count(1)": "n"}
    lines, grouped = [], []
    for no, rule in enumerate(suite.rules, start=1):
        if rule.type == ORDERED_COLUMNS:
            seen = literal(",".join(df.columns))
            lines.append(_line(no, rule, literal(df.columns == rule.columns), seen=seen))
        elif _absent(rule, df):
            seen = literal(f"no column {','.join(_absent(rule, df))}")
            lines.append(_line(no, rule, "FALSE", seen=seen))
        elif rule.type == OF_TYPE:
            kind = df.schema[rule.columns[0]].dataType
            fits = isinstance(kind, TYPE_FAMILIES[rule.kwargs["type_"]])
            lines.append(_line(no, rule, literal(fits), seen=literal(kind.simpleString())))
        elif rule.type in (UNIQUE, COMPOUND_UNIQUE):
            grouped.append(_uniqueness(df, no, rule))
        elif rule.type == MAX_BETWEEN:
            top = aggs.setdefault(f"max({quoted(rule.columns[0])})", f"x{no}")
            fits = f"coalesce({top} IS NOT NULL AND NOT {_outside(top, rule)}, FALSE)"
            lines.append(_line(no, rule, fits, seen=top))
        else:
            m = aggs.setdefault(f"count_if({_missing(rule)})", f"m{no}")
            u = aggs.setdefault(f"count_if({_unexpected(rule, df)})", f"u{no}")
            base = "n" if rule.type == NOT_NULL else f"n - {m}"
            lines.append(_line(no, rule, f"{u} = 0", ("n", m, u), base))
    frames = []
    if lines:
        counted = df.agg(*[F.expr(f"{how} AS {name}") for how, name in aggs.items()])
        frames.append(counted.selectExpr(f"inline(array({', '.join(lines)}))"))
    return reduce(DataFrame.unionByName, frames + grouped)


def flag_rows(df: DataFrame, suite: Suite, parameters: dict | None = None) -> DataFrame:
    """Rows that break a row rule, whole, with the numbers of the rules they break in ``violations``.

    One pass for all rules. Uniqueness is a property of groups: see :func:`duplicate_rows`.
    """
    hits = []
    for no, rule in enumerate(suite.bind(parameters or {}).rules, start=1):
        if not _absent(rule, df):
            bad = _unexpected(rule, df)
            if bad:
                hits.append(f"CASE WHEN {bad} THEN {no} END")
    broken = f"array_compact(array({', '.join(hits)}))" if hits else "CAST(array() AS ARRAY<INT>)"
    return df.withColumn("violations", F.expr(broken)).filter("size(violations) > 0")


def unique_violations(df: DataFrame, suite: Suite, salts: int | None = 1) -> DataFrame:
    """Rows that break a uniqueness rule, whole, with the rule's number as ``rule_no``; a row may break several."""
    found = [
        duplicate_rows(df.dropna(subset=rule.columns, how="all"), rule.columns, salts).withColumn("rule_no", F.lit(no))
        for no, rule in enumerate(suite.rules, start=1)
        if rule.type in (UNIQUE, COMPOUND_UNIQUE) and not _absent(rule, df)
    ]
    empty = df.limit(0).withColumn("rule_no", F.lit(0))
    return reduce(DataFrame.unionByName, found, empty)


def duplicate_rows(df: DataFrame, cols: Sequence[str], salts: int | None = 1) -> DataFrame:
    """All members of all duplicate groups, whole. ``salts`` spreads a group that holds much of the table."""
    repeated = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1")
    return keep_existing(df, repeated, cols, salts)


def primary_key_suite(name: str, cols: Sequence[str]) -> Suite:
    """Not null in every key column, and unique together."""
    suite = Suite(name)
    for c in cols:
        suite.expect(NOT_NULL, column=c)
    if len(cols) == 1:
        return suite.expect(UNIQUE, column=cols[0])
    return suite.expect(COMPOUND_UNIQUE, column_list=list(cols))


def length_suite(name: str, ddl: str) -> Suite:
    """Text no longer than a table definition allows; in lists, every element."""
    suite = Suite(name)
    for column, n in schemas.length_limits(ddl).items():
        suite.expect(LENGTHS, column=column, max_value=n)
    return suite


def song_suite(max_year) -> Suite:
    """The checks on cleaned songs. ``max_year`` may be a number or a run-time parameter."""
    features = schemas.SONG_FEATURES_3 + schemas.SONG_FEATURES_4
    measured = [c for c in schemas.SONG_COLUMNS if c in features]
    suite = Suite("song_silver").expect(ORDERED_COLUMNS, column_list=schemas.SONG_COLUMNS)
    # Columns that reports read, and ids.
    needed = ["id", "album_id", *schemas.SONG_LISTS, *measured, "key"]
    for c in (c for c in schemas.SONG_COLUMNS if c in needed):
        suite.expect(NOT_NULL, column=c)
    for c in ["track_number", "disc_number", "duration_ms", "time_signature", "year"]:
        suite.expect(OF_TYPE, column=c, type_="int")
    for c in measured:
        suite.expect(OF_TYPE, column=c, type_="float")
    for c in (c for c in measured if c not in ("loudness", "tempo")):
        suite.expect(BETWEEN, column=c, min_value=0.0, max_value=1.0)
    suite.expect(OF_TYPE, column="explicit", type_="bool")
    suite.expect(IN_SET, column="mode", value_set=MODES)
    suite.expect(IN_SET, column="key", value_set=PITCHES)
    suite.expect(BETWEEN, column="year", min_value=1800, max_value=max_year)
    return suite.expect(UNIQUE, column="id")


def play_suite() -> Suite:
    """The checks on cleaned plays. Its column order puts ``ts`` first, unlike the cleaning job's output."""
    order = ["ts", "id", *[c for c in schemas.PLAY_COLUMNS if c not in ("ts", "id")]]
    suite = Suite("play_gold").expect(ORDERED_COLUMNS, column_list=order)
    suite.expect(DIFFER_IN_RECORD, column_list=order)
    for c in ["ts", "id", "seconds_played", "track_name", "album_artist_name"]:
        suite.expect(NOT_NULL, column=c)
    return suite.expect(BETWEEN, column="seconds_played", min_value=0)
