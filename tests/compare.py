"""Compare a Spark result with the SQL result, as sets of rows with equal column names and types."""

from __future__ import annotations

import datetime
import glob
import math
import os
from collections import Counter

import duckdb

SPARK_TYPES = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP",
}


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW \"{name}\" AS SELECT * FROM '{path}'")
    return con


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return v


def difference(df, con, sql):
    """None when equal, otherwise a short text."""
    rel = con.sql(sql)
    want_types = dict(zip(rel.columns, map(str, rel.types)))
    got_types = {f.name: SPARK_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    if sorted(want_types) != sorted(got_types):
        return f"columns {sorted(got_types)} want {sorted(want_types)}"
    for c, t in want_types.items():
        if t != got_types[c]:
            return f"type of {c}: {got_types[c]} want {t}"
    order = sorted(want_types)
    want = Counter(tuple(_value(r[rel.columns.index(c)]) for c in order) for r in rel.fetchall())
    got = Counter(tuple(_value(r[c]) for c in order) for r in df.collect())
    if got == want:
        return None
    extra, lacking = got - want, want - got
    return (
        f"rows {sum(got.values())} want {sum(want.values())}; columns {order}; "
        f"extra {list(extra)[:2]}; lacking {list(lacking)[:2]}"
    )
