"""Names and values written into SQL expressions."""

from __future__ import annotations

import datetime


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v).upper()
    if isinstance(v, float):
        return f"double('{v}')"
    if isinstance(v, datetime.datetime):
        return f"timestamp_ntz'{v.isoformat(sep=' ')}'"
    if isinstance(v, datetime.date):
        return f"date'{v.isoformat()}'"
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(v)
