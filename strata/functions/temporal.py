from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The layouts yyyy-MM-dd and yyyy-MM-ddTHH:mm:ssZ, the latter with a literal T and Z. A cast is several
# times faster than parsing by a format but lenient, hence the check of the layout before it.
DAY_PATTERN = r"^(?!0000)\d{4}-\d{2}-\d{2}\z"
INSTANT_PATTERN = r"^(?!0000)\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z\z"


def to_day(c: Column) -> Column:
    """Full dates only: a year or a year and month alone give NULL."""
    text = c.cast("string")
    return F.when(text.rlike(DAY_PATTERN), text).try_cast("date")


def to_wall_clock(c: Column) -> Column:
    """``yyyy-MM-ddTHH:mm:ssZ`` to a zone-less timestamp with the same digits, whatever the session zone."""
    return F.when(c.rlike(INSTANT_PATTERN), F.substring(c, 1, 19)).try_cast("timestamp_ntz")
