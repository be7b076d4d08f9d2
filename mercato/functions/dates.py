"""Date/time expressions: fractional day differences, calendar parts, month keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import col_

_MICROS_PER_DAY = 86_400_000_000.0


def days_between(start, end) -> Column:
    """(end - start) in fractional days (seconds / 86400), NULL if either is NULL."""
    return F.timestamp_diff("MICROSECOND", col_(start), col_(end)) / F.lit(_MICROS_PER_DAY)


def month_key(ts) -> Column:
    """'YYYY-MM' of a timestamp (NULL stays NULL)."""
    return F.date_format(col_(ts), "yyyy-MM")


DATE_PARTS = {
    "year": F.year,
    "month": F.month,
    "day": F.dayofmonth,
    "weekday": F.weekday,       # Monday = 0
    "hour": F.hour,
    "quarter": F.quarter,
}


def with_date_parts(df, ts: str, parts=("year", "month", "day", "weekday", "hour", "quarter"),
                    prefix: str = "purchase_"):
    return df.withColumns({f"{prefix}{p}": DATE_PARTS[p](F.col(ts)) for p in parts})
