"""Small Column helpers shared by the jobs (null, rounding and mode semantics)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def modal(c: str | Column) -> Column:
    """Most frequent non-null value; ties resolve to the smallest value; all-null -> NULL.

    ``mode(col, deterministic=True)`` is a partial aggregate whose buffer holds one
    counter per *distinct* value of the group, never the group's rows.
    """
    return F.mode(col_(c), True)


def sum0(c: str | Column) -> Column:
    """Group sum where an empty / all-null group sums to 0 (pandas semantics)."""
    return F.coalesce(F.sum(col_(c)), F.lit(0).cast("double"))


def flag(cond: Column) -> Column:
    """Boolean condition as 0/1 int; NULL comparisons count as False."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def latest_non_null(value: str | Column, *order: str | Column) -> Column:
    """Value of the row with the greatest ``order`` tuple among rows where value is not null.

    ``max_by`` skips rows whose ordering is NULL, so masking the ordering struct
    with ``when(value IS NOT NULL)`` gives pandas' per-column skip-null 'last'.
    A NULL inside the struct (missing timestamp) sorts lowest, like
    ``sort_values(na_position='first')``.
    """
    v = col_(value)
    return F.max_by(v, F.when(v.isNotNull(), F.struct(*[col_(o) for o in order])))


def fround(c: str | Column, digits: int) -> Column:
    """Round a double as ``round(x * 10^d) / 10^d`` (half away from zero on the
    binary value).  Spark's ``round(double, d)`` rounds the shortest decimal text
    instead, so the two disagree on values such as 16.6503125; this form is the
    common one of numpy-style tools and SQL engines."""
    scale = float(10 ** digits)
    return F.round(col_(c) * F.lit(scale)) / F.lit(scale)


def round_clean(c: str | Column, digits: int) -> Column:
    """``fround`` to ``digits + 3`` then to ``digits``: the first step absorbs the
    last-bit noise of floating sums, so a value that is exactly on a half of the
    last kept digit rounds the same way whatever the summation order."""
    return fround(fround(c, digits + 3), digits)


def round_doubles(df, digits: int = 6):
    """Round every double column (presentation of floating aggregates).

    Rounds to ``digits + 3`` first: that absorbs the last-bit noise of sums taken
    in different orders, so a mean that is exactly on a half of the last kept
    digit rounds the same way whatever the summation order."""
    out = []
    for f in df.schema.fields:
        if f.dataType.typeName() == "double":
            out.append(round_clean(F.col(f.name), digits).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)
