"""The key at a given position of an ordering, by refining a histogram.

Nothing is sorted or written.  A round counts the rows of at most ``BUCKETS`` ranges of the first
undecided key column, per group, in one pass with partial aggregation; a running count over the
ranges tells which one holds the position, and the next round looks at its rows alone.  Once few
rows are left their keys are fetched in order.  Numbers, dates and times are cut into equal
ranges, texts by their next letters.  What reaches the driver is bounded by BUCKETS and ``FEW``
times the number of groups, which is checked.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 2048
FEW = 2000
LETTERS = 3                        # of a text that a round adds
MAX_GROUPS = 1000


@dataclass
class _Place:
    """Where a group's position is known to be: rows equal to ``fixed``, and in a range of the next column."""

    left: int                                        # 1-based position among the rows in reach
    rows: int                                        # rows in reach
    fixed: list = field(default_factory=list)        # values of the columns that are decided, as ``_numeric`` has them
    low: object = None                               # range of the next column: numbers, or a text's first letters
    high: object = None
    cut: tuple | None = None


def _numeric(df: DataFrame, name: str) -> Column | None:
    """The column as a number that sorts like it; None for texts."""
    kind = df.schema[name].dataType.typeName()
    c = F.col(name)
    if kind in ("timestamp_ntz", "timestamp"):
        return F.unix_micros(c.cast("timestamp"))
    if kind == "date":
        return F.unix_date(c).cast("long")
    if kind in ("byte", "short", "integer", "long", "boolean"):
        return c.cast("long")
    if kind == "string":
        return None
    raise TypeError(f"cannot cut {name}, a {kind}, into ranges")


def _same(df: DataFrame, names: list[str], values: list) -> Column:
    """True where columns have these values, numbers and times in the form of ``_numeric``."""
    out = F.lit(True)
    for n, v in zip(names, values):
        number = _numeric(df, n)
        out = out & (F.col(n) if number is None else number).eqNullSafe(F.lit(v))
    return out


def cutoffs(df: DataFrame, order_by: list[str], groups: list[str], position) -> list[tuple[tuple, tuple | None]]:
    """(group, key) for every group of ``df``: the ``order_by`` key of its row at the 1-based place ``position(rows)``,
    nulls first; None where that is 0.  Without groups there is one, of all rows."""
    keys = df.select(*groups, *order_by)
    counts = keys.groupBy(*groups).count().limit(MAX_GROUPS + 1).collect() if groups else [(keys.count(),)]
    if len(counts) > MAX_GROUPS:
        raise ValueError(f"more than {MAX_GROUPS} values of {groups}")
    at = {tuple(r)[:-1]: _Place(position(r[-1]), r[-1]) for r in counts}
    while open_ := {g: p for g, p in at.items() if p.left > 0 and p.cut is None}:
        if all(p.rows <= FEW for p in open_.values()) or all(len(p.fixed) == len(order_by) for p in open_.values()):
            _finish(keys, order_by, groups, open_)
        else:
            _refine(keys, order_by, groups, {g: p for g, p in open_.items() if p.rows > FEW and len(p.fixed) < len(order_by)})
    return [(g, p.cut) for g, p in at.items()]


def _reach(keys: DataFrame, order_by: list[str], groups: list[str], g: tuple, p: _Place) -> Column:
    out = _same(keys, order_by, p.fixed)
    for name, value in zip(groups, g):
        out = out & F.col(name).eqNullSafe(F.lit(value))
    if p.low is not None:
        name = order_by[len(p.fixed)]
        number = _numeric(keys, name)
        out = out & (F.col(name).startswith(p.low) if number is None else number.between(p.low, p.high))
    return out


def _finish(keys: DataFrame, order_by: list[str], groups: list[str], places: dict) -> None:
    """Fetches the keys in reach, FEW a group at most or all alike, and takes those at their places."""
    for g, p in places.items():
        if len(p.fixed) == len(order_by):                 # copies of one key
            p.cut = tuple(_value(keys, c, v) for c, v in zip(order_by, p.fixed))
            continue
        own = keys.filter(_reach(keys, order_by, groups, g, p)).select(*order_by)
        rows = own.orderBy(*[F.col(c).asc_nulls_first() for c in order_by]).limit(p.left).collect()
        p.cut = tuple(rows[-1])


def _refine(keys: DataFrame, order_by: list[str], groups: list[str], places: dict) -> None:
    """One round for every group: ranges of the first undecided column, their counts, and the one that holds the place."""
    which, reach = F.lit(None).cast("int"), F.lit(False)
    ordered = list(places.items())
    inside = [_reach(keys, order_by, groups, g, p) for g, p in ordered]
    for k, near in enumerate(inside):
        reach, which = reach | near, F.when(near, F.lit(k)).otherwise(which)
    rows = keys.filter(reach).withColumn("_g", which)
    # bounds of numbers that have none yet
    spans = {}
    for k, (g, p) in enumerate(ordered):
        name = order_by[len(p.fixed)]
        if p.low is None and (number := _numeric(keys, name)) is not None:
            mine = F.when(F.col("_g") == k, number)
            spans[k] = (F.min(mine), F.max(mine))
    if spans:
        got = rows.agg(*[e.alias(f"{side}{k}") for k, (a, b) in spans.items() for side, e in (("a", a), ("b", b))]).first()
        for k in spans:
            ordered[k][1].low, ordered[k][1].high = got[f"a{k}"], got[f"b{k}"]
    bucket = F.lit(None).cast("string")
    for k, (g, p) in enumerate(ordered):
        name = order_by[len(p.fixed)]
        number = _numeric(keys, name)
        if number is None:
            own = F.substring(F.col(name), 1, len(p.low or "") + LETTERS)
        elif p.low is None:                               # nulls alone
            own = F.lit(None).cast("string")
        else:
            width = (p.high - p.low) // BUCKETS + 1
            wide = "decimal(20,0)" if p.high - p.low >= 1 << 62 else "long"      # a difference that a long may not hold
            own = F.call_function("div", number.cast(wide) - F.lit(p.low).cast(wide), F.lit(width).cast(wide)).cast("string")
        bucket = F.when(F.col("_g") == k, own).otherwise(bucket)
    counts: dict[int, list] = {}
    for k, b, n in rows.groupBy("_g", bucket.alias("_b")).count().collect():
        counts.setdefault(k, []).append((b, n))
    for k, (g, p) in enumerate(ordered):
        name = order_by[len(p.fixed)]
        text = _numeric(keys, name) is None
        own = sorted(counts[k], key=lambda x: (x[0] is not None, (x[0].encode() if text else int(x[0])) if x[0] is not None else 0))
        for b, n in own:
            if p.left <= n:
                break
            p.left -= n
        p.rows = n
        if b is None:                                     # all null: the next column decides
            p.fixed, p.low, p.high = [*p.fixed, None], None, None
        elif text:
            # a text shorter than its bucket's letters is that text; else those that begin so go on
            if len(b) < len(p.low or "") + LETTERS:
                p.fixed, p.low = [*p.fixed, b], None
            else:
                p.low = b
        else:
            width = (p.high - p.low) // BUCKETS + 1
            p.low, p.high = p.low + int(b) * width, min(p.high, p.low + (int(b) + 1) * width - 1)
            if width == 1:
                p.fixed, p.low, p.high = [*p.fixed, p.low], None, None


def _value(keys: DataFrame, name: str, number):
    """A decided value as its column has it."""
    kind = keys.schema[name].dataType.typeName()
    if number is None or kind == "string":
        return number
    if kind == "timestamp_ntz":
        return dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=number)
    if kind == "timestamp":
        return dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(microseconds=number)
    if kind == "date":
        return dt.date(1970, 1, 1) + dt.timedelta(days=number)
    return bool(number) if kind == "boolean" else number
