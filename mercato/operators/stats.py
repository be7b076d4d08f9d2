"""Exact distributed quantiles (linear interpolation, as pandas/numpy).

``percentile`` keeps every value of a group in one aggregation buffer, so a
global percentile puts a whole column into one task.  Here equal values are
counted first (with map-side combine, so a value that most rows have is one row
per task), and the distinct values get the range of ranks they cover from a
running total.  Several columns are handled in ONE sort by unpivoting them into
``(column_name, value)``.  Where a stated error of rank will do, sketches take one pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sequence import running_total


def quantiles_by(long: DataFrame, keys: list[str], value: str, qs: list[float]) -> DataFrame:
    """Per ``keys`` group: columns ``q_0..`` = linear-interpolated quantiles of the
    non-null ``value``s (NULL for an empty group)."""
    vals = long.select(*keys, F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    counts = vals.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    ranked = running_total(vals.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c")), ["_v"], "_c", keys, out="_to")
    # a value covers the 1-based ranks (_to - _c, _to]; those wanted are floor(h)+1 and ceil(h)+1, h = (n-1)q
    targets = counts.select(*keys, *[(F.lit(q) * (F.col("_n") - 1)).alias(f"_h{i}")
                                     for i, q in enumerate(qs)])
    j = ranked.join(targets, keys, "inner") if keys else ranked.crossJoin(F.broadcast(targets))

    def covers(rank: F.Column) -> F.Column:
        return (rank <= F.col("_to")) & (rank > F.col("_to") - F.col("_c"))

    want = None
    for i, _ in enumerate(qs):
        h = F.col(f"_h{i}")
        c = covers(F.floor(h) + 1) | covers(F.ceil(h) + 1)
        want = c if want is None else (want | c)
    picks = []
    for i, _ in enumerate(qs):
        h = F.col(f"_h{i}")
        picks.append(F.max(F.when(covers(F.floor(h) + 1), F.col("_v"))).alias(f"_lo{i}"))
        picks.append(F.max(F.when(covers(F.ceil(h) + 1), F.col("_v"))).alias(f"_hi{i}"))
        picks.append(F.first(h).alias(f"_h{i}"))
    near = j.filter(want)
    agg = near.groupBy(*keys).agg(*picks) if keys else near.agg(*picks)
    out = []
    for i, _ in enumerate(qs):
        h = F.col(f"_h{i}")
        out.append((F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * (h - F.floor(h)))
                   .alias(f"q_{i}"))
    return agg.select(*keys, *out)


def exact_quantiles(df: DataFrame, column: str, qs: list[float]) -> DataFrame:
    """One row with ``q_<i>`` columns for a single column."""
    return quantiles_by(df.select(F.col(column).alias("_x")), [], "_x", qs)


def column_quantiles(df: DataFrame, cols: list[str], qs: list[float], accuracy: int | None = None) -> DataFrame:
    """Rows ``(column_name, q_0, ...)`` for several numeric columns, one sort in total.

    With ``accuracy`` the quantiles come from mergeable sketches instead, one a column, all filled in a single pass
    without a sort or shuffle of rows: a result is then a value of the column whose rank differs from the wanted one by at most
    rows / accuracy, and a sketch's size follows the accuracy, not the rows."""
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "column_name string")
    if accuracy and cols:
        sketched = df.agg(*[F.percentile_approx(F.col(c).cast("double"), list(qs), accuracy).alias(f"s{i}") for i, c in enumerate(cols)])
        each = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"s{i}").alias("q")) for i, c in enumerate(cols)]))
        return sketched.select(each.alias("v")).select("v.column_name", *[F.col("v.q")[i].alias(f"q_{i}") for i in range(len(qs))])
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]) \
        .unpivot([], cols, "column_name", "_val") if cols else None
    res = quantiles_by(long, ["column_name"], "_val", qs)
    return names.join(res, "column_name", "left")
