"""Train/test splits (W3, M6, M7) without a single-task global window."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .cutoff import cutoffs


def _le_struct(cols: list[str], bound: str) -> F.Column:
    """(cols...) <= bound struct, lexicographic; NULLs sort first (as in the ranking)."""
    row = F.struct(*[F.col(c) for c in cols])
    return F.when(F.col(bound).isNull(), F.lit(False)).otherwise(
        F.expr(f"struct({', '.join(f'`{c}`' for c in cols)}) <= `{bound}`")) if cols else F.lit(False)


def _cutoffs(df: DataFrame, order_by: list[str], group: list[str], position) -> DataFrame:
    """Per group: the ``order_by`` key ``_cut`` of the row at 1-based ``position(n)`` (NULL where that is 0), as a
    table of a row a group, whose number ``cutoffs`` bounds."""
    found = cutoffs(df, order_by, group, position)
    key = StructType([StructField(c, df.schema[c].dataType) for c in order_by])
    schema = StructType([StructField(c, df.schema[c].dataType) for c in group] + [StructField("_cut", key)])
    return df.sparkSession.createDataFrame([(*g, cut) for g, cut in found], schema)


def temporal_split(df: DataFrame, order_by: list[str], frac: float = 0.8, out: str = "split") -> DataFrame:
    """The first ``floor(frac * n)`` rows in ``order_by`` order (a total order)
    are 'train', the rest 'test'.  The key at that position is found from histograms
    of the key columns; the wide rows are then labelled by comparing with that
    one-row cutoff -- a narrow, broadcast filter.  No row is sorted or moved."""
    cut = _cutoffs(df, order_by, [], lambda n: math.floor(n * frac))
    j = df.crossJoin(F.broadcast(cut))                                  # one row
    return j.withColumn(out, F.when(_le_struct(order_by, "_cut"), "train").otherwise("test")).drop("_cut")


def split_hash(id_col: str, seed: int) -> F.Column:
    """Reproducible per-row pseudo-random key: md5 of 'seed:id' (hex text)."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


def stratified_split(df: DataFrame, id_col: str, label: str, test_frac: float = 0.2, seed: int = 42,
                     out: str = "split", keys: DataFrame | None = None) -> DataFrame:
    """M6: per label, the ``round(test_frac * n_label)`` rows with the smallest
    md5(seed:id) are 'test' -- exact class proportions, reproducible anywhere.  The cuts are found in some passes over the ids
    and labels: ``keys`` gives them where they are cheaper to read than ``df`` (the same rows)."""
    hashed = lambda rows: rows.withColumn("_h", split_hash(id_col, seed))
    h = hashed(df)
    cut = _cutoffs(h if keys is None else hashed(keys.select(id_col, label)), ["_h", id_col], [label], lambda n: math.floor(n * test_frac + 0.5))
    cut = cut.withColumnRenamed(label, "_of")
    j = h.join(F.broadcast(cut), F.col(label).eqNullSafe(F.col("_of")), "left").drop("_of")     # at most MAX_GROUPS rows
    return j.withColumn(out, F.when(_le_struct(["_h", id_col], "_cut"), "test").otherwise("train")) \
        .drop("_h", "_cut")


def churn_split(df: DataFrame, label: str = "is_churn", order_by=("last_purchase_date", "customer_unique_id"),
                id_col: str = "customer_unique_id", frac: float = 0.8) -> DataFrame:
    """M7: temporal split; when the train slice holds one class only, fall back to
    the stratified split.  The decision reads one scalar (distinct train labels)."""
    t = temporal_split(df, list(order_by), frac)
    n_classes = t.filter(F.col("split") == "train").agg(F.countDistinct(label)).first()[0]
    if n_classes >= 2:
        return t
    return stratified_split(df, id_col, label, 1 - frac)
