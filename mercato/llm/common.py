"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

# fixed values: the white space that separates words (space, tab to carriage return)
SPACE_CLASS = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\f\r"


def pinned(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder (survives lost executors)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def trimmed(text: Column) -> Column:
    return F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))


def words(text: Column) -> Column:
    """The words of a text as an array; none for null or blank texts."""
    t = trimmed(text)
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, SPACE_CLASS))


def n_words(text: Column) -> Column:
    t = trimmed(text)
    return F.when(t == "", F.lit(0)).otherwise(F.size(F.split(t, SPACE_CLASS))).cast("long")


def rows_with(docs: DataFrame, keys: DataFrame, named: dict[str, Column]) -> DataFrame:
    """The rows of ``docs`` (see ``boxed``) whose ``named`` values are a row of ``keys``."""
    match = F.lit(True)
    for k, (name, value) in enumerate(named.items()):
        match = match & value.eqNullSafe(F.col(f"_key_{k}_"))
    keys = keys.select(*[F.col(name).alias(f"_key_{k}_") for k, name in enumerate(named)])
    return docs.join(keys, match, "left_semi")


def boxed(docs: DataFrame, needed: list[str]) -> tuple[DataFrame, list[Column]]:
    """``docs`` with its columns renamed apart and the ``needed`` ones under their own names too, so that names used
    inside an operator clash with none of its columns; and the columns as they were, to be selected at the end."""
    place = {c: i for i, c in enumerate(docs.columns)}
    inner = docs.toDF(*[f"in_{i}" for i in range(len(docs.columns))]).withColumns({c: F.col(f"in_{place[c]}") for c in needed})
    return inner, [F.col(f"in_{i}").alias(c) for i, c in enumerate(docs.columns)]
