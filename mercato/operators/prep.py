"""Model-input preparation as table jobs.

Fitted state (medians, label maps, weights, scaler moments) is a small table
computed by an aggregate and applied by a join, so fitting and applying both run
on the executors; only constant-size results ever reach the driver.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sequence import exact_sequence, pin
from .stats import column_quantiles

UNKNOWN = "unknown"


def numeric_and_categorical(df: DataFrame, cols: list[str]) -> tuple[list[str], list[str]]:
    """Split feature columns by type (strings are categorical)."""
    cat = [c for c in cols if df.schema[c].dataType.typeName() == "string"]
    return [c for c in cols if c not in cat], cat


def fit_medians(df: DataFrame, cols: list[str], accuracy: int | None = None) -> DataFrame:
    """M1 fit: one row, one median per column: exact (one distributed sort), or sketched (see ``column_quantiles``)."""
    q = column_quantiles(df, cols, [0.5], accuracy)
    return pin(q.groupBy().pivot("column_name", cols).agg(F.first("q_0")), "medians")


def impute_median(df: DataFrame, cols: list[str], medians: DataFrame | None = None) -> DataFrame:
    """M1 apply: NULL numerics -> the fitted median (fit on ``df`` when not given)."""
    if not cols:
        return df
    medians = fit_medians(df, cols) if medians is None else medians
    m = medians.select(*[F.col(c).alias(f"_med_{c}") for c in cols])
    out = df.crossJoin(F.broadcast(m))          # one row
    return out.withColumns({c: F.coalesce(F.col(c).cast("double"), F.col(f"_med_{c}"))
                            for c in cols}).drop(*m.columns)


def fill_unknown(df: DataFrame, cols: list[str]) -> DataFrame:
    """M2: NULL categoricals -> 'unknown'."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(UNKNOWN)) for c in cols})


def fit_label_map(df: DataFrame, col: str) -> DataFrame:
    """M3 fit: ``(value, code)`` with codes 0..n-1 in sorted value order.  The
    distinct values are numbered with the distributed exact sequence (no
    single-task window even for a large vocabulary)."""
    vals = df.select(F.col(col).alias("value")).filter(F.col("value").isNotNull()).distinct()
    return pin(exact_sequence(vals, ["value"], out="code").withColumn("code", (F.col("code") - 1).cast("int")), "label_map")


def apply_label_map(df: DataFrame, col: str, mapping: DataFrame, out: str | None = None) -> DataFrame:
    """M3/J15 apply: value -> code, unseen or NULL -> -1."""
    out = out or col
    m = mapping.select(F.col("value").alias("_lm_value"), F.col("code").alias("_lm_code"))
    j = df.join(m, df[col] == m["_lm_value"], "left")
    return j.withColumn(out, F.coalesce(F.col("_lm_code"), F.lit(-1))).drop("_lm_value", "_lm_code")


def encode_categoricals(df: DataFrame, cols: list[str], maps: dict[str, DataFrame] | None = None
                        ) -> tuple[DataFrame, dict[str, DataFrame]]:
    maps = dict(maps or {})
    for c in cols:
        if c not in maps:
            maps[c] = fit_label_map(df, c)
        df = apply_label_map(df, c, maps[c])
    return df, maps


def pos_weight(df: DataFrame, label: str) -> DataFrame:
    """M4: one row ``pos_weight`` = negatives / positives (1.0 without positives)."""
    return df.agg(F.coalesce(F.try_divide(F.sum(F.when(F.col(label) == 0, 1).otherwise(0)).cast("double"),
                                          F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).cast("double")),
                             F.lit(1.0)).alias("pos_weight"))


def with_pos_weight(df: DataFrame, label: str, weight_col: str = "weight") -> DataFrame:
    w = pos_weight(df, label)
    return df.crossJoin(F.broadcast(w)).withColumn(
        weight_col, F.when(F.col(label) == 1, F.col("pos_weight")).otherwise(F.lit(1.0))).drop("pos_weight")


def balanced_weights(df: DataFrame, label: str) -> DataFrame:
    """M5: per class weight n / (k * n_class)."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_class"))
    tot = c.agg(F.sum("n_class").alias("n"), F.count(F.lit(1)).alias("k"))
    return c.crossJoin(tot).select(label, (F.col("n") / (F.col("k") * F.col("n_class"))).alias("class_weight"))


def with_balanced_weights(df: DataFrame, label: str, weight_col: str = "weight") -> DataFrame:
    w = balanced_weights(df, label).withColumnRenamed("class_weight", weight_col)
    return df.join(w, label, "left")                # one row per class; sent to every task if Spark finds it small


def fit_scaler(df: DataFrame, cols: list[str]) -> DataFrame:
    """M9 fit: mean and *population* std per column; zero std -> 1."""
    return df.agg(*[e for c in cols for e in (
        F.avg(c).alias(f"{c}__mean"),
        F.coalesce(F.when(F.stddev_pop(c) == 0, F.lit(1.0)).otherwise(F.stddev_pop(c)),
                   F.lit(1.0)).alias(f"{c}__std"))])


def standardize(df: DataFrame, cols: list[str], scaler: DataFrame | None = None) -> DataFrame:
    """M9 apply: (x - mean) / std."""
    scaler = fit_scaler(df, cols) if scaler is None else scaler
    out = df.crossJoin(F.broadcast(scaler))           # one row
    return out.withColumns({c: (F.col(c) - F.col(f"{c}__mean")) / F.col(f"{c}__std") for c in cols}) \
        .drop(*scaler.columns)


def assemble(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    """Feature vector in the declared column order."""
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="keep").transform(df)


def prepare_features(df: DataFrame, cols: list[str], maps=None, medians=None):
    """Reference preprocessing: median-impute numerics, 'unknown' + sorted codes for
    categoricals.  Returns (prepared df, label maps, medians)."""
    num, cat = numeric_and_categorical(df, cols)
    df = fill_unknown(df, cat)
    df, maps = encode_categoricals(df, cat, maps)
    medians = fit_medians(df, num) if (medians is None and num) else medians
    df = impute_median(df, num, medians)
    return df, maps, medians


def index_ids(inter: DataFrame) -> DataFrame:
    """Integer ids in order of first appearance in the (person, product)-sorted
    interaction table: person id = rank of the person; product id = rank of
    (first person who bought it, product).  Both ranks are distributed sequences."""
    cust = exact_sequence(inter.select("customer_unique_id").distinct(), ["customer_unique_id"],
                          out="customer_idx")
    prod = exact_sequence(inter.groupBy("product_id").agg(F.min("customer_unique_id").alias("_first")),
                          ["_first", "product_id"], out="product_idx").drop("_first")
    return (inter.join(cust, "customer_unique_id").join(prod, "product_id")
                 .select((F.col("customer_idx") - 1).alias("customer_idx"),
                         (F.col("product_idx") - 1).alias("product_idx"),
                         "customer_unique_id", "product_id", "interaction_count"))
