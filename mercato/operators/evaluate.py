"""Model evaluation as aggregations over prediction tables.

Metrics are single conditional-count / sum aggregates (partial, map-side
combined); only the one-row result reaches the driver.  ROC AUC is exact: scores
are reduced to one row per distinct score, ranked with the distributed exact
sequence, and the rank-sum (Mann-Whitney) statistic gives the trapezoidal AUC
with ties counted one half.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sequence import running_total


def _div0(a, b):
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def binary_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy, precision, recall, F1 (zero-division -> 0) and the confusion counts."""
    y, p = F.col(label), F.col(prediction)
    c = pred.agg(F.sum(F.when((y == 1) & (p == 1), 1).otherwise(0)).alias("tp"),
                 F.sum(F.when((y == 0) & (p == 1), 1).otherwise(0)).alias("fp"),
                 F.sum(F.when((y == 0) & (p == 0), 1).otherwise(0)).alias("tn"),
                 F.sum(F.when((y == 1) & (p == 0), 1).otherwise(0)).alias("fn"))
    tp, fp, tn, fn = (F.coalesce(F.col(x), F.lit(0)) for x in ("tp", "fp", "tn", "fn"))
    prec, rec = _div0(tp, tp + fp), _div0(tp, tp + fn)
    return c.select(
        _div0(tp + tn, tp + fp + tn + fn).alias("accuracy"), prec.alias("precision"), rec.alias("recall"),
        _div0(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
        tp.cast("long").alias("tp"), fp.cast("long").alias("fp"),
        tn.cast("long").alias("tn"), fn.cast("long").alias("fn"))


def roc_auc(pred: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Exact ROC AUC (one row ``auc_roc``; NULL when one class is absent).

    Equal scores are counted first, so a score that most rows share is one row per
    task; the rows of one distinct score cover ranks [lo, hi] of a running total and
    share the average rank (lo + hi) / 2."""
    rows = pred.select(F.col(score).cast("double").alias("_s"),
                       F.when(F.col(label) == 1, 1).otherwise(0).alias("_y"))
    per = running_total(rows.groupBy("_s").agg(F.sum("_y").alias("_np"), F.count(F.lit(1)).alias("_n")),
                        ["_s"], "_n", out="_hi").withColumn("_lo", F.col("_hi") - F.col("_n") + 1)
    return per.agg(F.sum(F.col("_np") * (F.col("_lo") + F.col("_hi")) / 2.0).alias("_rs"),
                   F.sum("_np").cast("double").alias("_np"),
                   F.sum("_n").cast("double").alias("_n")).select(
        F.try_divide(F.col("_rs") - F.col("_np") * (F.col("_np") + 1) / 2.0,
                     F.col("_np") * (F.col("_n") - F.col("_np"))).alias("auc_roc"))


def multiclass_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy, macro F1, weighted F1 (classes = labels seen in either column)."""
    cm = pred.groupBy(F.col(label).alias("y"), F.col(prediction).alias("p")).agg(
        F.count(F.lit(1)).alias("n"))
    support = cm.groupBy(F.col("y").alias("c")).agg(F.sum("n").alias("support"))
    predicted = cm.groupBy(F.col("p").alias("c")).agg(F.sum("n").alias("predicted"))
    tp = cm.filter(F.col("y") == F.col("p")).select(F.col("y").alias("c"), F.col("n").alias("tp"))
    per = (support.join(predicted, "c", "full").join(tp, "c", "left")
                  .fillna(0, ["support", "predicted", "tp"]))
    per = per.withColumn("f1", _div0(2 * F.col("tp"), F.col("support") + F.col("predicted")))
    return per.agg(
        _div0(F.sum("tp"), F.sum("support")).alias("accuracy"),
        F.avg("f1").alias("f1_macro"),
        _div0(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("f1_weighted"))


def class_report(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """E3 by class: precision, recall, F1 (zero-division -> 0) and support of every label seen in either column."""
    cm = pred.groupBy(F.col(label).alias("y"), F.col(prediction).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    hit = F.col("y") == F.col("p")
    per = cm.select(F.explode(F.array(
        F.struct(F.col("y").alias("class"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted"), F.when(hit, F.col("n")).otherwise(0).alias("tp")),
        F.struct(F.col("p").alias("class"), F.lit(0).cast("long").alias("support"), F.col("n").alias("predicted"), F.lit(0).cast("long").alias("tp")))).alias("c")) \
        .select("c.*").filter("class is not null").groupBy("class").agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "tp")])
    return per.select("class", _div0(F.col("tp"), F.col("predicted")).alias("precision"), _div0(F.col("tp"), F.col("support")).alias("recall"),
                      _div0(2 * F.col("tp"), F.col("support") + F.col("predicted")).alias("f1_score"), "support")


def confusion_matrix(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return pred.groupBy(F.col(label).alias("actual"), F.col(prediction).alias("predicted")) \
        .agg(F.count(F.lit(1)).alias("count"))


def regression_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """RMSE, MAE, MAPE in percent over non-zero targets, R^2 (one pass + one pass)."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    m = pred.agg(F.avg(y).alias("_ybar"))
    j = pred.crossJoin(F.broadcast(m))          # one row
    return j.agg(
        F.sqrt(F.avg((y - p) * (y - p))).alias("rmse"),
        F.avg(F.abs(y - p)).alias("mae"),
        (F.avg(F.when(y != 0, F.abs((y - p) / y))) * 100.0).alias("mape"),
        (F.lit(1.0) - F.try_divide(F.sum((y - p) * (y - p)),
                                   F.sum((y - F.col("_ybar")) * (y - F.col("_ybar"))))).alias("r2"))


def feature_importance(model, names: list[str], k: int = 10):
    """E5: top-k (feature, importance rounded to 4) from a tree ensemble (driver-side,
    size = number of features)."""
    imp = model.featureImportances.toArray().tolist()
    pairs = sorted(zip(names, imp), key=lambda t: (-t[1], t[0]))[:k]
    return [(n, round(v, 4)) for n, v in pairs]
