"""Boosted trees by histograms: MLlib's trees where nothing is random, and as good ones where it is."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from mercato.operators import boosting as bo
from mercato.operators import evaluate as ev
from mercato.operators import prep as pp
from mercato.plans import train as tr

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(3000, numPartitions=3).select(
        (F.col("id") * 7919 % 13).cast("double").alias("a"), (F.col("id") * 104729 % 17).cast("double").alias("b"),
        (F.col("id") * 1299709 % 5).cast("double").alias("c"), F.col("id"))
    df = df.withColumn("y", F.col("a") * F.col("c") + F.col("b") * F.col("b") / 7 + F.col("id") % 11 / 5)
    return pp.assemble(df.withColumn("late", (F.col("y") > 30).cast("int")), FEATURES).persist()


@pytest.mark.parametrize("kind", ["regression", "classification"])
def test_same_trees_as_mllib_where_all_rows_and_features_are_used(rows, kind, monkeypatch):
    monkeypatch.setattr(bo, "BLOCK", 500)
    p = tr.TreeParams(max_iter=12, max_depth=4, subsampling_rate=1.0, feature_subset="1.0", max_bins=32)
    if kind == "regression":
        est, data, weight = tr._gbt_regressor(p), rows.withColumn("label", F.col("y")), None
    else:
        est, weight = tr._gbt_classifier(p, "weight"), "weight"
        data = rows.withColumn("label", F.col("late").cast("double")).withColumn("weight", F.when(F.col("late") == 1, 2.5).otherwise(1.0))
    one, two = bo.fit(est, data, p, weight), est.fit(data)
    assert type(one) is type(two) and one.getNumTrees == two.getNumTrees
    value = (lambda m: m.transform(data).select("id", vector_to_array("probability")[1].alias("p"))) if weight else \
        (lambda m: m.transform(data).select("id", F.col("prediction").alias("p")))
    both = np.array(value(one).join(value(two).withColumnRenamed("p", "q"), "id").select("p", "q").collect())
    assert len(both) == 3000
    np.testing.assert_allclose(both[:, 0], both[:, 1], rtol=1e-7, atol=1e-9)
    np.testing.assert_allclose(one.featureImportances.toArray(), two.featureImportances.toArray(), atol=1e-7)


def test_larger_tables_grow_by_histograms_and_judge_as_well(rows, monkeypatch):
    """Before, MLlib went over a large table's rows as objects, a level after the other."""
    data = rows.drop("features").withColumn("split", F.when(F.col("id") % 6 == 0, "test").otherwise("train"))
    p = tr.TreeParams(max_iter=12, max_depth=4, step_size=0.3)
    by_mllib = tr._regress(data, FEATURES, "y", p)
    small = by_mllib.metrics.first()
    monkeypatch.setattr(tr, "ROWS_BY_MLLIB", 1000)
    monkeypatch.setattr(tr.GBTRegressor, "fit", None)
    large = tr._regress(data, FEATURES, "y", p)
    m = large.metrics.first()
    assert (m["train_size"], m["test_size"]) == (2500, 500)
    assert m["r2"] > 0.8 and abs(m["r2"] - small["r2"]) < 0.05
    again = tr._regress(data, FEATURES, "y", p).metrics.first()
    assert again == m
    for (f, one), (g, two) in zip(ev.feature_importance(large.model, FEATURES), ev.feature_importance(by_mllib.model, FEATURES)):
        assert f == g and abs(one - two) < 0.05


def test_odd_columns(spark):
    """A column of one value, one without any, and a table that can't be split."""
    df = spark.createDataFrame([(1.0, float("nan"), float(i % 4), float(i % 4 == 0)) for i in range(40)], "a double, b double, c double, y double")
    data = pp.assemble(df, FEATURES).withColumn("label", F.col("y"))
    p = tr.TreeParams(max_iter=3, max_depth=2, subsampling_rate=1.0, feature_subset="1.0")
    model = bo.fit(tr._gbt_regressor(p), data, p)
    assert model.transform(data).filter(F.abs(F.col("prediction") - F.col("y")) > 1e-9).count() == 0
    flat = bo.fit(tr._gbt_regressor(p), data.withColumn("label", F.lit(3.0)), p)
    assert [r[0] for r in flat.transform(data).select("prediction").distinct().collect()] == [3.0]
