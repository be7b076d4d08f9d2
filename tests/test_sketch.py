"""Sketched quantiles within their stated error of rank."""

import random

from pyspark.sql import functions as F

from mercato.operators import prep as pp
from mercato.operators import reports as rp
from mercato.operators import stats as st


def test_sketched_quantiles_stay_within_their_error(spark):
    rng = random.Random(1)
    rows = [(rng.gauss(0, 1), rng.choice([0.0, 0.0, 1.0, None]), float(i % 50), None) for i in range(20_000)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(7)
    qs, accuracy = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0], 200
    got = {r["column_name"]: [r[f"q_{i}"] for i in range(len(qs))] for r in st.column_quantiles(df, ["a", "b", "c", "d"], qs, accuracy).collect()}
    for k, name in enumerate("abc"):
        values = sorted(r[k] for r in rows if r[k] is not None)
        n = len(values)
        for q, v in zip(qs, got[name]):
            low, high = sum(x < v for x in values), sum(x <= v for x in values)        # ranks that the value covers
            assert low - n / accuracy <= q * n <= high + n / accuracy + 1, (name, q)
    assert got["d"] == [None] * len(qs)


def test_sketches_take_one_pass_and_the_exact_path_is_the_default(spark):
    df = spark.range(1, 1002).select(F.col("id").cast("double").alias("x"))
    plan = st.column_quantiles(df, ["x"], [0.5], 1000)._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and plan.count("Exchange") <= 1
    assert rp.describe_columns(df, ["x"], accuracy=10_000).first()["p50"] == rp.describe_columns(df, ["x"]).first()["p50"] == 501
    assert pp.fit_medians(df, ["x"], accuracy=10_000).first()["x"] == pp.fit_medians(df, ["x"]).first()["x"] == 501
