"""The stored master is written in passes: the same rows, and no shuffle stays on disk after the write."""

import time

import pytest
from pyspark.sql import functions as F

from mercato.operators import features as fe
from mercato.operators import master as ms
from mercato.plans import master_table as mt
from mercato.sources.binding import bind_marketplace
from tests.conftest import SMOKE


@pytest.fixture(scope="module")
def tables(spark):
    return bind_marketplace(spark, SMOKE)


def same(a, b):
    a, b = a.select(*sorted(a.columns)), b.select(*sorted(b.columns))
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {f.getName() for f in (files.apply(i) for i in range(files.size())) if f.getName().startswith("shuffle_")}


@pytest.mark.parametrize("by_month", [False, True])
def test_passes_give_the_same_table(spark, tables, tmp_path, by_month):
    got = mt.write_master(spark, tables, f"{tmp_path}/master", buckets=4, by_month=by_month, passes=3)
    assert same(got.drop(mt.MONTH), ms.build_master(tables))
    for job in (fe.delay_features, ms.order_grain):
        assert "Exchange" not in plan(job(got)), job.__name__
    if not by_month:
        assert len(list((tmp_path / "master").glob("*.zstd.parquet"))) == 4 * 3


def test_shuffles_go_with_the_pass_that_made_them(spark, tables, tmp_path):
    before = shuffles(spark)
    mt.write_master(spark, tables, f"{tmp_path}/master", buckets=3, passes=2)
    for _ in range(100):                                          # files go in the background
        left = {f.split("_")[1] for f in shuffles(spark) - before}
        if len(left) <= 6:
            break
        time.sleep(.1)
    assert len(left) <= 6                                         # small ones of the tables by zip, by seller and the binding
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"


def test_passes_keep_every_order_whatever_the_type_of_its_key(spark, tables, tmp_path):
    twice = tables["orders"].limit(3)
    nulls = tables["orders"].limit(2).withColumn("order_id", F.lit(None).cast("long"))
    odd = {**tables, "orders": tables["orders"].unionByName(twice).unionByName(nulls),
           "order_items": tables["order_items"].withColumn("order_id", F.col("order_id").cast("int")),
           "payments": tables["payments"].withColumn("order_id", F.col("order_id").cast("decimal(20,0)")),
           "reviews": tables["reviews"].withColumn("order_id", F.col("order_id").cast("string"))}
    got = mt.write_master(spark, odd, f"{tmp_path}/master", buckets=2, passes=4)
    want = ms.build_master(odd)
    assert got.filter("order_id is null").count() == 2 and got.filter("price is not null").count() > 0
    assert same(got, want)


def test_passes_are_few():
    assert [mt.pass_count(n) for n in (0, 1, 10**6, 10**6 + 1, 3 * 10**6, 10**7, 10**12)] == [1, 1, 1, 2, 3, mt.MOST_PASSES, mt.MOST_PASSES]
