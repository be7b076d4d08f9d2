"""The stored master: buckets that spare the shuffles by order, months that are refreshed alone."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from mercato.operators import features as fe
from mercato.operators import master as ms
from mercato.operators import reports as rp
from mercato.plans import master_table as mt
from mercato.sources.binding import bind_marketplace
from tests.conftest import SMOKE


@pytest.fixture(scope="module")
def tables(spark):
    return bind_marketplace(spark, SMOKE)


@pytest.fixture(scope="module")
def master(spark, tables, tmp_path_factory):
    return mt.write_master(spark, tables, f"{tmp_path_factory.mktemp('whole')}/master", buckets=4)


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def same(a, b):
    a, b = a.select(*sorted(a.columns)), b.select(*sorted(b.columns))
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_jobs_by_order_move_nothing_by_order(spark, tables, master):
    loose = ms.build_master(tables)
    assert same(master, loose)
    for job in (fe.delay_features, ms.order_grain, rp.kpis):
        text = plan(job(master))
        assert "hashpartitioning(order_id" not in text and "rangepartitioning" not in text, job.__name__
    for job in (fe.delay_features, ms.order_grain):
        assert "Exchange" not in plan(job(master)), job.__name__
    assert same(ms.order_grain(master), ms.order_grain(loose)) and same(rp.kpis(master), rp.kpis(loose))
    one = master.filter(F.col("order_id") == master.first().order_id)
    assert "SelectedBucketsCount: 1 out of 4" in plan(one.groupBy("order_id").count())


def test_a_bucket_is_one_file(spark, tables, tmp_path):
    mt.write_master(spark, tables, f"{tmp_path}/master", buckets=5)
    assert len(list((tmp_path / "master").glob("*.parquet"))) == 5


def test_order_grain_keeps_ties_null_orders_and_itemless_orders(spark):
    rows = [("a", 2, "x"), ("a", 1, "y"), ("a", 1, "z"), ("b", None, "w"), (None, 3, "u"), (None, 5, "v"), ("c", None, "p"), ("c", 7, "q")]
    df = spark.createDataFrame(rows, "order_id string, order_item_id int, v string")
    assert sorted(r.v for r in ms.order_grain(df).collect()) == ["q", "u", "w", "y", "z"]
    assert ms.order_grain(df.limit(0)).collect() == []


def test_another_session_opens_the_table(spark, tables, tmp_path):
    path = f"{tmp_path}/master"
    written = mt.write_master(spark, tables, path, buckets=3, by_month=True)
    rows = written.count()
    spark.sql(f"DROP TABLE {mt._name(path)}")                     # what a new session starts with
    opened = mt.open_master(spark, path)
    assert opened.count() == rows and opened.columns == [*ms.MASTER_COLS, mt.MONTH]
    assert "Exchange" not in plan(ms.order_grain(opened))
    month = opened.select(F.max(mt.MONTH)).first()[0]
    assert f"{mt.MONTH}#" in plan(opened.filter(F.col(mt.MONTH) == month)) and opened.filter(F.col(mt.MONTH) == month).count() < rows


def changed(tables, month):
    """Orders of one month with another status, fewer items and other reviews; one month's orders are gone, one has none before."""
    key = mt.month_key("order_purchase_timestamp")
    orders = tables["orders"]
    months = [r[0] for r in orders.select(key.alias("m")).distinct().orderBy("m").collect()]
    gone, new = next(m for m in months if m and m != month), "2031-05"
    ids = orders.filter(key == month).select("order_id")
    lost = orders.filter(key == gone).select("order_id")
    added = orders.filter(key == month).orderBy("order_id").limit(5).withColumns({
        "order_id": -F.col("order_id"), "order_purchase_timestamp": F.lit(dt.datetime(2031, 5, 3)).cast("timestamp_ntz")})
    timeless = added.withColumns({"order_id": F.col("order_id") - 10**9, "order_purchase_timestamp": F.lit(None).cast("timestamp_ntz")})
    orders = orders.join(lost, "order_id", "left_anti").withColumn(
        "order_status", F.when(key == month, "refunded").otherwise(F.col("order_status"))).unionByName(added).unionByName(timeless)
    items = tables["order_items"]
    first = Window.partitionBy("order_id").orderBy("order_item_id")
    fewer = items.join(ids, "order_id", "left_semi").withColumn("_n", F.row_number().over(first)).filter("_n > 1").drop("_n")
    items = items.join(ids, "order_id", "left_anti").unionByName(fewer)
    reviews = tables["reviews"]
    reviews = reviews.join(ids, "order_id", "left_anti").unionByName(
        reviews.join(ids, "order_id", "left_semi").withColumn("review_comment_message", F.lit("changed")))
    return {**tables, "orders": orders, "order_items": items, "reviews": reviews}, [month, gone, new, None]


def test_refreshed_months_equal_a_rebuild(spark, tables, tmp_path):
    path = f"{tmp_path}/master"
    old = mt.write_master(spark, tables, path, buckets=3, by_month=True)
    by_size = old.groupBy(mt.MONTH).count().orderBy(F.desc("count"), mt.MONTH).first()[0]
    files = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "master").rglob("*.parquet")}
    now, months = changed(tables, by_size)
    got = mt.refresh_months(spark, now, path, months)
    want = ms.build_master(now)
    assert same(got.drop(mt.MONTH), want) and not same(got.drop(mt.MONTH), ms.build_master(tables))
    assert got.filter(f"{mt.MONTH} IS NULL").count() >= 5 and got.filter(f"{mt.MONTH} = '2031-05'").count() >= 5
    left = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "master").rglob("*.parquet")}
    untouched = [n for n in files if left.get(n) == files[n]]
    assert len(untouched) > len(files) / 2                       # the other months' files stay as they are
    assert "Exchange" not in plan(ms.order_grain(got))
    # the same again, and months that were never there, change nothing
    again = mt.refresh_months(spark, now, path, [*months, "1890-01"])
    assert same(again.drop(mt.MONTH), want)
    # the null month goes when its orders go
    orders = now["orders"].filter("order_purchase_timestamp IS NOT NULL")
    assert mt.refresh_months(spark, {**now, "orders": orders}, path, [None]).filter(f"{mt.MONTH} IS NULL").count() == 0


def test_a_master_without_months_is_not_refreshed(spark, tables, tmp_path):
    path = f"{tmp_path}/master"
    mt.write_master(spark, {**tables, "orders": tables["orders"].limit(0)}, path)
    assert mt.open_master(spark, path).count() == 0
    with pytest.raises(ValueError, match="by month"):
        mt.refresh_months(spark, tables, path, ["2020-01"])
