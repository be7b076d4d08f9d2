"""Disk of the stored master: columns an order has for itself without dictionaries, items written apart; pairs shuffled once."""

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from mercato.functions.dates import month_key
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


def dictionaries(path):
    """Of the columns in the files at ``path``: those with a dictionary."""
    found = set()
    for f in path.rglob("*.parquet"):
        m = pq.ParquetFile(f).metadata
        found |= {c.path_in_schema for c in (m.row_group(0).column(i) for i in range(m.num_columns)) if c.has_dictionary_page}
    return found


def test_what_an_order_has_for_itself_is_written_without_dictionary(spark, tables, tmp_path):
    months = [r[0] for r in tables["orders"].select(month_key("order_purchase_timestamp")).distinct().limit(3).collect()]
    tables = mt.orders_of_months(tables, months)
    mt.write_master(spark, tables, f"{tmp_path}/master", buckets=2, by_month=True, passes=2)
    spark.sql(f"DROP TABLE {mt._name(f'{tmp_path}/master')}")       # as another session would find it
    got = mt.refresh_months(spark, tables, f"{tmp_path}/master", months[:2])
    assert same(got.drop(mt.MONTH), ms.build_master(tables))
    found = dictionaries(tmp_path / "master")
    assert not found & set(mt.OF_AN_ORDER) and "order_status" in found


def test_items_of_a_pass_are_dealt_by_seller_and_product_before_the_joins_by_order(spark, tables, tmp_path, monkeypatch):
    seen, build = [], ms.build_master

    def built(*args):
        seen.append([f.rsplit("/", 2)[-2] for f in args[4].inputFiles()])
        return build(*args)

    monkeypatch.setattr(ms, "build_master", built)
    got = mt.write_master(spark, tables, f"{tmp_path}/master", buckets=2, passes=3)
    assert len(seen) == 3 and all(set(x) == {"master.items"} for x in seen)
    assert same(got, build(tables))
    assert not (tmp_path / "master.items").exists()


def test_a_pass_stays_a_tenth():
    assert mt.MOST_PASSES == 10 and mt.pass_count(6 * 10**6) == 6 and mt.pass_count(36 * 10**6) == 10


def test_interaction_summary_copies_no_pair(spark):
    rows = [(c, p, o) for c in (1, 2, 3) for p in range(c + 1) for o in range(p + 1)] + [(None, 5, 1), (4, None, 1), (5, 5, None)]
    got = fe.interaction_summary(fe.interactions(spark.createDataFrame(rows * 2, "customer_unique_id long, product_id long, order_id long")))
    assert got.collect() == [(3, 4, 9, 8)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "ReusedExchange" in plan
    odd = spark.createDataFrame([(None, 1, 3), (None, 2, 1), (7, None, 2), (7, 1, 9)], "customer_unique_id long, product_id long, interaction_count long")
    assert fe.interaction_summary(odd).collect() == [(1, 2, 4, 9)]
    assert fe.interaction_summary(odd.filter("false")).collect() == [(0, 0, 0, None)]
