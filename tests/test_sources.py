"""CSV inputs and the written tables."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from mercato.operators import master as ms
from mercato.plans import etl
from mercato.sources import io
from mercato.sources.binding import bind_marketplace
from tests.conftest import SMOKE


def write_csv(folder, name, text):
    (folder / f"{name}.csv").write_text(text, encoding="utf-8")


@pytest.fixture
def csv_folder(tmp_path):
    empty = {n: ",".join(s.fieldNames()) + "\n" for n, s in io.SCHEMAS.items()}
    for name, text in empty.items():
        write_csv(tmp_path, name, text)
    write_csv(tmp_path, "payments", "\ufeff" + empty["payments"] + "a,1,card,9,10.5\na,2,card,24,NA\nb,1,card,x,1\n")
    write_csv(tmp_path, "reviews", empty["reviews"] + 'r,a,5,"so ""good""","two\nlines, one comma",2020-01-02 03:04:05,never\n')
    return tmp_path


def test_csv_types_quotes_breaks_bom_and_missing(spark, csv_folder):
    t = io.load_marketplace(spark, str(csv_folder))
    assert set(t) == set(io.SCHEMAS) and t["orders"].count() == 0
    most = ms.payments_by_order(t["payments"]).filter("order_id = 'a'").first()
    assert most.payment_installments_max == 24 and most.payment_value_total == 10.5
    assert t["payments"].filter("order_id = 'b'").first().payment_installments is None
    r = t["reviews"].first()
    assert (r.review_comment_title, r.review_comment_message) == ('so "good"', "two\nlines, one comma")
    assert str(r.review_creation_date) == "2020-01-02 03:04:05" and r.review_answer_timestamp is None


def test_csv_with_a_column_missing_is_an_error(spark, csv_folder):
    write_csv(csv_folder, "sellers", "seller_id,seller_city,seller_state\n")
    with pytest.raises(ValueError, match="sellers"):
        io.load_marketplace(spark, str(csv_folder))


def test_master_from_csv_equals_master_from_tables(spark, tmp_path):
    tables = bind_marketplace(spark, SMOKE)
    schemas = {}
    for name, df in tables.items():
        stamps = {f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp_ntz"}
        schemas[name] = StructType([StructField(f.name, StringType() if f.name in stamps else f.dataType)
                                    for f in df.schema.fields])
        df.select(*[F.col(c).cast("string").alias(c) for c in df.columns]) \
            .write.option("header", True).option("escape", '"').csv(f"{tmp_path}/{name}.csv")
    got = ms.build_master(io.load_marketplace(spark, str(tmp_path), schemas))
    want = ms.build_master(tables)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_feature_tables_are_written_and_read_back(spark, tmp_path):
    tables = bind_marketplace(spark, SMOKE)
    etl.run_etl(spark, tables, str(tmp_path))
    master = spark.read.parquet(f"{tmp_path}/master")
    paths = etl.run_features(master, tables["reviews"], str(tmp_path / "features"),
                             master.select("seller_id").distinct())
    rows = {name: spark.read.parquet(path).count() for name, path in paths.items()}
    assert rows["delay_features"] == 485 and rows["customer_features"] == 150 and rows["pricing_features"] == 6000
    assert rows["interactions"] == rows["interaction_matrix"] == 5382 and rows["kpis"] == 1
    assert rows["orders_unique"] == master.select("order_id").distinct().count()
    assert rows["sellers_with_clusters"] == master.select("seller_id").distinct().count()
