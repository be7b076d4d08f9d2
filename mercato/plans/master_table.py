"""The master as a stored table in buckets of ``order_id``, whole or by purchase month.

An order's rows stand in one bucket, so whatever groups or joins by ``order_id`` reads its bucket and moves nothing;
jobs by other keys read the files as if there were no buckets.  A table by month is also laid out by the month of
purchase: a filter on ``purchase_month`` reads that month's files alone, and ``refresh_months`` writes the months named
anew from their orders, without touching the others.

A large table is written in some passes, each of them a share of the orders and a file a bucket: the shuffles of a pass hold its
orders alone and are deleted after it, so the disk holds the table and a share of the shuffles, not all of them.  A pass writes its
items with their sellers and products first: the shuffles that dealt them by seller and by product go before those by order come.
Orders meet their customers once, before the passes: a pass can't tell its customers by a hash, so each would shuffle all of them.  The
orders with their customers stand in a folder a pass, which goes with the pass, so they take the disk that the table doesn't take yet.

The layout (number of buckets, by month or not) stands beside the data in ``<path>.layout``, written after the data, so that any
session can open the table.
"""

from __future__ import annotations

import hashlib
import json
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.dates import month_key
from ..operators import master as ms
from ..session import setting, shuffles_deleted
from ..sources.binding import LazyTables
from .bundles import delete_folder

KEY, ORDER_IN_BUCKET, MONTH, PASS = "order_id", ("order_id", "order_item_id"), "purchase_month", "_pass"
ROWS_A_BUCKET, MOST_BUCKETS = 2_000_000, 100_000
# every pass reads the inputs again, so there are few of them however large the table is
ROWS_A_PASS, MOST_PASSES = 1_000_000, 10
BY_ORDER = ("orders", "order_items", "payments", "reviews", "review_keys")
# a dictionary of what nearly every order has for itself is as long as the column, and its numbers don't compress
OF_AN_ORDER = ("order_id", "customer_id", "customer_unique_id", "order_purchase_timestamp", "order_approved_at",
               "order_delivered_carrier_date", "order_delivered_customer_date")
FILES = {"compression": "zstd", **{f"parquet.enable.dictionary#{c}": "false" for c in OF_AN_ORDER}}


def bucket_count(spark: SparkSession, items: int) -> int:
    """Buckets of some two million items, and at least one for each core that a shuffle could use."""
    least = min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return min(max(least, -(-items // ROWS_A_BUCKET)), MOST_BUCKETS)


def pass_count(items: int) -> int:
    return min(max(1, -(-items // ROWS_A_PASS)), MOST_PASSES)


def _pass(key: Column, passes: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(passes))


def orders_of_pass(tables: dict[str, DataFrame], n: int, passes: int) -> dict[str, DataFrame]:
    """The tables with a share of the orders alone and what belongs to them: the ``n``-th of ``passes``, by a hash of the
    order that has nothing to do with that of the buckets."""
    kind = tables["orders"].schema[KEY].dataType

    def own(df: DataFrame) -> DataFrame:
        # the key as the orders have it: a number has other hashes in other types
        key = F.col(KEY) if df.schema[KEY].dataType == kind else F.col(KEY).try_cast(kind)
        return df.filter(_pass(key, passes) == n)

    return LazyTables({name: lambda name=name: own(tables[name]) if name in BY_ORDER else tables[name] for name in tables})


def _name(path: str) -> str:
    return f"mercato_master_{hashlib.md5(path.encode()).hexdigest()[:16]}"


@contextmanager
def _dealt_once(spark: SparkSession, buckets: int):
    """As many shuffle partitions as buckets: joins deal a side anew where it comes in another number of partitions.  Shuffles are
    deleted when the write that needs them is done."""
    with setting(spark, "spark.sql.shuffle.partitions", str(buckets)), shuffles_deleted(spark):
        yield


def _laid_out(tables: dict[str, DataFrame], by_month: bool, buckets: int, messages_apart: bool = False,
              at: tuple[DataFrame, DataFrame] | None = None, items: DataFrame | None = None, orders: DataFrame | None = None) -> DataFrame:
    """The rows dealt as the table is: a task writes one bucket of every month, one file each."""
    rows = ms.build_master(tables, buckets, messages_apart, at, items, orders)
    return rows.withColumn(MONTH, month_key("order_purchase_timestamp")) if by_month else rows


def write_master(spark: SparkSession, tables: dict[str, DataFrame], path: str, buckets: int | None = None,
                 by_month: bool = False, messages_apart: bool = False, passes: int | None = None) -> DataFrame:
    """Builds the master, writes it to ``path`` and returns the stored table.  An old table there is replaced.
    With ``messages_apart`` the table holds ids of messages, not their texts: an order's text isn't written once an item."""
    items = tables["order_items"].count()
    passes = passes or pass_count(items)
    buckets = buckets or bucket_count(spark, items)
    name = _name(path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    delete_folder(spark, f"{path}.layout")                        # a table without its layout isn't complete
    at = ms.places(tables)
    with _dealt_once(spark, buckets):
        dealt = ms.placed_orders(tables).withColumn(PASS, _pass(F.col(KEY), passes).cast("int"))
        dealt.write.mode("overwrite").options(**FILES).partitionBy(PASS).parquet(f"{path}.orders")
        for n in range(passes):
            part = tables if passes == 1 else orders_of_pass(tables, n, passes)
            ms.placed_items(part, at[1]).write.mode("overwrite").options(**FILES).parquet(f"{path}.items")
            items = spark.read.parquet(f"{path}.items")
            orders = spark.read.schema(dealt.schema).parquet(f"{path}.orders").filter(F.col(PASS) == n).drop(PASS)
            writer = _laid_out(part, by_month, buckets, messages_apart, at, items, orders).write.mode("append" if n else "overwrite") \
                .format("parquet").bucketBy(buckets, KEY).sortBy(*ORDER_IN_BUCKET).option("path", path).options(**FILES)
            (writer.partitionBy(MONTH) if by_month else writer).saveAsTable(name)
            delete_folder(spark, f"{path}.items")
            delete_folder(spark, f"{path}.orders/{PASS}={n}")
        delete_folder(spark, f"{path}.orders")
    spark.createDataFrame([(buckets, by_month, spark.table(name).schema.json())], "buckets int, by_month boolean, schema string") \
        .coalesce(1).write.json(f"{path}.layout")
    return spark.table(name)


def open_master(spark: SparkSession, path: str) -> DataFrame:
    """The table at ``path``, written by this session or any other one."""
    layout = spark.read.schema("buckets int, by_month boolean, schema string").json(f"{path}.layout").first()
    name, at = _name(path), path.replace("\\", "\\\\").replace("'", "\\'")
    if not spark.catalog.tableExists(name):
        schema = StructType.fromJson(json.loads(layout["schema"]))
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        months = f"PARTITIONED BY ({MONTH})" if layout["by_month"] else ""
        options = ", ".join(f"'{k}' '{v}'" for k, v in FILES.items())
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet OPTIONS ({options}) {months} CLUSTERED BY ({KEY}) "
                  f"SORTED BY ({', '.join(ORDER_IN_BUCKET)}) INTO {layout['buckets']} BUCKETS LOCATION '{at}'")
    if layout["by_month"]:
        spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")     # months that other sessions added or took away
    spark.catalog.refreshTable(name)
    return spark.table(name)


def orders_of_months(tables: dict[str, DataFrame], months: list[str | None]) -> dict[str, DataFrame]:
    """The tables with the orders of ``months`` alone and what belongs to them; None stands for orders without a purchase time."""
    key = month_key("order_purchase_timestamp")
    named = [m for m in months if m is not None]
    wanted = F.coalesce(key.isin(named), F.lit(False)) if named else F.lit(False)
    orders = tables["orders"].filter(wanted | key.isNull() if None in months else wanted)
    ids = orders.select(KEY).distinct()
    return {**tables, "orders": orders,
            **{n: tables[n].join(ids, KEY, "left_semi") for n in ("order_items", "payments", "reviews")}}


def refresh_months(spark: SparkSession, tables: dict[str, DataFrame], path: str, months: list[str | None]) -> DataFrame:
    """Writes the rows of ``months`` ('YYYY-MM') anew from ``tables``; equal to a rebuild where only orders of these months, or what
    belongs to them, changed.  Each month's files are replaced when all new ones are written; a month without
    orders any more goes.  An order that moved needs both its months named."""
    table = open_master(spark, path)
    if MONTH not in table.columns:
        raise ValueError(f"{path} is not laid out by month")
    layout = spark.read.schema("buckets int, by_month boolean").json(f"{path}.layout").first()
    part = orders_of_months(tables, months)
    left = {r[0] for r in part["orders"].select(month_key("order_purchase_timestamp")).distinct().collect()}   # among the months named
    rows = _laid_out(part, True, layout["buckets"]).select(*table.columns)
    # a table insert reads the mode from the session only
    with setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"), _dealt_once(spark, layout["buckets"]):
        rows.write.mode("overwrite").insertInto(_name(path))
    for gone in set(months) - left:
        value = "__HIVE_DEFAULT_PARTITION__" if gone is None else gone
        literal = "null" if gone is None else f"'{gone}'"
        spark.sql(f"ALTER TABLE {_name(path)} DROP IF EXISTS PARTITION ({MONTH}={literal})")
        delete_folder(spark, f"{path}/{MONTH}={value}")
    return open_master(spark, path)
