"""Descriptive reports over the master table.

Every report reduces the data with partial aggregates first; totals for
percentages come from the already-reduced table (a handful of rows), and top-k
uses ``orderBy(...).limit(k)``, which plans as TakeOrderedAndProject (per-task
top-k, then a k-row merge).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.common import flag, round_clean
from ..functions.dates import days_between, month_key
from .master import order_grain
from .stats import column_quantiles, exact_quantiles


def _pct(df: DataFrame, count_col: str = "count", digits: int = 2, out: str = "pct") -> DataFrame:
    """Percent of the total of ``count_col`` over an already-reduced table."""
    total = F.sum(count_col).over(Window.partitionBy(F.lit(0)))
    return df.withColumn(out, round_clean(F.col(count_col) * 100.0 / total, digits))


def _money_sum(c: str):
    """Exact cents sum (decimal) returned as double."""
    return F.coalesce(F.sum(F.col(c).cast("decimal(38,2)")), F.lit(0)).cast("double")


def kpis(master: DataFrame) -> DataFrame:
    """Orders, revenue, customers, sellers, average ticket (one row).  Orders are counted after
    a group by their key, which a master in buckets has together; an order's rows have one customer."""
    og = order_grain(master)
    o = og.groupBy("order_id").agg(F.sum(F.col("payment_value_total").cast("decimal(38,2)")).alias("_paid")) \
          .agg(F.count("order_id").alias("total_orders"), _money_sum("_paid").alias("total_revenue"))
    c = master.agg(F.countDistinct("customer_id").alias("total_customers"))
    s = master.agg(F.countDistinct("seller_id").alias("total_sellers"))
    return (o.crossJoin(c).crossJoin(s)   # 1 row x 1 row x 1 row
             .select("total_orders", round_clean("total_revenue", 2).alias("total_revenue"),
                     "total_customers", "total_sellers",
                     round_clean(F.coalesce(F.try_divide(F.col("total_revenue"), F.col("total_orders")),
                                       F.lit(0.0)), 2).alias("avg_ticket")))


def sales_by_month(master: DataFrame) -> DataFrame:
    """Orders and revenue per purchase month (rows with no month dropped)."""
    og = order_grain(master).withColumn("year_month", month_key("order_purchase_timestamp"))
    return (og.filter(F.col("year_month").isNotNull()).groupBy("year_month")
              .agg(F.countDistinct("order_id").alias("num_orders"),
                   round_clean(_money_sum("payment_value_total"), 2).alias("revenue"))
              .orderBy("year_month"))


def orders_by_month(master: DataFrame) -> DataFrame:
    """Orders per purchase month."""
    og = order_grain(master).withColumn("year_month", month_key("order_purchase_timestamp"))
    return (og.filter(F.col("year_month").isNotNull()).groupBy("year_month")
              .agg(F.count("order_id").alias("num_orders")).orderBy("year_month"))


def date_range(master: DataFrame) -> DataFrame:
    """First and last purchase timestamp."""
    return order_grain(master).agg(F.min("order_purchase_timestamp").alias("first_purchase"),
                                   F.max("order_purchase_timestamp").alias("last_purchase"))


def status_distribution(master: DataFrame) -> DataFrame:
    """Orders per status with percentage."""
    c = (order_grain(master).filter(F.col("order_status").isNotNull())
         .groupBy("order_status").agg(F.count("order_id").alias("count")))
    return _pct(c).orderBy(F.desc("count"), "order_status")


def customers_by_state(master: DataFrame) -> DataFrame:
    """Distinct customers (per-order ids) per customer state."""
    return (master.filter(F.col("customer_state").isNotNull()).groupBy("customer_state")
                  .agg(F.countDistinct("customer_id").alias("num_customers"))
                  .orderBy(F.desc("num_customers"), "customer_state"))


def top_k(df: DataFrame, value: str, key: str, k: int) -> DataFrame:
    """K largest ``value`` rows, ties broken by ``key`` ascending."""
    return df.orderBy(F.col(value).desc(), F.col(key).asc_nulls_last()).limit(k)


def top_regions(master: DataFrame, by: str = "customer_state", id_col: str = "customer_id",
                k: int = 10, grain: str = "order") -> DataFrame:
    """Top-k regions by distinct ids (order grain for customer columns)."""
    src = order_grain(master) if grain == "order" else master
    c = (src.filter(F.col(by).isNotNull()).groupBy(by)
            .agg(F.countDistinct(id_col).alias("num_distinct")))
    return top_k(c, "num_distinct", by, k)


def review_distribution(master: DataFrame) -> DataFrame:
    """A22 (order grain): latest review score (rounded) counts with percentage."""
    og = order_grain(master).filter(F.col("review_score").isNotNull())
    c = (og.groupBy(F.round("review_score").cast("int").alias("review_score"))
           .agg(F.count(F.lit(1)).alias("count")))
    return _pct(c)


def raw_review_distribution(reviews: DataFrame) -> DataFrame:
    """A22 (raw reviews): count per review score."""
    return (reviews.filter(F.col("review_score").isNotNull()).groupBy("review_score")
                   .agg(F.count(F.lit(1)).alias("count")))


def mean_review_score(master: DataFrame) -> DataFrame:
    return order_grain(master).agg(F.avg("review_score").alias("mean_review_score"))


def top_categories(master: DataFrame, k: int = 15) -> DataFrame:
    """Categories with most item rows."""
    c = (master.filter(F.col("product_category_name_english").isNotNull())
               .groupBy(F.col("product_category_name_english").alias("category"))
               .agg(F.count(F.lit(1)).alias("count")))
    return top_k(c, "count", "category", k)


def payment_mix(master: DataFrame) -> DataFrame:
    """Orders per main payment type with percentage."""
    c = (order_grain(master).filter(F.col("payment_type_main").isNotNull())
         .groupBy("payment_type_main").agg(F.count("order_id").alias("count")))
    return _pct(c)


MONEY_COLS = ["price", "freight_value", "payment_value_total"]


def _column_stats(df: DataFrame, cols: list[str], qs: list[float], qnames: list[str], accuracy: int | None = None) -> DataFrame:
    """Per column: count, mean, sample std, min, max (one aggregation pass) and exact
    quantiles (one distributed sort for all columns)."""
    agg = df.agg(*[e for c in cols for e in (
        F.count(c).alias(f"{c}__count"), F.avg(c).alias(f"{c}__mean"),
        F.stddev_samp(c).alias(f"{c}__std"), F.min(c).cast("double").alias(f"{c}__min"),
        F.max(c).cast("double").alias(f"{c}__max"))])
    stack = ", ".join(f"'{c}', `{c}__count`, `{c}__mean`, `{c}__std`, `{c}__min`, `{c}__max`"
                      for c in cols)
    base = agg.selectExpr(f"stack({len(cols)}, {stack}) AS (column_name, count, mean, std, min, max)")
    q = column_quantiles(df, cols, qs, accuracy)
    q = q.select("column_name", *[F.col(f"q_{i}").alias(n) for i, n in enumerate(qnames)])
    return base.join(q, "column_name", "left")


def price_stats(master: DataFrame, cols: list[str] = MONEY_COLS, accuracy: int | None = None) -> DataFrame:
    """Mean, median, min, max, sample std of each money column (nulls dropped).  With ``accuracy`` the median is
    sketched in one pass, off by at most rows / accuracy ranks."""
    st = _column_stats(master, cols, [0.5], ["median"], accuracy)
    return st.select(F.col("column_name").alias("metric"), "mean", "median", "min", "max", "std")


def describe_columns(df: DataFrame, cols: list[str], accuracy: int | None = None) -> DataFrame:
    """Count, mean, std, min, quartiles, max per column (long format).  With ``accuracy`` the quartiles are
    sketched in one pass, off by at most rows / accuracy ranks."""
    st = _column_stats(df, cols, [0.25, 0.5, 0.75], ["p25", "p50", "p75"], accuracy)
    return st.select("column_name", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def null_profile(df: DataFrame, k: int = 10) -> DataFrame:
    """Percentage of NULLs per column, top-k non-zero (one pass over the data)."""
    row = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in df.columns])
    long = row.unpivot(["_n"], df.columns, "column_name", "nulls")
    pct = long.select("column_name", round_clean(F.col("nulls") * 100.0 / F.col("_n"), 4).alias("null_pct"))
    return top_k(pct.filter(F.col("null_pct") > 0), "null_pct", "column_name", k)


def delivered(df: DataFrame) -> DataFrame:
    """Delivered orders with both delivery dates."""
    return df.filter((F.col("order_status") == "delivered")
                     & F.col("order_delivered_customer_date").isNotNull()
                     & F.col("order_estimated_delivery_date").isNotNull())


def delivered_with_delay(master: DataFrame) -> DataFrame:
    """A28 table: delivered orders (order grain) with delay days and late flag."""
    d = delivered(order_grain(master))
    d = d.withColumn("delivery_delay_days", days_between("order_estimated_delivery_date",
                                                         "order_delivered_customer_date"))
    return d.withColumn("is_delayed", flag(F.col("delivery_delay_days") > 0))


def delay_summary(master: DataFrame) -> DataFrame:
    """Delivered, late, on time, % late, mean/median/max/min delay days."""
    d = delivered_with_delay(master)
    base = d.agg(F.count(F.lit(1)).alias("n_delivered"), F.sum("is_delayed").alias("n_delayed"),
                 F.avg("delivery_delay_days").alias("mean_delay_days"),
                 F.max("delivery_delay_days").alias("max_delay_days"),
                 F.min("delivery_delay_days").alias("min_delay_days"))
    med = exact_quantiles(d, "delivery_delay_days", [0.5]).withColumnRenamed("q_0", "median_delay_days")
    return base.crossJoin(med).select(
        "n_delivered", F.coalesce(F.col("n_delayed"), F.lit(0)).alias("n_delayed"),
        (F.col("n_delivered") - F.coalesce(F.col("n_delayed"), F.lit(0))).alias("n_on_time"),
        round_clean(F.coalesce(F.try_divide(F.col("n_delayed") * 100.0, F.col("n_delivered")),
                          F.lit(0.0)), 2).alias("pct_delayed"),
        "mean_delay_days", "median_delay_days", "max_delay_days", "min_delay_days")


def sentiment_distribution(sentiment: DataFrame) -> DataFrame:
    """Reviews per sentiment label with percentage."""
    return _pct(sentiment.groupBy("sentiment").agg(F.count(F.lit(1)).alias("count")))


def distance_coverage(master: DataFrame) -> DataFrame:
    """Rows with a computed distance and their share."""
    return master.agg(F.count("distance_customer_seller_km").alias("n_with_distance"),
                      F.count(F.lit(1)).alias("n_rows")) \
        .withColumn("pct", round_clean(F.col("n_with_distance") * 100.0 / F.col("n_rows"), 2))


def target_balance(df: DataFrame, label: str, by: list[str] | None = None) -> DataFrame:
    """Label counts and shares, overall or per group (e.g. per split)."""
    keys = list(by or [])
    c = df.groupBy(*keys, label).agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0)))
    return c.withColumn("pct", round_clean(F.col("count") * 100.0 / total, 2))


def best_sellers(master: DataFrame, k: int = 20) -> DataFrame:
    """A33 + J14: top-k products by item rows, with their category (limit first, then join)."""
    c = (master.filter(F.col("product_id").isNotNull()).groupBy("product_id")
               .agg(F.count(F.lit(1)).alias("sales_count")))
    top = top_k(c, "sales_count", "product_id", k)
    # k ids, a bounded broadcast: only rows of the top products are de-duplicated
    cats = (master.join(F.broadcast(top.select("product_id")), "product_id", "left_semi")
                  .select("product_id", "product_category_name_english").distinct())
    return top.join(cats, "product_id", "left")



def popular_products(inter: DataFrame, k: int = 50) -> DataFrame:
    """Popularity baseline -- products with the largest summed interactions."""
    c = inter.groupBy("product_id").agg(F.sum("interaction_count").alias("popularity"))
    return top_k(c, "popularity", "product_id", k)
