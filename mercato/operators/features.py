"""The six task datasets (A5-A13, F2-F10), one grain each.

All are ``groupBy(key).agg(...)`` jobs: one shuffle on the grain key with
map-side partial aggregation.  Columns that are constant per order (order and
payment attributes) are carried with ``first(ignorenulls)``, which is exact for
constants and needs no ordering.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.common import flag, modal, sum0
from ..functions.dates import days_between, with_date_parts
from .master import order_grain
from .reports import delivered

CHURN_THRESHOLD_DAYS = 120


def _first(c: str):
    return F.first(c, ignorenulls=True).alias(c)


def delay_features(master: DataFrame) -> DataFrame:
    """A5: one row per delivered order: order attributes, item aggregates, target
    ``is_delayed`` (strictly late) and purchase-time features."""
    d = delivered(master)
    firsts = ["order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
              "order_delivered_customer_date", "order_estimated_delivery_date", "customer_id",
              "customer_state", "customer_city", "customer_zip_code_prefix",
              "payment_value_total", "payment_type_main", "payment_installments_max"]
    means = ["product_length_cm", "product_height_cm", "product_width_cm", "product_photos_qty",
             "customer_lat", "customer_lng", "seller_lat", "seller_lng",
             "distance_customer_seller_km"]
    f = d.groupBy("order_id").agg(
        *[_first(c) for c in firsts],
        F.count("order_item_id").alias("num_items"),
        sum0("price").alias("price"),
        sum0("freight_value").alias("freight_value"),
        modal("seller_id").alias("seller_id"),
        modal("seller_state").alias("seller_state"),
        modal("product_id").alias("product_id"),
        modal("product_category_name_english").alias("product_category_name_english"),
        sum0("product_weight_g").alias("product_weight_g"),
        *[F.avg(c).alias(c) for c in means])
    f = f.withColumn("delivery_delay_days", days_between("order_estimated_delivery_date",
                                                         "order_delivered_customer_date"))
    f = f.withColumn("is_delayed", flag(F.col("delivery_delay_days") > 0))
    f = with_date_parts(f, "order_purchase_timestamp")
    return f.withColumns({
        "promised_delivery_days": days_between("order_purchase_timestamp",
                                               "order_estimated_delivery_date"),
        # volume of the mean dimensions, not the mean of volumes
        "product_volume_cm3": F.col("product_length_cm") * F.col("product_height_cm")
                              * F.col("product_width_cm"),
        "same_state": flag(F.col("customer_state") == F.col("seller_state")),
    })


def ref_date(master: DataFrame) -> DataFrame:
    """The latest purchase timestamp (one row)."""
    return master.agg(F.max("order_purchase_timestamp").alias("ref_date"))


def products_per_customer(master: DataFrame) -> DataFrame:
    """Distinct products per person (item grain)."""
    return (master.filter(F.col("customer_unique_id").isNotNull())
                  .groupBy("customer_unique_id")
                  .agg(F.countDistinct("product_id").alias("num_unique_products")))


def _earliest(c: str):
    """Attribute of the person's earliest order carrying a value (skip nulls)."""
    return F.min_by(F.col(c), F.when(F.col(c).isNotNull(),
                                     F.struct("order_purchase_timestamp", "order_id"))).alias(c)


def customer_features(master: DataFrame) -> DataFrame:
    """A7 (+J10, F8, F9): RFM, churn flag and LTV target per person."""
    og = order_grain(master).filter(F.col("customer_unique_id").isNotNull())
    per = og.groupBy("customer_unique_id").agg(
        F.countDistinct("order_id").alias("num_orders"),
        F.min("order_purchase_timestamp").alias("first_purchase_date"),
        F.max("order_purchase_timestamp").alias("last_purchase_date"),
        sum0("payment_value_total").alias("total_spent"),
        _earliest("customer_state"), _earliest("customer_city"),
        _earliest("customer_zip_code_prefix"),
        modal("product_category_name_english").alias("favorite_category"),
        F.avg("review_score").alias("avg_review_score"))
    per = (per.join(products_per_customer(master), "customer_unique_id", "left")
              .withColumn("num_unique_products", F.coalesce(F.col("num_unique_products"), F.lit(0))))
    per = per.crossJoin(F.broadcast(ref_date(master)))     # one row
    per = per.withColumns({
        "recency_days": days_between("last_purchase_date", "ref_date"),
        "customer_lifetime_days": days_between("first_purchase_date", "last_purchase_date")})
    per = per.withColumns({
        "frequency_orders_per_day": F.col("num_orders") / (F.col("customer_lifetime_days") + 1),
        "avg_order_value": F.try_divide(F.col("total_spent"), F.col("num_orders")),
        "is_churn": flag(F.col("recency_days") > CHURN_THRESHOLD_DAYS),
        "ltv": F.col("total_spent")})
    return per.select(
        "customer_unique_id", "num_orders", "first_purchase_date", "last_purchase_date",
        "total_spent", "customer_state", "customer_city", "customer_zip_code_prefix",
        "favorite_category", "avg_review_score", "num_unique_products", "recency_days",
        "customer_lifetime_days", "frequency_orders_per_day", "avg_order_value", "is_churn", "ltv")


def sentiment_label(score) -> F.Column:
    """1-2 negative, 3 neutral, anything else (incl. NULL) positive."""
    s = F.col(score) if isinstance(score, str) else score
    return (F.when(s <= 2, "negative").when(s == 3, "neutral").otherwise("positive"))


def with_comment(reviews: DataFrame) -> DataFrame:
    """Reviews having a message."""
    return reviews.filter(F.col("review_comment_message").isNotNull())


def sentiment_dataset(reviews: DataFrame) -> DataFrame:
    """commented reviews with a 3-way sentiment label."""
    return with_comment(reviews).select(
        "review_id", "order_id", "review_score", "review_comment_title", "review_comment_message",
        sentiment_label("review_score").alias("sentiment"))


def interactions(master: DataFrame) -> DataFrame:
    """A9 (+P5): item rows per (person, product)."""
    return (master.select("customer_unique_id", "product_id", "order_id").dropna("any")
                  .groupBy("customer_unique_id", "product_id")
                  .agg(F.count("order_id").alias("interaction_count")))


def interaction_summary(inter: DataFrame) -> DataFrame:
    """A10: persons, products, pairs, largest count.

    Persons and products are told apart by an aggregate each, of one narrow column: two distinct counts in one aggregate would
    copy every pair.  Both take the largest count, so that Spark reads one shuffle of the pairs for both."""
    largest = F.max("interaction_count").alias("_max")
    persons = inter.groupBy("customer_unique_id").agg(F.count(F.lit(1)).alias("_n"), largest) \
        .agg(F.count("customer_unique_id").alias("num_customers"), F.sum("_n").alias("_pairs"), F.max("_max").alias("_by_person"))
    products = inter.groupBy("product_id").agg(largest) \
        .agg(F.count("product_id").alias("num_products"), F.max("_max").alias("_by_product"))
    return persons.crossJoin(F.broadcast(products)).select(                            # one row each
        "num_customers", "num_products", F.coalesce("_pairs", F.lit(0).cast("long")).alias("num_interactions"),
        F.greatest("_by_person", "_by_product").alias("max_interaction_count"))


PRICING_COLS = ["order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value",
                "product_category_name_english", "product_weight_g", "product_length_cm",
                "product_height_cm", "product_width_cm", "product_photos_qty", "seller_state",
                "order_purchase_timestamp"]


def pricing_features(master: DataFrame) -> DataFrame:
    """A11 (+P2, P6, J11, J12): item-grain pricing rows with product demand and
    category mean price.  Both are aggregate-then-join (skew-safe) rather than
    windows: a hot product or category is reduced map-side before the shuffle."""
    p = master.select(*PRICING_COLS).dropna(subset=["price", "product_id"])
    p = p.withColumn("product_volume_cm3", F.col("product_length_cm") * F.col("product_height_cm")
                     * F.col("product_width_cm"))
    p = with_date_parts(p, "order_purchase_timestamp", ("year", "month", "quarter"))
    demand = p.groupBy("product_id").agg(F.count(F.lit(1)).alias("product_demand_count"))
    cat = (p.filter(F.col("product_category_name_english").isNotNull())
            .groupBy("product_category_name_english").agg(F.avg("price").alias("category_avg_price")))
    return (p.join(demand, "product_id", "left")
             .join(cat, "product_category_name_english", "left")
             .select(*PRICING_COLS, "product_volume_cm3", "purchase_year", "purchase_month",
                     "purchase_quarter", "product_demand_count", "category_avg_price"))


def seller_delay_rate(delay: DataFrame) -> DataFrame:
    """Share of late orders credited to each order's modal seller."""
    return (delay.filter(F.col("seller_id").isNotNull()).groupBy("seller_id")
                 .agg(F.avg("is_delayed").alias("delay_rate")))


def distinct_counts(df: DataFrame, key: str, columns: dict[str, str]) -> DataFrame:
    """Rows (key, one count a column) with the number of distinct non-null values by key.

    Each column is a two-level aggregate of its own (values first, then their number), narrow and combined in
    every task; several distinct counts in one aggregate would copy every row once a column."""
    out = df.select(key).distinct()
    for column, name in columns.items():
        own = df.select(key, F.col(column).alias("_v")).filter("_v is not null").groupBy(key, "_v").agg(F.lit(1).alias("_one")) \
            .groupBy(key).agg(F.count(F.lit(1)).alias(name))
        out = out.join(own, key, "left").withColumn(name, F.coalesce(name, F.lit(0).cast("long")))
    return out


def seller_features(master: DataFrame, delay: DataFrame | None = None) -> DataFrame:
    """A12 (+J13): seller profile; ``avg_order_value`` is the mean item price and the
    review mean is weighted by item rows (reference semantics)."""
    if delay is None:
        delay = delay_features(master)
    rows = master.filter(F.col("seller_id").isNotNull())
    distinct = distinct_counts(rows, "seller_id", {"order_id": "num_orders", "product_id": "num_unique_products",
                                                   "customer_state": "num_states_served", "customer_id": "num_customers"})
    s = (rows.groupBy("seller_id").agg(
        sum0("price").alias("total_revenue"),
        F.avg("price").alias("avg_order_value"),
        F.avg("freight_value").alias("avg_freight"),
        modal("product_category_name_english").alias("main_category"),
        F.avg("review_score").alias("avg_review_score"),
        F.first("seller_state", ignorenulls=True).alias("seller_state"),
        F.avg("seller_lat").alias("seller_lat"),
        F.avg("seller_lng").alias("seller_lng")))
    return (s.join(distinct, "seller_id").join(seller_delay_rate(delay), "seller_id", "left")
             .withColumn("delay_rate", F.coalesce(F.col("delay_rate"), F.lit(0.0))).select(
                 "seller_id", "num_orders", "total_revenue", "avg_order_value", "avg_freight", "num_unique_products", "num_states_served",
                 "num_customers", "main_category", "avg_review_score", "seller_state", "seller_lat", "seller_lng", "delay_rate"))
