"""ETL: geo per zip, dimension enrichment, per-order pre-aggregates, item-grain master.

Facts are pre-aggregated to one row per order *before* they are joined (payments,
reviews), so the item-grain master never fans out, and every aggregate here is a
partial (map-side combined) aggregate: a hot key costs one buffer per task, never
a gathered group.  Dimension joins are plain equi-joins; Spark broadcasts a side
only when its measured size is under ``spark.sql.autoBroadcastJoinThreshold``
(planner statistics, re-checked at runtime by AQE) and uses a sort-merge join
otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.common import latest_non_null, modal
from ..functions.geo import haversine_km
from .sequence import pin

ORDER_COLS = ["order_id", "customer_id", "order_status", "order_purchase_timestamp",
              "order_approved_at", "order_delivered_carrier_date",
              "order_delivered_customer_date", "order_estimated_delivery_date"]
ORDER_TS_COLS = ORDER_COLS[3:]
PRODUCT_COLS = ["product_category_name", "product_weight_g", "product_length_cm",
                "product_height_cm", "product_width_cm", "product_photos_qty"]


def geo_by_zip(geolocation: DataFrame) -> DataFrame:
    """A1: one row per zip prefix: mean coordinates, modal city and state."""
    z = "geolocation_zip_code_prefix"
    return (geolocation.filter(F.col(z).isNotNull())
            .groupBy(z)
            .agg(F.avg("geolocation_lat").alias("geolocation_lat"),
                 F.avg("geolocation_lng").alias("geolocation_lng"),
                 modal("geolocation_city").alias("geolocation_city"),
                 modal("geolocation_state").alias("geolocation_state")))


def attach_geo(df: DataFrame, geo_zip: DataFrame, role: str) -> DataFrame:
    """J1/J2 + P1: left-join zip geography, renamed with the role prefix.  The
    join strategy is left to the optimiser, which knows the size of the per-zip table."""
    g = geo_zip.select(
        F.col("geolocation_zip_code_prefix").alias("_zip"),
        F.col("geolocation_lat").alias(f"{role}_lat"),
        F.col("geolocation_lng").alias(f"{role}_lng"),
        F.col("geolocation_city").alias(f"{role}_geo_city"),
        F.col("geolocation_state").alias(f"{role}_geo_state"))
    return df.join(g, df[f"{role}_zip_code_prefix"] == g["_zip"], "left").drop("_zip")


def payments_by_order(payments: DataFrame) -> DataFrame:
    """A3: payment count, modal type, max installments, total value per order."""
    return (payments.filter(F.col("order_id").isNotNull())
            .groupBy("order_id")
            .agg(F.count("payment_sequential").alias("payment_count"),
                 modal("payment_type").alias("payment_type_main"),
                 F.max("payment_installments").alias("payment_installments_max"),
                 # money added exactly: the total doesn't depend on the order in which rows meet
                 F.coalesce(F.sum(F.col("payment_value").try_cast("decimal(30,8)")).cast("double"), F.lit(0.0)).alias("payment_value_total")))


def reviews_by_order(reviews: DataFrame) -> DataFrame:
    """Latest (by answer time, falling back to creation time) non-null score,
    title and message -- each skipping nulls independently -- and the mean score.  Where the messages
    stand apart (``message_id``) the order gets its message's id; ``with_messages`` fetches the text."""
    ts = "review_answer_timestamp" if "review_answer_timestamp" in reviews.columns \
        else "review_creation_date"
    order = (ts, "review_id")
    return (reviews.filter(F.col("order_id").isNotNull())
            .groupBy("order_id")
            .agg(latest_non_null("review_score", *order).alias("review_score"),
                 F.avg("review_score").alias("review_score_mean"),
                 latest_non_null("review_comment_title", *order).alias("review_title"),
                 latest_non_null("message_id", *order).alias("message_id") if "message_id" in reviews.columns
                 else latest_non_null("review_comment_message", *order).alias("review_message")))


def with_messages(df: DataFrame, messages: DataFrame) -> DataFrame:
    """``review_message`` in the place of ``message_id``: the last join, so that no later shuffle carries a text.
    Rows without a message are spread over the tasks by their order; the id is unique in ``messages``, so a
    job that doesn't read the text doesn't run the join."""
    own = df.withColumn("_spread", F.when(F.col("message_id").isNull(), F.xxhash64("order_id")).otherwise(0))
    texts = messages.filter("message_id is not null").withColumn("_no_spread", F.col("message_id").bitwiseXOR(F.col("message_id")))
    keys = (own["message_id"] == texts["message_id"]) & (own["_spread"] == texts["_no_spread"])
    return own.join(texts, keys, "left").select(*["review_message" if c == "message_id" else own[c] for c in df.columns])


def with_distance(master: DataFrame) -> DataFrame:
    """Customer-seller great-circle km (NULL unless all four coordinates exist)."""
    return master.withColumn("distance_customer_seller_km",
                             haversine_km("customer_lat", "customer_lng", "seller_lat", "seller_lng"))


def places(t: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(geo per zip, sellers with geo), written once: the planner then knows their sizes, and moves the items and
    customers to neither where they are small."""
    geo = pin(geo_by_zip(t["geolocation"]), "geo_by_zip")
    return geo, pin(attach_geo(t["sellers"], geo, "seller"), "sellers_geo")


def placed_items(t: dict[str, DataFrame], sellers_geo: DataFrame) -> DataFrame:
    """The items with their seller's place, their product and its category.

    Seller / product / category enrichment keys all come from the item, so the left joins are applied to the narrow
    item table first (equivalent to joining them after the order->item join): the wide master is then only ever shuffled
    by order_id, the key shared by the item, payment and review joins.  A category belongs to the product, so it meets
    the products, not the items."""
    items = t["order_items"].select("order_id", "order_item_id", "product_id", "seller_id",
                                    "price", "freight_value")
    products = (t["products"].select("product_id", *PRODUCT_COLS)
                .join(t["category_translation"].select("product_category_name",
                                                       "product_category_name_english"),
                      "product_category_name", "left"))
    return (items
            .join(sellers_geo, "seller_id", "left")
            .join(products, "product_id", "left"))


def placed_orders(t: dict[str, DataFrame]) -> DataFrame:
    """The orders with their customer, who travels without the geography: the orders get that afterwards."""
    return t["orders"].select(*ORDER_COLS).join(t["customers"], "customer_id", "left")


def build_master(t: dict[str, DataFrame], partitions: int | None = None, messages_apart: bool = False,
                 at: tuple[DataFrame, DataFrame] | None = None, items: DataFrame | None = None,
                 orders: DataFrame | None = None) -> DataFrame:
    """One row per order item; orders without items keep one row of NULL item
    columns.  Column order follows the reference master table.  With ``partitions`` the rows
    come in so many partitions by ``order_id``: the orders are dealt so before the joins by
    order, which need that shuffle anyway, and all other sides follow.

    With ``messages_apart`` the reviews are read from ``review_keys``, whose messages stand in ``messages``, and
    the rows hold ``message_id`` in the place of ``review_message``: see ``with_messages``.  ``at`` are the ``places``,
    ``items`` the ``placed_items`` and ``orders`` the ``placed_orders``, where they are there already."""
    m = _joined(t, t["review_keys" if messages_apart else "reviews"], partitions, at or places(t), items, orders)
    return m.select(*(MASTER_KEY_COLS if messages_apart else MASTER_COLS))


def _joined(t: dict[str, DataFrame], reviews: DataFrame, partitions: int | None, at: tuple[DataFrame, DataFrame],
            items: DataFrame | None, orders: DataFrame | None) -> DataFrame:
    geo, sellers_geo = at
    items = placed_items(t, sellers_geo) if items is None else items
    orders = attach_geo(placed_orders(t) if orders is None else orders, geo, "customer")
    if partitions:
        orders = orders.repartition(partitions, "order_id")
    m = (orders
         .join(items, "order_id", "left")
         .join(payments_by_order(t["payments"]), "order_id", "left")
         .join(reviews_by_order(reviews), "order_id", "left"))
    return with_distance(m)


MASTER_COLS = ORDER_COLS + [
    "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state",
    "customer_lat", "customer_lng", "customer_geo_city", "customer_geo_state",
    "order_item_id", "product_id", "seller_id", "price", "freight_value",
    "seller_zip_code_prefix", "seller_city", "seller_state", "seller_lat", "seller_lng",
    "seller_geo_city", "seller_geo_state",
    *PRODUCT_COLS, "product_category_name_english",
    "payment_count", "payment_type_main", "payment_installments_max", "payment_value_total",
    "review_score", "review_score_mean", "review_title", "review_message",
    "distance_customer_seller_km"]
MASTER_KEY_COLS = ["message_id" if c == "review_message" else c for c in MASTER_COLS]


def order_grain(master: DataFrame) -> DataFrame:
    """One row per order -- its item row with the lowest number, or the single
    item-less row.  Every task keeps its lowest rows of an order before the shuffle on ``order_id``;
    a master in buckets of ``order_id`` isn't shuffled."""
    lowest = Window.partitionBy("order_id").orderBy(F.col("order_item_id").asc_nulls_last())
    return master.withColumn("_place", F.rank().over(lowest)).filter("_place = 1").drop("_place")
