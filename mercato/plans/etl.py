"""ETL plan: bind/read inputs -> build the master table -> persist it (S8) -> feature and report tables.

The master is written once as parquet, in buckets of ``order_id`` (the key of the
per-order joins and aggregates downstream; ``master_table.py``), and every report / feature job reads
the written table: downstream scans then prune columns and push predicates
(e.g. ``order_status = 'delivered'``) into the parquet reader, and the lineage
back to the raw inputs is cut.  The folder lives under the cluster's shared
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from ..operators import features as fe
from ..operators import master as ms
from ..operators import prep as pp
from ..operators import reports as rp
from ..session import ensure_checkpoint_dir
from ..sources.io import write_table
from .master_table import write_master


def master_location(spark: SparkSession, sf_dir: str) -> str:
    root = ensure_checkpoint_dir(spark).rstrip("/")
    tag = hashlib.md5(f"{spark.sparkContext.applicationId}:{sf_dir}".encode()).hexdigest()[:12]
    return f"{root}/tables/master_{tag}"


def materialize_master(spark: SparkSession, tables: dict[str, DataFrame], path: str, messages_apart: bool = False) -> DataFrame:
    """Build the master table, write it in buckets of order_id, return the written table."""
    return write_master(spark, tables, path, messages_apart=messages_apart)


def run_etl(spark: SparkSession, tables: dict[str, DataFrame], out_root: str, by_month: bool = False) -> dict[str, str]:
    """The ETL sinks (master, orders, customers/sellers with geo, products,
    geo per zip, reviews).  A master ``by_month`` can be refreshed by ``master_table.refresh_months``."""
    geo = ms.geo_by_zip(tables["geolocation"])
    outs = {
        "orders_processed": tables["orders"],
        "customers_geo": ms.attach_geo(tables["customers"], geo, "customer"),
        "sellers_geo": ms.attach_geo(tables["sellers"], geo, "seller"),
        "products_processed": tables["products"],
        "geolocation_agg": geo,
        "reviews_processed": tables["reviews"],
    }
    paths = {"master": f"{out_root}/master"}
    write_master(spark, tables, paths["master"], by_month=by_month)
    for name, df in outs.items():
        paths[name] = write_table(df, out_root, name)
    return paths


def run_features(master: DataFrame, reviews: DataFrame, out_root: str, sellers: DataFrame | None = None) -> dict[str, str]:
    """Orders with their delay, the feature tables, the interaction matrix with its
    ids, the KPIs and, where ``sellers`` gives them, the sellers with clusters and tiers."""
    inter = fe.interactions(master)
    outs = {
        "orders_unique": ms.order_grain(master),
        "delivered_with_delay": rp.delivered_with_delay(master),
        "delay_features": fe.delay_features(master),
        "customer_features": fe.customer_features(master),
        "sentiment_dataset": fe.sentiment_dataset(reviews),
        "interactions": inter,
        "pricing_features": fe.pricing_features(master),
        "seller_features": fe.seller_features(master),
        "interaction_matrix": pp.index_ids(inter),
        "kpis": rp.kpis(master),
    }
    if sellers is not None:
        outs["sellers_with_clusters"] = sellers
    return {name: write_table(df, out_root, name) for name, df in outs.items()}
