"""Training jobs that save bundles, and scoring that loads them.

Scoring never trains: it takes a bundle, checks that its features are those the code asks for, and
applies its maps, medians, vocabulary and models.  ``current`` is what the registered queries use: the
newest bundle that was trained on the same data, or a new one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import features as fe
from ..operators import scoring as sc
from ..operators import text as tx
from . import train as tr
from .bundles import Bundle, append_training_metrics, current_bundle, data_fingerprint, feature_kind, load_bundle, models_root, save_bundle


def _fitted(prefix: str, maps: dict[str, DataFrame], medians: DataFrame | None) -> dict[str, DataFrame]:
    out = {f"{prefix}_map_{c}": m for c, m in maps.items()}
    return out if medians is None else {**out, f"{prefix}_medians": medians}


def _kinds(df: DataFrame, features: list[str]) -> list[list[str]]:
    return [[f, feature_kind(df, f)] for f in features]


def _importance(spark: SparkSession, pairs) -> DataFrame:
    """E5 result (at most 10 (feature, importance) pairs) as a table."""
    return spark.createDataFrame([(i + 1, n, float(v)) for i, (n, v) in enumerate(pairs)], "rank int, feature string, importance double")


def _delay_parts(master: DataFrame, params=None) -> tuple[dict, dict, dict]:
    r = tr.train_delay(master, params)
    spark = master.sparkSession
    return {"delay": r.model}, {"metrics": r.metrics, "delay_importance": _importance(spark, r.extras["importance"]),
                                **_fitted("delay", r.extras["label_maps"], r.extras["medians"])}, \
        {"delay": _kinds(fe.delay_features(master), tr.DELAY_FEATURES)}


def _customer_parts(master: DataFrame, params=None) -> tuple[dict, dict, dict]:
    r = tr.train_churn_ltv(master, params)
    spark, x = master.sparkSession, r.extras
    customers = fe.customer_features(master)
    return {"churn": r.model[0], "ltv": r.model[1]}, {
        "metrics": r.metrics, "churn_importance": _importance(spark, x["churn_importance"]), "ltv_importance": _importance(spark, x["ltv_importance"]),
        **_fitted("churn", x["churn_maps"], x["churn_medians"]), **_fitted("ltv", x["ltv_maps"], x["ltv_medians"])}, \
        {"churn": _kinds(customers, tr.CHURN_FEATURES), "ltv": _kinds(customers, tr.LTV_FEATURES)}


def _pricing_parts(master: DataFrame, params=None) -> tuple[dict, dict, dict]:
    r = tr.train_pricing(master, params)
    return {"pricing": r.model}, {"metrics": r.metrics, "pricing_importance": _importance(master.sparkSession, r.extras["importance"]),
                                  **_fitted("pricing", r.extras["label_maps"], r.extras["medians"])}, \
        {"pricing": _kinds(fe.pricing_features(master), tr.PRICING_FEATURES)}


def _sentiment_parts(reviews: DataFrame, **kw) -> tuple[dict, dict, dict]:
    r = tr.train_sentiment(reviews, **kw)
    return {"sentiment": r.model}, {"metrics": r.metrics, "vocab": r.extras["vocab"], "classes": r.extras["classes"]}, \
        {"sentiment": [["review_clean", "text"]]}


def _seller_parts(master: DataFrame, **kw) -> tuple[dict, dict, dict]:
    r = tr.cluster_sellers(master, **kw)
    return {}, {"metrics": r.metrics, **{k: r.extras[k] for k in ("k_table", "sellers", "sizes", "profile", "tiers", "centers", "medians", "scaler")}}, \
        {"sellers": [[f, "number"] for f in tr.SELLER_FEATURES]}


def _recommender_parts(master: DataFrame, **kw) -> tuple[dict, dict, dict]:
    r = tr.train_als(master, **kw)
    return {"als": r.model}, {"metrics": r.metrics, "recommendations": r.extras["recommendations"], "popular": r.extras["popular"]}, {"als": []}


#: bundle -> (table it is trained on, training)
TRAINING: dict[str, tuple[str, Callable]] = {
    "delay": ("master", _delay_parts), "customers": ("master", _customer_parts), "pricing": ("master", _pricing_parts),
    "sentiment": ("reviews_by_core", _sentiment_parts), "sellers": ("master", _seller_parts), "recommender": ("master", _recommender_parts)}


def train_bundle(spark: SparkSession, root: str, name: str, table: DataFrame, data: str = "", **kw) -> Bundle:
    """Trains on ``table``, saves a new version and adds its metrics to the history."""
    models, tables, features = TRAINING[name][1](table, **kw)
    version = save_bundle(spark, root, name, models, tables, features, data)
    bundle = load_bundle(spark, root, name, version)
    append_training_metrics(bundle, bundle.tables["metrics"], root)
    return bundle


def current(spark: SparkSession, sf_dir: str, name: str, table: Callable[[str], DataFrame]) -> Bundle:
    """The newest bundle that was trained on the files now in ``sf_dir``; trained if there is none.  ``table`` gives a
    table by name and is asked only for training."""
    root, data = models_root(spark), data_fingerprint(spark, sf_dir)
    return current_bundle(spark, root, name, data) or train_bundle(spark, root, name, table(TRAINING[name][0]), data)


def _scored(bundle: Bundle, model: str, features: list[str], rows: DataFrame, prob: str | None) -> DataFrame:
    bundle.check(model, features)
    bundle.check_types(model, rows)
    maps = {c.removeprefix(f"{model}_map_"): t for c, t in bundle.tables.items() if c.startswith(f"{model}_map_")}
    return tr.score_with_model(bundle.models[model], rows, features, maps, bundle.tables.get(f"{model}_medians"), prob)


def score_delay(bundle: Bundle, orders: DataFrame) -> DataFrame:
    """Orders (``order_id`` and the delay features) with probability, band and actions."""
    scored = _scored(bundle, "delay", tr.DELAY_FEATURES, orders.select("order_id", *tr.DELAY_FEATURES), "prob_delay")
    return sc.risk_band(scored, "prob_delay").select("order_id", "prob_delay", "risk_band", "actions")


def score_customers(bundle: Bundle, customers: DataFrame) -> DataFrame:
    """Persons with churn probability and status, expected value and segment.  Both models score the same row."""
    both = customers.select("customer_unique_id", *dict.fromkeys([*tr.CHURN_FEATURES, *tr.LTV_FEATURES]))
    rows = both.select("customer_unique_id", F.struct(*tr.LTV_FEATURES).alias("_ltv"), *tr.CHURN_FEATURES)
    churn = _scored(bundle, "churn", tr.CHURN_FEATURES, rows, "prob_churn").select("customer_unique_id", "prob_churn", "_ltv.*")
    ltv = _scored(bundle, "ltv", tr.LTV_FEATURES, churn, None).withColumnRenamed("prediction", "ltv_pred")
    return sc.ltv_segment(sc.churn_status(ltv, "prob_churn"), "ltv_pred").select(
        "customer_unique_id", "prob_churn", "churn_status", "retention", "ltv_pred", "segment")


def score_prices(bundle: Bundle, items: DataFrame) -> DataFrame:
    """Items with the model's price and the bands around it."""
    keys = ["order_id", "order_item_id", "product_id"]
    scored = _scored(bundle, "pricing", tr.PRICING_FEATURES, items.select(*keys, *tr.PRICING_FEATURES), None) \
        .withColumnRenamed("prediction", "base_price")
    return sc.price_bands(scored).select(*keys, "base_price", "competitive_price", "premium_price")


def score_sentiment(bundle: Bundle, reviews: DataFrame) -> DataFrame:
    """C5 by the model: every review with a text, its sentiment by score, the predicted one and its confidence."""
    bundle.check("sentiment", ["review_clean"])
    rows = tx.clean_reviews(fe.sentiment_dataset(reviews)).select("review_id", "sentiment", "review_clean")
    vocab, classes = bundle.tables["vocab"], bundle.tables["classes"]
    vectors = tx.tfidf_vectors(rows, vocab)
    pred = bundle.models["sentiment"].transform(vectors).withColumn("confidence", F.array_max(vector_to_array("probability")))
    names = classes.select(F.col("code").cast("double").alias("prediction"), F.col("value").alias("predicted_sentiment"))
    return pred.join(names, "prediction").select("review_id", "sentiment", "predicted_sentiment", "confidence")
