"""Model training and evaluation jobs (T1-T7, T9, E1-E8), on MLlib but for K-means.

Each job: feature table -> reference preprocessing (medians, 'unknown', sorted
codes; fitted on the whole table as the reference does) -> split -> distributed
fit -> evaluation aggregates.  Only the one-row metrics table and constant-size
artefacts (importances, vocabulary) reach the driver.

MLlib equivalents of the reference learners: gradient-boosted trees
(``GBTClassifier`` / ``GBTRegressor``: 200 iterations, depth 5-6, step 0.05,
row subsampling 0.8, feature subsampling 0.8 per node; on more than some tasks' rows grown by
histograms, ``operators/boosting.py``), multinomial logistic
regression with balanced class weights and ``regParam = 1 / (C * sum(weights))``
(the scikit-learn objective divided by the weight total), and ALS.  K-means runs all
numbers of clusters and restarts together (``operators/kmeans.py``).  Trees differ from xgboost in details (per-node column sampling, no
leaf L2 term), so tests bound metrics rather than compare them exactly.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.ml.recommendation import ALS
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import boosting as bo
from ..operators import evaluate as ev
from ..operators import features as fe
from ..operators import kmeans as km
from ..operators import prep as pp
from ..operators import recommend as rc
from ..operators import split as sp
from ..operators import text as tx
from ..operators.sequence import pin, unpin

DELAY_FEATURES = ["purchase_year", "purchase_month", "purchase_day", "purchase_weekday", "purchase_hour",
                  "purchase_quarter", "promised_delivery_days", "num_items", "price", "freight_value",
                  "payment_value_total", "payment_installments_max", "product_weight_g",
                  "product_volume_cm3", "product_photos_qty", "distance_customer_seller_km", "same_state",
                  "customer_state", "seller_state", "product_category_name_english", "payment_type_main"]
CHURN_FEATURES = ["num_orders", "num_unique_products", "frequency_orders_per_day", "avg_order_value",
                  "avg_review_score", "customer_state", "favorite_category"]
LTV_FEATURES = ["num_orders", "num_unique_products", "frequency_orders_per_day", "avg_order_value",
                "avg_review_score", "customer_lifetime_days", "customer_state", "favorite_category"]
PRICING_FEATURES = ["product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
                    "product_volume_cm3", "product_photos_qty", "freight_value", "purchase_year",
                    "purchase_month", "purchase_quarter", "product_demand_count", "category_avg_price",
                    "product_category_name_english", "seller_state"]
SELLER_FEATURES = ["num_orders", "total_revenue", "avg_order_value", "avg_freight", "num_unique_products",
                   "avg_review_score", "num_states_served", "num_customers", "delay_rate"]


@dataclass
class TreeParams:
    max_iter: int = 200
    max_depth: int = 6
    step_size: float = 0.05
    subsampling_rate: float = 0.8
    feature_subset: str = "0.8"
    seed: int = 42
    max_bins: int = 64


def _materialize(m: DataFrame) -> DataFrame:
    """A one-row metrics table as a local relation (constant size), so caches used to
    compute it can be released."""
    return m.sparkSession.createDataFrame(m.collect(), m.schema)


@dataclass
class TrainResult:
    metrics: DataFrame
    model: object = None
    extras: dict = field(default_factory=dict)


def _gbt_classifier(p: TreeParams, weight_col: str | None = None) -> GBTClassifier:
    g = GBTClassifier(featuresCol="features", labelCol="label", maxIter=p.max_iter, maxDepth=p.max_depth,
                      stepSize=p.step_size, subsamplingRate=p.subsampling_rate,
                      featureSubsetStrategy=p.feature_subset, seed=p.seed, maxBins=p.max_bins)
    if weight_col:
        g.setWeightCol(weight_col)
    return g


def _gbt_regressor(p: TreeParams) -> GBTRegressor:
    return GBTRegressor(featuresCol="features", labelCol="label", maxIter=p.max_iter, maxDepth=p.max_depth,
                        stepSize=p.step_size, subsamplingRate=p.subsampling_rate,
                        featureSubsetStrategy=p.feature_subset, seed=p.seed, maxBins=p.max_bins)


ROWS_A_TASK = 50_000
ROWS_BY_MLLIB = 200_000            # boosted by MLlib: below some 240,000 rows a tree takes either way as long


def sized(df: DataFrame) -> DataFrame:
    """Training rows in as many partitions as they fill: boosting runs a job for every level of every tree, and
    on a table of one partition's size most of such a job would be the start of its other tasks."""
    return df.coalesce(max(1, -(-df.count() // ROWS_A_TASK)))


def _boosted(estimator, data: DataFrame, params: TreeParams, weighted_by: str | None = None) -> tuple[DataFrame, object]:
    """(``data``, the model of its 'train' rows).  A table of some tasks' rows goes to MLlib and is held for the evaluation; for larger ones trees grow
    by histograms (``operators/boosting.py``), and the rows are read from where they are written."""
    def train(df: DataFrame) -> DataFrame:
        rows = df.filter(F.col("split") == "train")
        return pp.with_pos_weight(rows, weighted_by, "weight") if weighted_by else rows

    if data.count() <= ROWS_BY_MLLIB:
        data = sized(data).persist()                               # reused by fit and evaluation
        return data, estimator.fit(train(data))
    return data, bo.fit(estimator, train(data), params, "weight" if weighted_by else None)


def _split_sizes(df: DataFrame) -> DataFrame:
    return df.agg(F.sum(F.when(F.col("split") == "train", 1).otherwise(0)).cast("long").alias("train_size"),
                  F.sum(F.when(F.col("split") == "test", 1).otherwise(0)).cast("long").alias("test_size"))


def _classify(prepared: DataFrame, features: list[str], label: str, params: TreeParams,
              prefix: str = "") -> TrainResult:
    data = pp.assemble(prepared, features).withColumn("label", F.col(label).cast("double")) \
        .select("split", "label", label, "features")
    data, model = _boosted(_gbt_classifier(params, "weight"), data, params, label)
    test = data.filter(F.col("split") == "test")
    pred = pin(model.transform(test).select(label, vector_to_array("probability")[1].alias("score"),
                                            F.col("prediction").cast("int").alias("prediction")), "test_scores")
    m = ev.binary_metrics(pred, label, "prediction").drop("tp", "fp", "tn", "fn")
    m = m.crossJoin(ev.roc_auc(pred, label, "score")).crossJoin(_split_sizes(data))
    if prefix:
        m = m.select(*[F.col(c).alias(c if c.endswith("_size") else f"{prefix}{c}") for c in m.columns])
    m = _materialize(m)
    data.unpersist()
    return TrainResult(m, model, {"importance": ev.feature_importance(model, features)})


def train_delay(master: DataFrame, params: TreeParams | None = None) -> TrainResult:
    """Late-delivery classifier on the delay table, temporal 80/20 split."""
    params = params or TreeParams(max_depth=6)
    d = fe.delay_features(master).select("order_id", "order_purchase_timestamp", "is_delayed", *DELAY_FEATURES)
    d, maps, medians = pp.prepare_features(d, DELAY_FEATURES)
    d = pin(sp.temporal_split(d, ["order_purchase_timestamp", "order_id"]), "delay_prepared")
    r = _classify(d, DELAY_FEATURES, "is_delayed", params)
    r.extras.update(label_maps=maps, medians=medians)
    return r


def train_churn_ltv(master: DataFrame, params: TreeParams | None = None) -> TrainResult:
    """T2 + T3: churn classifier and LTV regressor on the customer table (temporal
    split on last purchase, stratified fallback when train has one class)."""
    params = params or TreeParams(max_depth=5)
    c = pin(sp.churn_split(pin(fe.customer_features(master), "customers")), "customer_split")
    churn_prep, churn_maps, churn_medians = pp.prepare_features(c, CHURN_FEATURES)
    churn_prep = pin(churn_prep, "churn_prepared")
    churn = _classify(churn_prep, CHURN_FEATURES, "is_churn", params, prefix="churn_")
    ltv_prep, ltv_maps, ltv_medians = pp.prepare_features(c, LTV_FEATURES)
    ltv_prep = pin(ltv_prep, "ltv_prepared")
    ltv = _regress(ltv_prep, LTV_FEATURES, "ltv", params, prefix="ltv_")
    m = _materialize(churn.metrics.crossJoin(ltv.metrics.drop("train_size", "test_size")).withColumn(
        "leakage_alarm", F.col("churn_auc_roc") > 0.95))
    return TrainResult(m, (churn.model, ltv.model), {
        "churn_importance": churn.extras["importance"], "ltv_importance": ltv.extras["importance"],
        "churn_maps": churn_maps, "churn_medians": churn_medians, "ltv_maps": ltv_maps,
        "ltv_medians": ltv_medians})


def _regress(prepared: DataFrame, features: list[str], label: str, params: TreeParams,
             prefix: str = "") -> TrainResult:
    data = pp.assemble(prepared, features).withColumn("label", F.col(label).cast("double")) \
        .select("split", "label", "features")
    data, model = _boosted(_gbt_regressor(params), data, params)
    test = data.filter(F.col("split") == "test")
    pred = pin(model.transform(test).select("label", "prediction"), "test_scores")
    m = ev.regression_metrics(pred, "label", "prediction").crossJoin(_split_sizes(data))
    if prefix:
        m = m.select(*[F.col(c).alias(c if c.endswith("_size") else f"{prefix}{c}") for c in m.columns])
    m = _materialize(m)
    data.unpersist()
    return TrainResult(m, model, {"importance": ev.feature_importance(model, features)})


def train_pricing(master: DataFrame, params: TreeParams | None = None) -> TrainResult:
    """T5: price regressor, temporal split on year*100+month."""
    params = params or TreeParams(max_depth=6)
    p = fe.pricing_features(master)
    p, maps, medians = pp.prepare_features(p, PRICING_FEATURES)
    p = p.withColumn("_ym", (F.col("purchase_year") * 100 + F.col("purchase_month")).cast("long"))
    p = pin(sp.temporal_split(p, ["_ym", "order_id", "order_item_id"]), "pricing_prepared")
    r = _regress(p, PRICING_FEATURES, "price", params)
    r.extras.update(label_maps=maps, medians=medians)
    return r


def train_sentiment(reviews: DataFrame, c: float = 1.0, max_iter: int = 1000, max_features: int = 5000
                    ) -> TrainResult:
    """T4: TF-IDF (fit on train) + multinomial logistic regression, balanced
    class weights, stratified 80/20 split.

    What needs no words (split, counts, classes) is found on ids and labels, written once.  Texts are cleaned where they are
    read, once for the vocabulary and once for the vectors, and are not written: they are most of the input's size."""
    ds = fe.sentiment_dataset(reviews)
    keys = pin(tx.with_words(ds).select("review_id", "sentiment"), "sentiment_keys")
    cleaned = tx.clean_reviews(ds).select("review_id", "sentiment", "review_clean")
    split = sp.stratified_split(cleaned, "review_id", "sentiment", 0.2, 42, keys=keys)
    split_keys = sp.stratified_split(keys, "review_id", "sentiment", 0.2, 42)
    n_train = split_keys.filter(F.col("split") == "train").count()
    n_docs = reviews.sparkSession.createDataFrame([(n_train,)], "n_docs long")
    vocab = pin(tx.fit_tfidf(split.filter(F.col("split") == "train"), max_features=max_features, n_docs=n_docs), "vocab")
    vec = tx.tfidf_vectors(split, vocab)
    classes = pp.fit_label_map(keys, "sentiment")               # sorted labels -> 0..k-1
    vec = pp.apply_label_map(vec.withColumn("_lbl", F.col("sentiment")), "_lbl", classes, "label") \
        .withColumn("label", F.col("label").cast("double")) \
        .select("review_id", "sentiment", "split", "label", "features")
    vec = sized(pin(vec, "sentiment_vectors"))                  # read from there; the learner holds its rows in blocks of its own
    train = pp.with_balanced_weights(vec.filter(F.col("split") == "train"), "sentiment", "weight")
    lr = LogisticRegression(featuresCol="features", labelCol="label", weightCol="weight", family="multinomial",
                            regParam=1.0 / (c * max(n_train, 1)), elasticNetParam=0.0, standardization=False,
                            maxIter=max_iter, tol=1e-6)
    model = lr.fit(train)
    pred = model.transform(vec).withColumn("confidence", F.array_max(vector_to_array("probability")))
    pred = pin(pred.select("review_id", "sentiment", "split", "label", "prediction", "confidence"), "sentiment_pred")
    m = _materialize(ev.multiclass_metrics(pred.filter(F.col("split") == "test"), "label", "prediction")
                     .crossJoin(_split_sizes(pred)))
    unpin(vec)
    classes = pin(classes, "sentiment_classes")
    return TrainResult(m, model, {"vocab": vocab, "classes": classes, "predictions": pred})


def top_terms(model, vocab: DataFrame, classes: DataFrame, k: int = 10) -> DataFrame:
    """The k terms with the largest coefficient per class (coefficients are a
    k x vocabulary matrix: constant size)."""
    spark = vocab.sparkSession
    mat = model.coefficientMatrix.toArray()
    rows = [(int(ci), int(ti), float(mat[ci, ti])) for ci in range(mat.shape[0]) for ti in range(mat.shape[1])]
    coef = spark.createDataFrame(rows, "code int, term_index int, coef double")
    j = coef.join(vocab.select("term", "term_index"), "term_index").join(
        classes.withColumnRenamed("value", "sentiment"), "code")
    from pyspark.sql import Window
    w = Window.partitionBy("sentiment").orderBy(F.col("coef").desc(), F.col("term"))
    return j.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k) \
        .select("sentiment", "rank", "term", "coef")


def cluster_sellers(master: DataFrame, ks=range(2, 9), restarts: int = 10, seed: int = 42) -> TrainResult:
    """T6 + T7 + E7: K-means on standardised seller features, all ``ks`` and ``restarts`` in one pass a round;
    per k the restart of lowest inertia, and the k of the best Euclidean silhouette."""
    s = pin(fe.seller_features(master), "sellers")
    medians = pp.fit_medians(s, SELLER_FEATURES)
    x = pp.impute_median(s, SELLER_FEATURES, medians)
    scaler = pin(pp.fit_scaler(x, SELLER_FEATURES), "scaler")
    x = pp.standardize(x, SELLER_FEATURES, scaler)
    data = pin(x.select("seller_id", F.array(*[F.col(c).cast("double") for c in SELLER_FEATURES]).alias("features")), "seller_vectors")
    spark = data.sparkSession
    models = km.best_by_k(km.fit_kmeans(data, "features", list(ks), restarts, seed))
    silhouettes = km.silhouettes(data, "features", models)
    table = spark.createDataFrame([(m.k, m.inertia, silhouettes[m.k]) for m in models], "k int, inertia double, silhouette double")
    model = max(models, key=lambda m: (silhouettes[m.k], -m.k))
    metrics = _materialize(data.agg(F.count(F.lit(1)).alias("num_sellers")).select(
        "num_sellers", F.lit(model.k).alias("best_k"), F.lit(silhouettes[model.k]).alias("silhouette_score"),
        F.lit(model.inertia).alias("inertia")))
    labels = pin(km.assign(data, "features", model).select("seller_id", "cluster"), "seller_clusters")
    # cluster labels on the raw (unscaled) seller table, as the profiles report raw means
    labelled = s.join(labels, "seller_id")
    from ..operators import scoring as sc
    profile = sc.cluster_profile(labelled)                      # A35 on the K-means labels
    tiers = sc.cluster_tiers(profile)                           # A36
    centers = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(model.centers)], "cluster int, center array<double>")
    return TrainResult(metrics, model, {"k_table": table, "sellers": sc.seller_tiers(labelled, tiers),
                                        "sizes": sc.cluster_sizes(labelled), "profile": profile,
                                        "tiers": tiers, "centers": centers, "medians": medians, "scaler": scaler})


def train_als(purchases: DataFrame, rank: int = 10, reg: float = 0.1, alpha: float = 1.0, seed: int = 42, k: int = 10
              ) -> TrainResult:
    """Implicit-feedback ALS on the first-appearance ids, judged by each person's last new product.

    ``purchases`` has customer_unique_id, product_id and order_purchase_timestamp.  The product that a person with
    several bought last for the first time is left out, the model is fitted on the rest and ranks, for every person, all
    products that they haven't bought; recall and NDCG at ``k`` count how often and how high it stands.  The most
    popular products of the same rest are ranked beside it (T8)."""
    last, rest = rc.leave_last_out(purchases)
    rest, last = pin(rest, "interactions_rest"), pin(last, "interactions_last")
    ids = pin(pp.index_ids(rest), "interaction_ids")
    unpin(rest)                                                    # the pairs with their ids hold the same
    # factors are written every round: what was shuffled for the rounds before isn't needed then, and goes with the driver's garbage
    als = ALS(userCol="customer_idx", itemCol="product_idx", ratingCol="interaction_count", implicitPrefs=True,
              rank=rank, regParam=reg, alpha=alpha, seed=seed, coldStartStrategy="drop", checkpointInterval=1)
    model = als.fit(sized(ids.withColumn("customer_idx", F.col("customer_idx").cast("int"))
                             .withColumn("product_idx", F.col("product_idx").cast("int"))
                             .withColumn("interaction_count", F.col("interaction_count").cast("float"))))
    top = pin(rc.recommend(model.userFactors, model.itemFactors, ids, k), "recommendations")
    popular = pin(rc.popular_unseen(ids, k), "popular")
    every = ids.select("customer_unique_id", "product_id").unionByName(last.select("customer_unique_id", "product_id"))
    metrics = every.agg(F.countDistinct("customer_unique_id").alias("num_customers"), F.countDistinct("product_id").alias("num_products"),
                        F.count(F.lit(1)).alias("num_interactions")) \
        .withColumns({"rank": F.lit(rank), "k": F.lit(k)}).crossJoin(rc.ranking_metrics(top, last, k, "")) \
        .crossJoin(rc.ranking_metrics(popular, last, k, "popular_").drop("popular_judged"))
    return TrainResult(_materialize(metrics), model, {"ids": ids, "recommendations": top, "popular": popular})


def recommender_metrics(inter: DataFrame, top_n: int = 50) -> DataFrame:
    """T8 metrics row: persons, products, pairs, size of the popularity list."""
    return fe.interaction_summary(inter).select("num_customers", "num_products", "num_interactions",
                                                F.lit(top_n).alias("top_n_products"))


def score_with_model(model, df: DataFrame, features: list[str], maps: dict, medians: DataFrame | None = None,
                     prob_col: str | None = "prob") -> DataFrame:
    """C1/C2/C3/C8 batch scoring: apply the *fitted* encoders and medians (unseen
    -> -1) then the model.  Classifiers: positive-class probability in
    ``prob_col``; regressors: ``prediction``."""
    keep = [c for c in df.columns if c not in features]
    prepared, _, _ = pp.prepare_features(df, features, maps=maps, medians=medians)
    out = model.transform(pp.assemble(prepared, features)).select(*keep, "prediction",
                                                                 *(["probability"] if prob_col else []))
    return out.withColumn(prob_col, vector_to_array("probability")[1]).drop("probability") if prob_col else out

