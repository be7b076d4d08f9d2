"""Bundles, batched K-means, ranked recommendations and the training jobs, on small tables."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from mercato.operators import features as fe
from mercato.operators import kmeans as km
from mercato.operators import recommend as rc
from mercato.plans import bundles as bu
from mercato.plans import models as md
from mercato.plans import train as tr
from mercato.plans.catalog import bound, master_of

SMOKE = "/root/testdata/sf0.001"
SMALL = tr.TreeParams(max_iter=3, max_depth=3)


@pytest.fixture(scope="module")
def master(spark):
    return master_of(spark, SMOKE)


# ---------------------------------------------------------------- bundles


def test_scoring_from_disk_without_training(spark, master, tmp_path, monkeypatch):
    root = f"file://{tmp_path}"
    made = md.train_bundle(spark, root, "customers", master, "data one", params=SMALL)
    monkeypatch.setattr(tr, "train_churn_ltv", None)                # from here on nothing can train
    loaded = bu.current_bundle(spark, root, "customers", "data one")
    rows = fe.customer_features(master)
    one, two = (sorted(tuple(r) for r in md.score_customers(b, rows).collect()) for b in (made, loaded))
    assert one == two and len(one) == rows.count()
    assert all(0 <= r[1] <= 1 and r[2] == ("churned" if r[1] > .5 else "active") and r[5] in ("VIP", "Premium", "Bronze") for r in one)
    assert bu.current_bundle(spark, root, "customers", "other data") is None
    # unseen categories and nulls are scored, not lost
    odd = rows.limit(3).withColumn("customer_state", F.lit("NOWHERE")).withColumn("avg_review_score", F.lit(None).cast("double"))
    assert md.score_customers(loaded, odd).count() == 3
    history = bu.metrics_history(spark, root).collect()
    assert {r["metric"] for r in history} >= {"churn_accuracy", "ltv_r2"} and {r["version"] for r in history} == {1}


def test_other_features_are_an_error(spark, master, tmp_path, monkeypatch):
    root = f"file://{tmp_path}"
    b = md.train_bundle(spark, root, "pricing", master, params=SMALL)
    items = fe.pricing_features(master)
    assert md.score_prices(b, items).count() == items.count()
    with pytest.raises(bu.BundleError, match="is a text"):
        md.score_prices(b, items.withColumn("product_weight_g", F.lit("heavy")))
    changed = [*tr.PRICING_FEATURES[1:], tr.PRICING_FEATURES[0]]
    monkeypatch.setattr(tr, "PRICING_FEATURES", changed)
    with pytest.raises(bu.BundleError, match="fitted on the features"):
        md.score_prices(b, items)
    manifest = tmp_path / "pricing" / "v1" / "manifest.json"
    m = json.loads(manifest.read_text())
    m["features"]["pricing"][0][0] = "renamed"
    manifest.write_text(json.dumps(m))
    (tmp_path / "pricing" / "v1" / ".manifest.json.crc").unlink(missing_ok=True)
    with pytest.raises(bu.BundleError, match="manifest"):
        bu.load_bundle(spark, root, "pricing")


def test_versions_are_complete_and_never_overwritten(spark, tmp_path):
    root = f"file://{tmp_path}"
    t = spark.range(3)
    with pytest.raises(bu.BundleError):
        bu.load_bundle(spark, root, "x")
    assert [bu.save_bundle(spark, root, "x", {}, {"t": t}, {"m": []}) for _ in range(2)] == [1, 2]
    (tmp_path / "x" / "v7").mkdir()                                 # a writer that died before its manifest
    assert bu.versions(spark, root, "x") == [1, 2] and bu.load_bundle(spark, root, "x").version == 2
    assert not bu._create(spark, f"{root}/x/v2/manifest.json", "{}")
    assert bu.load_bundle(spark, root, "x", 1).tables["t"].count() == 3


def test_fingerprint_follows_the_files(spark, tmp_path):
    (tmp_path / "a.parquet").write_text("one")
    first = bu.data_fingerprint(spark, str(tmp_path))
    assert first == bu.data_fingerprint(spark, str(tmp_path))
    (tmp_path / "a.parquet").write_text("another")
    assert first != bu.data_fingerprint(spark, str(tmp_path))


def test_sentiment_and_delay_train_and_score(spark, master, tmp_path):
    root = f"file://{tmp_path}"
    b = md.train_bundle(spark, root, "delay", master, params=SMALL)
    r = b.tables["metrics"].first()
    assert 0.5 <= r["accuracy"] <= 1 and 0.4 <= r["auc_roc"] <= 1 and r["train_size"] > r["test_size"]
    again = tr.train_delay(master, SMALL).metrics.first()
    assert tuple(again) == tuple(r)                                 # trained twice, the same metrics
    scored = md.score_delay(b, fe.delay_features(master))
    assert scored.count() == fe.delay_features(master).count() and scored.filter("prob_delay is null").isEmpty()
    reviews = bound(spark, SMOKE)["reviews"]
    b = md.train_bundle(spark, root, "sentiment", reviews, max_iter=15, max_features=300)
    m, out = b.tables["metrics"].first(), md.score_sentiment(b, reviews)
    assert 0.3 <= m["accuracy"] <= 1 and out.count() == m["train_size"] + m["test_size"]
    assert {r[0] for r in out.select("predicted_sentiment").distinct().collect()} <= {"positive", "negative", "neutral"}


# ---------------------------------------------------------------- K-means


def blobs(n, seed, d=3, k=4):
    rng = np.random.default_rng(seed)
    c = rng.standard_normal((k, d)) * 6
    return np.round(c[rng.integers(0, k, n)] + rng.standard_normal((n, d)), 6)


def test_kmeans_is_as_good_as_one_fit_at_a_time(spark):
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector
    x = blobs(600, 1)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, features array<double>").repartition(6)
    models = km.best_by_k(km.fit_kmeans(df, "features", [2, 3, 4, 5], restarts=6))
    vec = df.select(array_to_vector("features").alias("features")).cache()
    for m in models:
        want = min(KMeans(k=m.k, seed=s, maxIter=100).fit(vec).summary.trainingCost for s in range(3))
        assert m.inertia <= want * 1.0001 + 1e-9
        d = ((x[:, None, :] - m.centers[None]) ** 2).sum(axis=2)
        assert np.isclose(d.min(axis=1).sum(), m.inertia)
        if m.k == 4:
            got = {r["id"]: r["cluster"] for r in km.assign(df, "features", m).collect()}
            assert [got[i] for i in range(600)] == d.argmin(axis=1).tolist()
    other = df.repartition(3, "id")
    assert all(np.allclose(a.centers, b.centers) for a, b in zip(models, km.best_by_k(km.fit_kmeans(other, "features", [2, 3, 4, 5], restarts=6))))


def test_a_round_is_one_job_for_all_models(spark, monkeypatch):
    df = spark.createDataFrame([(v.tolist(),) for v in blobs(200, 5)], "features array<double>")
    passes = []
    real = km._pass
    monkeypatch.setattr(km, "_pass", lambda rows, models: passes.append(len(models)) or real(rows, models))
    models = km.fit_kmeans(df, "features", range(2, 9), restarts=10)
    assert len(models) == 70 and max(passes) == 70 and len(passes) <= 60


def test_silhouette_equals_all_distances(spark):
    x = np.vstack([blobs(200, 2), np.repeat(blobs(1, 9), 20, axis=0), [[99.0, 99, 99]]])
    df = spark.createDataFrame([(v.tolist(),) for v in x], "features array<double>").repartition(4)
    models = [km.KMeansModel(k, 0, x[:k] if k < 4 else np.vstack([x[:3], x[-1:]]), 0.0) for k in (2, 3, 4)]
    got = km.silhouettes(df, "features", models, block=64)
    away = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    for m in models:
        c = ((x[:, None, :] - m.centers[None]) ** 2).sum(axis=2).argmin(axis=1)
        s = []
        for i in range(len(x)):
            own = (c == c[i]) & (np.arange(len(x)) != i)
            if not own.any():
                s.append(0.0)
                continue
            a, b = away[i, own].mean(), min(away[i, c == o].mean() for o in set(c.tolist()) - {c[i]})
            s.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
        assert got[m.k] == pytest.approx(np.mean(s), abs=1e-9)


def test_kmeans_on_few_and_equal_rows(spark):
    same = spark.createDataFrame([([1.0, 2.0],)] * 5, "features array<double>")
    models = km.best_by_k(km.fit_kmeans(same, "features", [2, 3], restarts=2))
    assert [m.inertia for m in models] == [0, 0] and set(km.silhouettes(same, "features", models).values()) == {0.0}
    with pytest.raises(ValueError):
        km.fit_kmeans(same.limit(0), "features", [2])


# ---------------------------------------------------------------- recommendations


def test_recommendations_equal_all_scores(spark, monkeypatch):
    monkeypatch.setattr(rc, "USERS", 7)
    monkeypatch.setattr(rc, "ITEMS", 9)
    rng = np.random.default_rng(0)
    u, v = rng.standard_normal((25, 4)), rng.standard_normal((31, 4))
    v[5] = v[6]                                                     # ties go to the smaller product
    pairs = sorted({(int(a), int(b)) for a, b in zip(rng.integers(0, 25, 120), rng.integers(0, 31, 120))} | {(a, 0) for a in range(25)} | {(0, b) for b in range(31)})
    ids = spark.createDataFrame([(a, b, f"c{a}", f"p{b}", 1) for a, b in pairs], "customer_idx long, product_idx long, customer_unique_id string, product_id string, interaction_count long")
    frame = lambda m: spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(m)], "id int, features array<float>")
    u, v = u.astype(np.float32).astype(float), v.astype(np.float32).astype(float)
    got = {}
    for r in rc.recommend(frame(u), frame(v), ids, 5).collect():
        got.setdefault(r["customer_unique_id"], []).append((r["rank"], r["product_id"], r["score"]))
    for a in range(25):
        mine = {b for x, b in pairs if x == a}
        want = sorted(((-float(u[a] @ v[b]), b) for b in range(31) if b not in mine))[:5]
        own = sorted(got.get(f"c{a}", []))
        assert [(r, p) for r, p, _ in own] == [(k + 1, f"p{b}") for k, (_, b) in enumerate(want)]
    assert "c0" not in got                                          # who has bought everything
    popular = {}
    for r in rc.popular_unseen(ids, 3).collect():
        popular.setdefault(r["customer_unique_id"], []).append((r["rank"], r["product_id"]))
    n = {b: sum(1 for _, y in pairs if y == b) for b in range(31)}
    for a in range(1, 25):
        mine = {b for x, b in pairs if x == a}
        assert [p for _, p in sorted(popular[f"c{a}"])] == [f"p{b}" for b in sorted(set(n) - mine, key=lambda b: (-n[b], f"p{b}"))[:3]]


def test_last_new_product_is_left_out_and_ranked(spark):
    rows = [("a", "x", 1), ("a", "y", 2), ("a", "x", 3), ("b", "x", 1), ("c", "z", 5), ("c", "y", 5), (None, "x", 1), ("d", None, 1)]
    df = spark.createDataFrame(rows, "customer_unique_id string, product_id string, order_purchase_timestamp int")
    last, rest = rc.leave_last_out(df)
    assert sorted(map(tuple, last.collect())) == [("a", "y"), ("c", "z")]
    assert sorted(map(tuple, rest.collect())) == [("a", "x", 2), ("b", "x", 1), ("c", "y", 1)]
    top = spark.createDataFrame([("a", 2, "y", 1.0), ("a", 1, "q", 2.0), ("c", 1, "x", 1.0)], "customer_unique_id string, rank int, product_id string, score double")
    assert tuple(rc.ranking_metrics(top, last, 10, "").first()) == (2, 0.5, pytest.approx(0.5 / np.log2(3)))


def test_recommendations_depend_on_the_model(spark, master):
    one, two = (tr.train_als(master, rank=r) for r in (2, 6))
    a, b = ({(r["customer_unique_id"], r["rank"]): r["product_id"] for r in t.extras["recommendations"].collect()} for t in (one, two))
    assert set(a) == set(b) and a != b
    m = one.metrics.first()
    assert m["judged"] > 0 and 0 <= m["ndcg"] <= m["recall"] <= 1 and 0 <= m["popular_recall"] <= 1
