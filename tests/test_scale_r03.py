"""What keeps the marketplace queries within disk, time and memory: texts travel last and are read once."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from mercato.operators import master as ms
from mercato.operators import scoring as sc
from mercato.operators import text as tx
from mercato.plans import catalog
from mercato.sources.binding import bind_marketplace
from tests.conftest import SMOKE


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def same(a, b):
    a, b = a.select(*sorted(a.columns)), b.select(*sorted(b.columns))
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_reviews_by_order_carries_no_text_through_a_shuffle(spark):
    t = bind_marketplace(spark, SMOKE)
    got = catalog.QUERIES["reviews_by_order"](spark, SMOKE)
    assert got.columns == ["order_id", "review_score", "review_score_mean", "review_title", "review_message"]
    assert same(got, catalog.round_doubles(ms.reviews_by_order(t["reviews"]), 6))
    keys = ms.reviews_by_order(t["review_keys"])
    assert "message_id" in keys.columns and not any("text" in x or "message" in x and x != "message_id" for x in keys.columns)


def test_master_with_messages_apart_is_the_master(spark):
    t = bind_marketplace(spark, SMOKE)
    got = catalog.with_messages(spark, SMOKE, ms.build_master(t, messages_apart=True))
    assert got.columns == ms.MASTER_COLS
    assert same(got, ms.build_master(t))


def test_stored_master_holds_no_texts_and_jobs_without_texts_join_none(spark):
    stored = catalog.master_keys_of(spark, SMOKE)
    assert "message_id" in stored.columns and "review_message" not in stored.columns
    whole = catalog.master_of(spark, SMOKE)
    assert whole.columns == ms.MASTER_COLS
    assert "documents" not in plan(whole.groupBy("product_id").count()) and "Join" not in plan(whole.groupBy("product_id").count())
    assert "Join" in plan(whole.select("review_message"))
    assert whole.filter("review_message is null").count() == stored.filter("message_id is null").count()


def test_messages_meet_ids_null_ids_and_unknown_ids(spark):
    rows = spark.createDataFrame([(1, 7), (1, 7), (2, None), (None, None), (3, 8), (4, 9)], "order_id long, message_id long")
    texts = spark.createDataFrame([(7, "seven"), (8, None), (None, "nobody's")], "message_id long, review_message string")
    got = sorted(((r.order_id or 0, r.review_message or "") for r in ms.with_messages(rows, texts).collect()))
    assert got == [(0, ""), (1, "seven"), (1, "seven"), (2, ""), (3, ""), (4, "")]


def test_category_joined_to_products_gives_the_items_theirs(spark):
    m = ms.build_master(bind_marketplace(spark, SMOKE))
    bad = m.filter("product_category_name_english is not null and product_category_name_english <> concat('cat_', product_category_name)")
    assert bad.isEmpty() and not m.filter("product_category_name_english is not null").isEmpty()


def test_a_text_is_lowered_once_and_cleaned_once(spark):
    rows = [(1, "RUIM e ótimo, ÓTIMO"), (2, "não PROBLEMA"), (3, None), (4, ""), (5, "Excelente recomendo atraso"), (6, "12 !?")]
    df = spark.createDataFrame(rows, "review_id long, review_text string")
    got = {r.review_id: (r.pos_hits, r.neg_hits, r.predicted_sentiment, r.confidence) for r in sc.keyword_sentiment(df).collect()}
    assert got == {1: (1, 1, "neutral", .65), 2: (0, 2, "negative", .80), 3: (0, 0, "neutral", .65), 4: (0, 0, "neutral", .65),
                   5: (2, 1, "positive", .85), 6: (0, 0, "neutral", .65)}
    assert sc.keyword_sentiment(df).columns == ["review_id", "review_text", "pos_hits", "neg_hits", "predicted_sentiment", "confidence"]
    assert plan(sc.negative_alerts(sc.keyword_sentiment(df))).count("lower(") == 1
    named = df.withColumnRenamed("review_text", "review_comment_message").withColumn("review_comment_title", F.lit(None).cast("string"))
    clean = tx.clean_reviews(named)
    assert {r.review_id: r.review_clean for r in clean.collect()} == {1: "ruim e ótimo ótimo", 2: "não problema", 5: "excelente recomendo atraso"}
    assert plan(clean).count("regexp_replace(") == 1


def test_reviews_are_dealt_over_all_tasks(spark):
    assert "RepartitionByExpression [event_id" in plan(bind_marketplace(spark, SMOKE)["reviews"])


@pytest.mark.parametrize("most", [1, 3, 1000])
def test_tokens_are_counted_in_bounded_slices(spark, most):
    tokens = [["a", "b"], None, [], ["c"] * 7, ["a"], ["b", "a", "b"]]
    batch = pa.record_batch([pa.array(range(6)), pa.array(tokens, pa.list_(pa.string()))], names=["doc_id", "tokens"])
    parts = list(tx.token_slices(iter([batch, batch.slice(0, 0)]), most))
    assert [r for p in parts for r in p.column("tokens").to_pylist()] == tokens
    size = [sum(len(t or []) for t in p.column("tokens").to_pylist()) for p in parts]
    assert all(s <= most or p.num_rows == 1 or np.count_nonzero([len(t or []) for t in p.column("tokens").to_pylist()]) == 1 for s, p in zip(size, parts))
    docs = spark.createDataFrame([(1, "aa bb aa"), (2, "bb aa"), (3, None), (4, "cc")], "review_id long, review_clean string").coalesce(1)
    got = {r.term: (r.df, r.total) for r in tx.term_stats(docs, "review_clean").collect()}
    assert got == {"aa": (2, 3), "bb": (2, 2), "cc": (1, 1), "aa bb": (1, 1), "bb aa": (2, 2)}
