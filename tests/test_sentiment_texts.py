"""Sentiment training: texts are worked on by all cores, and only where words are needed."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from mercato.operators import split as sp
from mercato.operators import text as tx
from mercato.plans import train as tr
from mercato.sources.binding import bind_marketplace


def test_reviews_with_texts_are_dealt_over_the_cores(spark, tmp_path):
    """Before, the ids' size decided: all reviews of a small or middling table, with all their texts, were one task's."""
    at = dt.datetime(2024, 1, 1)
    spark.createDataFrame([(i, at, i % 7, "purchase") for i in range(600)], "event_id long, ts timestamp_ntz, user_id long, event_type string") \
        .coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    spark.createDataFrame([(i, f"text {i}") for i in range(40)], "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    reviews = bind_marketplace(spark, str(tmp_path))["reviews_by_core"]
    tasks = reviews.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.count("review_comment_message").alias("texts")).collect()
    assert sum(t["n"] for t in tasks) == sum(t["texts"] for t in tasks) == 600
    assert len(tasks) > spark.sparkContext.defaultParallelism / 2 or spark.sparkContext.defaultParallelism == 1


TEXTS = ["good one", "", "  ", "123 !?", "ÇÃO", "Привет", "İ", "ß", "\n\tx", None, "ñ", "日本 5"]


def test_texts_with_words_are_those_that_cleaning_keeps(spark):
    df = spark.createDataFrame([(i * 20 + j, t, m) for i, t in enumerate([None, "", "great", "7"]) for j, m in enumerate(TEXTS)] * 2,
                               "review_id long, review_comment_title string, review_comment_message string")
    kept = tx.clean_reviews(df).select("review_id").collect()
    assert sorted(tx.with_words(df).select("review_id").collect()) == sorted(kept) and 0 < len(kept) < df.count()


def test_split_by_keys_equals_split_by_rows(spark):
    df = spark.createDataFrame([(i % 90, "ab"[i % 3 == 0], "x" * i) for i in range(200)], "id long, label string, text string")
    rows = lambda d: sorted(map(tuple, d.collect()))
    assert rows(sp.stratified_split(df, "id", "label", keys=df.select("label", "id"))) == rows(sp.stratified_split(df, "id", "label"))


def test_no_text_is_written(spark, monkeypatch):
    """Before, the cleaned texts of all reviews were written to the shared folder, and cleaned once more in every pass of the split."""
    written = []
    monkeypatch.setattr(tr, "pin", lambda df, name="x", pin=tr.pin: written.append((name, df.columns)) or pin(df, name))
    words = ["good fine item", "bad late broken", "so so plain"]
    df = spark.createDataFrame([(i, i, (5, 1, 3)[i % 3], None, f"{words[i % 3]} {'abcdefgh'[i % 8] * 3}") for i in range(300)],
                               "review_id long, order_id long, review_score int, review_comment_title string, review_comment_message string")
    r = tr.train_sentiment(df, max_iter=20, max_features=50)
    m = r.metrics.first()
    assert m["accuracy"] == pytest.approx(1) and (m["train_size"], m["test_size"]) == (240, 60)
    assert r.extras["predictions"].count() == 300
    assert written and not [n for n, columns in written if {"review_clean", "review_comment_message"} & set(columns)]
