"""Sparse vectors of TF-IDF weights, assembled in Arrow."""

from pyspark.sql import functions as F

from mercato.operators import text as tx

TEXTS = ["good product good price", "bad product", None, "", "zz", "late late late delivery bad product", "good price"]


def corpus(spark):
    return spark.createDataFrame([(i, "keep", t) for i, t in enumerate(TEXTS)], "review_id long, tokens string, review_clean string").repartition(3)


def test_vectors_hold_the_weights(spark):
    docs = corpus(spark)
    vocab = tx.fit_tfidf(docs.filter("review_clean IS NOT NULL"), min_df=1, max_df=1.0)
    vectors = tx.tfidf_vectors(docs, vocab)
    assert vectors.columns == ["review_id", "tokens", "review_clean", "features"]
    got = {r.review_id: r for r in vectors.collect()}
    assert len(got) == len(TEXTS) and all(r.tokens == "keep" and r.review_clean == TEXTS[i] for i, r in got.items())
    want = {}
    for r in tx.apply_tfidf(docs, vocab).collect():
        want.setdefault(r.doc_id, {})[r.term_index] = r.weight
    size = vocab.count()
    for i, r in got.items():
        assert r.features.size == size and list(r.features.indices) == sorted(want.get(i, {}))
        assert dict(zip(r.features.indices.tolist(), r.features.values.tolist())) == want.get(i, {})
    assert got[2].features.numNonzeros() == got[3].features.numNonzeros() == 0 and got[0].features.numNonzeros() > 3


def test_no_row_function_and_no_shuffle(spark):
    docs = corpus(spark)
    vocab = tx.fit_tfidf(docs, min_df=1, max_df=1.0)
    plan = tx.tfidf_vectors(docs.drop("tokens"), vocab)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "BatchEvalPython" not in plan and plan.count("Exchange") == 1      # the corpus' own


def test_empty_vocabulary_and_empty_corpus(spark):
    docs = corpus(spark)
    vocab = tx.fit_tfidf(docs, min_df=1, max_df=1.0)
    none = tx.tfidf_vectors(docs, vocab.limit(0)).collect()
    assert len(none) == len(TEXTS) and all(r.features.size == 1 and r.features.numNonzeros() == 0 for r in none)
    assert tx.tfidf_vectors(docs.limit(0), vocab).collect() == []
    again = tx.tfidf_vectors(docs.withColumn("features", F.lit(1)), vocab)                             # an old column of that name gives way
    assert again.columns.count("features") == 1 and again.count() == len(TEXTS)
