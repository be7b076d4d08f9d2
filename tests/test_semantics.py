"""Unit frames, one per semantics rule (ties, nulls, strict bounds, ...)."""

import datetime as dt

from pyspark.sql import functions as F

from mercato.functions.common import flag, latest_non_null, modal, round_clean, sum0
from mercato.functions.dates import days_between
from mercato.functions.geo import haversine_km
from mercato.functions.text import clean_text, review_text
from mercato.operators import evaluate as ev
from mercato.operators import features as fe
from mercato.operators import prep as pp
from mercato.operators import scoring as sc
from mercato.operators import split as sp
from mercato.operators.sequence import exact_sequence
from mercato.operators.stats import column_quantiles, exact_quantiles


def test_modal_ties_and_all_null(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (1, "a"), (1, "c"), (2, None), (2, None)],
                               "k int, v string")
    got = dict(df.groupBy("k").agg(modal("v").alias("m")).collect())
    assert got == {1: "a", 2: None}


def test_latest_non_null_per_column(spark):
    t = dt.datetime
    df = spark.createDataFrame([
        (1, 10, 5, "old title", t(2020, 1, 1)),
        (1, 11, 3, None, t(2020, 1, 2)),            # newest has no title
        (1, 12, 1, "no time", None),                # null timestamp sorts lowest
        (2, 20, 4, "x", t(2020, 1, 1)),
        (2, 21, 2, "y", t(2020, 1, 1)),             # equal time: higher id wins
    ], "order_id int, review_id int, score int, title string, ts timestamp_ntz")
    got = {r[0]: (r[1], r[2]) for r in df.groupBy("order_id").agg(
        latest_non_null("score", "ts", "review_id"), latest_non_null("title", "ts", "review_id")).collect()}
    assert got == {1: (3, "old title"), 2: (2, "y")}


def test_sum_of_all_null_is_zero(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 2.5)], "k int, v double")
    assert dict(df.groupBy("k").agg(sum0("v")).collect()) == {1: 0.0, 2: 2.5}


def test_strict_late_and_day_fractions(spark):
    t = dt.datetime
    df = spark.createDataFrame([(t(2020, 1, 1), t(2020, 1, 1)), (t(2020, 1, 1), t(2020, 1, 1, 0, 0, 0, 1)),
                                (t(2020, 1, 1), None), (t(2020, 1, 1), t(2020, 1, 2, 12))],
                               "est timestamp_ntz, dlv timestamp_ntz")
    rows = df.select(days_between("est", "dlv").alias("d"), flag(days_between("est", "dlv") > 0).alias("late")) \
        .collect()
    assert [r.late for r in rows] == [0, 1, 0, 0] or [r.late for r in rows] == [0, 1, 0, 1]
    assert rows[3].d == 1.5 and rows[3].late == 1 and rows[2].d is None


def test_haversine_null_and_value(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 1.0), (None, 0.0, 0.0, 1.0)], "a double, b double, c double, d double")
    r = df.select(haversine_km("a", "b", "c", "d").alias("km")).collect()
    assert abs(r[0].km - 111.195) < 0.01 and r[1].km is None


def test_clean_text_rules(spark):
    df = spark.createDataFrame([("ÓTIMO!! Chegou 2 dias antes", None), ("1234", None),
                                ("a b", "Título"), ("NA", None)], "m string, t string")
    out = [r.c for r in df.select(clean_text(review_text(F.col("t"), F.col("m"))).alias("c")).collect()]
    assert out == ["ótimo chegou dias antes", "", "título a b", "na"]


def test_round_clean_half(spark):
    df = spark.createDataFrame([(16.6503125,), (2.675,)], "x double")
    # binary-value rounding, identical to the SQL engines (not the decimal-text rounding of round())
    assert [r[0] for r in df.select(round_clean("x", 6)).collect()] == [16.650312, 2.675]


def test_exact_sequence_matches_row_number_with_hot_key(spark):
    # one key holds most rows: numbering must still be exact and restart per key
    rows = [(1, i) for i in range(3000)] + [(k, i) for k in range(2, 50) for i in range(3)]
    df = spark.createDataFrame(rows, "k int, v int").repartition(7)
    got = exact_sequence(df, ["v"], ["k"], "n").collect()
    assert all(r.n == r.v + 1 for r in got) and len(got) == len(rows)
    glob = exact_sequence(df, ["k", "v"], [], "g").orderBy("g").collect()
    assert [r.g for r in glob] == list(range(1, len(rows) + 1))


def test_exact_quantiles_linear(spark):
    df = spark.createDataFrame([(x,) for x in [1.0, 2.0, 3.0, 4.0, None]], "x double")
    q = exact_quantiles(df, "x", [0.25, 0.5, 0.75]).first()
    assert (q.q_0, q.q_1, q.q_2) == (1.75, 2.5, 3.25)
    cq = {r.column_name: r.q_0 for r in column_quantiles(df.withColumn("y", F.col("x") * 2), ["x", "y"], [0.5])
          .collect()}
    assert cq == {"x": 2.5, "y": 5.0}


def test_temporal_split_sizes(spark):
    for n in (5, 101):
        df = spark.createDataFrame([(i, i // 3) for i in range(n)], "id int, day int")
        s = sp.temporal_split(df, ["day", "id"], 0.8)
        tr = s.filter(F.col("split") == "train").count()
        assert tr == int(0.8 * n) and s.count() == n
        assert s.filter(F.col("split") == "train").agg(F.max("id")).first()[0] < \
            s.filter(F.col("split") == "test").agg(F.min("id")).first()[0]


def test_churn_split_falls_back_when_train_single_class(spark):
    df = spark.createDataFrame([(i, dt.datetime(2020, 1, 1 + i), 1 if i < 8 else 0) for i in range(10)],
                               "customer_unique_id int, last_purchase_date timestamp_ntz, is_churn int")
    s = sp.churn_split(df)
    train_labels = {r[0] for r in s.filter(F.col("split") == "train").select("is_churn").distinct().collect()}
    assert train_labels == {0, 1}


def test_stratified_split_counts(spark):
    df = spark.createDataFrame([(i, "a" if i % 3 else "b") for i in range(300)], "id int, y string")
    s = sp.stratified_split(df, "id", "y", 0.2, 42)
    got = {(r.y, r.split): r["count"] for r in s.groupBy("y", "split").count().collect()}
    assert got[("a", "test")] == 40 and got[("b", "test")] == 20


def test_label_map_unseen_is_minus_one(spark):
    train = spark.createDataFrame([("b",), ("a",), (None,)], "c string")
    m = pp.fit_label_map(pp.fill_unknown(train, ["c"]), "c")
    assert {r.value: r.code for r in m.collect()} == {"a": 0, "b": 1, "unknown": 2}
    new = spark.createDataFrame([("zzz",), ("b",)], "c string")
    assert [r.c for r in pp.apply_label_map(new, "c", m).orderBy("c").collect()] == [-1, 1]


def test_standardize_population_std_and_zero_variance(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, z double")
    out = pp.standardize(df, ["x", "z"]).orderBy("x").collect()
    assert [r.x for r in out] == [-1.0, 1.0] and [r.z for r in out] == [0.0, 0.0]


def test_elasticity_optimum(spark):
    df = spark.createDataFrame([(1, 100.0, 50.0)], "product_id int, base_price double, demand double")
    curve = sc.elasticity_curve(df)
    assert curve.count() == 20
    best = sc.optimal_price(curve).first()
    assert best.optimal_point == 13 and abs(best.optimal_price - (70 + 13 * 60 / 19)) < 1e-9
    assert curve.filter(F.col("point") == 19).first().price == 130.0


def test_metrics(spark):
    df = spark.createDataFrame([(1, 1, 0.9), (0, 1, 0.8), (1, 0, 0.3), (0, 0, 0.1), (1, 1, 0.8)],
                               "y int, p int, s double")
    m = ev.binary_metrics(df, "y", "p").first()
    assert (m.tp, m.fp, m.tn, m.fn) == (2, 1, 1, 1) and abs(m.f1_score - 2 / 3) < 1e-12
    auc = ev.roc_auc(df, "y", "s").first().auc_roc
    # pos {0.9, 0.3, 0.8} x neg {0.8, 0.1}: 1 + 1 + 0 + 1 + 0.5 (tie) + 1
    assert abs(auc - 4.5 / 6) < 1e-12
    r = ev.regression_metrics(spark.createDataFrame([(0.0, 1.0), (2.0, 2.0)], "y double, p double"),
                              "y", "p").first()
    assert r.mape == 0.0 and r.mae == 0.5


def test_keyword_and_heuristics(spark):
    df = spark.createDataFrame([("Excelente, recomendo!",), ("Ruim, não gostei",), ("ok",)], "review_text string")
    out = [r.predicted_sentiment for r in sc.keyword_sentiment(df).collect()]
    assert out == ["positive", "negative", "neutral"]
    c = spark.createDataFrame([(0.0, 10.0, 2), (400.0, 300.0, 1)],
                              "customer_lifetime_days double, avg_order_value double, num_orders int")
    hc = [r.prob_churn for r in sc.heuristic_churn(c).collect()]
    assert hc == [0.95, 0.1]
    seg = [r.segment for r in sc.ltv_segment(sc.heuristic_ltv(c)).collect()]
    assert seg == ["Bronze", "Premium"]


def test_sentiment_label_null_is_positive(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (4,), (None,)], "s int")
    assert [r[0] for r in df.select(fe.sentiment_label("s")).collect()] == \
        ["negative", "negative", "neutral", "positive", "positive"]


def test_decision_rules(spark):
    df = spark.createDataFrame([(1, 0.7), (2, 0.5)], "id int, p double")
    rb = [r.risk_band for r in sc.risk_band(df, "p").orderBy("id").collect()]
    cs = sc.churn_status(df, "p").orderBy("id").collect()
    assert rb == ["high", "low"] and [r.churn_status for r in cs] == ["churned", "active"]
    assert abs(cs[0].retention - 0.3) < 1e-12 and len(cs[0].actions) == 3
    pb = sc.price_bands(spark.createDataFrame([(100.0,)], "base_price double")).first()
    assert abs(pb.competitive_price - 90.0) < 1e-9 and abs(pb.premium_price - 115.0) < 1e-9
    hp = sc.heuristic_price(spark.createDataFrame(
        [(1000.0, 5000.0, 15.0, 3.0, 50)],
        "product_weight_g double, product_volume_cm3 double, freight_value double, product_photos_qty double, "
        "product_demand_count int")).first().base_price
    assert abs(hp - (50 + 5 + 30 + 15) * 1.05) < 1e-9
    fq = sc.scoring_frequency(spark.createDataFrame([(3, 0.0), (4, 2.0)],
                                                    "num_orders int, customer_lifetime_days double")).collect()
    assert [r.frequency_orders_per_day for r in fq] == [3.0, 2.0]


def test_recommendations_take_first_categories_and_top_items(spark):
    t = dt.datetime
    m = spark.createDataFrame([
        (1, "toys", 10, t(2020, 1, 1)), (1, "books", 11, t(2020, 2, 1)), (1, "garden", 12, t(2020, 3, 1)),
        (2, "toys", 10, t(2020, 1, 5)), (2, "toys", 13, t(2020, 1, 6)), (3, "books", 11, t(2020, 1, 1)),
    ], "customer_unique_id int, product_category_name_english string, product_id int, "
       "order_purchase_timestamp timestamp_ntz")
    rec = sc.recommend_by_category(m).collect()
    cats1 = {(r.category_rank, r.category) for r in rec if r.customer_unique_id == 1}
    assert cats1 == {(1, "toys"), (2, "books")}
    toys = {(r.item_rank, r.item) for r in rec if r.customer_unique_id == 2}
    assert toys == {(1, "10"), (2, "13")}


def test_io_roundtrip(spark, tmp_path):
    from mercato.sources import io
    df = spark.createDataFrame([("o1", "2020-01-02 03:04:05", "NA"), ("o2", "not a date", "x")],
                               "order_id string, order_purchase_timestamp string, note string")
    out = io.coerce_timestamps(io.normalize_nulls(df), ["order_purchase_timestamp"]).orderBy("order_id").collect()
    assert out[0].order_purchase_timestamp == dt.datetime(2020, 1, 2, 3, 4, 5) and out[0].note is None
    assert out[1].order_purchase_timestamp is None
    io.write_table(df, str(tmp_path), "t")
    assert io.read_table(spark, str(tmp_path), "t").count() == 2
    import pytest
    with pytest.raises(io.MissingTableError):
        io.read_table(spark, str(tmp_path), "absent")
    with pytest.raises(ValueError):
        io.require(df, ["order_id", "missing_col"])


def test_exact_sequence_null_keys(spark):
    # a NULL group large enough to straddle range partitions keeps one numbering
    rows = [(None, i) for i in range(500)] + [(1, i) for i in range(300)] + [(2, 0)]
    df = spark.createDataFrame(rows, "k int, v int").repartition(5)
    got = exact_sequence(df, ["v"], ["k"], "n").collect()
    assert len(got) == len(rows) and all(r.n == r.v + 1 for r in got)


def test_exact_sequence_spreads_equal_values_and_keeps_large_longs(spark):
    # nine rows in ten share one value: no partition of the written sort holds more than its share
    from mercato.operators.sequence import _PID, _numbered_copies, _sorted
    rows = [(2**53 + 2 * i + 1 if i % 3 else None, 1 if i % 10 else i) for i in range(20_000)]
    df = spark.createDataFrame(rows, "big long, v int").repartition(8)
    merging = "spark.sql.adaptive.coalescePartitions.enabled"      # would join the few small ranges of this table
    spark.conf.set(merging, "false")
    try:
        placed = _sorted(_numbered_copies(df), ["v"], [])
        assert max(r["count"] for r in placed.groupBy(_PID).count().collect()) < 6_000
    finally:
        spark.conf.unset(merging)
    got = exact_sequence(df, ["v"], [], "n").collect()
    assert sorted(r.n for r in got) == list(range(1, 20_001))
    assert sorted(str(r.big) for r in got) == sorted(str(b) for b, _ in rows)


def test_ranges_do_not_depend_on_the_order_in_which_rows_arrive(spark):
    # a task that runs again may get its rows in another order: every row has to go where it went before
    from mercato.operators.sequence import _PID, _TIE, _numbered_copies, _sorted
    rows = [(i % 3, "x" if i % 2 else f"s{i}") for i in range(4_000)]
    a = spark.createDataFrame(rows, "v int, s string").repartition(6, "s")
    b = spark.createDataFrame(rows[::-1], "v int, s string").repartition(6, "s")
    one, two = (sorted(tuple(r) for r in _numbered_copies(d).collect()) for d in (a, b))
    assert one == two and len(one) == 4_000 and _TIE in _numbered_copies(a).columns
    one, two = ({(r[_PID], r["v"], r["s"]): r["n"] for r in _sorted(_numbered_copies(d), ["v"], []).groupBy(_PID, "v", "s")
                 .agg(F.count("*").alias("n")).collect()} for d in (a, b))
    assert one == two
