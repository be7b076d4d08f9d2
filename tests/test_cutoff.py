"""Cutoffs by histogram refinement against a sort."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from mercato.operators import cutoff as co
from mercato.operators import split as sp


def exact(rows, order, group, position):
    out = {}
    for g in {r[group] if group is not None else () for r in rows}:
        own = sorted(((tuple(r[c] for c in order)) for r in rows if group is None or r[group] == g),
                     key=lambda k: tuple((x is not None, x.encode() if isinstance(x, str) else x if x is not None else 0) for x in k))
        n = position(len(own))
        out[(g,) if group is not None else ()] = own[n - 1] if n else None
    return out


def test_equals_a_sort(spark, monkeypatch):
    monkeypatch.setattr(co, "FEW", 7)
    monkeypatch.setattr(co, "BUCKETS", 500)
    rng = random.Random(7)
    base = dt.datetime(2020, 1, 1)
    rows = []
    for i in range(900):
        t = None if rng.random() < .05 else base + dt.timedelta(days=rng.randint(0, 40), seconds=rng.choice([0, 0, 5, 86399]), microseconds=rng.choice([0, 1]))
        s = rng.choice([None, "", "a", "ab", "abc", "abcd", "é", "日本", f"abc{rng.randint(0, 9)}", f"z{rng.random()}"])
        rows.append((t, s, rng.choice([None, -2**40, 0, 3, 2**62, rng.randint(-9, 9)]), rng.choice(["x", "x", "x", "y", None]),
                     None if rng.random() < .1 else dt.date(2020, 1, 1) + dt.timedelta(days=rng.randint(-500, 9)), i))
    df = spark.createDataFrame(rows, "t timestamp_ntz, s string, n long, g string, d date, i int").repartition(5)
    names = df.columns
    df = df.coalesce(1).cache()
    for order, group, positions in ((["t", "i"], None, (0, 1)), (["s", "i"], "g", (.8,)), (["n", "s"], None, (.5, .9)), (["d", "t", "i"], None, (.1, 1)),
                                    (["s"], None, (.3,))):
        for share in positions:
            for position in (lambda n: min(n, int(n * share + 0.999)),):
                got = dict(co.cutoffs(df, order, [group] if group else [], position))
                at = [names.index(c) for c in order]
                assert got == exact(rows, at, names.index(group) if group else None, position), (order, group)


def test_splits_move_and_sort_no_row(spark):
    df = spark.range(5000).select(F.col("id"), (F.col("id") % 7).cast("string").alias("label"),
                                  F.timestamp_add("HOUR", F.col("id") % 900, F.lit(dt.datetime(2021, 1, 1)).cast("timestamp_ntz")).alias("t"))
    t = sp.temporal_split(df, ["t", "id"], 0.8)
    s = sp.stratified_split(df, "id", "label", 0.2)
    for out in (t, s):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Exchange range" not in plan and "Exchange hash" not in plan and "Sort" not in plan
    assert t.filter("split = 'train'").count() == 4000
    train, test = (t.filter(F.col("split") == x).agg(F.min(F.struct("t", "id")), F.max(F.struct("t", "id"))).first() for x in ("train", "test"))
    assert tuple(train[1]) < tuple(test[0])
    by = {(r["label"], r["split"]): r["count"] for r in s.groupBy("label", "split").count().collect()}
    n = {r["label"]: r["count"] for r in df.groupBy("label").count().collect()}
    assert all(by[x, "test"] == int(n[x] * 0.2 + 0.5) for x in n)


def test_many_groups_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(co, "MAX_GROUPS", 5)
    with pytest.raises(ValueError):
        co.cutoffs(spark.range(20).withColumn("g", F.col("id")), ["id"], ["g"], lambda n: 1)
