"""Recommendations by bounds: equal to all products, without a copy of a person for each block of items."""

import glob

import numpy as np
import pytest

from mercato.operators import recommend as rc
from mercato.operators.sequence import pin, unpin


@pytest.mark.parametrize("n, m, first, group", [(300, 900, 32, 16), (50, 20, 64, 8), (40, 5, 2, 4), (1, 300, 16, 4)])
def test_best_unseen_equals_all_products(monkeypatch, n, m, first, group):
    monkeypatch.setattr(rc, "FIRST", first)
    monkeypatch.setattr(rc, "GROUP", group)
    rng = np.random.default_rng(n + m)
    x, y = rng.normal(size=(n, 4)), rng.normal(size=(m, 4))
    y[m // 2:m // 2 + 3] = y[0]                                    # ties
    x[0] = 0                                                       # all products are 0
    seen = [rng.choice(m, rng.integers(0, m // 2 + 1), replace=False).astype(np.int64) for _ in range(n)]
    seen[-1] = np.arange(m - 2)                                    # two products left
    u, j, v = rc.best_unseen(x, seen, y, 6)
    for i in range(n):
        score = (x[i] * y).sum(axis=1)
        left = np.setdiff1d(np.arange(m), seen[i])
        want = left[np.lexsort((left, -score[left]))][:6]
        assert j[u == i].tolist() == want.tolist()
        np.testing.assert_allclose(v[u == i], score[want], rtol=1e-12)


def test_persons_are_not_copied(spark, monkeypatch):
    """Before, a person's factors and products were copied once for each block of items, and the copies shuffled."""
    monkeypatch.setattr(rc, "ITEMS", 10)
    rng = np.random.default_rng(3)
    frame = lambda f: spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(f)], "id int, features array<float>")
    ids = spark.createDataFrame([(u, i, u + 100, i + 500) for u in range(20) for i in range(u % 4)], "customer_idx long, product_idx long, customer_unique_id long, product_id long")
    ids = ids.unionByName(spark.createDataFrame([(0, i, 100, i + 500) for i in range(45)], ids.schema))
    out = rc.recommend(frame(rng.normal(size=(20, 3))), frame(rng.normal(size=(45, 3))), ids, 4)
    assert "Generate" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert out.filter("customer_unique_id > 100").groupBy("customer_unique_id").count().filter("count <> 4").count() == 0
    assert out.filter("customer_unique_id = 100").count() == 0


def test_unpin_deletes_what_pin_wrote(spark):
    df = pin(spark.range(10), "unpinned")
    folder = df.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
    assert glob.glob(f"{folder}/*.parquet")
    unpin(df)
    assert not glob.glob(f"{folder}*")
