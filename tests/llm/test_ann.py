"""Nearest neighbours against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from mercato.llm import ann

SCHEMA = "vec_id long, embedding array<double>, score string, row int, id string, d int, list int, asks int"


def frame(spark, rows):
    """Vectors with further columns whose names clash with those used inside."""
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "s", 1, "i", 2, 3, 4)
                                  for i, v in rows], SCHEMA).repartition(5)


def brute(rows, k, every=20):
    """(query_id, rank, vec_id, score) rows; a row is left out by its place, not by its id."""
    fine = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = []
    for at, (i, v) in enumerate(fine):
        if i % every == 0:
            own = sorted((-float((v * w).sum()), j) for place, (j, w) in enumerate(fine) if place != at and len(w) == len(v))
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(own[:k])]
    return sorted(out)


def found(spark, rows, k=5, every=20, **kw):
    got = ann.nearest_neighbours(frame(spark, rows), F.col("vec_id") % every == 0, k, **kw).collect()
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got)


def same(got, want):
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], rtol=1e-13)


def test_small_tables_are_exact_with_odd_rows(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.standard_normal(6) * rng.choice([1, 50])) for i in range(240)]
    rows += [(300 + i, rows[7][1]) for i in range(60)]                       # copies: ties go to the smaller id
    rows += [(20, rows[3][1]), (20, rows[3][1]), (40, rng.standard_normal(6))]       # repeated ids are rows of their own
    rows += [(None, rng.standard_normal(6)), (400, None), (420, [0.0] * 6), (440, [1.0, None, 0, 0, 0, 0]), (460, [float("nan")] * 6),
             (480, [float("inf")] + [1.0] * 5), (500, []), (520, [1.0, 2.0]), (521, [2.0, 1.0]), (540, [3.0])]
    same(found(spark, rows), brute(rows, 5))
    assert found(spark, rows[:0]) == []
    assert found(spark, [(20, [1.0, 2.0])]) == []                             # no candidates, no rows
    same(found(spark, [(20, [1e-200, 0.0]), (21, [1e-180, 0.0]), (22, [1e200, 1.0]), (23, [-1.0, 0])]),
         brute([(20, [1e-200, 0.0]), (21, [1e-180, 0.0]), (22, [1e200, 1.0]), (23, [-1.0, 0])], 5))


@pytest.mark.parametrize("kind", ["groups", "norms", "copies"])
def test_recall_and_scores_of_the_index(spark, monkeypatch, kind):
    monkeypatch.setattr(ann, "BLOCK", 64)                                    # lists fall into several blocks
    rng = np.random.default_rng(4)
    centers = rng.standard_normal((30, 12)) * 3
    x = centers[rng.integers(0, 30, 3000)] + rng.standard_normal((3000, 12))
    if kind == "norms":
        x *= np.exp(rng.standard_normal((3000, 1)))                           # largest products are not nearest directions
    if kind == "copies":
        x[1000:2200] = x[5]                                                   # more than a third of the rows
    rows = list(enumerate(x))
    got, want = found(spark, rows, k=10), brute(rows, 10)
    assert len(got) == len(want)
    assert len({g[:2] for g in got}) == len(got) and all(g[0] != g[2] for g in got)
    scores = {(g[0], g[2]): g[3] for g in got}
    for (q, v), s in scores.items():
        assert np.isclose(s, (x[q] * x[v]).sum(), rtol=1e-13)
    hit = len({(g[0], g[2]) for g in got} & {(w[0], w[2]) for w in want})
    assert hit / len(want) >= 0.9, hit / len(want)
    by_query = {}
    for q, r, v, s in got:
        by_query.setdefault(q, []).append((r, -s, v))
    for hits in by_query.values():
        assert [h[0] for h in hits] == list(range(1, 11)) and [h[1:] for h in hits] == sorted(h[1:] for h in hits)
    if kind == "copies":                                                      # every answer of a copy is found, in order of ids
        copies = [w for w in want if 1000 <= w[0] < 2200]
        assert [g[:3] for g in got if 1000 <= g[0] < 2200] == [w[:3] for w in copies]


def test_walk_finds_the_nearest_lists():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((4000, 16))
    x /= np.sqrt((x * x).sum(axis=1))[:, None]
    index = ann.fit_index(x, len(x), 0.0, 10)
    q = index.scaled(x[:500], False)
    ids, near = index.walk(q, 8)
    exact = np.sort(ann._distances(q, index.centers), axis=1)[:, :8]
    assert (np.diff(near, axis=1) >= 0).all() and (np.abs(near - exact) < 1e-9).mean() > 0.97
    row, at = index.place(x)
    assert set(row.tolist()) == set(range(4000))                              # every vector is in a list
    size = np.bincount(at, minlength=len(index.centers))
    assert size.max() <= 4 * size.mean()


def test_query_recall_on_the_test_table(spark):
    import __spark_entry__ as e
    d = "/root/testdata/sf0.1"
    got = e.queries()["op13_nearest_neighbours"](spark, d).collect()
    table = spark.read.parquet(f"{d}/embeddings.parquet").collect()
    ids, x = np.array([r["vec_id"] for r in table]), np.array([r["embedding"] for r in table], float)
    mine = {}
    for r in got:
        mine.setdefault(r["query_id"], set()).add(r["vec_id"])
    hit = 0
    asked = np.flatnonzero(ids % 20 == 0)
    for q in asked:
        s = x @ x[q]
        s[q] = -np.inf
        hit += len(mine[ids[q]] & set(ids[np.lexsort((ids, -s))[:20]].tolist()))
    assert len(got) == 20 * len(asked) and hit / (20 * len(asked)) >= 0.9
