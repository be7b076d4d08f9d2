"""The silhouette's blocks: their number follows the cores, so what is shuffled grows with the rows and not with their square."""

import numpy as np
import pytest

from mercato.operators import kmeans as km


def test_blocks_follow_the_cores():
    assert [km.block_count(n, 1024, 12) for n in (0, 1, 1024, 1025, 5000)] == [1, 1, 1, 2, 5]
    assert km.block_count(10_000, 1024, 12) == km.block_count(360_000, 1024, 12) == 8
    assert km.block_count(360_000, 1024, 400) == 40
    assert km.block_count(10**6, 1024, 12) == 20


@pytest.mark.parametrize("block, most", [(7, 20), (500, 100), (1024, 50_000)])
def test_silhouettes_of_few_and_many_blocks(spark, monkeypatch, block, most):
    monkeypatch.setattr(km, "MOST_IN_BLOCK", most)
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(size=(1200, 3)), rng.normal(size=(900, 3)) + 4, np.full((3, 3), 2.5)])
    df = spark.createDataFrame([(v.tolist(),) for v in x], "v array<double>").repartition(3)
    centers = np.array([[0., 0, 0], [4, 4, 4]])
    own = ((x[:, None] - centers) ** 2).sum(2).argmin(1)
    away = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    inside = np.array([away[i, own == own[i]].sum() / ((own == own[i]).sum() - 1) for i in range(len(x))])
    outside = np.array([away[i, own != own[i]].mean() for i in range(len(x))])
    want = ((outside - inside) / np.maximum(inside, outside)).mean()
    assert km.silhouettes(df, "v", [km.KMeansModel(2, 0, centers, 0.0)], block)[2] == pytest.approx(want, abs=1e-9)


def test_distances_of_two_blocks_are_made_once(monkeypatch):
    """Sums of both blocks by model and cluster from one tile each; equal rows are at distance 0, far from the origin too."""
    monkeypatch.setattr(km, "TILE", (16, 32))
    rng = np.random.default_rng(7)
    x, y = rng.normal(size=(70, 3)) + 1e6, rng.normal(size=(90, 3)) + 1e6
    y[:20] = x[:20]
    begin = np.array([0, 2, 5])
    labels = [[rng.integers(0, k, n) for k in (2, 3)] for n in (len(x), len(y))]
    away = np.sqrt(((x[:, None] - y[None]) ** 2).sum(2))
    one, two = km.summed_distances(x, labels[0], y, labels[1], begin)
    for m, k in enumerate((2, 3)):
        for c in range(k):
            np.testing.assert_allclose(one[:, begin[m] + c], away[:, labels[1][m] == c].sum(1), rtol=1e-9)
            np.testing.assert_allclose(two[:, begin[m] + c], away[labels[0][m] == c].sum(0), rtol=1e-9)
    assert km.summed_distances(x, labels[0], y, labels[1], begin, False)[1].shape == (0, 5)
    alone = km.summed_distances(x[:1], [l[:1] for l in labels[0]], y[:1], [l[:1] for l in labels[1]], begin)[0]
    assert not alone.any()
