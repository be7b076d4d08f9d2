"""K-means for several numbers of clusters and restarts at once (T6), with the Euclidean silhouette.

Every round is one pass over the data: tasks hold all centers of all models (a table whose size is
the models', not the data's), assign their rows to each model and return one row of sums per model and
cluster.  Models that have converged are left out of later rounds.  So 70 fits cost as many jobs as
their longest, not the sum of all.

Starts are chosen the same way: a pass returns, for every restart, the rows with the largest
weighted random keys, the weight being the squared distance to what is chosen so far (a weighted
sample without replacement); a last pass weighs the chosen rows by how many they are nearest to, and
k-means++ on this small table gives every k its centers.  Random numbers come from a hash of the
row, so reruns agree however rows are dealt.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOL = 1e-4
MAX_ROUNDS = 300
START_ROUNDS = 3
BLOCK = 1024                       # rows of the smallest blocks in the silhouette
TILE = (256, 512)                  # rows of what is compared at once
NEARLY = 1e-7                      # squared distances below this share of the rows' squares are made from differences
MOST_IN_BLOCK = 50_000             # rows of the largest blocks


@dataclass
class KMeansModel:
    k: int
    restart: int
    centers: np.ndarray
    inertia: float


def _vectors(batch: pa.RecordBatch, column: str = "x") -> np.ndarray:
    col = batch.column(column)
    n = len(col)
    return col.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(n, -1) if n else np.empty((0, 0))


def _square(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(axis=1)[:, None] + (centers * centers).sum(axis=1) - 2 * (x @ centers.T), 0)


def _uniform(h: np.ndarray, salt: int) -> np.ndarray:
    """Numbers in (0, 1) from row hashes, others for every salt."""
    with np.errstate(over="ignore"):
        z = h.astype(np.uint64) + np.uint64(salt + 1) * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(float) / 2**53 + 2**-55


def _starts(rows: DataFrame, ks: list[int], restarts: int, seed: int) -> list[list[np.ndarray]]:
    """[restart][k]: centers to start from."""
    most = 2 * max(ks)
    chosen: list[np.ndarray | None] = [None] * restarts
    for step in range(START_ROUNDS + 1):
        now = list(chosen)

        def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[list] = [[] for _ in range(restarts)]
            for batch in batches:
                x, h = _vectors(batch), batch.column("h").to_numpy()
                for r in range(restarts if len(x) else 0):
                    weight = np.ones(len(x)) if now[r] is None else _square(x, now[r]).min(axis=1)
                    key = np.full(len(x), -np.inf)
                    some = weight > 1e-12
                    key[some] = np.log(_uniform(h[some], seed * 1000 + r * 10 + step)) / weight[some]
                    best = np.argsort(-key, kind="stable")[:most]
                    held[r] = sorted(held[r] + [(float(key[i]), int(h[i]), x[i].tolist()) for i in best if some[i]], reverse=True)[:most]
            rows_ = [(r, k, h, v) for r in range(restarts) for k, h, v in held[r]]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows_) if rows_ else [()] * 4, (
                pa.int32(), pa.float64(), pa.int64(), pa.list_(pa.float64())))], names=["r", "key", "h", "x"])

        found: list[list] = [[] for _ in range(restarts)]
        # 2 x k rows a restart and task; those of all tasks are met pair by pair in the same limit
        for r, key, h, x in rows.mapInArrow(sample, "r int, key double, h long, x array<double>").collect():
            found[r].append((key, h, x))
        for r in range(restarts):
            new = [x for _, _, x in sorted(found[r], reverse=True)[:1 if step == 0 else most]]
            if new:
                chosen[r] = np.array(new) if now[r] is None else np.vstack([now[r], new])
    sums = _pass(rows, [c for c in chosen])
    out = []
    for r, (n, _, _) in enumerate(sums):
        rng = np.random.default_rng(seed + r)
        out.append([_plus_plus(chosen[r], n, k, rng) for k in ks])
    return out


def _plus_plus(x: np.ndarray, weight: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Centers of a small weighted table: k-means++ and a few rounds of Lloyd's."""
    at = [rng.choice(len(x), p=weight / weight.sum())]
    while len(at) < min(k, len(x)):
        w = weight * _square(x, x[at]).min(axis=1)
        if w.sum() <= 0:
            break
        at.append(rng.choice(len(x), p=w / w.sum()))
    centers = x[at].copy()
    for _ in range(20):
        near = _square(x, centers).argmin(axis=1)
        for c in range(len(centers)):
            if weight[near == c].sum() > 0:
                centers[c] = np.average(x[near == c], axis=0, weights=weight[near == c])
    return centers


def _pass(rows: DataFrame, models: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """For each model's centers: rows by cluster, their sums, and the sum of squared distances.  One job."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = [np.zeros(len(c)) for c in models]
        total, cost = [np.zeros_like(c) for c in models], np.zeros(len(models))
        for batch in batches:
            x = _vectors(batch)
            for m, c in enumerate(models if len(x) else []):
                d = _square(x, c)
                near = d.argmin(axis=1)
                cost[m] += d[np.arange(len(x)), near].sum()
                n[m] += np.bincount(near, minlength=len(c))
                np.add.at(total[m], near, x)
        yield pa.record_batch([pa.array([m for m, c in enumerate(models) for _ in c], pa.int32()), pa.array([i for c in models for i in range(len(c))], pa.int32()),
                               pa.array(np.concatenate(n)), pa.array([v.tolist() for t in total for v in t], pa.list_(pa.float64())),
                               pa.array([cost[m] * (i == 0) for m, c in enumerate(models) for i in range(len(c))])], names=["m", "c", "n", "x", "cost"])

    d = len(models[0][0])
    got = rows.mapInArrow(run, "m int, c int, n double, x array<double>, cost double").groupBy("m", "c") \
        .agg(F.sum("n"), F.sum("cost"), *[F.sum(F.col("x")[j]) for j in range(d)]).collect()
    out = [[np.zeros(len(c)), np.zeros_like(c), 0.0] for c in models]
    for m, c, n, cost, *x in got:
        out[m][0][c], out[m][1][c] = n, x
        out[m][2] += cost
    return [tuple(o) for o in out]


def fit_kmeans(df: DataFrame, column: str, ks: list[int], restarts: int = 10, seed: int = 42, tol: float = TOL,
               max_rounds: int = MAX_ROUNDS) -> list[KMeansModel]:
    """A model for every k and restart on the array column ``column`` (equal lengths, no nulls).  An error on an empty table."""
    rows = df.select(F.col(column).cast("array<double>").alias("x"), F.xxhash64(column).alias("h"))
    if rows.isEmpty():
        raise ValueError("no rows to cluster")
    starts = _starts(rows, ks, restarts, seed)
    models = [(k, r, starts[r][i]) for i, k in enumerate(ks) for r in range(restarts)]
    centers = [c for _, _, c in models]
    open_ = list(range(len(models)))
    for _ in range(max_rounds):
        if not open_:
            break
        still = []
        for m, (n, total, _) in zip(open_, _pass(rows, [centers[m] for m in open_])):
            new = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], centers[m])      # an empty cluster stays
            if (((new - centers[m]) ** 2).sum(axis=1) > tol * tol).any():
                still.append(m)
            centers[m] = new
        open_ = still
    return [KMeansModel(k, r, c, float(cost)) for (k, r, _), c, (_, _, cost) in zip(models, centers, _pass(rows, centers))]


def best_by_k(models: list[KMeansModel]) -> list[KMeansModel]:
    """The restart of lowest inertia for each k."""
    return [min((m for m in models if m.k == k), key=lambda m: (m.inertia, m.restart)) for k in sorted({m.k for m in models})]


def assign(df: DataFrame, column: str, model: KMeansModel) -> DataFrame:
    """``df`` with ``cluster``: the nearest center, the first of equally near ones; native columns."""
    v = F.col(column)
    away = [sum(((v[j] - float(c)) * (v[j] - float(c)) for j, c in enumerate(center)), F.lit(0.0)) for center in model.centers]
    best = F.array_min(F.array(*[F.struct(a.alias("away"), F.lit(i).alias("cluster")) for i, a in enumerate(away)]))
    return df.withColumn("cluster", best["cluster"])


def _by_cluster(labels: list[np.ndarray], begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(an order of the rows in which those of the same clusters in all models stand together, the group of each row in
    it, the groups' clusters as a table of 0 and 1)."""
    groups, of = np.unique(np.stack(labels, axis=1), axis=0, return_inverse=True)
    order = np.argsort(of.ravel(), kind="stable")
    member = np.zeros((len(groups), begin[-1]))
    for m in range(groups.shape[1]):
        member[np.arange(len(groups)), begin[m] + groups[:, m]] = 1
    return order, of.ravel()[order], member


def summed_distances(x: np.ndarray, labels_x: list[np.ndarray], y: np.ndarray, labels_y: list[np.ndarray], begin: np.ndarray,
                     both: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(distances of each row of ``x`` summed over the rows of ``y`` by model and cluster, with ``both`` the same of ``y`` over ``x``).

    A tile of distances is made once, from products, and those of nearly equal rows again from differences: equal
    rows are at distance 0.  Rows of the same clusters stand together, so that a tile is summed by a few slices, not once a cluster."""
    middle = y.mean(axis=0)                                        # distances stay, products lose fewer digits
    (order_x, group_x, member_x), (order_y, group_y, member_y) = _by_cluster(labels_x, begin), _by_cluster(labels_y, begin)
    x, y = (x - middle)[order_x], (y - middle)[order_y]
    size_x, size_y = (x * x).sum(axis=1), (y * y).sum(axis=1)
    wide_x, wide_y = np.column_stack([-2 * x, size_x, np.ones(len(x))]), np.column_stack([y, np.ones(len(y)), size_y])
    out_x, out_y = np.zeros((len(x), begin[-1])), np.zeros((len(y) if both else 0, begin[-1]))
    parts = []
    for t in range(0, len(y), TILE[1]):
        own = group_y[t:t + TILE[1]]
        starts = np.flatnonzero(np.diff(own, prepend=-1))
        parts.append((slice(t, t + len(own)), starts, member_y[own[starts]], np.ascontiguousarray(wide_y[t:t + len(own)].T), size_y[t:t + len(own)].max()))
    for s in range(0, len(x), TILE[0]):
        own = group_x[s:s + TILE[0]]
        rows = slice(s, s + len(own))
        starts_x = np.flatnonzero(np.diff(own, prepend=-1))
        of_x = member_x[own[starts_x]]
        for cols, starts, of_y, wide, largest in parts:
            away = wide_x[rows] @ wide
            few = NEARLY * (size_x[rows] + largest)
            if away.min() <= few.max():
                i, j = np.nonzero(away <= few[:, None])
                away[i, j] = ((x[rows][i] - y[cols][j]) ** 2).sum(axis=1)
            np.sqrt(away, out=away)
            out_x[rows] += np.add.reduceat(away, starts, axis=1) @ of_y
            if both:
                out_y[cols] += np.add.reduceat(away, starts_x, axis=0).T @ of_x
    back_x, back_y = np.empty_like(out_x), np.empty_like(out_y)
    back_x[order_x] = out_x
    if both:
        back_y[order_y] = out_y
    return back_x, back_y


def _joined(columns: list[pa.ChunkedArray]) -> pa.ChunkedArray:
    return pa.chunked_array([c for column in columns for c in column.chunks])


def block_count(n: int, block: int, cores: int) -> int:
    """Blocks of ``block`` rows, but no more than give every core some four pairs, and at least one for each ``MOST_IN_BLOCK`` rows."""
    enough = max(8, math.ceil(math.sqrt(4 * cores)))
    return max(1, min(-(-n // block), max(enough, -(-n // MOST_IN_BLOCK))))


def silhouettes(df: DataFrame, column: str, models: list[KMeansModel], block: int = BLOCK) -> dict[int, float]:
    """The mean Euclidean silhouette of each model (by k; a row alone in its cluster counts 0; one cluster gives 0).

    The measure needs every row's mean distance to every cluster.  Blocks of rows meet in pairs, each two of them once, and a pair returns
    the summed distances of both blocks' rows by model and cluster, never the distances (``summed_distances``).  There are as many blocks as keep
    the cores busy, not as the rows ask for: every block meets a copy of all rows, so what is shuffled grows with the rows alone up to some
    ``MOST_IN_BLOCK`` a block.  Work grows with the square of the rows: meant for tables like sellers, up to some 500,000 rows."""
    n = df.count()
    blocks = block_count(n, block, df.sparkSession.sparkContext.defaultParallelism)
    rows = df.select(F.xxhash64(column).alias("h"), F.col(column).cast("array<double>").alias("x")) \
        .withColumn("id", F.monotonically_increasing_id()).withColumn("own", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    from .sequence import pin
    rows = pin(rows, "silhouette")
    all_centers = [m.centers for m in models]
    width = [len(c) for c in all_centers]
    begin = np.cumsum([0, *width])

    def near(x):
        return [_square(x, c).argmin(axis=1) for c in all_centers]

    def pair(left: pa.Table, right: pa.Table) -> pa.Table:
        left, right = left.combine_chunks(), right.combine_chunks()
        if not left.num_rows or not right.num_rows:
            return pa.table({"id": pa.array([], pa.int64()), "x": pa.array([], pa.list_(pa.float64())), "sums": pa.array([], pa.list_(pa.float64()))})
        x, y = _vectors(left.to_batches()[0]), _vectors(right.to_batches()[0])
        same = left.column("own")[0].as_py() == right.column("other")[0].as_py()
        sums = summed_distances(x, near(x), y, near(y), begin, not same)
        ids, at = ([t.column(c) for t in (left, right)[:1 if same else 2]] for c in ("id", "x"))
        told = np.concatenate(sums[:len(ids)])
        ends = pa.array(np.arange(len(told) + 1, dtype=np.int32) * np.int32(begin[-1]))
        return pa.table({"id": _joined(ids), "x": _joined(at), "sums": pa.ListArray.from_arrays(ends, pa.array(told.ravel()))})

    # a block meets itself and the later ones
    a = rows.select("id", "x", "own", F.explode(F.sequence(F.col("own"), F.lit(blocks - 1))).alias("other"))
    b = rows.select("id", "x", F.explode(F.sequence(F.lit(0), F.col("own"))).alias("mine"), F.col("own").alias("other")).withColumnRenamed("mine", "own")
    sums = a.groupBy("own", "other").cogroup(b.groupBy("own", "other")).applyInArrow(pair, "id long, x array<double>, sums array<double>")
    total = sums.groupBy("id").agg(F.first("x").alias("x"), *[F.sum(F.col("sums")[j]).alias(f"s{j}") for j in range(int(begin[-1]))])
    counts = [np.asarray(c) for c, _, _ in _pass(rows.select("x", "h"), all_centers)]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(len(models))
        for batch in batches:
            x = _vectors(batch)
            if not len(x):
                continue
            s = np.column_stack([batch.column(f"s{j}").to_numpy() for j in range(int(begin[-1]))])
            at = np.arange(len(x))
            for m, c in enumerate(near(x)):
                size, own = counts[m], s[:, begin[m]:begin[m + 1]]
                if (size > 0).sum() < 2:
                    continue
                inside = own[at, c] / np.maximum(size[c] - 1, 1)
                mean = np.where(size > 0, own / np.maximum(size, 1), np.inf)
                mean[at, c] = np.inf
                outside = mean.min(axis=1)
                top = np.maximum(inside, outside)
                out[m] += np.where((size[c] > 1) & (top > 0), (outside - inside) / np.where(top > 0, top, 1), 0).sum()
        yield pa.record_batch([pa.array(range(len(models)), pa.int32()), pa.array(out)], names=["m", "s"])

    got = total.mapInArrow(score, "m int, s double").groupBy("m").agg(F.sum("s")).collect()
    by = {models[m].k: float(s) / n for m, s in got}
    return {m.k: by.get(m.k, 0.0) for m in models}
