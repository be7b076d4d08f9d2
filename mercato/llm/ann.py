"""Approximate nearest neighbours by inner product over balanced posting lists.

Largest inner products become smallest distances: vectors are scaled by the largest norm and get one
more coordinate that brings them to length one, queries are scaled to length one and get a zero there.

An index is fitted on a bounded sample: balanced bisection gives lists of equal size, whose means are
refined with a price on full lists.  The means are the nodes of a graph (each linked to near ones that
no nearer link hides, and to its neighbours in the bisection) that is walked best first.  Every vector
goes to its nearest list and, where it lies near a border, to a few more lists that don't stand in
each other's way.  A query visits the lists whose distance is within a ratio of its nearest list's;
the ratio is the one that finds ``target`` of the sample's own neighbours.

Lists and their queries are dealt in blocks of bounded size, so that a crowded list is many tasks'
work.  A query's nearest lists are searched first: the other ones return what reaches the best ``k`` found there,
not ``k`` vectors each, so what is returned grows with the queries, not with the lists they visit.  Equal vectors are one class, searched once; a class names its first members alone, as many as
an answer can hold.  Scores are inner products of the vectors themselves in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import pinned

SAMPLE = 20_000                    # vectors that the index of one length is fitted on, at most
SAMPLE_VALUES = 1 << 22            # and numbers in them
MAX_LISTS = 16_384
ALONE = 512                        # vectors that are one list
REPLICAS = 4                       # lists that a vector is in, at most
BORDER = 1.15                      # of a vector's nearest distance: the lists that it may also be in
LINKS = 16                         # links of a graph's node
WIDTH = 32                         # nodes that a walk holds
TARGET = 0.95                      # share of the sample's neighbours that the ratio has to find
TRIALS = 256                       # vectors of the sample that the ratio is fitted on
BLOCK = 4096                       # vectors, and queries, of a block
ROWS = 512                         # vectors that walk the graph together
HOME = 32                          # the lists searched first hold one in so many of the vectors
FIELDS = "id long, d int, list int"


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    square = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1) - 2 * (x @ y.T)
    return np.sqrt(np.maximum(square, 0))


def _bisected(x: np.ndarray, n: int, rng: np.random.Generator) -> list[np.ndarray]:
    """``n`` groups of rows of equal size, neighbours in order, by halving along two means."""
    parts = [(np.arange(len(x)), n)]
    out = []
    while parts:
        rows, n = parts.pop()
        if n == 1:
            out.append(rows)
            continue
        own = x[rows]
        a, b = own[rng.choice(len(rows), 2, replace=False)]
        for _ in range(4):
            side = own @ (b - a)
            cut = np.median(side)
            low = side <= cut
            if low.all() or not low.any():
                break
            a, b = own[low].mean(axis=0), own[~low].mean(axis=0)
        first = n // 2
        order = np.argsort(own @ (b - a), kind="stable")
        at = len(rows) * first // n
        parts += [(rows[order[at:]], n - first), (rows[order[:at]], first)]
    return out


@dataclass
class Index:
    """Lists of the vectors of one length."""

    peak: float                                   # log of the largest norm
    centers: np.ndarray
    links: np.ndarray
    ratio: float

    def scaled(self, x: np.ndarray, query: bool) -> np.ndarray:
        own = np.abs(x).max(axis=1)
        y = x / own[:, None]
        if query:
            y /= np.sqrt((y * y).sum(axis=1))[:, None]
            return np.column_stack([y, np.zeros(len(y))])
        y *= np.exp(np.log(own) - self.peak)[:, None]
        return np.column_stack([y, np.sqrt(np.maximum(0, 1 - (y * y).sum(axis=1)))])

    def walk(self, x: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``width`` nearest lists of each row that a best-first walk finds, with their distances."""
        n, k = len(self.centers), len(x)
        width = min(width, n)
        norms = (self.centers * self.centers).sum(axis=1)
        own = (x * x).sum(axis=1)
        ids = np.unique(np.linspace(0, n - 1, width).astype(np.int64))      # spread over the bisection's order
        near = np.maximum(own[:, None] + norms[ids] - 2 * (x @ self.centers[ids].T), 0)
        beam, seen = np.broadcast_to(ids, (k, len(ids))).copy(), np.zeros((k, n + 1), bool)
        seen[:, ids] = True
        open_ = np.ones(beam.shape, bool)
        rows, step = np.arange(k), 4
        while open_.any():
            pick = np.argsort(np.where(open_, near, np.inf), axis=1)[:, :step]
            live = np.take_along_axis(open_, pick, 1)
            np.put_along_axis(open_, pick, False, 1)
            to = np.where(live[:, :, None], self.links[np.take_along_axis(beam, pick, 1)], n).reshape(k, -1)
            to[seen[rows[:, None], to]] = n
            to.sort(axis=1)                                                  # a node met twice in a step counts once
            to[:, 1:][to[:, 1:] == to[:, :-1]] = n
            seen[rows[:, None], to] = True
            real = to < n
            if not real.any():
                continue
            at = np.minimum(to, n - 1)
            far = own[:, None] + norms[at] - 2 * np.einsum("kd,kmd->km", x, self.centers[at])
            far = np.where(real, np.maximum(far, 0), np.inf)
            beam, near = np.concatenate([beam, at], 1), np.concatenate([near, far], 1)
            open_ = np.concatenate([open_, real], 1)
            best = np.argsort(near, axis=1, kind="stable")[:, :width]
            beam, near, open_ = (np.take_along_axis(v, best, 1) for v in (beam, near, open_))
            open_ &= np.isfinite(near)
        order = np.argsort(near, axis=1, kind="stable")
        return np.take_along_axis(beam, order, 1), np.sqrt(np.take_along_axis(near, order, 1))

    def place(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, list): every row in its nearest list and, near a border, in further ones."""
        beam, near = self.walk(self.scaled(x, False), WIDTH)
        taken = np.zeros(beam.shape, bool)
        taken[:, 0] = True
        for j in range(1, beam.shape[1]):
            may = (near[:, j] <= near[:, 0] * BORDER) & (taken.sum(axis=1) < REPLICAS)
            for i in range(j):
                # a list nearer to one that is taken than to the vector adds little
                between = np.sqrt(((self.centers[beam[:, i]] - self.centers[beam[:, j]]) ** 2).sum(axis=1))
                may &= ~taken[:, i] | (between >= near[:, j])
            taken[:, j] = may
        row, at = np.nonzero(taken)
        return row, beam[row, at]

    def visit(self, x: np.ndarray, sizes: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, list, home): the lists within the ratio of each query's nearest one, and as many more as hold ``least`` vectors.
        The nearest of them, which are searched first, are ``home``."""
        first = max(least, int(sizes.sum()) // HOME)
        q, width, n = self.scaled(x, True), WIDTH, len(self.centers)
        rows, out = np.arange(len(q)), []
        while len(rows):
            beam, near = self.walk(q[rows], width)
            held = np.cumsum(sizes[beam], axis=1) - sizes[beam]
            wanted = (near <= near[:, :1] * self.ratio) | (held < least)
            done = ~wanted[:, -1] | (beam.shape[1] >= n)                     # else the walk was too narrow
            r, at = np.nonzero(wanted & done[:, None])
            out.append((rows[r], beam[r, at], held[r, at] < first))
            rows, width = rows[~done], width * 2
        return tuple(np.concatenate(v) for v in zip(*out)) if out else (np.empty(0, np.int64),) * 2 + (np.empty(0, bool),)


def _linked(centers: np.ndarray) -> np.ndarray:
    """Each center's links: its neighbours in order, and near centers that no nearer link hides."""
    n = len(centers)
    links = np.empty((n, LINKS + 2), np.int64)
    for begin in range(0, n, 1024):
        own = centers[begin:begin + 1024]
        dist = _distances(own, centers)
        near = np.argsort(dist, axis=1)[:, :min(n, 4 * LINKS)]
        for r in range(len(own)):
            kept: list[int] = []
            for c in near[r][near[r] != begin + r]:
                if len(kept) == LINKS:
                    break
                if not kept or (((centers[kept] - centers[c]) ** 2).sum(axis=1) >= dist[r, c] ** 2).all():
                    kept.append(int(c))
            kept += [int(c) for c in near[r] if c != begin + r and c not in kept][:LINKS - len(kept)]
            links[begin + r] = (kept + [begin + r] * LINKS)[:LINKS] + [max(0, begin + r - 1), min(n - 1, begin + r + 1)]
    return links


def fit_index(sample: np.ndarray, n: int, peak: float, k: int, target: float = TARGET) -> Index:
    """An index for ``n`` vectors of which ``sample`` are given; ``peak`` is the log of the largest norm."""
    lists = 1 if n <= ALONE else max(1, min(int(np.sqrt(n)), MAX_LISTS, len(sample) // 16))
    index = Index(peak, np.zeros((1, sample.shape[1] + 1)), np.zeros((1, LINKS + 2), np.int64), 1.0)
    if lists == 1:
        return index
    x, rng = index.scaled(sample, False), np.random.default_rng(len(sample))
    groups = _bisected(x, lists, rng)
    index.centers = np.array([x[g].mean(axis=0) for g in groups])
    mean = len(x) / lists
    price = np.zeros(lists)
    for _ in range(6):                              # lists above the mean size move away, others come nearer
        near = np.concatenate([(_distances(x[s:s + 2048], index.centers) ** 2 + price).argmin(axis=1) for s in range(0, len(x), 2048)])
        size = np.bincount(near, minlength=lists)
        some = np.flatnonzero(size)
        order = np.argsort(near, kind="stable")
        index.centers[some] = np.add.reduceat(x[order], np.cumsum(size[some]) - size[some]) / size[some, None]
        price += 0.02 * (size - mean) / mean * ((x - index.centers[near]) ** 2).sum(axis=1).mean()
    index.links = _linked(index.centers)
    # the ratio at which the sample's own neighbours are found
    trial = rng.permutation(len(sample))[:TRIALS]
    row, at = (np.concatenate(v) for v in zip(*((r + s, c) for s in range(0, len(sample), ROWS)
                                                for r, c in [index.place(sample[s:s + ROWS])])))
    q = index.scaled(sample[trial], True)
    scores = q @ x.T
    scores[np.arange(len(trial)), trial] = -np.inf
    # the k-th neighbour among n vectors is as near as one of a lower rank among the sample's
    near = np.argsort(-scores, axis=1)[:, :max(1, min(-(-k * len(sample) // n), len(sample) - 1))]
    dist = _distances(q, index.centers)
    order = np.argsort(row, kind="stable")
    row, at = row[order], at[order]
    begin, end = np.searchsorted(row, near), np.searchsorted(row, near, side="right")
    most = dist.max(axis=1, keepdims=True) * np.ones(near.shape)
    for j in range(REPLICAS):
        has = begin + j < end
        mine = dist[np.arange(len(trial))[:, None], at[np.minimum(begin + j, len(at) - 1)]]
        most = np.where(has, np.minimum(most, mine) if j else mine, most)
    index.ratio = float(np.quantile(most / dist.min(axis=1, keepdims=True), target)) * (1 + 1e-9)
    return index


def _matrix(column: pa.Array, rows: np.ndarray, d: int) -> np.ndarray:
    return column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), d)


def _by_length(batches: Iterator[pa.RecordBatch], lists) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, d = batch.column("id").to_numpy(), batch.column("d").to_numpy()
        for length in np.unique(d).tolist():
            of = np.flatnonzero(d == length)
            for s in range(0, len(of), ROWS):
                rows = of[s:s + ROWS]
                r, c, *home = lists(length, _matrix(batch.column("embedding"), rows, length))
                yield pa.record_batch([pa.array(ids[rows[r]]), pa.array(np.full(len(r), length, np.int32)), pa.array(c.astype(np.int32)),
                                       *map(pa.array, home)], names=["id", "d", "list", "home"][:3 + len(home)])


def block_search(k: int):
    """The ``k`` best classes of a block's vectors for each of its queries, copies counted once, but none below the query's ``bar``."""

    def run(asked: pa.Table, held: pa.Table) -> pa.Table:
        asked, held = asked.combine_chunks(), held.combine_chunks()
        q_id, ids, least = asked.column("id").to_numpy(), held.column("id").to_numpy(), held.column("least").to_numpy()
        floor, out = asked.column("bar").to_numpy(), []
        if len(q_id) and len(ids):
            d = asked.column("d")[0].as_py()
            q, x = (_matrix(t.column("embedding").combine_chunks(), np.arange(t.num_rows), d) for t in (asked, held))
            with np.errstate(all="ignore"):
                for s in range(0, len(q), ROWS):
                    own = q[s:s + ROWS]
                    rough = np.nan_to_num(own @ x.T, nan=-np.inf)
                    size = np.sqrt((own * own).sum(axis=1))[:, None] * np.sqrt((x * x).sum(axis=1))
                    slack = np.nan_to_num(size * (1e-14 * d), posinf=0.0)
                    bar = np.partition(rough - slack, -k, axis=1)[:, [-k]] if len(x) > k else np.full((len(own), 1), -np.inf)
                    least_score = floor[s:s + ROWS, None]
                    i, j = np.nonzero((rough + slack >= bar) & ~(rough + slack < least_score))
                    # rows alone are summed in one order whatever stands beside them
                    score = (own[i] * x[j]).sum(axis=1)
                    reached = ~(score < least_score[i, 0])
                    i, j, score = i[reached], j[reached], score[reached]
                    order = np.lexsort((ids[j], least[j], -np.nan_to_num(score, nan=-np.inf), i))
                    i, j, score = i[order], j[order], score[order]
                    first = np.flatnonzero(np.diff(i, prepend=-1))
                    top = np.arange(len(i)) - np.repeat(first, np.diff(np.append(first, len(i)))) < k
                    out.append((q_id[s + i[top]], ids[j[top]], least[j[top]], score[top]))
        a, b, c, e = (np.concatenate(v) for v in zip(*out)) if out else (np.empty(0, np.int64),) * 3 + (np.empty(0),)
        return pa.table({"id": a, "hit": b, "least": c, "score": e})

    return run


def _valid(v: Column) -> Column:
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(v, lambda x: x != 0), F.lit(False))


def _indexes(classes: DataFrame, k: int, target: float) -> dict[int, Index]:
    """An index for each length of vectors, fitted on a sample that hashes choose."""
    v = F.transform("embedding", lambda x: F.abs(x.cast("double")))
    top = F.array_max(v)
    square = F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x)
    # squares that leave the range of doubles are taken again of scaled numbers
    norm = F.when((square > 1e-280) & (square < 1e300), F.log(square) / 2) \
        .otherwise(F.log(top) + F.log(F.aggregate(v, F.lit(0.0), lambda a, x: a + (x / top) * (x / top))) / 2)
    out = {}
    for d, n, peak in classes.groupBy("d").agg(F.count("*"), F.max(norm)).collect():
        most = max(64, min(SAMPLE, SAMPLE_VALUES // d))
        share = min(1.0, most / n)
        own = classes.filter(F.col("d") == d)
        if n <= ALONE:
            own = own.limit(1)                      # one list: nothing to fit
        elif share < 1:
            own = own.filter(F.pmod(F.xxhash64("embedding", F.lit(13)), F.lit(1 << 30)) < int(share * (1 << 30))).limit(2 * most)
        table = own.select("embedding").toArrow()
        sample = _matrix(table.column("embedding").combine_chunks(), np.arange(table.num_rows), d)
        out[d] = fit_index(sample, n, peak, k, target)
    return out


def nearest_neighbours(vectors: DataFrame, is_query: Column, k: int = 20, target: float = TARGET) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``vectors`` (``vec_id``, ``embedding``) that ``is_query`` picks, its
    ``k`` nearest found among all rows but itself by inner product, ties to the smaller vec_id.

    Vectors of the query's length are its candidates.  Null ids, and vectors that are null, zero or hold
    null or non-finite numbers, take no part.  Rows that repeat an id are rows of their own.  At most
    ``ALONE`` distinct vectors are searched whole, so small tables have exact answers; beyond that,
    neighbours in lists outside the ratio are missed, and a query that finds fewer than ``k`` lists visits more.
    Products beyond the range of doubles are infinite.  An empty table gives an empty result."""
    kind = vectors.schema["embedding"].dataType.simpleString()
    v = F.col("embedding") if kind in ("array<float>", "array<double>") else F.col("embedding").cast("array<double>")
    rows = vectors.withColumn("embedding", v).select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", F.coalesce(is_query, F.lit(False)).alias("asks")) \
        .filter(F.col("vec_id").isNotNull() & _valid(F.col("embedding")))
    rows = pinned(rows.withColumn("row", F.monotonically_increasing_id()))
    # an answer holds k rows of a class at most, and one more is the query's own
    first = rows.withColumn("_n", F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id", "row"))).filter(F.col("_n") <= k + 1)
    members = first.groupBy("embedding").agg(F.array_sort(F.collect_list(F.struct("vec_id", "row"))).alias("members"))
    classes = pinned(rows.groupBy("embedding").agg(F.min("row").alias("id"), F.max("asks").alias("asks")).join(members, "embedding")
                     .withColumn("d", F.size("embedding")).withColumn("least", F.col("members")[0]["vec_id"]))
    spark = vectors.sparkSession
    shared = spark.sparkContext.broadcast(_indexes(classes, k, target))      # MAX_LISTS centers a length
    own = classes.select("id", "d", "embedding")
    placed = pinned(own.mapInArrow(lambda it: _by_length(it, lambda d, x: shared.value[d].place(x)), FIELDS))
    sizes = _counts(placed, shared.value)
    held = spark.sparkContext.broadcast(sizes)
    asked = pinned(classes.filter("asks").select("id", "d", "embedding").mapInArrow(
        lambda it: _by_length(it, lambda d, x: shared.value[d].visit(x, held.value[d], REPLICAS * (k + 1))), f"{FIELDS}, home boolean"))
    # a list's vectors and queries meet in blocks of bounded size
    parts = _parts(placed, "parts").join(_parts(asked, "askers"), ["d", "list"])
    number = lambda c: F.pmod(F.xxhash64("id"), F.col(c))
    each = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    by = ["d", "list", "part", "asker"]
    left = asked.join(parts, ["d", "list"]).withColumn("asker", number("askers")).withColumn("part", each("parts")) \
        .join(own.drop("d"), "id").select(*[F.col(c).alias(c) for c in (*by, "id", "embedding", "home")])
    right = placed.join(parts, ["d", "list"]).withColumn("part", number("parts")).withColumn("asker", each("askers")) \
        .join(classes.select("id", "embedding", "least"), "id") \
        .select(*[F.col(c).alias(c) for c in (*by, "id", "embedding", "least")])
    # lists that share a vector both return it: more are held until copies are gone
    ranked = Window.partitionBy("id").orderBy(F.col("score").desc(), "least", "hit")

    def found(asking: DataFrame) -> DataFrame:
        return asking.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(block_search(k + 1), "id long, hit long, least long, score double")

    def best_of(some: DataFrame) -> DataFrame:
        some = some.withColumn("_n", F.row_number().over(ranked)).filter(F.col("_n") <= REPLICAS * (k + 1)).drop("_n")
        return some.groupBy("id", "hit", "least").agg(F.max("score").alias("score")) \
            .withColumn("_n", F.row_number().over(ranked)).filter(F.col("_n") <= k + 1)

    near = pinned(best_of(found(left.filter("home").withColumn("bar", F.lit(float("-inf"))))))
    # what is below the last of k + 1 that are found can't be an answer
    bars = near.filter(F.col("_n") == k + 1).select("id", F.col("score").alias("bar"))
    far = left.filter("not home").join(bars, "id", "left").withColumn("bar", F.coalesce("bar", F.lit(float("-inf"))))
    few = best_of(near.drop("_n").unionByName(found(far)))
    each_row = few.join(classes.select(F.col("id").alias("hit"), "members"), "hit").select("id", "score", F.explode("members").alias("m"))
    best = F.struct((-F.col("score")).alias("away"), F.col("m.vec_id").alias("vec_id"), F.col("m.row").alias("row"), "score")
    hits = pinned(each_row.groupBy("id").agg(F.slice(F.array_sort(F.collect_list(best)), 1, k + 1).alias("hits")))
    queries = rows.filter("asks").select("vec_id", "row", "embedding").join(own.select("id", "embedding"), "embedding").drop("embedding")
    others = F.slice(F.filter("hits", lambda h: h["row"] != F.col("row")), 1, k)
    return queries.join(hits, "id").select(F.col("vec_id").alias("query_id"), F.posexplode(others).alias("at", "h")) \
        .select("query_id", (F.col("at") + 1).alias("rank"), F.col("h.vec_id").alias("vec_id"), F.col("h.score").alias("score"))


def _counts(placed: DataFrame, indexes: dict[int, Index]) -> dict[int, np.ndarray]:
    out = {d: np.zeros(len(i.centers), np.int64) for d, i in indexes.items()}
    for d, c, n in placed.groupBy("d", "list").count().collect():            # a row a list
        out[d][c] = n
    return out


def _parts(placed: DataFrame, name: str) -> DataFrame:
    return placed.groupBy("d", "list").agg(F.ceil(F.count("*") / BLOCK).alias(name))
