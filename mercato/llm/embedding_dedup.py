"""Embedding near-dedup by a subspace pigeonhole join.

Unit vectors at cosine >= t are at squared distance <= 2 - 2t.  After a fixed random rotation
the dimensions are split into blocks, and by the pigeonhole principle at least one block of
a linked pair lies within the block's proportional share of that squared distance.  So each
block is range-joined under its budget: a vector lives in the grid cell of its first block
coordinates and visits the neighbouring cells that its range touches and that come after its
own.  The union of the blocks' candidates is verified by the cosine of the vectors themselves,
in double precision.

A pair is taken in the later one of the cells that its vectors live in, and in the first block
whose budget it meets, so every link is counted once without a table of pairs: a cell returns
one row a vector, its number of links and the root of its local component.  Equal vectors are
one class with a count.  A cell with more than ``CELL`` vectors is split into pairs of parts.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pinned
from .graph import connected_components

BLOCKS = 4
CELL = 4096
PER_CELL = 4000                    # vectors of the largest label aimed at in a cell: a copy costs as much as some thousand pairs
TILE = 512
SLACK = 1e-9                       # rounding in the range join, before exact verification

_rotations: dict[int, np.ndarray] = {}


def rotation(d: int) -> np.ndarray:
    if d not in _rotations:
        _rotations[d] = np.linalg.qr(np.random.default_rng(d).standard_normal((d, d)))[0]
    return _rotations[d]


def rotated(x: np.ndarray) -> np.ndarray:
    """Unit vectors of the rows of ``x``, rotated; the same for a row whatever stands beside it."""
    out = np.zeros_like(x)
    for j, row in enumerate(rotation(x.shape[1])):
        out += x[:, j, None] * row
    return out / np.sqrt((x * x).sum(axis=1))[:, None]


def block_bounds(d: int) -> list[tuple[int, int]]:
    n = min(BLOCKS, d)
    return [(d * k // n, d * (k + 1) // n) for k in range(n)]


def _matrix(column: pa.Array, rows: np.ndarray, d: int) -> np.ndarray:
    """Vectors as doubles, each scaled by a power of two, which changes no cosine, so that squares stay in range."""
    x = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), d)
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])


def cells(classes: DataFrame, budget: float, grid_dims: int, carried: str) -> DataFrame:
    """The ``carried`` columns (a schema) with (block, cell, home): every class in the cell of each
    block that it lives in and in the later ones that its range touches."""
    names = [c.split()[0] for c in carried.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array([len(v) for v in batch.column("embedding")], np.int64)
            for d in np.unique(sizes).tolist():
                of = np.flatnonzero(sizes == d)
                x = rotated(_matrix(batch.column("embedding"), of, d))
                for k, (a, b) in enumerate(block_bounds(d)):
                    radius = np.sqrt(budget * (b - a) / d + SLACK) + SLACK
                    own = x[:, a:min(b, a + grid_dims)]
                    low = np.floor((own - radius) / (2 * radius)).astype(np.int64)
                    high = np.floor((own + radius) / (2 * radius)).astype(np.int64)
                    live = np.floor(own / (2 * radius)).astype(np.int64)
                    # a range is one cell wide, so it touches at most two cells a dimension
                    for step in product((0, 1), repeat=own.shape[1]):
                        cell = low + np.array(step)
                        after = np.zeros(len(cell), np.int64)            # by the first coordinate that differs
                        for j in range(cell.shape[1] - 1, -1, -1):
                            after = np.where(cell[:, j] != live[:, j], cell[:, j] - live[:, j], after)
                        rows = np.flatnonzero((cell <= high).all(axis=1) & (after >= 0))
                        picked = batch.take(pa.array(of[rows]))
                        yield pa.record_batch(
                            [*(picked.column(c) for c in names), pa.array(np.full(len(rows), k, np.int32)),
                             pa.array([f"{d}:" + "/".join(map(str, c)) for c in cell[rows].tolist()], pa.string()),
                             pa.array(after[rows] == 0)], names=[*names, "block", "cell", "home"])

    return classes.select("id", "embedding", "mult", "label").mapInArrow(
        run, f"{carried}, block int, cell string, home boolean")


def cell_links(threshold: float):
    """Links of one cell, or of two parts of it: (id, root, n) for every vector that has any."""

    budget = 2 - 2 * threshold

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ids, mult = table.column("id").to_numpy(), table.column("mult").to_numpy()
        home, part = table.column("home").to_numpy(zero_copy_only=False), table.column("part").to_numpy()
        emb = table.column("embedding").combine_chunks()
        if isinstance(emb, pa.ChunkedArray):
            emb = emb.chunk(0)
        d = len(emb[0])
        x = _matrix(emb, np.arange(len(ids)), d)
        norm = np.sqrt((x * x).sum(axis=1))
        bounds, k = block_bounds(d), table.column("block")[0].as_py()
        share = [budget * (b - a) / d + SLACK for a, b in bounds]
        own = x @ rotation(d)[:, bounds[k][0]:bounds[k][1]] / norm[:, None]
        half = (own * own).sum(axis=1) / 2
        r, known = np.empty_like(x), np.zeros(len(ids), bool)    # whole rotated vectors, of linked rows alone
        first, second = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        left = np.flatnonzero(home & ((part == first) | (part == second)))
        links: list[tuple[np.ndarray, np.ndarray]] = []
        for a in range(0, len(left), TILE):
            p = left[a:a + TILE]
            dot = own[p] @ own.T
            dot -= half[p][:, None]
            near = dot >= half - (share[k] + SLACK) / 2          # squared distance within the block's budget
            near &= (ids[p][:, None] < ids) | ~home              # of two that live here, the smaller id leads
            if first != second:
                near &= part[p][:, None] != part[None, :]
            u, v = np.nonzero(near)
            u = p[u]
            for c in range(0, len(u), 1 << 16):
                y, z = u[c:c + (1 << 16)], v[c:c + (1 << 16)]
                good = (x[y] * x[z]).sum(axis=1) / (norm[y] * norm[z]) >= threshold
                y, z = y[good], z[good]
                new = np.unique(np.concatenate([y, z]))
                new = new[~known[new]]
                r[new], known[new] = rotated(x[new]), True
                within = [((r[y, s:t] - r[z, s:t]) ** 2).sum(axis=1) <= most for (s, t), most in zip(bounds[:k + 1], share)]
                mine = within[k] & ~np.any([*within[:k], np.zeros(len(y), bool)], axis=0)
                links.append((y[mine], z[mine]))
        y = np.concatenate([np.empty(0, np.int64), *(u for u, _ in links)])
        z = np.concatenate([np.empty(0, np.int64), *(v for _, v in links)])
        n = np.zeros(len(ids), np.int64)
        np.add.at(n, y, mult[z])
        np.add.at(n, z, mult[y])
        root = ids.copy()
        while True:
            before = root.copy()
            np.minimum.at(root, y, root[z])
            np.minimum.at(root, z, root[y])
            if (before == root).all():
                break
        some = np.flatnonzero(n)
        return pa.table({"id": ids[some], "root": root[some], "n": n[some]})

    return run


def _valid() -> Column:
    v = F.col("embedding")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col("label").isNotNull() & fine & F.exists(v, lambda x: x != 0), F.lit(False))


def embedding_near_dedup(vectors: DataFrame, threshold: float = 0.98, grid_dims: int | None = None) -> DataFrame:
    """One row per row of ``vectors`` (``vec_id``, ``embedding``, ``label``): vec_id, n_links, component_id, kept.

    Vectors are compared when their labels are equal and not null, and their lengths are equal.
    Vectors that are null, zero or hold null or non-finite components link with nothing; they are
    components of their own.  n_links counts rows, copies included; component_id is the smallest
    vec_id that links reach (null only if all ids are).  ``grid_dims`` (block coordinates that the
    grid uses) follows the number of vectors if not given; it changes cost, never links."""
    # vectors keep their own type, so that none is rounded before cosines are taken
    kind = vectors.schema["embedding"].dataType.simpleString()
    kind = kind if kind in ("array<float>", "array<double>") else "array<double>"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("embedding"),
                          F.col("label").cast("string").alias("label"), _valid().alias("_valid"))
    classes = pinned(rows.filter("_valid").groupBy("label", "embedding").agg(
        F.min("vec_id").alias("least"), F.count("*").alias("mult")).withColumn("id", F.monotonically_increasing_id()))
    if grid_dims is None:
        largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 1
        grid_dims = int(min(8, max(1, np.ceil(np.log(max(1, largest / PER_CELL)) / np.log(3)))))
    budget, by = 2 - 2 * threshold, ["label", "block", "cell"]
    # vectors are placed twice, the first time for the cells' sizes alone: cheaper than to keep all copies
    sizes = cells(classes, budget, grid_dims, "label string").groupBy(*by).agg(F.count("*").alias("n")).filter("n > 1") \
        .withColumn("parts", F.ceil(F.col("n") / CELL).cast("int"))
    placed = cells(classes, budget, grid_dims, f"id long, embedding {kind}, mult long, label string")
    placed = placed.join(sizes, by).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))) \
        .withColumn("i", F.least("part", "other")).withColumn("j", F.greatest("part", "other"))
    found = pinned(placed.select(*by, "i", "j", "part", "id", "embedding", "mult", "home")
                   .groupBy(*by, "i", "j").applyInArrow(cell_links(threshold), "id long, root long, n long"))
    roots = connected_components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    known = classes.join(found.groupBy("id").agg(F.sum("n").alias("links")), "id", "left") \
        .join(roots.withColumnRenamed("node", "id"), "id", "left") \
        .withColumn("root", F.coalesce("root", "id")) \
        .select("label", "embedding", "least", "root", (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n_links"))
    smallest = known.groupBy("root").agg(F.min("least").alias("component_id"))
    known = pinned(known.join(smallest, "root").select("label", "embedding", "n_links", "component_id"))
    linked = rows.filter("_valid").join(known, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = rows.filter("not _valid").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
