"""Gradient-boosted trees for tables of more than some tasks' rows.

The learner is MLlib's: thresholds from a sample of the rows, the first tree on the labels, each later one on the loss's
gradient with ``step_size``, regression trees by variance, rows sampled for each tree and features for each node.  What differs is how
a tree is grown, and the random numbers:

- rows are binned once, a byte a feature, and held column by column in blocks, where numpy counts a block's bins;
- a pass counts one level, and of two siblings the smaller one alone: the other is what their parent had besides;
- the pass that begins a tree also adds the tree before to the rows' sums, so there are as many jobs as levels.

The driver holds the histograms of one level and the trees: their sizes follow the parameters, not the rows.  The result is MLlib's own
model, written in its format and loaded; impurities of nodes are not kept in it (NaN), gains and counts are.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml import PredictionModel
from pyspark.ml.functions import vector_to_array
from pyspark.serializers import BatchedSerializer, CPickleSerializer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import delete_path, ensure_checkpoint_dir

BLOCK = 65_536                     # rows of a block
ROWS_A_PART = 1_000_000            # rows of a task, where there are more than the cores need
LEAST_A_PART = 50_000
SAMPLE = 10_000                    # rows that thresholds come from, or the square of the bins
KEEP_EVERY = 10                    # trees after which the rows' sums are written, so that lineage stays short


@dataclass
class Tree:
    """A tree by places in a heap: the children of i are 2i + 1 and 2i + 2."""

    feature: np.ndarray            # -1: a leaf, or no node
    bin: np.ndarray                # rows up to this bin go left
    gain: np.ndarray
    stats: np.ndarray              # (rows, weight, weighted sum) of each node

    @classmethod
    def empty(cls, depth: int) -> Tree:
        n = 2 ** (depth + 1) - 1
        return cls(np.full(n, -1, np.int32), np.zeros(n, np.int32), np.full(n, -1.0), np.zeros((n, 3)))

    def values(self) -> np.ndarray:
        return np.where(self.stats[:, 1] > 0, self.stats[:, 2] / np.where(self.stats[:, 1] > 0, self.stats[:, 1], 1), 0.0)


def thresholds(sample: np.ndarray, bins: int) -> list[np.ndarray]:
    """Per column at most ``bins - 1`` thresholds between its values, as many rows between each as can be."""
    out = []
    for column in sample.T:
        values, n = np.unique(column[~np.isnan(column)], return_counts=True)
        if len(values) > bins:
            upto = np.cumsum(n)
            at = np.unique(np.searchsorted(upto, upto[-1] * np.arange(1, bins) / bins))
            at = at[at < len(values) - 1]
        else:
            at = np.arange(len(values) - 1)
        out.append((values[at] + values[at + 1]) / 2 if len(at) else np.empty(0))
    return out


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), width)


def _packed(train: DataFrame, cuts: list[np.ndarray], parts: int) -> RDD:
    """Blocks (binned features by column, labels, weights or None where all are 1)."""
    width = len(cuts)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def block() -> pa.RecordBatch:
            x, y, w = (np.concatenate([h[i] for h in held]) for i in range(3))
            binned = np.stack([np.searchsorted(cuts[j], x[:, j]).astype(np.uint8) for j in range(width)])
            return pa.record_batch([pa.array([binned.tobytes()], pa.binary()), pa.array([y.tobytes()], pa.binary()),
                                    pa.array([b"" if (w == 1).all() else w.tobytes()], pa.binary())], names=["x", "y", "w"])

        for batch in batches:
            if batch.num_rows:
                held.append((_matrix(batch.column("x"), width), *(batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in "yw")))
                n += batch.num_rows
            if n >= BLOCK:
                yield block()
                held, n = [], 0
        if n:
            yield block()

    def arrays(row) -> tuple:
        y = np.frombuffer(row["y"], float)
        return np.frombuffer(row["x"], np.uint8).reshape(width, len(y)), y, np.frombuffer(row["w"], float) if len(row["w"]) else None

    rows = train.coalesce(parts).mapInArrow(pack, "x binary, y binary, w binary").rdd.map(arrays)
    return _one_by_one(rows).persist(StorageLevel.MEMORY_AND_DISK)


def _one_by_one(blocks: RDD) -> RDD:
    """A block at a time goes to a task, and blocks of two tables meet by place."""
    return blocks._reserialize(BatchedSerializer(CPickleSerializer(), 1))


def _dealt(x: np.ndarray, rows: np.ndarray | None, tree: Tree, last: int, wanted: set[int] | None = None) -> list[tuple[int, np.ndarray]]:
    """(node, its rows) of the nodes that rows reach by level ``last``; of that level only the ``wanted`` ones."""
    n = x.shape[1]
    level, out = [(0, np.arange(n) if rows is None else rows)], []
    for depth in range(last + 1):
        below = []
        for node, own in level:
            f = tree.feature[node]
            if depth == last or f < 0:
                if wanted is None or node in wanted:
                    out.append((node, own))
                continue
            left = x[f].take(own) <= tree.bin[node]
            for child, side in ((2 * node + 1, left), (2 * node + 2, ~left)):
                if depth + 1 < last or wanted is None or child in wanted:
                    below.append((child, own[side]))
        level = below
    return out


def _gradient(kind: str, y: np.ndarray, total: np.ndarray | None) -> np.ndarray:
    """What the next tree is fitted on: the labels, then the loss's negative gradient."""
    if kind == "squared":
        return y if total is None else 2 * (y - total)
    sign = 2 * y - 1
    return sign if total is None else 4 * sign / (1 + np.exp(np.minimum(2 * sign * total, 700)))


def _add(block: tuple, total: np.ndarray | None, tree: Tree, weight: float) -> np.ndarray:
    """The rows' sums with another tree."""
    out = np.zeros(len(block[1])) if total is None else total.copy()
    values, depth = weight * tree.values(), int(math.log2(len(tree.feature) + 1)) - 1
    for node, own in _dealt(block[0], None, tree, depth):
        out[own] += values[node]
    return out


def _sampled(n: int, rate: float, *key: int) -> np.ndarray:
    return np.flatnonzero(np.random.default_rng(key).random(n, dtype=np.float32) < rate) if rate < 1 else np.arange(n)


def histograms(x: np.ndarray, found: list[tuple[int, np.ndarray]], slots: dict[int, int], bins: int, target: np.ndarray,
               weight: np.ndarray | None) -> np.ndarray:
    """(feature, slot, bin, [rows, weight, weighted sum]) of the rows of each node."""
    own = np.concatenate([r for _, r in found]) if found else np.empty(0, np.int64)
    base = np.repeat(np.array([slots[node] * bins for node, _ in found], np.int64), [len(r) for _, r in found])
    size, out = len(slots) * bins, np.zeros((len(x), len(slots) * bins, 3))
    w = None if weight is None else weight.take(own)
    t = target.take(own) if w is None else target.take(own) * w
    for j in range(len(x) if len(own) else 0):
        code = x[j].take(own) + base
        out[j, :, 0] = np.bincount(code, minlength=size)
        out[j, :, 1] = out[j, :, 0] if w is None else np.bincount(code, w, size)
        out[j, :, 2] = np.bincount(code, t, size)
    return out.reshape(len(x), len(slots), bins, 3)


def best_split(h: np.ndarray, features: np.ndarray) -> tuple[int, int, float, np.ndarray, np.ndarray] | None:
    """(feature, bin, gain, left, right) of a node's histogram (feature, bin, 3), among ``features``; the first of equal ones."""
    left = h[features].cumsum(axis=1)
    whole = left[:1, -1:]
    right = whole - left
    fine = (left[..., 0] >= 1) & (right[..., 0] >= 1) & (left[..., 1] > 0) & (right[..., 1] > 0)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (left[..., 2] ** 2 / left[..., 1] + right[..., 2] ** 2 / right[..., 1] - whole[..., 2] ** 2 / whole[..., 1]) / whole[..., 1]
    gain = np.where(fine, gain, -np.inf)
    i, b = np.unravel_index(int(gain.argmax()), gain.shape)
    return (int(features[i]), int(b), float(gain[i, b]), left[i, b], right[i, b]) if gain[i, b] > 0 else None


def _grow(pairs: RDD, tree_at: int, kind: str, width: int, bins: int, depth: int, share: float, rate: float, seed: int) -> Tree:
    """One tree; ``pairs`` are blocks with their rows' sums, None before the first tree."""
    tree, picked = Tree.empty(depth), max(1, math.ceil(share * width))
    held: dict[int, np.ndarray] = {}                              # histograms of the level's nodes
    rng = np.random.default_rng((seed, tree_at))
    counted, rest = [0], {}                                       # nodes counted by rows; node -> (parent, sibling) for the others
    for level in range(depth):
        slots = {node: i for i, node in enumerate(counted)}

        def run(at: int, blocks: Iterator[tuple], level=level, slots=slots) -> Iterator[np.ndarray]:
            out = np.zeros((width, len(slots), bins, 3))
            for k, ((x, y, w), total) in enumerate(blocks):
                rows = _sampled(len(y), rate, seed, tree_at, at, k)
                out += histograms(x, _dealt(x, rows, tree, level, set(slots)), slots, bins, _gradient(kind, y, total), w)
            yield out

        got = sum(pairs.mapPartitionsWithIndex(run).collect())
        now = {node: got[:, i] for node, i in slots.items()}
        now |= {node: held[parent] - now[sibling] for node, (parent, sibling) in rest.items()}
        counted, rest, held = [], {}, {}
        for node in sorted(now):
            h = now[node]
            if level == 0:
                tree.stats[node] = h[0].sum(axis=0)
            split = best_split(h, np.sort(rng.choice(width, picked, replace=False)))
            if split is None:
                continue
            tree.feature[node], tree.bin[node], tree.gain[node] = split[:3]
            a, b = 2 * node + 1, 2 * node + 2
            tree.stats[a], tree.stats[b] = split[3:]
            if level + 1 < depth:
                held[node] = h
                less, more = (a, b) if split[3][0] <= split[4][0] else (b, a)
                counted.append(less)
                rest[more] = (node, less)
        if not counted:
            break
    return tree


def grow(train: DataFrame, kind: str, p, weight: str | None = None) -> tuple[list[Tree], list[float], list[np.ndarray]]:
    """(trees, their weights, thresholds by feature) for ``train`` (features, label and, if named, ``weight``)."""
    spark = train.sparkSession
    rows = train.select(vector_to_array("features").alias("x"), F.col("label").cast("double").alias("y"),
                        (F.col(weight) if weight else F.lit(1.0)).cast("double").alias("w"))
    n = rows.count()
    few = max(p.max_bins ** 2, SAMPLE)
    sample = rows.select("x").sample(min(1.0, 1.0 * few / n), seed=p.seed) if n > few else rows.select("x")
    cuts = thresholds(np.array([r[0] for r in sample.collect()], float), p.max_bins)      # some ten thousand rows
    width, share = len(cuts), float(p.feature_subset)
    bins = max(len(c) for c in cuts) + 1
    if bins > 256:
        raise ValueError("a bin is a byte: max_bins is 256 at most")
    cores = spark.sparkContext.defaultParallelism
    parts = max(1, min(-(-n // LEAST_A_PART), max(cores, -(-n // ROWS_A_PART))))
    blocks = _packed(rows, cuts, parts)
    ensure_checkpoint_dir(spark)
    trees, weights = [], []
    totals = _one_by_one(blocks.map(lambda b: None))
    before, kept = [], None
    try:
        for t in range(p.max_iter):
            tree = _grow(blocks.zip(totals), t, kind, width, bins, p.max_depth, share, p.subsampling_rate, p.seed)
            for old in before:                                    # its first pass made the sums anew from the old ones
                old.unpersist()
            before = []
            if totals.isCheckpointed() and totals.getCheckpointFile() != kept:
                delete_path(spark, kept)
                kept = totals.getCheckpointFile()
            trees.append(tree)
            weights.append(1.0 if t == 0 else p.step_size)
            if t + 1 < p.max_iter:
                old = totals
                totals = _one_by_one(blocks.zip(old).map(lambda b, tree=tree, w=weights[-1]: _add(*b, tree, w))).persist(StorageLevel.MEMORY_AND_DISK)
                if (t + 1) % KEEP_EVERY == 0:
                    totals.checkpoint()
                before.append(old)
    finally:
        totals.unpersist()
        blocks.unpersist()
        delete_path(spark, kept)
    return trees, weights, cuts


_NODE = ("treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, gain: double, "
         "leftChild: int, rightChild: int, split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>")


def _rows(number: int, tree: Tree, cuts: list[np.ndarray]) -> list[tuple]:
    """A tree's nodes as MLlib stores them: numbered with the left subtree before the right one."""
    out, values = [], tree.values()

    def visit(node: int) -> int:
        own = len(out)
        out.append(None)
        count, weight, total = (float(v) for v in tree.stats[node])
        told = [float(values[node]), float("nan"), [weight, total, float("nan")], int(count)]
        f = int(tree.feature[node])
        if f < 0:
            out[own] = (number, (own, *told, -1.0, -1, -1, (-1, [], -1)))
        else:
            left, right = visit(2 * node + 1), visit(2 * node + 2)
            out[own] = (number, (own, *told, float(tree.gain[node]), left, right, (f, [float(cuts[f][tree.bin[node]])], -1)))
        return own

    visit(0)
    return out


def as_mllib(spark: SparkSession, estimator, trees: list[Tree], weights: list[float], cuts: list[np.ndarray]) -> PredictionModel:
    """MLlib's model of these trees, with the parameters of ``estimator``: written as MLlib writes it, and loaded."""
    from pyspark.ml.util import DefaultParamsReader

    kind = "classification" if "Classifier" in type(estimator).__name__ else "regression"
    params = {p.name: v for p, v in estimator.extractParamMap().items() if p.name not in ("validationIndicatorCol", "thresholds")}
    head = {"timestamp": 0, "sparkVersion": spark.version, "defaultParamMap": {}}
    whole = {**head, "class": f"org.apache.spark.ml.{kind}.{'GBTClassificationModel' if kind == 'classification' else 'GBTRegressionModel'}",
             "uid": estimator.uid, "paramMap": params, "numFeatures": len(cuts), "numTrees": len(trees)}
    each = [{**head, "class": "org.apache.spark.ml.regression.DecisionTreeRegressionModel", "uid": f"dtr_{uuid.uuid4().hex[:12]}",
             "paramMap": {"maxDepth": params["maxDepth"], "featuresCol": params["featuresCol"], "labelCol": params["labelCol"]}} for _ in trees]
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/boosted/{uuid.uuid4().hex}"
    try:
        spark.createDataFrame([(json.dumps(whole),)], "value string").coalesce(1).write.text(f"{path}/metadata")
        spark.createDataFrame([(i, json.dumps(m), float(w)) for i, (m, w) in enumerate(zip(each, weights, strict=True))], "_1 int, _2 string, _3 double") \
            .coalesce(1).write.parquet(f"{path}/treesMetadata")
        spark.createDataFrame([r for i, t in enumerate(trees) for r in _rows(i, t, cuts)], _NODE).coalesce(1).write.parquet(f"{path}/data")
        return DefaultParamsReader.loadParamsInstance(path, spark)
    finally:
        delete_path(spark, path)


def fit(estimator, train: DataFrame, p, weight: str | None = None) -> PredictionModel:
    """What ``estimator`` (MLlib's boosted trees with the parameters ``p``) would fit, by histograms."""
    kind = "logistic" if "Classifier" in type(estimator).__name__ else "squared"
    return as_mllib(train.sparkSession, estimator, *grow(train, kind, p, weight))
