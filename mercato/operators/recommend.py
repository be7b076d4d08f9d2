"""Ranked recommendations and how well they rank (T9), with popularity beside them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

USERS, ITEMS = 65_536, 500_000     # ranked together in a task, sent to the tasks at once
GROUP, GROUPS_AT_ONCE = 64, 8      # persons that share a bound, and their groups whose bounds are made at once
FIRST = 2048                       # items multiplied out at once
LEAST = -1e300


def leave_last_out(purchases: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(last, rest): for every person with several products the one bought last for the first time (of equal times
    the largest id), and all other (customer_unique_id, product_id, interaction_count) rows.  Nulls are left out."""
    inter = purchases.filter("customer_unique_id is not null and product_id is not null") \
        .groupBy("customer_unique_id", "product_id").agg(F.count(F.lit(1)).alias("interaction_count"),
                                                         F.min("order_purchase_timestamp").alias("_first"))
    last = inter.groupBy("customer_unique_id").agg(F.max(F.struct("_first", "product_id")).alias("_last"), F.count(F.lit(1)).alias("_n")) \
        .filter("_n > 1").select("customer_unique_id", F.col("_last.product_id").alias("product_id"))
    return last, inter.drop("_first").join(last, ["customer_unique_id", "product_id"], "left_anti")


def _factors(column: pa.ChunkedArray) -> np.ndarray:
    col = column.combine_chunks()
    n = len(col)
    return col.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(n, -1) if n else np.empty((0, 0))


def _alike(x: np.ndarray, most: int) -> list[np.ndarray]:
    """The rows in groups of up to ``most`` that lie near each other: halved again and again across the widest column."""
    open_, out = [np.arange(len(x))], []
    while open_:
        own = open_.pop()
        if len(own) <= most:
            out.append(own)
            continue
        column = x[own, x[own].var(axis=0).argmax()]
        order = np.argsort(column, kind="stable")
        open_ += [own[order[:len(own) // 2]], own[order[len(own) // 2:]]]
    return out


def best_unseen(x: np.ndarray, seen: list[np.ndarray], y: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of ``x``, row of ``y``, product): each x's ``k`` largest products with the ``y`` but its ``seen`` ones, ties to the smaller row of y.

    Rows of x that lie near each other are ranked together.  With c their mean and r the largest distance from it, no product
    with y is above c y + r |y|, so a y whose bound is below the k-th best of all of them is left out: it can't be among
    any one's k best.  What is left is multiplied out, and what reaches a row's k-th best is told."""
    out, where = [], np.full(len(y), -1, np.int64)
    size_y = np.sqrt((y * y).sum(axis=1))
    slack = 1e-12 * np.sqrt((x * x).sum(axis=1)).max(initial=0) * size_y.max(initial=0)      # products differ by rounding
    groups = _alike(x, GROUP) if len(x) and len(y) else []
    for at in range(0, len(groups), GROUPS_AT_ONCE):
        some = groups[at:at + GROUPS_AT_ONCE]
        centers = np.array([x[g].mean(axis=0) for g in some])
        bounds = centers @ y.T
        for own, center, bound in zip(some, centers, bounds, strict=True):
            mine = x[own]
            bound += np.sqrt(((mine - center) ** 2).sum(axis=1)).max() * size_y + slack
            known = np.concatenate([seen[i] for i in own])
            of = np.repeat(np.arange(len(own)), [len(seen[i]) for i in own])
            u, j, v = (np.empty(0, t) for t in (np.int64, np.int64, float))
            kth = np.full(len(own), -np.inf)
            first = np.argpartition(-bound, FIRST)[:FIRST] if len(y) > FIRST else np.arange(len(y))
            rest = None
            while len(first):
                score = mine @ y[first].T
                where[first] = np.arange(len(first))
                hit = where[known]
                where[first] = -1
                score[of[hit >= 0], hit[hit >= 0]] = -np.inf
                if rest is None and len(first) > k:
                    kth = np.partition(score, len(first) - k, axis=1)[:, len(first) - k]
                r, c = np.nonzero(score >= np.maximum(kth - slack, LEAST)[:, None])
                u, j = np.concatenate([u, r]), np.concatenate([j, first[c]])
                v = np.concatenate([v, (mine[r] * y[first[c]]).sum(axis=1)])
                order = np.lexsort((j, -v, u))
                u, j, v = u[order], j[order], v[order]
                begin = np.searchsorted(u, np.arange(len(own)))
                top = np.arange(len(u)) - begin[u] < k
                u, j, v = u[top], j[top], v[top]
                n = np.bincount(u, minlength=len(own))
                kth = np.where(n == k, v[np.minimum(np.cumsum(n), len(v)) - 1] if len(v) else -np.inf, -np.inf)
                if rest is None:
                    bound[first] = -np.inf
                    rest = np.flatnonzero(bound >= max(kth.min(), LEAST))
                    rest = rest[np.argsort(-bound[rest], kind="stable")]
                rest = rest[:np.searchsorted(-bound[rest], -kth.min(), side="right")]
                first, rest = rest[:FIRST], rest[FIRST:]
            out.append((own[u], j, v))
    return tuple(np.concatenate(c) for c in zip(*out)) if out else (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))


def recommend(users: DataFrame, items: DataFrame, ids: DataFrame, k: int) -> DataFrame:
    """(customer_unique_id, rank, product_id, score): each person's ``k`` best products that ``ids`` doesn't know as bought.

    ``users`` and ``items`` are factor tables (id, features).  Items are sent to the tasks, ``ITEMS`` at a time, and a task returns
    ``k`` rows a user for each: persons and their own products are shuffled once, and no table of pairs or copies is made.  Ties go
    to the smaller product index."""
    spark = users.sparkSession
    seen = ids.groupBy(F.col("customer_idx").alias("id")).agg(F.collect_list(F.col("product_idx").cast("long")).alias("seen"))     # a person's own products
    left = users.join(seen, "id", "left").select(F.col("id").cast("long").alias("id"), "features", "seen")
    last = items.agg(F.max("id")).first()[0]

    def ranked_in(first: int) -> DataFrame:
        part = items.filter(F.col("id").between(first, first + ITEMS - 1)).select("id", "features").toArrow().sort_by("id")
        shared = spark.sparkContext.broadcast((part.column("id").to_numpy().astype(np.int64), _factors(part.column("features")).astype(np.float32)))

        def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            item, factors = shared.value
            y = factors.astype(float)

            def rows(held: list[pa.RecordBatch]) -> pa.RecordBatch:
                a = pa.Table.from_batches(held).combine_chunks()
                own = pc.fill_null(pc.list_value_length(a.column("seen")), 0).to_numpy().astype(np.int64)
                flat = a.column("seen").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                place = np.searchsorted(item, flat)
                here = np.flatnonzero((place < len(item)) & (item[np.minimum(place, len(item) - 1)] == flat)) if len(item) else np.empty(0, np.int64)
                by = np.searchsorted(np.repeat(np.arange(len(own)), own)[here], np.arange(len(own) + 1))
                known = [place[here[s:e]] for s, e in zip(by[:-1], by[1:])]
                u, j, v = best_unseen(_factors(a.column("features")), known, y, k)
                return pa.record_batch([pa.array(a.column("id").to_numpy()[u].astype(np.int64)), pa.array(item[j]), pa.array(v)], names=["customer_idx", "product_idx", "score"])

            held, n = [], 0
            for batch in batches:
                held.append(batch)
                n += batch.num_rows
                if n >= USERS:
                    yield rows(held)
                    held, n = [], 0
            if n:
                yield rows(held)

        return left.mapInArrow(best, "customer_idx long, product_idx long, score double")

    parts = [ranked_in(first) for first in range(0, (last or 0) + 1, ITEMS)]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    ranked = Window.partitionBy("customer_idx").orderBy(F.col("score").desc(), "product_idx")
    found = found.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
    return found.join(ids.select("customer_idx", "customer_unique_id").distinct(), "customer_idx") \
        .join(ids.select("product_idx", "product_id").distinct(), "product_idx").select("customer_unique_id", "rank", "product_id", "score")


def popular_unseen(ids: DataFrame, k: int) -> DataFrame:
    """The same for the products that most persons bought (ties to the smaller id); score is their number."""
    seen = ids.groupBy("customer_unique_id").agg(F.collect_list("product_id").alias("seen"))
    longest = seen.agg(F.max(F.size("seen"))).first()[0] or 0
    # the first k + longest products hold k unseen ones for everybody
    top = ids.groupBy("product_id").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "product_id").limit(k + longest)
    listed = top.agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("away"), "product_id"))).alias("listed"))
    mine = seen.crossJoin(F.broadcast(listed)) \
        .withColumn("listed", F.slice(F.filter("listed", lambda p: ~F.array_contains("seen", p["product_id"])), 1, k))
    return mine.select("customer_unique_id", F.posexplode("listed").alias("at", "p")).select(
        "customer_unique_id", (F.col("at") + 1).alias("rank"), F.col("p.product_id").alias("product_id"), (-F.col("p.away")).cast("double").alias("score"))


def ranking_metrics(top: DataFrame, last: DataFrame, k: int, prefix: str) -> DataFrame:
    """One row: persons judged, and recall and NDCG at ``k`` of the product that was left out."""
    hit = last.join(top.filter(F.col("rank") <= k), ["customer_unique_id", "product_id"], "left")
    share = lambda x: F.coalesce(F.try_divide(F.sum(x), F.count(F.lit(1))), F.lit(0.0))
    return hit.agg(F.count(F.lit(1)).alias(f"{prefix}judged"), share(F.when(F.col("rank").isNotNull(), 1.0).otherwise(0.0)).alias(f"{prefix}recall"),
                   share(F.coalesce(F.lit(1.0) / F.log2(F.col("rank") + 1), F.lit(0.0))).alias(f"{prefix}ndcg"))
