"""Mixing sources to target weights by capped water-filling.

Sources share the total size by weight; a target stops at ``max_epochs`` times its source's
size and what it leaves is shared again, by weight, among the sources that aren't clamped.
The rounds end at a known level: with the sources in order of cap / weight, the clamped ones
are those whose cap is under their share of what the sources before them left.

A source's target is met by whole repetitions of all its documents and one more of some:
those whose seeded hash is below the point at which their sizes add up to the rest.  The
point is found from sums by hash bucket, so nothing is sorted and no source meets in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import boxed, n_words, pinned, trimmed

BUCKETS = 4096
MAX_SENT = 100_000                 # sources whose plan is sent to every task
WEIGHTS = (5, 2, 1)


def _hash(seed: str, begin: int) -> Column:
    """28 seeded bits of a document's id (the same for a null one everywhere)."""
    digest = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(f":{seed}")).cast("binary"))
    return F.conv(F.substring(digest, begin, 7), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = 3) -> DataFrame:
    """``sizes`` (source, source_size; one row a source) with ``target``.

    Sources by code point, null last, take the weights in turn.  The windows below run over
    the table of sources, which has a row a source and not a row a document."""
    order = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.lit(weights[-1])
    for i, w in enumerate(weights[:-1]):
        weight = F.when(order % len(weights) == i, F.lit(w)).otherwise(weight)
    w = sizes.withColumn("_w", weight.cast("long")).withColumn("_cap", F.col("source_size") * max_epochs)
    by_level = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_level.rowsBetween(0, Window.unboundedFollowing)
    w = (w.withColumn("_left", F.sum("source_size").over(Window.partitionBy()) - F.coalesce(F.sum("_cap").over(before), F.lit(0)))
         .withColumn("_weights", F.sum("_w").over(rest)))
    # the first source that its share doesn't fill sets the level of all that follow
    w = w.withColumn("_open", F.col("_left") * F.col("_w") <= F.col("_cap") * F.col("_weights"))
    first = F.first(F.when(F.col("_open"), F.struct("_left", "_weights")), ignorenulls=True).over(
        by_level.rowsBetween(Window.unboundedPreceding, 0))
    w = w.withColumn("_level", first)
    share = F.col("_level._left").cast("double") * F.col("_w") / F.col("_level._weights")
    return w.select("source", "source_size", F.when(F.col("_level").isNull(), F.col("_cap").cast("double"))
                    .otherwise(F.least(share, F.col("_cap").cast("double"))).alias("target"))


def mixing_plan(own: DataFrame, weights: tuple[int, ...], max_epochs: int) -> DataFrame:
    """One row a source: source, source_size, target, whole repetitions, and where the next one ends.

    ``own`` has source, size and the seeded ``_bucket`` of every document."""
    sums = own.groupBy("source", "_bucket").agg(F.sum("size").alias("_mass"))
    targets = pinned(source_targets(sums.groupBy("source").agg(F.sum("_mass").alias("source_size")), weights, max_epochs))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    targets = targets.withColumn("_whole", whole).withColumn("_rest", F.col("target") - F.col("_whole") * F.col("source_size"))
    # the bucket in which a source's rest runs out, and the share of it that is taken
    upto = F.sum("_mass").over(Window.partitionBy("source").orderBy("_bucket"))
    share = (F.col("_rest") - F.col("_upto") + F.col("_mass")) / F.col("_mass")
    cut = _match(sums.withColumn("_upto", upto), targets.select("source", "_rest")) \
        .filter((F.col("_upto") > F.col("_rest")) & (F.col("_mass") > 0)) \
        .groupBy("source").agg(F.min(F.struct("_bucket", share.alias("share"))).alias("_cut"))
    return pinned(_match(targets, cut, "left").select("source", "source_size", "target", "_whole", "_cut"))


def _match(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    right = right.withColumnRenamed("source", "_source")
    return left.join(right, F.col("source").eqNullSafe(F.col("_source")), how).drop("_source")


def _with_plan(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """The table of sources is sent to every task while it is small, which is checked."""
    return _match(rows, F.broadcast(plan) if plan.count() <= MAX_SENT else plan)


def _repeats(size: Column, bucket: Column, fine: Column) -> Column:
    more = F.when(F.col("_cut").isNull(), F.lit(0)).when(bucket < F.col("_cut._bucket"), F.lit(1)) \
        .when((bucket == F.col("_cut._bucket")) & (fine < F.col("_cut.share") * (1 << 28)), F.lit(1)).otherwise(F.lit(0))
    return F.when(size > 0, F.col("_whole") + more).otherwise(0).cast("long")


def _sized(docs: DataFrame, seed: str) -> DataFrame:
    return pinned(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"))
                  .withColumn("_bucket", _hash(seed, 1) % BUCKETS).withColumn("_fine", _hash(seed, 9)))


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = 3, seed: str = "mix") -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``, ``source``): doc_id, size, source, source_size,
    target, repeats, taken (= repeats x size).

    A document's size is its number of words (null text: 0).  Documents without words are never
    repeated.  Equal ids get equal decisions within a source; reruns agree.  An empty table gives
    an empty result; other columns are ignored."""
    own = _sized(docs, seed)
    rows = _with_plan(own, mixing_plan(own, weights, max_epochs))
    return rows.withColumn("repeats", _repeats(F.col("size"), F.col("_bucket"), F.col("_fine"))) \
        .select("doc_id", "size", "source", "source_size", "target", "repeats",
                (F.col("repeats") * F.col("size")).alias("taken"))


def repeated(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = 3, seed: str = "mix") -> DataFrame:
    """The rows of ``docs``, all columns, as often as ``mix_sources`` takes them."""
    inner, columns = boxed(docs, ["doc_id", "text", "source"])
    taken = _with_plan(inner, mixing_plan(_sized(inner, seed), weights, max_epochs))
    times = _repeats(F.length(trimmed(F.col("text"))), _hash(seed, 1) % BUCKETS, _hash(seed, 9))
    return taken.withColumn("_again", F.explode(F.array_repeat(F.lit(0), times.cast("int")))).select(*columns)
