"""Exact dedup by deterministic block naming.

Texts are cut into blocks of a fixed number of characters.  The distinct blocks are sorted
within their hash partition and numbered in that order, so equal blocks get one integer
name and different blocks get different ones.  Then adjacent names are paired and the
distinct pairs are named in the same way, again and again, until one name is left of each
document.  Two documents are equal exactly when they end on the same level with the same
name: no digest is trusted.  Numbering sorted partitions makes names deterministic, so a
recomputed task gives the same ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import boxed, pinned, rows_with

BLOCK_CHARS = 4096
HOT_SHARE = 200                    # content of over one in so many rows is named apart
LEAST_HOT = 1000


def _named(rows: DataFrame, content: list[str]) -> DataFrame:
    """``rows`` with ``name`` in place of ``content``: one integer for each distinct content.

    Content that more than ``1 / HOT_SHARE`` of the rows have (so fewer than HOT_SHARE contents)
    is named from a broadcast table, by negative numbers, so that it doesn't meet in one task."""
    spark, digest = rows.sparkSession, F.xxhash64(*content)
    total, hot = _frequent(rows, digest)
    parts = []
    if hot:
        common = rows.filter(digest.isin(hot)).select(*content).distinct().sort(*content).collect()
        table = spark.createDataFrame([(*r, -1 - i) for i, r in enumerate(common)],
                                      rows.select(*content).schema.add("name", "long"))
        parts.append(_joined(rows.filter(digest.isin(hot)), F.broadcast(table), content))
        rows = rows.filter(~digest.isin(hot))
    names = rows.select(*content).distinct().sortWithinPartitions(*content) \
        .withColumn("name", F.monotonically_increasing_id())
    parts.append(_joined(rows, names, content))
    return parts[0].unionByName(parts[1]) if hot else parts[0]


def _frequent(rows: DataFrame, digest: Column) -> tuple[int, list[int]]:
    """Number of rows, and the digests that more than one in HOT_SHARE of them have."""
    counts = pinned(rows.groupBy(digest.alias("d")).count().filter("count > 1").select("d", "count"))
    total = rows.count()
    least = max(LEAST_HOT, total // HOT_SHARE)
    return total, [r[0] for r in counts.filter(F.col("count") > least).select("d").collect()]


def _joined(rows: DataFrame, names: DataFrame, content: list[str]) -> DataFrame:
    names = names.select(*[F.col(c).alias(f"_{c}") for c in content], "name")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) if c == "right" else F.col(c) == F.col(f"_{c}") for c in content]
    return rows.join(names, same).drop(*content, *[f"_{c}" for c in content])


def block_identity(texts: DataFrame, key: list[str], longest: int, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``key`` columns with ``level`` and ``name``: equal for two texts exactly when the texts are equal.

    ``texts`` has the key columns and ``text``, no nulls; ``longest`` is the longest text's length."""
    n_blocks = F.greatest(F.lit(1), F.ceil(F.length("text") / block_chars)).cast("int")
    blocks = texts.select(*key, n_blocks.alias("_n"), "text", F.explode(F.sequence(F.lit(0), n_blocks - 1)).alias("pos")) \
        .withColumn("block", F.expr(f"substring(text, pos * {block_chars} + 1, {block_chars})")).drop("text")
    named = pinned(_named(blocks, ["block"]))
    level, most, done = 0, max(1, -(-longest // block_chars)), []
    while most > 1:                                     # log2 of the longest text's blocks
        done.append(named.filter("_n = 1").select(*key, F.lit(level).alias("level"), "name"))
        odd = F.col("pos") % 2 == 1
        pairs = pinned(named.filter("_n > 1").groupBy(*key, "_n", F.floor(F.col("pos") / 2).alias("pos")).agg(
            F.max(F.when(~odd, F.col("name"))).alias("left"), F.max(F.when(odd, F.col("name"))).alias("right")))
        named = pinned(_named(pairs, ["left", "right"]).withColumn("_n", F.ceil(F.col("_n") / 2).cast("int")))
        most, level = -(-most // 2), level + 1
    out = named.select(*key, F.lit(level).alias("level"), "name")
    for part in done:
        out = out.unionByName(part)
    return out.distinct()                               # repeated rows have one identity


def exact_dedup(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``): doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after no change; null counts as empty.  Of equal texts the
    row with the largest doc_id stays.  Rows that repeat both id and text get the same values
    (all of them count in group_size); a group whose ids are all null keeps its rows, with a
    null keep_id.  An empty table gives an empty result; other columns are ignored."""
    # rows are told apart by id and content; a null id is written apart from every number
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")).select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"), F.xxhash64("text").alias("_h"),
        F.length("text").alias("_len"), "doc_id", "text")
    key = ["_id", "_h", "_len"]
    narrow = pinned(rows.select(*key, "doc_id", F.sha2("text", 256).alias("text_sha256")))
    longest = narrow.agg(F.max("_len")).first()[0] or 0
    identity = block_identity(rows.select(*key, "text"), key, longest, block_chars)
    own = pinned(identity.join(narrow.groupBy(*key, "doc_id").count(), key))
    groups = own.groupBy("level", "name").agg(F.max("doc_id").alias("keep_id"), F.sum("count").alias("group_size"))
    found = own.join(groups, ["level", "name"]).select(*key, "keep_id", "group_size")
    return narrow.join(found, key).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, of which ``exact_dedup`` keeps one for each text.

    Rows that repeat both id and text are one row in the result."""
    inner, columns = boxed(docs, ["doc_id", "text"])
    digest = F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)
    kept = pinned(exact_dedup(inner).filter("kept").groupBy("doc_id", "text_sha256").count())
    out = rows_with(inner, kept, {"doc_id": F.col("doc_id"), "text_sha256": digest})
    if kept.filter("count > 1").isEmpty():
        return out.select(*columns)
    return out.withColumn("_digest", digest).dropDuplicates(["doc_id", "_digest"]).select(*columns)
