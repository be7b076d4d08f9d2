"""Best-two-fit packing of documents into sequences of a fixed number of tokens.

Lengths are whole numbers up to the sequence length, so all that the packing rule needs
is how many pieces have each length.  The rule runs on that histogram (one row a length):
a bin is filled greedily with the longest piece that fits, then its smallest piece is
replaced by two unpacked ones that fill its expanded gap more tightly, and the resulting
pattern of lengths is used for as many bins as the counts allow.  Pieces are numbered
within their length (in parts, so that a common length spreads over many tasks) and find
their bin and offset by that number.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import pinned
from .tokenize import BatchEncoder, text_batches

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
BATCH_BYTES = 4 << 20


def token_pieces(docs: DataFrame, tokenizer: str, max_len: int = 2048, end_id: int = 0) -> DataFrame:
    """Every document's ids (with ``end_id`` appended) as pieces of at most ``max_len`` ids.

    Only longer documents are cut; the first piece takes what the full ones leave over.
    Null and empty texts are one piece that holds the end id alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = BatchEncoder.of(tokenizer)
        for batch in text_batches(batches, "text", BATCH_BYTES):
            ids, offsets = encoder.encode(batch.column("text"))
            rows: list[tuple[int, int, int, int, int]] = []
            for i in range(batch.num_rows):
                own = np.append(ids[offsets[i]:offsets[i + 1]], end_id).astype("<u4")
                n = len(own)
                cuts = [0, *range(n % max_len or max_len, n + 1, max_len)]
                rows.extend((i, k, a, b - a, zlib.crc32(own[a:b])) for k, (a, b) in enumerate(zip(cuts, cuts[1:])))
            row, piece, start, length, crc = map(np.array, zip(*rows))
            yield pa.record_batch([batch.column("doc_id").take(pa.array(row)), pa.array(piece, pa.int32()),
                                   *(pa.array(x, pa.int64()) for x in (start, length, crc))],
                                  names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES)


def best_two_fit(counts: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """Patterns of lengths and how many bins use each, for ``counts`` pieces of each length."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    out = []
    while (there := np.flatnonzero(left)).size:
        own = left.copy()
        pattern = [int(there[-1])]
        own[pattern[0]] -= 1
        gap = capacity - pattern[0]
        while gap > 0 and (fits := np.flatnonzero(own[:gap + 1])).size:
            pattern.append(int(fits[-1]))
            own[pattern[-1]] -= 1
            gap -= pattern[-1]
        while gap > 0 and len(pattern) > 1 and (pair := _two_that_fit(own, pattern[-1], pattern[-1] + gap)):
            gap += pattern[-1] - sum(pair)
            own[pattern.pop()] += 1
            for x in pair:
                own[x] -= 1
            pattern = sorted([*pattern, *pair], reverse=True)
        need = {x: pattern.count(x) for x in set(pattern)}
        bins = int(min(left[x] // n for x, n in need.items()))
        for x, n in need.items():
            left[x] -= n * bins
        out.append((pattern, bins))
    return out


def _two_that_fit(left: np.ndarray, above: int, room: int) -> tuple[int, int] | None:
    """Two available lengths whose sum is the largest that is over ``above`` and at most ``room``."""
    have = np.flatnonzero(left[:room])
    if not have.size:
        return None
    # the longest partner of each length; a length that is there once isn't its own partner
    at = np.searchsorted(have, room - have, side="right") - 1
    at = np.where((at >= 0) & (have[at] == have) & (left[have] < 2), at - 1, at)
    total = np.where(at >= 0, have + have[at], 0)
    best = int(total.argmax())
    return (int(have[best]), int(have[at[best]])) if total[best] > above else None


def pack(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces with a ``length`` of 1 to ``capacity``.

    The pieces of a sequence stand in it without gaps from offset 0.  Equal rows are
    interchangeable; an empty table gives an empty result."""
    spark = pieces.sparkSession
    pieces = pinned(pieces)
    histogram = {int(r[0]): int(r[1]) for r in pieces.groupBy("length").count().collect()}  # at most `capacity` rows
    plan, used, base = [], dict.fromkeys(histogram, 0), 0
    for pattern, bins in best_two_fit(histogram, capacity):
        for x in dict.fromkeys(pattern):
            n = pattern.count(x)
            plan.append((x, used[x], used[x] + n * bins, base, n, sum(y for y in pattern if y > x)))
            used[x] += n * bins
        base += bins
    slots = spark.createDataFrame(plan, "length long, _from long, _to long, _base long, _each int, _at long")

    parts = 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = pieces.withColumn("_part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(parts)))
    before = (own.groupBy("length", "_part").count()
              .withColumn("_before", F.sum("count").over(Window.partitionBy("length").orderBy("_part")) - F.col("count"))
              .drop("count"))
    ranked = own.withColumn("_n", F.row_number().over(
        Window.partitionBy("length", "_part").orderBy("doc_id", "piece", "ids_crc32", "start"))) \
        .join(before, ["length", "_part"]).withColumn("_rank", F.col("_n") - 1 + F.col("_before"))
    # patterns come from a histogram of `capacity` lengths; few enough rows are checked, not assumed
    slots = F.broadcast(slots) if len(plan) <= 100_000 else slots
    step = F.col("_rank") - F.col("_from")
    return (ranked.join(slots, "length").filter((F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to")))
            .withColumn("sequence_id", F.col("_base") + F.floor(step / F.col("_each")))
            .withColumn("offset", F.col("_at") + step % F.col("_each") * F.col("length"))
            .drop("_part", "_before", "_n", "_rank", "_from", "_to", "_base", "_each", "_at"))


def best_fit_packing(docs: DataFrame, tokenizer: str, max_len: int = 2048, end_id: int = 0) -> DataFrame:
    """Packs all documents (columns ``doc_id``, ``text``) into sequences of at most ``max_len`` ids.

    One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.  Null texts
    count as empty, a null doc_id is packed like any other, repeated rows are packed each."""
    packed = pack(token_pieces(docs, tokenizer, max_len, end_id), max_len)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
