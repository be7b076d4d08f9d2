"""Substring dedup: Rabin-Karp hashes of every fixed-length window of words, counted in Spark.

Documents are dealt into blocks by a hash of their id and text.  In each block every window's
hash is taken; equal ones are merged (a hash is sent at most twice) and go, as sorted arrays,
to the bucket that a second, independent Rabin-Karp hash names.  A bucket finds the hashes
that occur more than once anywhere and returns them to the blocks they came from, where the
windows with these hashes merge into maximal removal intervals.  A passage that many documents
share is thus at most two numbers a block, however often it occurs.

Windows are told apart by 64 bits and the bucket number; with n windows and b buckets about
n^2 / (b * 2^65) windows are expected to be taken for another one's copy (3e-5 for 1.4e8
windows in 50 buckets), and b grows with the input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokenize import text_batches

BATCH_BYTES = 8 << 20
BUCKET_BYTES = 32 << 20            # text for which there is one bucket, and two blocks
FLUSH = 4_000_000                  # hashes a task holds before it sends them
BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))     # odd multipliers


def rolling_hashes(values: np.ndarray, length: int, base: np.uint64) -> np.ndarray:
    """Rabin-Karp hash (modulo 2^64) of every run of ``length`` values, built by doubling."""
    n = len(values) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    power, width, have = np.array([base]), 1, values
    out, done = np.zeros(n, np.uint64), 0
    while True:
        if length & width:                                   # the next `width` values of the window
            out = out * power + have[done:done + n]
            done += width
        if done == length:
            return out
        have = have[:-width] * power + have[width:]
        power, width = power * power, 2 * width


class _Windows:
    """The words of a batch of texts and the hashes of their windows."""

    def __init__(self, texts: list[bytes], length: int, buckets: int):
        import xxhash
        self.words = [t.split() for t in texts]
        self.sizes = np.fromiter(map(len, self.words), np.int64, len(texts))
        digest = xxhash.xxh64_intdigest
        values = np.fromiter((digest(w) for ws in self.words for w in ws), np.uint64, int(self.sizes.sum()))
        begins = np.cumsum(self.sizes) - self.sizes
        inside = np.ones(max(0, len(values) - length + 1), bool)       # windows within one text
        for b in begins[1:].tolist():
            inside[max(0, b - length + 1):b] = False
        self.at = np.flatnonzero(inside)
        self.hash = rolling_hashes(values, length, BASES[0])[self.at]
        other = rolling_hashes(values, length, BASES[1])[self.at]
        self.bucket = ((other ^ other >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)
        self.begins = begins


def _sorted(hashes: np.ndarray, buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By bucket, then hash; of equal pairs at most two stay."""
    order = np.argsort(hashes)
    order = order[np.argsort(buckets[order], kind="stable")]
    h, b = hashes[order], buckets[order]
    third = np.zeros(len(h), bool)
    third[2:] = (h[2:] == h[:-2]) & (b[2:] == b[:-2])
    return h[~third], b[~third]


def _runs(values: np.ndarray) -> list[tuple[int, int]]:
    cut = np.flatnonzero(values[1:] != values[:-1]) + 1
    return list(zip([0, *cut.tolist()], [*cut.tolist(), len(values)])) if len(values) else []


def remove_repeats(docs: DataFrame, length: int = 35) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``): doc_id, n_words, n_removed, removed, kept_text.

    Every word that is covered by a window of ``length`` words whose word sequence also starts
    anywhere else (same document included) is removed; windows are judged on the input.
    ``removed`` lists the maximal intervals [begin, end) of word numbers.  Null texts have no words;
    texts under ``length`` words lose none; repeated rows are copies of each other like any texts;
    a null doc_id is like any other.  Other columns are ignored."""
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET_BYTES))
    blocks = 2 * buckets
    # one exchange of the texts serves the hashing and the removal
    dealt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
                        F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int").alias("block")) \
        .repartition(buckets, "block")

    def send(held: dict[int, list]) -> pa.RecordBatch:
        rows: list[tuple[int, int, bytes]] = []
        for block, parts in held.items():
            h, b = _sorted(np.concatenate([x for x, _ in parts]), np.concatenate([y for _, y in parts]))
            rows.extend((block, int(b[x]), h[x:y].tobytes()) for x, y in _runs(b))
        cols = zip(*rows) if rows else ([], [], [])
        return pa.record_batch([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.binary()))],
                               names=["block", "bucket", "hashes"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        n = 0
        for batch in text_batches(batches, "text", BATCH_BYTES):
            own = batch.column("block").to_numpy()
            texts = batch.column("text").cast(pa.large_binary()).to_pylist()
            for block in np.unique(own).tolist():
                w = _Windows([texts[i] for i in np.flatnonzero(own == block)], length, buckets)
                held.setdefault(block, []).append((w.hash, w.bucket))
                n += len(w.hash)
            if n > FLUSH:
                yield send(held)
                held, n = {}, 0
        yield send(held)

    def repeated(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x, "<u8") for x in table.column("hashes").to_pylist()]
        own = table.column("block").to_numpy()
        h, block = np.concatenate(parts), np.repeat(own, [len(x) for x in parts])
        order = np.argsort(h, kind="stable")
        h, block = h[order], block[order]
        same = h[1:] == h[:-1]
        again = np.zeros(len(h), bool)
        again[1:] = same
        again[:-1] |= same
        h, block = h[again], block[again]
        order = np.lexsort((h, block))
        h, block = h[order], block[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (block[1:] != block[:-1])
        h, block = h[new], block[new]
        runs = _runs(block)
        return pa.table({"block": pa.array([int(block[x]) for x, _ in runs], pa.int32()),
                         "bucket": pa.array([table.column("bucket")[0].as_py()] * len(runs), pa.int32()),
                         "hashes": pa.array([h[x:y].tobytes() for x, y in runs], pa.binary())})

    counted = dealt.mapInArrow(hashed, "block int, bucket int, hashes binary") \
        .groupBy("bucket").applyInArrow(repeated, "block int, bucket int, hashes binary")

    def removal(texts: pa.Table, marks: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x, "<u8") for x in marks.column("hashes").to_pylist()]
        known = np.concatenate([np.empty(0, np.uint64), *parts])
        where = np.repeat(marks.column("bucket").to_numpy(), [len(x) for x in parts]).astype(np.int32)
        order = np.argsort(known, kind="stable")
        known, where = known[order], where[order]
        done = [_cleaned(b, known, where, length, buckets)
                for b in text_batches(texts.combine_chunks().to_batches(), "text", BATCH_BYTES)]
        return pa.Table.from_batches(done, CLEANED) if done else CLEANED.empty_table()

    return dealt.groupBy("block").cogroup(counted.groupBy("block")).applyInArrow(
        removal, "doc_id long, n_words long, n_removed long, removed array<struct<begin:long,end:long>>, kept_text string")


CLEANED = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                     ("removed", pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))), ("kept_text", pa.string())])


def _cleaned(batch: pa.RecordBatch, known: np.ndarray, where: np.ndarray, length: int, buckets: int) -> pa.RecordBatch:
    w = _Windows(batch.column("text").cast(pa.large_binary()).to_pylist(), length, buckets)
    again = np.zeros(len(w.hash), bool)
    if len(known):
        at = np.searchsorted(known, w.hash)
        while (open_ := (at < len(known)) & ~again).any():      # more than once only where hashes collide
            i = np.flatnonzero(open_)
            i = i[known[at[i]] == w.hash[i]]
            again[i] = where[at[i]] == w.bucket[i]
            rest = i[~again[i]]
            if not len(rest):
                break
            nxt = np.full(len(at), len(known), at.dtype)
            nxt[rest] = at[rest] + 1
            at = nxt
    starts = w.at[again]
    n = int(w.sizes.sum())
    edge = np.zeros(n + 1, np.int32)
    edge[starts] += 1
    np.subtract.at(edge, starts + length, 1)
    covered = np.cumsum(edge)[:n] > 0
    rows = []
    for i, words in enumerate(w.words):
        a = int(w.begins[i])
        own = covered[a:a + len(words)]
        flip = np.flatnonzero(np.diff(np.concatenate([[0], own.view(np.int8), [0]])))
        spans = [{"begin": int(x), "end": int(y)} for x, y in zip(flip[::2], flip[1::2])]
        kept = words if not spans else [words[j] for j in np.flatnonzero(~own).tolist()]
        rows.append((len(words), int(own.sum()), spans, b" ".join(kept).decode()))
    cols = list(zip(*rows)) if rows else [[], [], [], []]
    return pa.record_batch([batch.column("doc_id"), *(pa.array(c, CLEANED.field(k + 1).type) for k, c in enumerate(cols))],
                           schema=CLEANED)
