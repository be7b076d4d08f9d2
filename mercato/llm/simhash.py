"""SimHash near-dedup over a byte-position inverted index with count filtering.

Two 64-bit fingerprints that differ in at most ``max_bits`` bits differ in at most that many
of their eight bytes, so they share at least ``8 - max_bits`` positional bytes.  A posting of
one byte would hold one in 256 of all documents; so the index is keyed by sets of byte
positions, chosen so that every choice of differing bytes leaves at least one set untouched
(for three bits: the 14 four-byte sets of the Steiner system S(3, 4, 8)).  Within a posting
the shared positional bytes of each pair are tallied, pairs that reach the guaranteed minimum
are kept and verified by their bit distance.

Only distinct fingerprints are indexed, so copies are one entry.  A posting with more than
``POSTING`` entries is not compared in one task: its entries are indexed again over the bits
that the posting leaves open, in eighths of half the width (4, 2, then 1 bit), by the same
argument.  After four levels at most 16 distinct fingerprints can share a posting.  From
each posting only the edges of a spanning star are sent on.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import boxed, pinned, rows_with
from .graph import connected_components
from .tokenize import text_batches

POSTING = 1024
BATCH_BYTES = 4 << 20
SHINGLE_BLOCK = 1 << 16


def fingerprint(text: bytes, shingle: int) -> int:
    """Fingerprint of a text: A-Z lowered, words between white space, shingles space-joined."""
    import xxhash
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begins = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    ones, n = np.zeros(64, np.int64), len(words) - k + 1
    for a in range(0, n, SHINGLE_BLOCK):
        spans = zip(begins[a:min(a + SHINGLE_BLOCK, n)].tolist(), ends[a + k - 1:a + k - 1 + SHINGLE_BLOCK].tolist())
        h = np.array([digest(joined[x:y], 42) for x, y in spans], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, digest, fp): the text's hash and its fingerprint, signed longs, for every row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, "text", BATCH_BYTES):
            texts = pc.fill_null(batch.column("text").cast(pa.large_binary()), b"").to_pylist()
            fp = np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)
            yield pa.record_batch([batch.column("doc_id"), batch.column("digest"), pa.array(fp)],
                                  names=["doc_id", "digest", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("digest"), "text") \
        .mapInArrow(run, "doc_id long, digest long, fp long")


def position_sets(max_bits: int) -> list[tuple[int, ...]]:
    """Sets of the positions 0..7 such that any ``max_bits`` positions miss at least one set."""
    if max_bits <= 3:
        return [s for s in combinations(range(8), 4) if s[0] ^ s[1] ^ s[2] ^ s[3] == 0]
    return list(combinations(range(8), 8 - max_bits))


def masks_within(mask: int, max_bits: int) -> list[int]:
    """Bit masks that extend ``mask``: its open bits in eight pieces, one mask a position set."""
    open_bits = [i for i in range(64) if not mask >> i & 1]
    pieces = [sum(1 << int(i) for i in p) for p in np.array_split(open_bits, 8)]
    return [mask | sum(pieces[i] for i in s) for s in position_sets(max_bits)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def posting_edges(members: DataFrame, max_bits: int) -> DataFrame:
    """(a, b) spanning edges of the verified links in each posting (mask, key) of ``members``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []                             # the last, perhaps unfinished posting
        for batch in batches:
            rows = np.stack([batch.column(c).to_numpy() for c in ("mask", "key", "fp")])
            rows = np.concatenate([*held, rows], axis=1)
            cut = np.flatnonzero((rows[:2, 1:] != rows[:2, :-1]).any(axis=0)) + 1
            bounds = [0, *cut.tolist()]
            held = [rows[:, bounds[-1]:]]
            yield _edges([rows[2, a:b] for a, b in zip(bounds, bounds[1:])], max_bits)
        if held:
            yield _edges([held[0][2]], max_bits)

    return members.select("mask", "key", "fp").repartition("mask", "key").sortWithinPartitions("mask", "key", "fp") \
        .mapInArrow(run, "a long, b long")


def _edges(postings: list[np.ndarray], max_bits: int) -> pa.RecordBatch:
    a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for fps in postings:
        m = len(fps)
        x = fps[:, None] ^ fps[None, :]
        shared = (x.view(np.uint8).reshape(m, m, 8) == 0).sum(axis=2, dtype=np.int8)    # the tally of each pair
        near = shared >= 8 - max_bits
        near &= np.bitwise_count(x.view(np.uint64)) <= max_bits
        label = np.arange(m)
        while True:
            lower = np.where(near, label[None, :], m).min(axis=1)
            if (lower == label).all():
                break
            label = lower
        own = label != np.arange(m)
        a.append(fps[own])
        b.append(fps[label[own]])
    return pa.record_batch([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])


def near_edges(fps: DataFrame, max_bits: int, posting: int = POSTING) -> DataFrame:
    """Edges (a, b) that connect exactly the fingerprints (distinct ``fp``) within ``max_bits`` bits."""
    spark = fps.sparkSession
    masks = {0: masks_within(0, max_bits)}
    level = fps.select(F.lit(0).cast("long").alias("mask"), "fp")
    edges: DataFrame | None = None
    for depth in range(4):
        if depth == 0:
            index = level.select("fp", F.explode(F.array(*[F.lit(_signed(m)) for m in masks[0]])).alias("mask"))
        else:
            # a table of constant size: it depends on max_bits alone
            table = spark.createDataFrame([(_signed(m), _signed(s)) for m, subs in masks.items() for s in subs],
                                          "mask long, sub long")
            index = level.join(F.broadcast(table), "mask").select("fp", F.col("sub").alias("mask")).distinct()
        index = index.withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
        sizes = index.groupBy("mask", "key").agg(F.count("*").alias("n")).filter("n > 1")
        members = pinned(index.join(sizes, ["mask", "key"]))
        last = depth == 3
        found = posting_edges(members if last else members.filter(F.col("n") <= posting), max_bits)
        edges = found if edges is None else edges.unionByName(found)
        level = members.filter(F.col("n") > posting).select("mask", "fp")
        if last or level.isEmpty():
            break
        masks = {s: masks_within(s, max_bits) for subs in masks.values() for s in subs}
    return edges.distinct()


def _components(docs: DataFrame, shingle: int, max_bits: int) -> DataFrame:
    own = pinned(fingerprints(docs, shingle))
    first = pinned(own.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = connected_components(near_edges(first.select("fp"), max_bits))
    first = pinned(first.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
                   .withColumn("root", F.coalesce("root", "fp")))
    smallest = first.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = pinned(first.join(smallest, "root").select("fp", "component_id"))
    return own.join(classes, "fp")


def simhash_components(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``): doc_id, fingerprint (16 hex digits), component_id.

    Fingerprints at ``max_bits`` or fewer differing bits are linked; component_id is the smallest
    doc_id that links reach, the document's own included.  Texts without words, empty and null ones
    have fingerprint zero and are linked like any other.  Rows with a null doc_id take part; they
    have a null component_id only where no id is reachable.  Other columns are ignored."""
    return _components(docs, shingle, max_bits).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one_of_each(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """The rows of ``docs``, all columns, whose doc_id is their component's smallest.

    Rows without an id stay only in components that hold no id."""
    inner, columns = boxed(docs, ["doc_id", "text"])
    kept = _components(inner, shingle, max_bits).filter(F.col("doc_id").eqNullSafe(F.col("component_id"))) \
        .select("doc_id", "digest").distinct()
    return rows_with(inner, kept, {"doc_id": F.col("doc_id"), "digest": F.xxhash64("text")}).select(*columns)
