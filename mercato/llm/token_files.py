"""Token-id shards with Elias-Fano document boundaries.

A data set is a folder of shard files and a ``manifest`` table (one row a shard).  A shard
holds the concatenated ids of a run of documents in ascending doc_id order:

    magic | ids (16 bits if the vocabulary allows, else 32) | doc ids | boundaries | footer

Doc ids and boundaries are Elias-Fano sequences: the low bits of each value are packed,
the high bits are a unary bit vector, and every 256th one's position is kept as a 32-bit
number so that ``select`` reads a short stretch of bits.  That is about 2 + log2(ids a
document) bits a boundary, without 64-bit offset tables.  Files are written under a
temporary name and moved, so a repeated task replaces its own file by the same bytes.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pfs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tokenize import BatchEncoder, text_batches

MAGIC = b"MTOK0001"
SAMPLE = 256
SHARD_IDS = 1 << 26
BATCH_BYTES = 8 << 20
MANIFEST = "shard long, part int, file string, n_docs long, n_ids long"
DOCUMENTS = "doc_id long, start long, n_tokens long, ids_crc32 long"


class EliasFano:
    """A non-decreasing sequence of whole numbers from 0 in near-minimal space."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        v = np.asarray(values, np.uint64)
        n = len(v)
        if n == 0:
            return cls(0, 0, np.empty(0, np.uint8), np.empty(0, np.uint8), np.empty(0, "<u4"))
        low_bits = max(0, (int(v[-1]) // n).bit_length() - 1)
        ones = (v >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(ones[-1]) + 1, np.uint8)
        bits[ones] = 1
        shifts = np.arange(low_bits, dtype=np.uint64)
        low = ((v[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).reshape(-1)
        return cls(n, low_bits, np.packbits(low, bitorder="little"), np.packbits(bits, bitorder="little"),
                   ones[::SAMPLE].astype("<u4"))

    def _low(self, i: int) -> int:
        a, b = i * self.low_bits, (i + 1) * self.low_bits
        stretch = int.from_bytes(self.low[a // 8:(b + 7) // 8].tobytes(), "little")
        return stretch >> a % 8 & (1 << self.low_bits) - 1

    def select(self, i: int) -> int:
        """Value number ``i``."""
        k = i // SAMPLE
        begin = int(self.samples[k])
        end = int(self.samples[k + 1]) + 1 if k + 1 < len(self.samples) else 8 * len(self.high)
        bits = np.unpackbits(self.high[begin // 8:(end + 7) // 8], bitorder="little")[begin % 8:]
        one = begin + int(np.flatnonzero(bits)[i % SAMPLE])
        return one - i << self.low_bits | self._low(i)

    def values(self) -> np.ndarray:
        """All values at once."""
        if self.n == 0:
            return np.empty(0, np.int64)
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[:self.n]
        high = (ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)
        if not self.low_bits:
            return high.astype(np.int64)
        bits = np.unpackbits(self.low, bitorder="little", count=self.n * self.low_bits).reshape(self.n, self.low_bits)
        low = (bits.astype(np.uint64) << np.arange(self.low_bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
        return (high | low).astype(np.int64)

    def parts(self) -> list[bytes]:
        return [self.low.tobytes(), self.high.tobytes(), self.samples.astype("<u4").tobytes()]

    def sizes(self) -> list[int]:
        return [self.n, self.low_bits, *map(len, self.parts())]

    @classmethod
    def read(cls, f, at: int, sizes: list[int]) -> EliasFano:
        n, low_bits, a, b, c = sizes
        part = lambda pos, size, kind: np.frombuffer(f.read_at(size, pos), kind)
        return cls(n, low_bits, part(at, a, np.uint8), part(at + a, b, np.uint8), part(at + a + b, c, "<u4"))


class _ShardWriter:
    def __init__(self, folder: str, shard: int, part: int, dtype: np.dtype):
        self.fs, root = pfs.FileSystem.from_uri(folder)
        self.file = f"shard-{shard:06d}-{part:04d}.ids"
        self.temp, self.path = f"{root}/.{self.file}.{uuid.uuid4().hex}", f"{root}/{self.file}"
        self.out = self.fs.open_output_stream(self.temp)
        self.out.write(MAGIC)
        self.dtype, self.n_ids, self.docs, self.ends = dtype, 0, [], [np.zeros(1, np.int64)]

    def add(self, doc_ids: list[int | None], ids: np.ndarray, ends: np.ndarray) -> None:
        self.out.write(ids.astype(self.dtype, copy=False).tobytes())
        self.docs.extend(doc_ids)
        self.ends.append(self.n_ids + ends)
        self.n_ids += len(ids)

    def close(self) -> tuple[str, int, int]:
        known = np.array([x for x in self.docs if x is not None], np.int64)   # null ids come first
        first = int(known[0]) if len(known) else 0
        keys = EliasFano.of(known.astype(np.uint64) - np.uint64(first % 2**64))   # wraps to the distance
        bounds = EliasFano.of(np.concatenate(self.ends))
        footer = json.dumps({"width": self.dtype.itemsize, "n_ids": self.n_ids, "nulls": len(self.docs) - len(known),
                             "first": first, "keys": keys.sizes(), "bounds": bounds.sizes()}).encode()
        for x in (*keys.parts(), *bounds.parts(), footer, len(footer).to_bytes(8, "little")):
            self.out.write(x)
        self.out.close()
        self.fs.move(self.temp, self.path)
        return self.file, len(self.docs), self.n_ids


class ShardReader:
    """Random access to one shard file: boundaries by select, ids by a ranged read."""

    def __init__(self, folder: str, file: str):
        fs, root = pfs.FileSystem.from_uri(folder)
        self.f = fs.open_input_file(f"{root}/{file}")
        size = self.f.size()
        n = int.from_bytes(self.f.read_at(8, size - 8), "little")
        if self.f.read_at(8, 0) != MAGIC:
            raise ValueError(f"{file} is no token shard")
        self.footer = meta = json.loads(self.f.read_at(n, size - 8 - n))
        self.dtype = np.dtype(f"<u{meta['width']}")
        at = 8 + meta["n_ids"] * meta["width"]
        self.keys = EliasFano.read(self.f, at, meta["keys"])
        self.bounds = EliasFano.read(self.f, at + sum(meta["keys"][2:]), meta["bounds"])
        self.n_docs = self.bounds.n - 1

    def doc_id(self, i: int) -> int | None:
        i -= self.footer["nulls"]
        return None if i < 0 else self.footer["first"] + self.keys.select(i)

    def doc_ids(self) -> list[int | None]:
        return [None] * self.footer["nulls"] + (self.keys.values() + self.footer["first"]).tolist()

    def read(self, begin: int, end: int) -> np.ndarray:
        """Ids ``begin`` to ``end`` of the shard."""
        return np.frombuffer(self.f.read_at((end - begin) * self.dtype.itemsize, 8 + begin * self.dtype.itemsize), self.dtype)

    def document(self, i: int) -> np.ndarray:
        return self.read(self.bounds.select(i), self.bounds.select(i + 1))


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0,
                      shard_ids: int = SHARD_IDS) -> None:
    """Encodes every document (``doc_id``, ``text``), appends ``end_id`` and writes shards in
    ascending doc_id order (null ids first; rows that share an id stay side by side).

    Null texts are empty.  ``folder`` is a URI that driver and executors share.  A range
    partition is one shard, or several once it passes ``shard_ids`` ids."""
    fs, root = pfs.FileSystem.from_uri(folder)
    fs.create_dir(root, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        shard, part = TaskContext.get().partitionId(), 0
        encoder, writer = BatchEncoder.of(tokenizer), None
        for batch in text_batches(batches, "text", BATCH_BYTES):
            ids, offsets = encoder.encode(batch.column("text"))
            n = batch.num_rows
            ends = offsets[1:] + np.arange(1, n + 1)                 # with the end ids
            ids = np.insert(ids, offsets[1:], end_id)
            if writer and writer.n_ids + len(ids) > shard_ids:
                yield _listed(shard, part, writer)
                writer, part = None, part + 1
            writer = writer or _ShardWriter(folder, shard, part, encoder.dtype)
            writer.add(batch.column("doc_id").to_pylist(), ids, ends)
        if writer:
            yield _listed(shard, part, writer)

    order = [F.col("doc_id").asc_nulls_first(), F.col("_h")]
    (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("_h"))
     .repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
     .mapInArrow(run, MANIFEST).write.parquet(f"{folder}/manifest"))


def _listed(shard: int, part: int, writer: _ShardWriter) -> pa.RecordBatch:
    file, n_docs, n_ids = writer.close()
    return pa.record_batch([pa.array([shard], pa.int64()), pa.array([part], pa.int32()), pa.array([file]),
                            pa.array([n_docs], pa.int64()), pa.array([n_ids], pa.int64())],
                           names=["shard", "part", "file", "n_docs", "n_ids"])


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document from the files of ``folder``: doc_id, start, n_tokens, ids_crc32."""
    manifest = spark.read.parquet(f"{folder}/manifest")
    # one row a shard, so this running sum is a small table whatever the number of ids
    listed = manifest.withColumn("base", F.sum("n_ids").over(Window.orderBy("shard", "part")) - F.col("n_ids"))
    n = manifest.count()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, base in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist()):
                shard = ShardReader(folder, file)
                docs, bounds = shard.doc_ids(), shard.bounds.values()
                for a in range(0, shard.n_docs, 4096):
                    b = min(a + 4096, shard.n_docs)
                    crc = [zlib.crc32(shard.read(x, y).astype("<u4")) for x, y in zip(bounds[a:b], bounds[a + 1:b + 1])]
                    yield pa.record_batch([pa.array(docs[a:b], pa.int64()), pa.array(bounds[a:b] + base, pa.int64()),
                                           pa.array(np.diff(bounds[a:b + 1]), pa.int64()), pa.array(crc, pa.int64())],
                                          names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return listed.select("shard", "part", "file", "base").repartition(max(1, n), "shard", "part").mapInArrow(run, DOCUMENTS)
