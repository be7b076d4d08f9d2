"""Source divergence audit over a k-squared quadtree of the group-term count matrix.

A language's matrix has a row for each source and a column for each kept term.  Natural text fills
few of its cells, so the matrix is held as a quadtree that splits rows and columns by ``K`` at each
level and has nodes for quadrants with a nonzero cell alone.  To compare all pairs of rows, two row
bands are walked jointly from the root: quadrants that are zero in both bands are left out, and at
the leaves that are nonzero in either one, every pair of rows is compared cell by cell.  A pair's
terms in the quadrants left out all have the same two probabilities, those of a count of zero, so
they are priced by one multiplication.

Spark deals the matrix into blocks of two bands of ``BAND`` rows and a stripe of columns, with as
many stripes as a language has entries for, so that neither a language nor a source nor a term meets
in one task.  Words are counted in batches, before the shuffle.  All arithmetic is on integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import pinned
from .tokenize import text_batches

K = 4                              # rows and columns that a quadrant is split into
BAND = 128                         # sources of a row band
STRIPE = 150_000                   # matrix entries aimed at in a stripe of columns
LEAVES = 1 << 14                   # pairs of leaves compared at once
BATCH_BYTES = 16 << 20
SCALE = 1_000_000_000
MIN_DOCS = 3
TOP_TERMS = 200

# bytes of terms stay, A-Z in lower case; all others separate
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def folded(texts: pa.Array) -> pa.LargeStringArray:
    """The texts with A-Z in lower case and a space for every character that belongs to no term."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = data.slice(ends[0], ends[-1] - ends[0]).to_pybytes() if data is not None and len(texts) else b""
    return pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(np.ascontiguousarray(ends - ends[0]) if len(texts) else np.zeros(1, np.int64)),
                                            pa.py_buffer(raw.translate(_FOLD)))


def batch_counts(batch: pa.RecordBatch) -> pa.RecordBatch:
    """(lang, source, term, n, docs) of a batch of (lang, source, text)."""
    parts = pc.split_pattern(folded(batch.column("text")), " ")
    row = np.repeat(np.arange(len(parts)), np.diff(parts.offsets.to_numpy()))
    flat = parts.flatten()
    some = pc.greater(pc.binary_length(flat), 0)
    coded = flat.filter(some).dictionary_encode()
    row, code, size = row[some.to_numpy(zero_copy_only=False)], coded.indices.to_numpy(), max(1, len(coded.dictionary))
    cells, tf = np.unique(row * size + code, return_counts=True)
    number: dict[tuple, int] = {}
    of = np.array([number.setdefault(g, len(number)) for g in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist())], np.int64)
    keys, at, docs = np.unique(of[cells // size] * size + cells % size, return_inverse=True, return_counts=True)
    group, names = pa.array(keys // size), list(number) or [("", "")]
    return pa.record_batch([pa.array([g[0] for g in names], pa.string()).take(group), pa.array([g[1] for g in names], pa.string()).take(group),
                            coded.dictionary.cast(pa.large_string()).take(pa.array(keys % size)).cast(pa.string()),
                            pa.array(np.bincount(at, tf, len(keys)).astype(np.int64)), pa.array(docs.astype(np.int64))],
                           names=["lang", "source", "term", "n", "docs"])


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of every term of every group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, "text", BATCH_BYTES):
            yield batch_counts(batch)

    return docs.select("lang", "source", "text").mapInArrow(run, "lang string, source string, term string, n long, docs long") \
        .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def probability(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + 1) / (total + terms)); decimal where a long could overflow."""
    below = total + terms
    wide = F.call_function("div", (F.lit(SCALE).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)")), below.cast("decimal(20,0)"))
    return F.when(count < 9 * SCALE, F.call_function("div", F.lit(SCALE).cast("long") * (count + 1), below)).otherwise(wide.cast("long")) + 1


def cost(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _levels(row: np.ndarray, col: np.ndarray, shape: tuple[int, int], k: int) -> list[np.ndarray]:
    """Keys of the nonzero quadrants, root first, leaves of k x k cells last."""
    rows, cols = max(1, -(-shape[0] // k)), max(1, -(-shape[1] // k))
    out = [np.unique((row // k) * cols + col // k)]
    r, c = out[0] // cols, out[0] % cols
    while rows > 1 or cols > 1:
        rows, cols = -(-rows // k), -(-cols // k)
        r, c = r // k, c // k
        out.append(np.unique(r * cols + c))
    return out[::-1]


def _holds(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(wanted), bool)
    at = np.searchsorted(keys, wanted)
    return keys[np.minimum(at, len(keys) - 1)] == wanted


def joint_leaves(a: list[np.ndarray], b: list[np.ndarray], shape: tuple[int, int, int], k: int, same: bool
                 ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row block of a, row block of b, column block) of the leaves that are nonzero in either tree.

    ``shape`` has the leaf blocks of a's rows, of b's rows and of the columns.  With ``same`` the
    trees are one and pairs of row blocks are walked once."""
    sizes = [shape]                                          # nodes of each level, leaves first
    while len(sizes) < len(a):
        sizes.append(tuple(-(-n // k) for n in sizes[-1]))
    ra = rb = c = np.zeros(1, np.int64)
    for level, (na, nb, nc) in enumerate(sizes[::-1]):
        if level:
            step = np.arange(k)
            ra, rb, c = (np.broadcast_to(x * k + y, (len(ra), k, k, k)).ravel() for x, y in (
                (ra[:, None, None, None], step[:, None, None]), (rb[:, None, None, None], step[:, None]),
                (c[:, None, None, None], step)))
            there = (ra < na) & (rb < nb) & (c < nc) & ((ra <= rb) | (not same))
            ra, rb, c = ra[there], rb[there], c[there]
        some = _holds(a[level], ra * nc + c) | _holds(b[level], rb * nc + c)
        ra, rb, c = ra[some], rb[some], c[some]
    return ra, rb, c


def _cells(rows: int, cols: int, row: np.ndarray, col: np.ndarray, p: np.ndarray, k: int
           ) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the nonzero leaves and their k x k values, 0 where a cell is zero."""
    wide = -(-cols // k)
    keys, at = np.unique((row // k) * wide + col // k, return_inverse=True)
    out = np.zeros((len(keys), k, k), np.int64)
    out[at, row % k, col % k] = p
    return keys, out


def block_sums(rows_a: np.ndarray, zero_a: np.ndarray, entries_a: tuple, rows_b: np.ndarray, zero_b: np.ndarray,
               entries_b: tuple, same: bool, k: int = K) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For every pair of rows of two bands: (row, other row, sum of costs, columns compared).

    ``rows`` number the bands' sources, ``zero`` is the probability of a count of zero, and entries
    are (place in the band, column, probability) of the nonzero cells."""
    cols = 1 + max([-1, *(int(e[1].max()) for e in (entries_a, entries_b) if len(e[1]))])
    na, nb = max(1, -(-len(rows_a) // k)), max(1, -(-len(rows_b) // k))
    high = max(na, nb) * k                                   # both trees get as many levels
    a = _levels(entries_a[0], entries_a[1], (high, cols), k)
    b = a if same else _levels(entries_b[0], entries_b[1], (high, cols), k)
    ra, rb, c = joint_leaves(a, b, (max(na, nb), max(na, nb), max(1, -(-cols // k))), k, same)
    there = (ra < na) & (rb < nb)
    ra, rb, c = ra[there], rb[there], c[there]
    wide = -(-cols // k)
    keys_a, cells_a = _cells(len(rows_a), cols, *entries_a, k)
    keys_b, cells_b = (keys_a, cells_a) if same else _cells(len(rows_b), cols, *entries_b, k)
    pad_a, pad_b = np.ones(na * k, np.int64), np.ones(nb * k, np.int64)
    pad_a[:len(zero_a)], pad_b[:len(zero_b)] = zero_a, zero_b
    there_sum, back_sum = np.zeros((na * k, nb * k), np.int64), np.zeros((na * k, nb * k), np.int64)
    seen = np.zeros((na, nb), np.int64)

    def leaf(keys, cells, pad, r, c):
        want = r * wide + c
        at = np.minimum(np.searchsorted(keys, want), max(0, len(keys) - 1))
        out = np.broadcast_to(pad.reshape(-1, k)[r][:, :, None], (len(r), k, k)).copy()
        if len(keys):
            got = np.where((keys[at] == want)[:, None, None], cells[at], 0)
            out = np.where(got > 0, got, out)
        return out

    for s in range(0, len(c), LEAVES):
        x, y, z = ra[s:s + LEAVES], rb[s:s + LEAVES], c[s:s + LEAVES]
        p = leaf(keys_a, cells_a, pad_a, x, z)[:, :, None, :]
        q = leaf(keys_b, cells_b, pad_b, y, z)[:, None, :, :]
        real = (z * k)[:, None] + np.arange(k) < cols        # the last block may be narrower
        square = (p - q) * (p - q) * real[:, None, None, :]
        order = np.argsort(x * nb + y, kind="stable")
        begin = np.flatnonzero(np.diff((x * nb + y)[order], prepend=-1))
        x, y = x[order][begin], y[order][begin]
        seen[x, y] += np.add.reduceat(real.sum(axis=1)[order], begin)
        for out, below in ((there_sum, q), (back_sum, p)):
            out.reshape(na, k, nb, k).transpose(0, 2, 1, 3)[x, y] += np.add.reduceat((square // below).sum(axis=3)[order], begin)
    i, j = np.nonzero(np.repeat(np.repeat(seen, k, axis=0), k, axis=1)[:len(rows_a), :len(rows_b)])
    seen = np.repeat(np.repeat(seen, k, axis=0), k, axis=1)[i, j]
    one, two, first, second = rows_a[i], rows_b[j], there_sum[i, j], back_sum[i, j]
    if same:                                                 # blocks on the diagonal hold both directions
        keep = i // k < j // k
        return (np.concatenate([one, two[keep]]), np.concatenate([two, one[keep]]),
                np.concatenate([first, second[keep]]), np.concatenate([seen, seen[keep]]))
    return np.concatenate([one, two]), np.concatenate([two, one]), np.concatenate([first, second]), np.concatenate([seen, seen])


def _block(key: tuple, table: pa.Table, size: int) -> pa.Table:
    """Sums of one block of bands of ``size`` rows: (row, term_id, p), with a null term for each source's zero count."""
    lang, i, j = (x.as_py() for x in key[:3])
    row, term, p = (table.column(c).combine_chunks() for c in ("row", "term_id", "p"))
    mark = term.is_null().to_numpy(zero_copy_only=False)
    row, p, term = row.to_numpy(), p.to_numpy(), pc.fill_null(term, -1).to_numpy()
    order = np.argsort(row[mark])
    rows, zero = row[mark][order], p[mark][order]
    row, p, term = row[~mark], p[~mark], term[~mark]
    ids, col, times = np.unique(term, return_inverse=True, return_counts=True)
    least = np.full(len(ids), np.iinfo(np.int64).max)
    np.minimum.at(least, col, row)
    place = np.empty(len(ids), np.int64)                     # columns that few sources have stand together
    place[np.lexsort((least, -times))] = np.arange(len(ids))
    col = place[col]

    def band(n: int):
        of, mine = rows // size == n, row // size == n
        return rows[of], zero[of], (np.searchsorted(rows[of], row[mine]), col[mine], p[mine])

    a, b, value, seen = block_sums(*band(i), *band(j), i == j)
    return pa.table({"lang": pa.array([lang] * len(a), pa.string()), "row": a, "other": b, "part_sum": value, "seen": seen})


def divergence_audit(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS, band: int = BAND,
                     stripe: int = STRIPE) -> DataFrame:
    """Rows of (lang, source, part, item, value, rank) over ``docs`` (``text``, ``lang``, ``source``).

    Part ``pair`` has, for every group (lang, source), each other source of the lang with its cost
    against it over all kept terms; part ``term`` has the ``top_terms`` terms that the group uses
    more than its lang does.  Null text, lang and source count as ''; a row is a document, repeated
    rows are several.  Terms in fewer than ``min_docs`` documents of a lang are left out; in a lang
    without terms every pair's value is 0.  Equal values rank by item in byte order.  A lang with one
    source has no ``pair`` rows, an empty table gives an empty result, other columns are ignored.
    ``band`` and ``stripe`` bound a block; they change cost, never results."""
    docs = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    of_term = Window.partitionBy("lang", "term")
    # a (lang, term) window has a row a source; ids are made before the one write that fixes them
    entries = pinned(term_counts(docs).withColumn("_id", F.monotonically_increasing_id())
                     .select("lang", "source", "term", "n", F.sum("docs").over(of_term).alias("docs"), F.sum("n").over(of_term).alias("total"),
                             F.min("_id").over(of_term).alias("term_id"), (F.col("_id") == F.min("_id").over(of_term)).alias("first"))
                     .filter(F.col("docs") >= min_docs).drop("docs"))
    langs = entries.groupBy("lang").agg(F.count_if("first").alias("terms"), F.sum("n").alias("lang_size"), F.count("*").alias("entries"))
    sizes = entries.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    groups = docs.select("lang", "source").distinct().join(sizes, ["lang", "source"], "left").join(langs, "lang", "left")
    # a table of sources, not of documents
    by_lang = Window.partitionBy("lang").orderBy("source")
    groups = pinned(groups.fillna(0, ["size", "terms", "lang_size", "entries"])
                    .withColumn("row", F.row_number().over(by_lang).cast("long") - 1)
                    .withColumn("bands", F.ceil(F.count("*").over(Window.partitionBy("lang")) / band))
                    .withColumn("stripes", F.greatest(F.lit(1), F.ceil(F.col("entries") / stripe)))
                    .withColumn("zero", F.when(F.col("terms") > 0, probability(F.lit(0).cast("long"), F.col("size"), F.col("terms")))
                                .otherwise(F.lit(1)).cast("long")))
    p = probability(F.col("n"), F.col("size"), F.col("terms"))
    known = entries.join(groups, ["lang", "source"]).withColumn("p", p)
    return _pairs(known, groups, band).unionByName(_terms(known, top_terms))


def _pairs(known: DataFrame, groups: DataFrame, size: int) -> DataFrame:
    each_band = F.explode(F.sequence(F.lit(0).cast("long"), F.col("bands") - 1)).alias("band")
    band = F.floor(F.col("row") / size)
    ij = [F.least("band", band).alias("i"), F.greatest("band", band).alias("j")]
    cells = known.select("lang", "row", "term_id", "p", F.pmod(F.xxhash64("term_id"), F.col("stripes")).alias("stripe"), each_band)
    marks = groups.filter("terms > 0").select("lang", "row", F.lit(None).cast("long").alias("term_id"), F.col("zero").alias("p"), "bands",
                                              F.explode(F.sequence(F.lit(0).cast("long"), F.col("stripes") - 1)).alias("stripe")) \
        .select("lang", "row", "term_id", "p", "stripe", each_band)
    sums = cells.unionByName(marks).select("lang", *ij, "stripe", "row", "term_id", "p").groupBy("lang", "i", "j", "stripe") \
        .applyInArrow(lambda key, table: _block(key, table, size), "lang string, row long, other long, part_sum long, seen long") \
        .groupBy("lang", "row", "other").agg(F.sum("part_sum").alias("part_sum"), F.sum("seen").alias("seen"))
    # the result's pairs, met by pairs of bands; those that no block holds share no quadrant at all
    banded = groups.select("lang", "source", "row", "zero", "terms", "bands", band.alias("own"), each_band)
    one = banded.select("lang", "source", "row", "zero", "terms", F.col("own").alias("i"), F.col("band").alias("j"))
    two = banded.select("lang", F.col("source").alias("item"), F.col("row").alias("other"), F.col("zero").alias("other_zero"),
                        F.col("band").alias("i"), F.col("own").alias("j"))
    pairs = one.join(two, ["lang", "i", "j"]).filter("row <> other").join(sums, ["lang", "row", "other"], "left").fillna(0, ["part_sum", "seen"])
    value = F.col("part_sum") + (F.col("terms") - F.col("seen")) * cost(F.col("zero"), F.col("other_zero"))
    ranked = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return pairs.select("lang", "source", F.lit("pair").alias("part"), "item", value.alias("value")) \
        .withColumn("rank", F.row_number().over(ranked))


def _terms(known: DataFrame, top_terms: int) -> DataFrame:
    q = probability(F.col("total"), F.col("lang_size"), F.col("terms"))
    ranked = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    # a limit on the rank takes effect in each task before the shuffle
    return known.withColumn("q", q).filter("p > q") \
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), cost(F.col("p"), F.col("q")).alias("value")) \
        .withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= top_terms)
