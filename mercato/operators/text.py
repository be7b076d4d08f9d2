"""Review text preparation and TF-IDF.

TF-IDF follows the reference vectoriser: accents folded, tokens of 2+ letters,
unigrams + bigrams of consecutive tokens, document-frequency bounds (min count,
max share), the ``max_features`` terms by corpus count (ties by term), sublinear
tf ``1 + ln(tf)``, smooth idf ``ln((1 + n) / (1 + df)) + 1`` and L2 rows.

A document's terms stand in one row, so its counts, weights and norm are found where the row is:
Arrow batches of token arrays are coded by a dictionary and counted with numpy.  What is shuffled are
the counts of the terms of each batch, and the vocabulary, bounded by ``max_features``, is the
only broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..functions.text import KEPT_LETTERS, clean_text, fold_accents, review_text
from .sequence import pin


def with_words(df: DataFrame) -> DataFrame:
    """The rows that ``clean_reviews`` keeps, their texts as they are: a text has words if it has one of the letters that cleaning
    keeps, and a look for the first such letter is all that takes."""
    t = df.filter(F.col("review_comment_message").isNotNull())
    title = F.col("review_comment_title") if "review_comment_title" in df.columns else F.lit(None)
    return t.filter(F.lower(review_text(title, F.col("review_comment_message"))).rlike(f"[{KEPT_LETTERS}]"))


def clean_reviews(df: DataFrame, id_col: str = "review_id") -> DataFrame:
    """Title + message, cleaned; rows empty after cleaning are dropped."""
    t = df.filter(F.col("review_comment_message").isNotNull())
    title = F.col("review_comment_title") if "review_comment_title" in df.columns else F.lit(None)
    clean = clean_text(review_text(title, F.col("review_comment_message")))
    # generated, not filtered: a filter on the cleaned text would clean it a second time
    return t.select(*[c for c in t.columns if c != "review_clean"],
                    F.explode(F.filter(F.array(clean), lambda c: F.length(c) > 0)).alias("review_clean"))


def tokens(text: Column) -> Column:
    """Tokens of 2 or more characters, accents folded."""
    return F.filter(F.split(fold_accents(text), " "), lambda t: F.length(t) >= 2)


TOKENS_AT_ONCE = 400_000


def token_slices(batches: Iterator[pa.RecordBatch], most: int | None = None) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` (last column: tokens) in slices of some ``most`` tokens, one row at least, so that the memory of
    counting them follows neither the rows of a batch nor their length."""
    most = most or TOKENS_AT_ONCE
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.list_value_length(batch.column(batch.num_columns - 1)), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, side="right")))
            yield batch.slice(at, upto - at)
            at = upto
    pa.default_memory_pool().release_unused()


def _coded(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """(row of each token, its code, the distinct tokens, places whose next token is in the same row)."""
    arrays = batch.column("tokens")
    rows = np.repeat(np.arange(len(arrays)), pc.fill_null(pc.list_value_length(arrays), 0).to_numpy(zero_copy_only=False))
    coded = arrays.flatten().dictionary_encode()
    return rows, coded.indices.to_numpy().astype(np.int64), coded.dictionary, np.flatnonzero(rows[1:] == rows[:-1])


def _counted(rows: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys, rows that have each, occurrences of each)."""
    distinct, at = np.unique(keys, return_inverse=True)
    own = np.unique(rows * max(1, len(distinct)) + at)
    n = len(distinct)
    return distinct, np.bincount(own % max(1, n), minlength=n), np.bincount(at, minlength=n)


def term_stats(docs: DataFrame, text_col: str, ngram_max: int = 2) -> DataFrame:
    """``(term, df, total)``: documents with a term and its occurrences, over unigrams and bigrams.  A row is a document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in token_slices(batches):
            rows, code, words, pairs = _coded(batch)
            found = [(words.take(pa.array(k)), df, n) for k, df, n in [_counted(rows, code)]]
            if ngram_max >= 2 and len(pairs):
                k, df, n = _counted(rows[pairs], code[pairs] * len(words) + code[pairs + 1])
                found.append((pc.binary_join_element_wise(words.take(pa.array(k // len(words))), words.take(pa.array(k % len(words))), " "), df, n))
            for term, df, n in found:
                yield pa.record_batch([term, pa.array(df.astype(np.int64)), pa.array(n.astype(np.int64))], names=["term", "df", "total"])

    return docs.select(tokens(F.col(text_col)).alias("tokens")).mapInArrow(run, "term string, df long, total long") \
        .groupBy("term").agg(F.sum("df").alias("df"), F.sum("total").alias("total"))


def _vocabulary(stats: DataFrame, n_docs: DataFrame, max_features: int, min_df: int,
                max_df: float) -> DataFrame:
    kept = (stats.crossJoin(F.broadcast(n_docs))                          # one row
                 .filter((F.col("df") >= min_df) & (F.col("df") <= F.col("n_docs") * F.lit(max_df))))
    vocab = kept.orderBy(F.col("total").desc(), F.col("term").asc()).limit(max_features)
    # vocab has at most max_features rows: index and idf over the bounded table
    return (vocab.withColumn("term_index", (F.row_number().over(Window.orderBy("term")) - 1).cast("int"))
                 .withColumn("idf", F.log((F.lit(1.0) + F.col("n_docs")) / (F.lit(1.0) + F.col("df"))) + 1.0)
                 .select("term", "term_index", "df", "idf"))


def fit_tfidf(train: DataFrame, text_col: str = "review_clean", id_col: str = "review_id",
              max_features: int = 5000, min_df: int = 5, max_df: float = 0.8, n_docs: DataFrame | None = None) -> DataFrame:
    """M8 fit: vocabulary ``(term, term_index, df, idf)`` from the training docs; ``n_docs`` gives their number (one row) if it is known."""
    n_docs = train.agg(F.count(F.lit(1)).alias("n_docs")) if n_docs is None else n_docs
    return _vocabulary(term_stats(train, text_col), n_docs, max_features, min_df, max_df)


class _Vocabulary:
    """The terms of a vocabulary, found by the codes of a batch."""

    def __init__(self, rows: list):
        self.terms = [r["term"] for r in rows]
        self.index = np.array([r["term_index"] for r in rows], np.int64)
        self.idf = np.array([r["idf"] for r in rows], float)
        words = sorted({w for t in self.terms for w in t.split(" ")})
        self.words, number = pa.array(words, pa.string()), {w: k for k, w in enumerate(words)}
        n = self.n = len(words) + 1
        keys = [(number[t] if " " not in t else (number[t.split(" ")[0]] + 1) * n + number[t.split(" ")[1]]) for t in self.terms]
        self.order = np.argsort(keys)                       # a word's number; for two, the first's and the second's
        self.keys = np.array(keys, np.int64)[self.order]

    def weights(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, place in the vocabulary, weight) of the batch's documents, by row."""
        rows, code, words, pairs = _coded(batch)
        known = pc.fill_null(pc.index_in(words, self.words), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        own = known[code] if len(code) else code
        a, b = (own[pairs], own[pairs + 1]) if len(pairs) else (own[:0], own[:0])
        both = (a >= 0) & (b >= 0)
        keys = np.concatenate([own[own >= 0], (a[both] + 1) * self.n + b[both]])
        of = np.concatenate([rows[own >= 0], rows[pairs][both] if len(pairs) else rows[:0]])
        if not len(self.keys) or not len(keys):
            return of[:0], of[:0], np.empty(0)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        hit = self.keys[at] == keys
        cells, tf = np.unique(of[hit] * len(self.keys) + self.order[at[hit]], return_counts=True)
        row, term = cells // len(self.keys), cells % len(self.keys)
        raw = (1 + np.log(tf.astype(float))) * self.idf[term]
        return row, term, raw / np.sqrt(np.bincount(row, raw * raw, batch.num_rows))[row]


def _weights(docs: DataFrame, vocab: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """``(doc_id, term, term_index, weight)`` of the vocabulary's terms, by document."""
    shared = docs.sparkSession.sparkContext.broadcast(_Vocabulary(vocab.select("term", "term_index", "idf").collect()))   # <= max_features

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        terms = pa.array(own.terms, pa.string())
        for batch in token_slices(batches):
            row, term, weight = own.weights(batch)
            yield pa.record_batch([batch.column("doc_id").take(pa.array(row)), terms.take(pa.array(term)), pa.array(own.index[term].astype(np.int32)), pa.array(weight)],
                                  names=["doc_id", "term", "term_index", "weight"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), tokens(F.col(text_col)).alias("tokens")) \
        .mapInArrow(run, f"doc_id {kind}, term string, term_index int, weight double")


def apply_tfidf(df: DataFrame, vocab: DataFrame, text_col: str = "review_clean",
                id_col: str = "review_id") -> DataFrame:
    """M8 apply: ``(doc_id, term, term_index, weight)`` with L2-normalised rows."""
    return _weights(df, vocab, text_col, id_col)


def fit_apply_tfidf(docs: DataFrame, split_col: str = "split", text_col: str = "review_clean",
                    id_col: str = "review_id", max_features: int = 5000, min_df: int = 5,
                    max_df: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Fit on the 'train' rows, weight all rows.  ``docs`` is written once, cleaned as it is, and read by both passes."""
    docs = pin(docs.select(id_col, split_col, text_col), "tfidf_docs")
    vocab = pin(fit_tfidf(docs.filter(F.col(split_col) == "train"), text_col, id_col, max_features, min_df, max_df), "vocab")
    return vocab, _weights(docs, vocab, text_col, id_col)


def tfidf_vectors(docs: DataFrame, vocab: DataFrame, text_col: str = "review_clean", out: str = "features") -> DataFrame:
    """``docs`` with the sparse vector of each row's weights by ``term_index``, as long as the vocabulary; a row without its
    terms, or of null text, has an empty one.  Vectors are assembled in Arrow where the rows are: nothing is shuffled."""
    from pyspark.ml.linalg import VectorUDT

    shared = docs.sparkSession.sparkContext.broadcast(_Vocabulary(vocab.select("term", "term_index", "idf").collect()))   # <= max_features
    kept = [c for c in docs.columns if c != out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in token_slices(batches):
            row, term, weight = own.weights(pa.record_batch([batch.column(len(kept))], names=["tokens"]))
            place = own.index[term]
            by = np.lexsort((place, row))
            ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=batch.num_rows))]).astype(np.int32))
            n = np.ones(batch.num_rows, np.int32)
            vector = pa.StructArray.from_arrays(
                [pa.array((0 * n).astype(np.int8)), pa.array(max(len(own.terms), 1) * n),      # 0: a sparse one
                 pa.ListArray.from_arrays(ends, pa.array(place[by].astype(np.int32))), pa.ListArray.from_arrays(ends, pa.array(weight[by].astype(float)))],
                names=["type", "size", "indices", "values"])
            yield pa.record_batch([*batch.columns[:-1], vector], names=[*kept, out])

    schema = StructType([*[docs.schema[c] for c in kept], StructField(out, VectorUDT())])
    return docs.select(*kept, tokens(F.col(text_col)).alias("__tokens")).mapInArrow(run, schema)
