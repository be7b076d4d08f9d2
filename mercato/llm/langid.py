"""Language identification: known words first, shorter and shorter character n-grams for the rest.

Training counts every word and every character n-gram (1 to ``MAX_N`` letters, with word
borders) of a sample of labelled rows, by language.  A word is scored by its per-language log
frequency if the model knows it; else by its n-grams of the longest length of which the
model knows any.  A document's score for a language is the mean over its words.

The sample is bounded in rows, the same number for every language, so a rare language keeps its rows
however large the others are.  Of what the sample holds every word and n-gram is kept.  The model
is sparse: a frequency of zero is a constant of the language and the kind of gram, and only what
exceeds it is stored, so its size follows the sample and not the number of languages.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pinned
from .divergence import folded
from .tokenize import ragged, text_batches

MAX_N = 4
ROWS = 6_000                       # labelled rows that the model is fitted on, shared evenly by the languages
FLUSH = 100_000                    # distinct words a task holds
BATCH_BYTES = 8 << 20
SCORED_BYTES = 1 << 20             # of text that is scored at once: its words take some ten times as much
EVIDENCE = 10                      # words whose agreement the score counts as independent
LETTERS = re.compile(r"[^\W\d_]+")


def grams(word: str, n: int) -> list[str]:
    """Character n-grams of a word between borders; a word shorter than that is one."""
    padded = f"<{word}>" if n > 1 else word
    return [padded[i:i + n] for i in range(len(padded) - n + 1)]


def word_counts(labelled: DataFrame) -> DataFrame:
    """(lang, gram, count) of the words of rows of (lang, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}
        for batch in text_batches(batches, "text", BATCH_BYTES):
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                held.setdefault(lang, Counter()).update(LETTERS.findall(text.lower()))
            if sum(map(len, held.values())) > FLUSH:
                yield _counted((x, w, c) for x, words in held.items() for w, c in words.items())
                held = {}
        yield _counted((x, w, c) for x, words in held.items() for w, c in words.items())

    return labelled.select("lang", "text").mapInArrow(run, "lang string, gram string, count long") \
        .groupBy("lang", "gram").agg(F.sum("count").alias("count"))


def gram_counts(words: DataFrame) -> DataFrame:
    """(lang, gram, count) of the n-grams of counted words; a gram's length tells its n and border."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], int] = {}
        for batch in batches:
            for lang, word, count in zip(*(batch.column(c).to_pylist() for c in ("lang", "gram", "count"))):
                for n in range(1, MAX_N + 1):
                    for g in grams(word, n):
                        held[lang, g] = held.get((lang, g), 0) + count
            if len(held) > FLUSH:
                yield _counted((x, g, c) for (x, g), c in held.items())
                held = {}
        yield _counted((x, g, c) for (x, g), c in held.items())

    return words.select("lang", "gram", "count").mapInArrow(run, "lang string, gram string, count long") \
        .groupBy("lang", "gram").agg(F.sum("count").alias("count"))


def _counted(rows) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [(), (), ()]
    return pa.record_batch([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.string(), pa.int64()))],
                           names=["lang", "gram", "count"])


class _Grown:
    """An array that chunks are added to, in amortised constant time a value."""

    def __init__(self, dtype):
        self.held, self.n = np.empty(1024, dtype), 0

    def add(self, values) -> None:
        while self.n + len(values) > len(self.held):
            self.held = np.concatenate([self.held, np.empty_like(self.held)])
        self.held[self.n:self.n + len(values)] = values
        self.n += len(values)


class Model:
    """Log frequencies by language: for every known word and n-gram, how far they exceed those of a count of zero.

    ``grams`` gives rows by kind (0: words, n: n-grams of n letters); row r has the languages
    ``lang[begin[r]:begin[r + 1]]`` and what they exceed ``floor[kind, language]`` by in ``more``."""

    def __init__(self, langs: list[str], grams: list[dict[str, int]], begin: np.ndarray, lang: np.ndarray, more: np.ndarray,
                 floor: np.ndarray, usual: int = 0):
        self.langs, self.grams, self.begin, self.lang, self.more, self.floor, self.usual = langs, grams, begin, lang, more, floor, usual
        self._forget()

    def _forget(self) -> None:
        # words met before, with their kind and sparse row, and tokens, which are a word or hold some
        self.tokens: dict[str, int] = {}
        self.words: dict[str, int] = {}
        self.token_size, self.token_words, self.kind, self.size, self.langs_of, self.more_of = (
            _Grown(t) for t in (np.int64, np.int64, np.int64, np.int64, np.int32, np.float64))

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k in ("langs", "grams", "begin", "lang", "more", "floor", "usual")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._forget()

    def known(self, w: str) -> tuple[int, list[int]]:
        """(kind, rows) of a word: its own row, or those of its longest known n-grams; kind -1 if not even a letter is known."""
        if (k := self.grams[0].get(w)) is not None:
            return 0, [k]
        for n in range(MAX_N, 0, -1):
            of = self.grams[n]
            if rows := [of[g] for g in grams(w, n) if g in of]:
                return n, rows
        return -1, []

    def score(self, w: str) -> tuple[int, np.ndarray, np.ndarray]:
        """(kind, languages, excess) of a word: the mean over its known grams."""
        kind, rows = self.known(w)
        return kind, *self._excess(np.array(rows, np.int64), np.full(len(rows), len(rows)))[1:]

    def _excess(self, rows: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(entries of each row, languages, excess): sparse rows one after another, each divided by its ``share``."""
        size = self.begin[rows + 1] - self.begin[rows]
        at = ragged(self.begin[rows], size)
        return size, self.lang[at], self.more[at] / np.repeat(share, size)

    def _learn(self, tokens: list[str]) -> None:
        """Splits new pieces of text without ASCII separators into words, and scores the new ones."""
        sizes, found, kinds, rows, counts = [], [], [], [], []
        for token in tokens:
            words = LETTERS.findall(token) if token.isascii() else LETTERS.findall(token.lower())
            for w in words:
                k = self.words.get(w)
                if k is None:
                    k = self.words[w] = len(self.words)
                    kind, own = self.known(w)
                    kinds.append(kind)
                    rows += own
                    counts.append(len(own))
                found.append(k)
            self.tokens[token] = len(self.tokens)
            sizes.append(len(words))
        count = np.array(counts, np.int64)
        of_row, lang, more = self._excess(np.array(rows, np.int64), np.repeat(count, count))
        size = np.add.reduceat(np.append(of_row, 0), np.cumsum(count) - count) * (count > 0) if len(count) else count
        for grown, values in ((self.token_size, sizes), (self.token_words, found), (self.kind, kinds), (self.size, size),
                              (self.langs_of, lang), (self.more_of, more)):
            grown.add(values)

    def predict_batch(self, batch: pa.RecordBatch) -> tuple[list[str], np.ndarray]:
        """Predicted languages and scores of the batch's texts, some at a time."""
        parts = [self._predict(b.column("text")) for b in text_batches([batch], "text", SCORED_BYTES)]
        return [x for names, _ in parts for x in names], np.concatenate([s for _, s in parts] or [np.empty(0)])

    def _predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        """Each distinct word is scored once and summed by place."""
        parts = pc.split_pattern(folded(texts), " ")
        doc = np.repeat(np.arange(len(parts)), np.diff(parts.offsets.to_numpy()))
        flat = parts.flatten()
        some = pc.greater(pc.binary_length(flat), 0)
        coded = flat.filter(some).dictionary_encode()
        doc = doc[some.to_numpy(zero_copy_only=False)]
        if len(self.tokens) > FLUSH:
            self._forget()
        distinct = coded.dictionary.to_pylist()
        self._learn([t for t in distinct if t not in self.tokens])
        number = np.fromiter(map(self.tokens.__getitem__, distinct), np.int64, len(distinct))
        token = number[coded.indices.to_numpy()] if len(coded) else np.empty(0, np.int64)
        t_size, t_words, kind, size, lang, more = (g.held[:g.n] for g in (
            self.token_size, self.token_words, self.kind, self.size, self.langs_of, self.more_of))
        t_begin, begin = np.cumsum(t_size) - t_size, np.cumsum(size) - size
        # a token that is not one word, as most are, stands for none or several
        doc, word = np.repeat(doc, t_size[token]), t_words[ragged(t_begin[token], t_size[token])] if len(token) else token
        n, langs = len(parts), len(self.langs)
        words = np.bincount(doc, minlength=n)
        doc, word = doc[kind[word] >= 0], word[kind[word] >= 0]
        kinds = np.bincount(doc * (MAX_N + 1) + kind[word], minlength=n * (MAX_N + 1)).reshape(n, MAX_N + 1)
        total = kinds.sum(axis=1)
        names, score = np.array(["und", *self.langs], object), np.zeros(n)
        best = np.zeros(n, np.int64)
        if langs:
            each = size[word]
            at = ragged(begin[word], each)
            sums = np.bincount(np.repeat(doc, each) * langs + lang[at], more[at], n * langs).reshape(n, langs) + kinds @ self.floor
            mean = sums / np.maximum(total, 1)[:, None]
            p = np.exp((mean - mean.max(axis=1, keepdims=True)) * np.minimum(total, EVIDENCE)[:, None])
            p /= p.sum(axis=1, keepdims=True)
            best = np.where(total > 0, p.argmax(axis=1), self.usual) + 1
            score = p[np.arange(n), best - 1]
        told = words > 0
        return names[np.where(told, best, 0)].tolist(), np.where(told & (best > 0), score, 0.0)

    def predict(self, text: str | None) -> tuple[str, float]:
        names, score = self._predict(pa.array([text], pa.string()))
        return names[0], float(score[0])


def sample(labelled: DataFrame, rows: int = ROWS) -> tuple[DataFrame, dict[str, int]]:
    """Rows of ``labelled`` (lang, text, key), about ``rows`` / languages of each at most, chosen by a hash of
    their key and text; and the number of rows of each language."""
    labelled = labelled.filter("lang is not null and text is not null")
    sizes = {r[0]: r[1] for r in labelled.groupBy("lang").count().collect()}          # a row a language
    share = F.lit(1.0)
    for lang, n in sizes.items():
        if n > rows / len(sizes):
            share = F.when(F.col("lang") == lang, rows / len(sizes) / n).otherwise(share)
    bits = 1 << 30
    return labelled.filter(F.pmod(F.xxhash64("key", "text", F.lit(29)), F.lit(bits)) < share * bits), sizes


def fit(labelled: DataFrame, rows: int = ROWS, key: Column | None = None) -> Model:
    """A model from rows of (lang, text), of which about ``rows`` are read at most; ``key`` helps to tell rows apart.
    Rows with a null lang or text teach nothing."""
    chosen, sizes = sample(labelled.select("lang", "text", (F.lit(0) if key is None else key).alias("key")), rows)
    langs = sorted(sizes)
    number = {x: k for k, x in enumerate(langs)}
    words = pinned(word_counts(chosen))
    tables = [words.withColumn("n", F.lit(0)), gram_counts(words).withColumn("n", F.length("gram"))]
    counted = tables[0].unionByName(tables[1]).toArrow()       # every gram of a bounded sample
    kind, lang = counted.column("n").to_numpy(), np.array([number[x] for x in counted.column("lang").to_pylist()], np.int64)
    count = counted.column("count").to_numpy().astype(float)
    total = np.bincount(kind * len(langs) + lang, count, (MAX_N + 1) * len(langs)).reshape(MAX_N + 1, len(langs))
    coded = counted.column("gram").combine_chunks().dictionary_encode()
    text, code = coded.dictionary.to_pylist(), coded.indices.to_numpy()
    rows_of, at = np.unique(kind * (len(text) + 1) + code, return_inverse=True)
    kinds = np.bincount(rows_of // (len(text) + 1), minlength=MAX_N + 1)
    below = total + 0.5 * kinds[:, None]
    floor = np.log(0.5 / np.where(kinds[:, None] > 0, below, 1))
    found: list[dict[str, int]] = [{} for _ in range(MAX_N + 1)]
    for k, r in enumerate(rows_of.tolist()):
        found[r // (len(text) + 1)][text[r % (len(text) + 1)]] = k
    order = np.lexsort((lang, at))
    begin = np.searchsorted(at[order], np.arange(len(rows_of) + 1))
    usual = max(range(len(langs)), key=lambda k: (sizes[langs[k]], -k), default=0)
    return Model(langs, found, begin, lang[order].astype(np.int32), np.log((count[order] + 0.5) / 0.5), floor, usual)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``): doc_id, lang_pred, score.

    ``und`` with score 0 for null texts, texts without letters, and every text if the model was
    fitted on no rows.  Of languages that score alike the first by name wins; a text of which no letter
    is known gets the language with most rows.  A document's other columns are not read."""
    shared = docs.sparkSession.sparkContext.broadcast(model)     # grows with the sample's rows alone

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in text_batches(batches, "text", BATCH_BYTES):
            names, scores = own.predict_batch(batch)
            yield pa.record_batch([batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                  names=["doc_id", "lang_pred", "score"])
        own._forget()                                            # the worker serves other tasks next

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text") \
        .mapInArrow(run, "doc_id long, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, all columns, whose ``text`` the model doesn't call ``und``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in text_batches(batches, "text", BATCH_BYTES):
            yield batch.filter(pa.array([x != "und" for x in own.predict_batch(batch)[0]], pa.bool_()))
        own._forget()

    return docs.mapInArrow(run, docs.schema)


def held_out(doc_id: str = "doc_id"):
    """True for the quarter of ids that training never sees (a null id is never held out)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit_on_training_rows(docs: DataFrame, rows: int = ROWS) -> Model:
    return fit(docs.filter(~held_out()), rows, F.col("doc_id"))
