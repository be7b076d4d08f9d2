"""Licence scans: MinHash bands over overlapping windows retrieve templates, containment verifies.

Texts are lower-cased words of letters and digits; shingles are five words (all words of a
template that has fewer).  Templates are grouped by shingle width and size class K (the next
power of two of their number of shingles); a class scans windows of 2K shingles every K, so each
run of K shingles lies whole within one window.
A window that reaches the containment bound holds all but so many of a template's shingles, so it
holds one of any set of more than these: each template gets such a set of marks with few, rare
words.  Texts without these words or too short for the class are left out first, and so are
windows without a mark: neither could be verified.
A window that holds at least 0.8 of a template's shingles has a Jaccard similarity of at least
0.4K / 2.1K = 0.19 with it (the class holds templates of over K/2 shingles), and with one row
in each of 48 bands the chance to share no band is below (1 - 0.19)^48 = 4e-5.  Retrieved templates
are verified by their exact shingles.

Only built-in functions run on the table; the templates are a parameter of bounded size.
"""

from __future__ import annotations

import json
import os
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pinned

SHINGLE = 5
BANDS = 48
CONTAINMENT = 0.8

# fixed values: short notices, SPDX lines, headers and full texts of the common licences; the
# id is the licence's SPDX name, in lower case, and the form of the template
with open(os.path.join(os.path.dirname(__file__), "license_templates.jsonl"), encoding="utf-8") as _lines:
    _ALL = {r["license_id"]: r["text"] for r in map(json.loads, _lines)}
TEMPLATES = {k: t for k, t in _ALL.items() if len(re.findall(r"[^\W_]+", t)) >= SHINGLE}
SHORT_TEMPLATES = {k: t for k, t in _ALL.items() if k not in TEMPLATES}
# words of many texts: marks are not chosen by them
COMMON = set("""a an the of to in on by or and as is it be for with under from at any all no not that this
    terms version public general free open source software foundation program work works code use used using
    copy copies other may must shall you your such which can will new or available made published commons zero
    attribution international generic universal domain library following conditions want do what rights
    everyone these those their them than then when where who whom has have had are was were been being if its""".split())


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def license_words(text: Column) -> Column:
    """Lower-case words of letters and digits (none for null)."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingle_texts(words: Column, width: int = SHINGLE) -> Column:
    n = F.size(words) - width + 1
    return F.when(n < 1, F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.array_join(F.slice(words, i, width), " ")))


def _hashes(words: Column, width: int = SHINGLE) -> Column:
    n = F.size(words) - width + 1
    return F.when(n < 1, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1),
                    lambda i: F.xxhash64(*[words[i + k] for k in range(width)])))


def _by_width(column: Column, made) -> Column:
    """``made(width)`` for the value of ``column``."""
    out = made(SHINGLE)
    for width in range(1, SHINGLE):
        out = F.when(column == width, made(width)).otherwise(out)
    return out


def bands(hashes: Column) -> Column:
    """(band, value): one seeded minimum a band over a set of shingle hashes."""
    return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.struct(
        b.alias("band"), F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, b))).alias("value")))


def needed(n: int, containment: float) -> int:
    """The least number of ``n`` shingles that reaches the bound."""
    return next((m for m in range(1, n + 1) if m / n >= containment), n)


def anchors(templates: list[list[str]], containment: float) -> tuple[list[str], list[list[int]]]:
    """Few words, and of each template the places of its marks: so many of its shingles that have one of
    these words that a text without any mark holds too few of its shingles."""
    sets = [[set(s.split()) for s in t] for t in templates]
    want = [len(t) - needed(len(t), containment) + 1 for t in templates]
    marks: list[list[int]] = [[] for _ in templates]
    free = [list(range(len(t))) for t in templates]
    out: list[str] = []
    while any(want):
        tally: Counter = Counter()
        for t, places, n in zip(sets, free, want):
            if n:
                of = Counter(w for i in places for w in t[i])
                tally.update({w: min(c, n) for w, c in of.items()})
        best = max(tally, key=lambda w: (w not in COMMON and not w.isdigit() and len(w) > 1, tally[w], len(w), w))
        out.append(best)
        for k, t in enumerate(sets):
            if want[k]:
                got = [i for i in free[k] if best in t[i]][:want[k]]
                marks[k] += got
                want[k] -= len(got)
                free[k] = [i for i in free[k] if best not in t[i]]
    return out, marks


def template_table(spark, templates: dict[str, str]) -> DataFrame:
    """license_id, shingle width, size class, distinct shingles (texts and hashes) of each template."""
    empty = [k for k, t in templates.items() if not re.search(r"[^\W_]", t)]
    if empty:
        raise ValueError(f"templates without words: {empty}")
    rows = spark.createDataFrame(list(templates.items()), "license_id string, text string")
    rows = rows.withColumn("w", license_words(F.col("text")))
    rows = rows.withColumn("width", F.least(F.size("w"), F.lit(SHINGLE)))
    both = _by_width(F.col("width"), lambda n: F.arrays_zip(
        shingle_texts(F.col("w"), n).alias("s"), _hashes(F.col("w"), n).alias("h")))
    rows = rows.select("license_id", "width", F.size("w").alias("n"), F.array_distinct(both).alias("both"))
    size = F.pow(F.lit(2), F.ceil(F.log2(F.greatest(F.col("n") - F.col("width") + 1, F.lit(1))))).cast("int")
    return rows.select("license_id", "width", size.alias("size"), F.transform("both", lambda b: b["s"]).alias("shingles"),
                       F.transform("both", lambda b: b["h"]).alias("hashes"))


def license_scan(docs: DataFrame, templates: dict[str, str] | None = None, containment: float = CONTAINMENT) -> DataFrame:
    """One row per document and template found: doc_id, license_id, containment, window_start, n_windows.

    ``containment`` is the largest share of the template's distinct shingles in one window,
    ``window_start`` the number of that window's first word (the first of equals), ``n_windows`` the
    windows that reach the bound.  Null, empty and short texts have no rows; rows with one doc_id
    (or none) are reported together; other columns are ignored."""
    spark = docs.sparkSession
    known = pinned(template_table(spark, templates if templates is not None else TEMPLATES | SHORT_TEMPLATES))
    listed = known.collect()                                          # the parameter, hashed by the same functions
    classes: dict[tuple[int, int], list] = {}
    for r in listed:
        classes.setdefault((r["width"], r["size"]), []).append(r)
    marks: dict[tuple[int, int], list[int]] = {}
    lengths: dict[int, dict[str, int]] = {}                           # of texts that a word can matter for, by width
    for (width, size), rs in sorted(classes.items()):
        words, places = anchors([r["shingles"] for r in rs], containment)
        marks[width, size] = sorted({r["hashes"][i] for r, at in zip(rs, places) for i in at})
        least = min(needed(len(r["shingles"]), containment) for r in rs) + width - 1        # words of one byte at least
        of = lengths.setdefault(width, {})
        of.update({w: min(2 * least - 1, of.get(w, 2 * least - 1)) for w in words})

    def holds(text: Column, of: dict[str, int]) -> Column:
        out = F.lit(False)
        for w, least in of.items():
            has = (F.octet_length(text) >= least) & F.contains(text, F.lit(w))
            if len(w) < 6:
                has = has & text.rlike(rf"(?<![\p{{L}}\p{{N}}]){re.escape(w)}(?![\p{{L}}\p{{N}}])")
            out = out | has
        return out

    def hint(text: Column) -> Column:
        """The widths whose marks the text can hold, one bit each."""
        every = {w: min(of[w] for of in lengths.values() if w in of) for of in lengths.values() for w in of}
        bits = F.lit(0)
        for width, of in lengths.items():
            bits = bits + F.when(holds(text, of), 1 << width).otherwise(0)
        return F.when(holds(text, every), bits).otherwise(0)

    def cuts(words: Column, hits: Column, width: int, size: int) -> Column:
        """The windows of a class around its marks."""
        own = F.filter(hits, lambda x: x["h"].isin(marks[width, size]))
        near = F.flatten(F.transform(own, lambda x: F.array(F.floor(x["i"] / size) - 1, F.floor(x["i"] / size))))
        return F.transform(F.filter(F.array_distinct(near), lambda j: j >= 0), lambda j: F.struct(
            F.lit(width).alias("width"), F.lit(size).alias("size"), (j * size).cast("int").alias("start"),
            F.slice(words, (j * size + 1).cast("int"), 2 * size + width - 1).alias("words")))

    def of_width(words: Column, width: int) -> Column:
        sizes = [k for w, k in sorted(classes) if w == width]
        any_of = sorted({h for k in sizes for h in marks[width, k]})
        hits = F.filter(F.transform(_hashes(words, width), lambda h, i: F.when(
            h.isin(any_of), F.struct(h.alias("h"), i.alias("i")))), lambda p: p.isNotNull())
        return _let(hits, lambda p: F.concat(*[cuts(words, p, width, k) for k in sizes]))

    def windows(words: Column) -> Column:
        kind = "array<struct<width:int,size:int,start:int,words:array<string>>>"
        return F.concat(*[F.when(F.col("_widths").bitwiseAND(1 << w) > 0, of_width(words, w)).otherwise(F.array().cast(kind))
                          for w in sorted(lengths)])

    found = docs.select("doc_id", "text", _let(F.lower("text"), hint).alias("_widths")).filter("_widths > 0") \
        .select("doc_id", F.explode(_let(license_words(F.col("text")), windows)).alias("at"))
    # the windows wait while their bands are looked up: they are numbered, so that their words move once
    found = pinned(found.select(F.monotonically_increasing_id().alias("window"), "doc_id", "at.*"))
    hashes = _by_width(F.col("width"), lambda n: _hashes(F.col("words"), n))
    banded = found.select("window", "width", "size", F.explode(_let(hashes, bands)).alias("b")) \
        .select("window", "width", "size", F.col("b.band").alias("band"), F.col("b.value").alias("value"))
    # at most `templates` x BANDS rows
    index = known.select("license_id", F.col("width").alias("_width"), F.col("size").alias("_size"), F.explode(bands(F.col("hashes"))).alias("b")) \
        .select("license_id", "_width", "_size", F.col("b.band").alias("_band"), F.col("b.value").alias("_value"))
    few = len(listed) <= 5000
    index = F.broadcast(index) if few else index
    pairs = banded.join(index, (F.col("band") == F.col("_band")) & (F.col("value") == F.col("_value"))
                        & (F.col("size") == F.col("_size")) & (F.col("width") == F.col("_width"))) \
        .select("window", "license_id").distinct()
    shingles = known.select("license_id", "shingles")
    held = _by_width(F.col("width"), lambda n: shingle_texts(F.col("words"), n))
    share = F.size(F.array_intersect(F.col("shingles"), held)) / F.size("shingles")
    verified = pairs.join(found, "window").join(F.broadcast(shingles) if few else shingles, "license_id") \
        .select("doc_id", "license_id", "start", share.alias("share")).filter(F.col("share") >= containment)
    return verified.groupBy("doc_id", "license_id").agg(
        F.max("share").alias("containment"), F.max_by("start", F.struct("share", -F.col("start"))).cast("long").alias("window_start"),
        F.countDistinct("start").alias("n_windows"))
