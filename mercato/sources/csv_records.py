"""CSV records with quoted line breaks, read by many tasks.

A reader that starts in the middle of a file can't tell whether it stands inside quotes, which is why
``multiLine`` gives a file to one task.  The number of quotes before that place tells: it is odd
inside them (an escaped quote counts twice).  So the file is read as lines, which Spark splits by byte
ranges, and one aggregate counts the quotes of each range; a running count over the ranges, one row
each, tells in which state each begins.  With that every task joins its own lines into records.  A
record that crosses ranges is met by the range that it begins in.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, line): the lines of every file, in order within a byte range; a carriage return stays."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("line"))


def _quotes(line):
    return F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of lines that stand in order: (file, start, piece, first, record).

    ``piece`` is null for a whole record, 0 for the beginning of one that its range doesn't end and -1 for the end or the
    middle of one that began before; ``first`` marks the first record of a file."""
    key, inside, held, at_start, whole = None, False, [], False, False

    def out(rows):
        cols = list(zip(*rows)) or [()] * 5
        return pa.record_batch([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string()))],
                               names=["file", "start", "piece", "first", "record"])

    def ended():
        # what a range leaves open: the head of a record, or a stretch of one that began before it
        return [(*key, 0 if whole else -1, at_start, "\n".join(held))] if held else []

    for batch in batches:
        files, starts, odd = (batch.column(c) for c in ("file", "start", "odd"))
        change = np.flatnonzero(np.append(True, (np.diff(starts.to_numpy()) != 0) | pc.not_equal(files[1:], files[:-1]).to_numpy(zero_copy_only=False))) \
            if batch.num_rows else []
        for a, b in zip(change, [*change[1:], batch.num_rows]):
            now = files[int(a)].as_py(), starts[int(a)].as_py()
            done = []
            if now != key:
                done += ended()
                key, inside, held = now, bool(odd[int(a)].as_py()), []
                at_start, whole = now[1] == 0, not inside
            lines = batch.column("line").slice(a, b - a)
            parity = np.cumsum(batch.column("n").slice(a, b - a).to_numpy()) + inside
            ends = np.flatnonzero(parity % 2 == 0)
            inside = bool(parity[-1] % 2)
            if len(ends):
                # records that end here; the first may have begun before
                bounds = np.concatenate([[0], ends + 1])
                texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), lines.slice(0, int(bounds[-1]))), "\n")
                if held or not whole:
                    done.append((*key, None if whole else -1, at_start, "\n".join([*held, texts[0].as_py()])))
                    texts = texts.slice(1)
                    at_start, held = False, []
                whole = True
                if done:
                    yield out(done)
                    done = []
                n = len(texts)
                if n:
                    yield pa.record_batch([pa.array([key[0]], pa.string()).take(pa.array(np.zeros(n, np.int64))), pa.array(np.full(n, key[1])),
                                           pa.nulls(n, pa.int32()), pa.array(np.arange(n) == 0) if at_start else pa.array(np.zeros(n, bool)),
                                           texts.cast(pa.string())], names=["file", "start", "piece", "first", "record"])
                    at_start = False
                lines = lines.slice(int(bounds[-1]))
            held += lines.to_pylist()
            if done:
                yield out(done)
    if key is not None and held:
        yield out(ended())


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, first, record): the records of the CSV files at ``path``, whole, without the line end.

    Quotes are ``"`` and are escaped by doubling; a quote inside an unquoted value is read as one that opens
    or closes.  A line break is a line feed, with a carriage return before it or not, and reads as a line feed.  A last
    record whose quotes never close is what is there.  Empty lines are left out."""
    lines = _lines(spark, path).withColumn("n", _quotes(F.col("line")))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    # one row a byte range
    odd = lines.groupBy("file", "start").agg(F.sum("n").alias("n")) \
        .select("file", "start", (F.coalesce(F.sum("n").over(before), F.lit(0)) % 2 == 1).alias("odd"))
    # a table of a row a range, met on the read side so that lines stay in order
    pieces = lines.join(F.broadcast(odd), ["file", "start"]).select("file", "start", "line", "n", "odd") \
        .mapInArrow(_joined, "file string, start long, piece int, first boolean, record string")
    whole = pieces.filter("piece is null").select("file", "first", "record")
    # heads and stretches of records that cross ranges: a head opens a record that the next ranges' stretches go on with
    crossing = pieces.filter("piece is not null").select("file", "start", "piece", "first", "record")
    ordered = Window.partitionBy("file").orderBy("start", "piece").rowsBetween(Window.unboundedPreceding, 0)
    met = crossing.withColumn("_r", F.sum(F.when(F.col("piece") == 0, 1).otherwise(0)).over(ordered))
    parts = F.array_sort(F.collect_list(F.struct("start", "record")))
    met = met.groupBy("file", "_r").agg(F.bool_or("first").alias("first"), F.array_join(F.transform(parts, lambda p: p["record"]), "\n").alias("record"))
    text = F.regexp_replace(F.replace(F.col("record"), F.lit("\r\n"), F.lit("\n")), "\\r$", "")
    return whole.unionByName(met.select("file", "first", "record")) \
        .withColumn("record", F.when(F.col("first"), F.ltrim(text, F.lit("﻿"))).otherwise(text)).filter("record <> ''")


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """The CSV files at ``path`` as text columns named by their header, equal in all files; missing values at a record's end
    are null, more values than the header names are left out.  An error on files without a header."""
    records = csv_records(spark, path)
    options = {"escape": '"', "mode": "PERMISSIVE", "maxCharsPerColumn": "-1"}
    heads = [r["record"] for r in records.filter("first").select("record").distinct().limit(2).collect()]
    if len(heads) != 1:
        raise ValueError(f"{path}: {'no header' if not heads else 'files with different headers'}")
    wide = spark.createDataFrame([(heads[0],)], "record string")
    # a header has no more names than commas and one
    fields = ", ".join(f"c{i} string" for i in range(heads[0].count(",") + 1))
    names = [x for x in wide.select(F.from_csv("record", fields, options).alias("v")).select("v.*").first() if x is not None]
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    return records.filter("not first").select(F.from_csv("record", schema, options).alias("v")).select("v.*").toDF(*names)
