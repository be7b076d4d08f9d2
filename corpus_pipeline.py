"""Corpus pipeline: documents to packed token sequences, in five stages.

Each stage calls one operator of ``mercato.llm`` on all that the stage before kept.  Stages take
``(spark, docs, sf_dir)``; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm import exact_dedup, langid, mixing, packing, simhash
from mercato.llm.tokenize import default_tokenizer
from mercato.session import ensure_checkpoint_dir


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents whose language can't be told: null texts and texts without letters."""
    return langid.keep_identified(docs, langid.fit_on_training_rows(docs))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact_dedup.keep_one_of_each(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of a SimHash component the document with the smallest doc_id stays."""
    return simhash.keep_one_of_each(docs, shingle=3, max_bits=3)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats and drops documents so that sources meet their target weights."""
    return mixing.repeated(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 ids."""
    return packing.best_fit_packing(docs, default_tokenizer(), max_len=2048, end_id=0)


STAGES = [("language_id", language_id), ("exact_dedup", drop_exact_copies), ("simhash_near_dedup", drop_near_copies),
          ("mixing", mix), ("packing", pack)]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``; what a stage keeps is a table in the shared folder."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
