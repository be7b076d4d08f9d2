"""Registered queries of this subpackage, with their SQL where SQL can express them."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from . import ann as an
from . import conversations as cv
from . import divergence as dv
from . import embedding_dedup as em
from . import exact_dedup as ed
from . import langid as li
from . import licenses as lc
from . import mixing as mx
from . import packing as pk
from . import private_data as pd
from . import simhash as sh
from . import substring_dedup as sd
from . import token_files as tf
from .tokenize import default_tokenizer


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sh.simhash_components(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sd.remove_repeats(table(spark, sf_dir, "documents"), length=35).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lc.license_scan(table(spark, sf_dir, "documents"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pk.best_fit_packing(table(spark, sf_dir, "documents"), default_tokenizer())


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return em.embedding_near_dedup(table(spark, sf_dir, "embeddings"), threshold=0.98)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ed.exact_dedup(table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mx.mix_sources(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/token-files-{uuid.uuid4().hex}"
    tf.write_token_files(table(spark, sf_dir, "documents"), folder, default_tokenizer())
    return tf.read_token_files(spark, folder)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return li.identify(docs, li.fit_on_training_rows(docs)).select(
        "doc_id", li.held_out().alias("held_out"), "lang_pred", "score")


def op10_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pd.replace_private_data(table(spark, sf_dir, "documents"), key="surrogate-key")


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dv.divergence_audit(table(spark, sf_dir, "documents"), min_docs=3, top_terms=200)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cv.repair_report(cv.damaged(table(spark, sf_dir, "conversations")))


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return an.nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_simhash_near_dedup, op2_substring_dedup, op3_license_scan, op4_best_fit_packing, op5_embedding_near_dedup,
        op6_exact_dedup, op7_mixing, op8_token_files, op9_language_id, op10_private_data, op11_source_divergence,
        op12_conversation_repair, op13_nearest_neighbours)}

ORACLES: dict[str, str] = {
    "op5_embedding_near_dedup": """
        WITH RECURSIVE v AS (
            SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
                  ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.98),
        reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
        least AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
        n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
        SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links,
               least(e.vec_id, coalesce(least.b, e.vec_id)) AS component_id,
               e.vec_id <= coalesce(least.b, e.vec_id) AS kept
        FROM embeddings e LEFT JOIN n ON n.a = e.vec_id LEFT JOIN least ON least.a = e.vec_id""",
    "op6_exact_dedup": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
        SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept,
               sha256(d.t) AS text_sha256
        FROM d JOIN g USING (t)""",
    "op11_source_divergence": r"""
        WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                          regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms,
                          row_number() OVER () AS id FROM documents),
        o AS (SELECT lang, source, id, unnest(terms) AS term FROM d),
        c AS (SELECT lang, source, term, count(*) AS n FROM o GROUP BY ALL),
        k AS (SELECT lang, term, count(*) AS total FROM o GROUP BY ALL HAVING count(DISTINCT id) >= 3),
        v AS (SELECT lang, count(*) AS v, sum(total)::BIGINT AS size FROM k GROUP BY lang),
        g AS (SELECT d.lang, d.source, coalesce(any_value(v.v), 0) AS v,
                     coalesce((SELECT sum(n) FROM c JOIN k USING (lang, term) WHERE c.lang = d.lang AND c.source = d.source), 0)::BIGINT AS size
              FROM d LEFT JOIN v ON v.lang = d.lang GROUP BY d.lang, d.source),
        p AS (SELECT g.lang, g.source, k.term, k.total, coalesce(c.n, 0) AS n,
                     1 + (1000000000 * (coalesce(c.n, 0) + 1)) // (g.size + g.v) AS p
              FROM g JOIN k ON k.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
        s AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p)::BIGINT AS value
              FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
        pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
                 FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
                 LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
        f AS (SELECT p.lang, source, 'term' AS part, term AS item, p, 1 + (1000000000 * (total + 1)) // (v.size + v.v) AS q
              FROM p JOIN v ON v.lang = p.lang WHERE n > 0),
        term AS (SELECT lang, source, part, item, ((p - q) * (p - q)) // q AS value FROM f WHERE p > q),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
                   FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
        SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200""",
}
