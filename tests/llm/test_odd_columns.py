"""Stage forms on columns whose names the operators use inside, and embeddings of doubles."""

import pytest

import corpus_pipeline as cp
from mercato.llm import embedding_dedup as em
from mercato.llm import exact_dedup as ed
from mercato.llm import mixing as mx
from mercato.llm import simhash as sh

NAMES = ["_source", "_whole", "_cut", "_target", "_again", "_key_0_", "_key_1_", "_digest", "digest", "text_sha256", "in_0", "in_1",
         "source_size", "target", "_bucket", "fp", "component_id", "count"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in NAMES)
A, B = " ".join(f"one{i}" for i in range(40)), " ".join(f"two{i}" for i in range(40))
ROWS = [(1, A, "en", "a"), (2, A, "en", "a"), (2, A, "en", "a"), (3, A + " tail", "en", "b"), (4, B, "de", None), (5, None, None, None),
        (6, "", "en", "b"), (None, "no id at all", "de", "b"), (7, "###", None, "c")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, k, *(f"{c}{k}" for c in NAMES)) for k, r in enumerate(ROWS)], SCHEMA)


def whole(rows):
    return sorted(tuple(r) for r in rows)


def test_stages_carry_every_column_through(spark, docs):
    given = {tuple(r) for r in docs.collect()}
    for stage in (ed.keep_one_of_each, sh.keep_one_of_each, mx.repeated):
        out = stage(docs)
        got = out.collect()
        assert out.columns == docs.columns and {tuple(r) for r in got} <= given and got
    kept = ed.keep_one_of_each(docs).collect()
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0) for r in kept) == [(False, 0), (True, 2), (True, 3), (True, 4), (True, 6), (True, 7)]
    assert {tuple(r) for r in mx.repeated(docs.filter("doc_id = 4")).collect()} == {t for t in given if t[0] == 4}


def test_pipeline_on_nulls_empty_tables_and_clashing_names(spark, docs, tmp_path):
    for name, df in (("odd", docs), ("none", docs.limit(0)), ("nulls", docs.filter("doc_id = 5"))):
        df.write.parquet(f"{tmp_path}/{name}/documents.parquet")
    got = cp.run(spark, f"{tmp_path}/odd")
    assert got.select("doc_id").distinct().count() >= 2
    assert set(r[0] for r in got.select("doc_id").collect()) <= {r[0] for r in ROWS}
    assert cp.run(spark, f"{tmp_path}/none").collect() == [] and cp.run(spark, f"{tmp_path}/nulls").collect() == []


def test_doubles_are_not_rounded(spark):
    schema = "vec_id long, embedding array<double>, label int, id long, mult long, root long, block int"
    rows = [(1, [1e-50, 0.0], 1), (2, [0.0, 1e-50], 1), (3, [1e40, 0.0], 1), (4, [2e200, 0.0], 1), (5, [0.0, 3e-200], 1),
            (6, [1.0, 1e-9], 2), (7, [1.0, 0.0], 2), (8, [], 1), (9, [float("inf"), 0.0], 1), (10, [1.0, 0.0], None)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in em.embedding_near_dedup(
        spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], schema)).collect()}
    assert got == {1: (2, 1), 3: (2, 1), 4: (2, 1), 2: (1, 2), 5: (1, 2), 6: (1, 6), 7: (1, 6), 8: (0, 8), 9: (0, 9), 10: (0, 10)}
    for cosine, links in ((0.98 + 1e-10, 1), (0.98 - 1e-10, 0)):
        v = [(1, [1.0, 0.0], 1, 1, 2, 3, 4), (2, [cosine, (1 - cosine ** 2) ** 0.5], 1, 1, 2, 3, 4)]
        assert [r["n_links"] for r in em.embedding_near_dedup(spark.createDataFrame(v, schema)).collect()] == [links, links]
