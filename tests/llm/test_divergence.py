"""Source divergence against whole-number brute force."""

import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from mercato.llm import divergence as dv

SCHEMA = "doc_id long, text string, lang string, source string, n long, term string, row int, p double, docs int"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, top=200):
    rows = [tuple("" if x is None else x for x in r) for r in rows]
    words = [TERM.findall(t.translate(LOWER)) for t, _, _ in rows]
    out = []
    for lang in {r[1] for r in rows}:
        docs, counts = Counter(), defaultdict(Counter)
        for (_, x, source), own in zip(rows, words):
            if x == lang:
                docs.update(set(own))
                counts[source].update(own)
        kept = {t for t, n in docs.items() if n >= 3}
        counts = {s: Counter({t: n for t, n in c.items() if t in kept}) for s, c in counts.items()}
        whole = sum(counts.values(), Counter())

        def p(c):
            n = sum(c.values()) + len(kept)
            return {t: 1 + 10**9 * (c[t] + 1) // n for t in kept}
        probs, all_p = {s: p(c) for s, c in counts.items()}, p(whole)
        for s, own in probs.items():
            pair = [(-sum((own[t] - q[t]) ** 2 // q[t] for t in kept), o) for o, q in probs.items() if o != s]
            term = [(-((own[t] - all_p[t]) ** 2 // all_p[t]), t) for t in kept if counts[s][t] and own[t] > all_p[t]]
            for part, items in (("pair", sorted(pair, key=lambda x: (x[0], x[1].encode()))),
                                ("term", sorted(term, key=lambda x: (x[0], x[1].encode()))[:top])):
                out += [(lang, s, part, item, -v, r + 1) for r, (v, item) in enumerate(items)]
    return sorted(out)


def found(spark, rows, **kw):
    df = spark.createDataFrame([(k, *r, 1, "t", 2, 3.0, 4) for k, r in enumerate(rows)], SCHEMA).repartition(5)
    got = dv.divergence_audit(df, **kw)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(tuple(r) for r in got.collect())


def corpus(n, sources, words, seed):
    rng = random.Random(seed)
    vocab = [f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}" for i in range(words)] + ["Été", "naïve", "日本", "A​B", "X-y", "it's"]
    return [(" ".join(rng.choice(vocab[: max(2, int(len(vocab) ** rng.random()))]) for _ in range(rng.randint(0, 30))),
             rng.choice(["en", "en", "de", None]), rng.choice([f"s{i}" for i in range(sources)] + [None, "s0", "s0", "s0"])) for _ in range(n)]


@pytest.mark.parametrize("band,stripe", [(128, 150_000), (4, 7), (3, 40), (1, 1000)])
def test_blocks_of_any_size_give_the_same_sums(spark, band, stripe):
    rows = corpus(220, 11, 150, band)
    assert found(spark, rows, band=band, stripe=stripe) == brute(rows)


def test_odd_rows(spark):
    rows = [(None, None, None), ("", "en", "a"), ("123 ,;", "en", "b"), ("one two", "en", "c"), ("one", "fr", "a"), ("one", "fr", "a"),
            ("ONE one\x00oNe", "fr", "b"), ("É é e", "fr", "z"), ("x" * 100_000 + " " + "one " * 200_000, "fr", "é"), ("one one", "xx", "only")]
    want = brute(rows)
    assert found(spark, rows) == want
    assert found(spark, rows + rows) == brute(rows + rows)                   # repeated rows are documents
    assert found(spark, []) == [] and found(spark, [("a b", "en", "s")] * 3) == brute([("a b", "en", "s")] * 3)
    assert [w for w in found(spark, rows + rows, top_terms=1) if w[2] == "term"] == [w for w in brute(rows + rows, 1) if w[2] == "term"]


def test_joint_walk_reaches_every_nonzero_leaf_once():
    rng = np.random.default_rng(3)
    for k, (na, nb, nc) in itertools.product((2, 3, 4), [(1, 1, 1), (5, 9, 40), (20, 3, 7), (16, 16, 64)]):
        a, b = (np.unique(rng.integers(0, [n, nc], (rng.integers(0, 30), 2)), axis=0) for n in (na, nb))
        high = max(-(-na // k), -(-nb // k)) * k
        trees = [dv._levels(m[:, 0], m[:, 1], (high, nc), k) for m in (a, b)]
        got = list(zip(*dv.joint_leaves(*trees, (high // k, high // k, max(1, -(-nc // k))), k, False)))
        block = [{(r // k, c // k) for r, c in m.tolist()} for m in (a, b)]
        want = {(x, y, z) for x in range(high // k) for y in range(high // k) for z in range(-(-nc // k)) if (x, z) in block[0] or (y, z) in block[1]}
        assert len(got) == len(set(got)) and set(got) == want


def test_probabilities_of_large_counts_are_exact(spark):
    from pyspark.sql import functions as F
    rows = [(0, 7, 3), (12, 10**6, 10**5), (10**12, 10**13, 10**6), (9 * 10**9, 10**11, 5), (9 * 10**9 - 1, 10**11, 5)]
    df = spark.createDataFrame(rows, "c long, n long, v long").select("c", "n", "v", dv.probability(F.col("c"), F.col("n"), F.col("v")).alias("p"))
    assert all(r["p"] == 1 + 10**9 * (r["c"] + 1) // (r["n"] + r["v"]) for r in df.collect())
