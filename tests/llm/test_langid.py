"""Language identification against a dense recount, and by language."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from mercato.llm import langid as li

LETTERS = re.compile(r"[^\W\d_]+")


def grams(w, n):
    w = f"<{w}>" if n > 1 else w
    return [w[i:i + n] for i in range(len(w) - n + 1)]


class Recount:
    """The rule stated plainly: all counts in dictionaries, each word scored by itself."""

    def __init__(self, labelled):
        self.langs = sorted({x for x, t in labelled if x is not None and t is not None})
        self.rows = Counter(x for x, t in labelled if x is not None and t is not None)
        self.n = defaultdict(Counter)
        for lang, text in labelled:
            if lang is not None and text is not None:
                for w in LETTERS.findall(text.lower()):
                    self.n[0, lang][w] += 1
                    for k in range(1, li.MAX_N + 1):
                        self.n[k, lang].update(grams(w, k))
        self.kinds = {k: len(set().union(*(self.n[k, x] for x in self.langs))) for k in range(li.MAX_N + 1)}
        self.size = {(k, x): sum(self.n[k, x].values()) for k in range(li.MAX_N + 1) for x in self.langs}

    def log(self, k, g):
        return [math.log((self.n[k, x][g] + 0.5) / (self.size[k, x] + 0.5 * self.kinds[k])) for x in self.langs]

    def word(self, w):
        if any(self.n[0, x][w] for x in self.langs):
            return self.log(0, w)
        for k in range(li.MAX_N, 0, -1):
            if known := [self.log(k, g) for g in grams(w, k) if any(self.n[k, x][g] for x in self.langs)]:
                return [sum(c) / len(known) for c in zip(*known)]
        return None

    def predict(self, text):
        words = LETTERS.findall((text or "").lower())
        if not words or not self.langs:
            return "und", 0.0
        scored = [s for w in words if (s := self.word(w))]
        if not scored:
            return max(self.langs, key=lambda x: (self.rows[x], [-ord(c) for c in x])), 1 / len(self.langs)
        mean = [sum(c) / len(scored) for c in zip(*scored)]
        p = [math.exp((m - max(mean)) * min(len(scored), li.EVIDENCE)) for m in mean]
        best = max(range(len(p)), key=lambda k: (p[k], -k))
        return self.langs[best], p[best] / sum(p)


def test_equals_a_dense_recount(spark):
    table = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang").collect()]
    table += [(1001, "ЖЖЖ", "ru"), (1005, "Привет, мир! don't “quoted”—dash ²x Ⅷ", None), (1006, "日本語。テスト", None), (1007, "ϞϞ", None),
              (1008, "ИЖ ЖИ", None), (1010, None, "en"), (1011, "été a b", "fr"), (1012, "x" * 50_000, None)]
    df = spark.createDataFrame(table, "doc_id long, text string, lang string").repartition(6)
    want = Recount([(x, t) for i, t, x in table if zlib.crc32(str(i).encode()) % 4 != 2])
    got = {r["doc_id"]: r for r in li.identify(df, li.fit_on_training_rows(df)).collect()}
    assert len(got) == len(table)
    for i, t, _ in table:
        name, score = want.predict(t)
        assert (got[i]["lang_pred"], got[i]["score"]) == (name, pytest.approx(score, rel=1e-9)), (i, t)


def test_every_word_of_the_sample_is_known(spark):
    # 160,000 words seen once in one language do not push out another's, nor one another
    letters = "abcdefghijklmnopqrst"
    once = [a + b + c + d for a in letters for b in letters for c in letters for d in letters]
    table = [("big", " ".join(once[k:k + 160])) for k in range(0, 160_000, 160)] + [("small", "uvwx vwxy wxyz")] * 10
    model = li.fit(spark.createDataFrame(table, "lang string, text string"))
    assert len(model.grams[0]) == 160_003
    assert all(model.predict(w)[0] == "big" for w in random.Random(1).sample(once, 50)) and model.predict("vwxy")[0] == "small"


def test_a_rare_language_in_a_large_table(spark):
    rng = random.Random(2)
    words = {x: ["".join(rng.choice(a) for _ in range(rng.randint(2, 7))) for _ in range(n)]
             for x, a, n in (("aa", "abcdefghij", 4000), ("bb", "fghijklmno", 4000), ("cc", "aeiouxyzfg", 300))}
    text = lambda x: " ".join(rng.choice(words[x]) for _ in range(12))
    table = [(x, text(x)) for x, n in (("aa", 9000), ("bb", 6000), ("cc", 60)) for _ in range(n)]
    df = spark.createDataFrame(table, "lang string, text string").repartition(8)
    chosen, sizes = li.sample(df.selectExpr("lang", "text", "0 AS key"), 900)
    assert sizes == {"aa": 9000, "bb": 6000, "cc": 60}
    by = {r[0]: r[1] for r in chosen.groupBy("lang").count().collect()}
    assert by["cc"] == 60 and 200 < by["aa"] < 400 and 200 < by["bb"] < 400   # shares are even, whatever the sizes
    model = li.fit(df, 900)
    for x in words:
        fresh = [text(x) for _ in range(200)]
        assert sum(model.predict(t)[0] == x for t in fresh) >= 190, x


def test_held_out_accuracy_by_language(spark):
    import __spark_entry__ as e
    d = "/root/testdata/sf0.01"
    lang = {r[0]: r[1] for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang").collect()}
    right, n = Counter(), Counter()
    for r in e.queries()["op9_language_id"](spark, d).collect():
        if r["held_out"] and r["lang_pred"] != "und" and lang[r["doc_id"]] is not None:
            n[lang[r["doc_id"]]] += 1
            right[lang[r["doc_id"]]] += r["lang_pred"] == lang[r["doc_id"]]
    assert len(n) == 4 and all(right[x] >= 0.95 * n[x] for x in n), (right, n)
