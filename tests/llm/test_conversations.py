"""Conversation repair against a recursion over whole audit strings."""

import hashlib
import itertools
import random
import zlib
from functools import lru_cache

import pytest

from mercato.llm import conversations as cv

SPACE = " \t\n\x0b\f\r"
NEXT = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
NAME = {"u": "user", "a": "assistant"}


def faults_of(rows):
    seen, out = set(), []
    for role, text in rows:
        held = text.rstrip(SPACE)
        if not held:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        elif held[-1] not in ".!?":
            out.append("truncated")
        else:
            out.append("")
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, audit, lines) by recursion from the end over whole strings."""
    faults = faults_of(rows)

    @lru_cache(None)
    def best(i, state, inserts):
        options = []
        if i == len(rows) and state in ("", "a"):
            options.append((0, "", ()))
        for to in "ua":
            if inserts < 2 and to in NEXT[state]:
                cost, audit, lines = best(i, to, inserts + 1) or (None, None, None)
                if cost is not None:
                    options.append((cost + 3, "I" + audit, (NAME[to] + ":", *lines)))
        if i < len(rows):
            (role, text), fault = rows[i], faults[i]
            if rest := best(i + 1, state, 0):
                options.append((rest[0] + 4, "D" + rest[1], rest[2]))
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                if role[:1] in NEXT[state] and (rest := best(i + 1, role[:1], 0)):
                    options.append((rest[0] + more, "K" + rest[1], (f"{role}:{text}", *rest[2])))
                for to in "ua":
                    if to in NEXT[state] and (rest := best(i + 1, to, 0)):
                        options.append((rest[0] + 3 + more, "R" + rest[1], (f"{NAME[to]}:{text}", *rest[2])))
        return min(options, default=None)

    return best(0, "", 0)


def expected(table):
    """Reports of (conv_id, turn, role, text) rows without damage, by conversation."""
    out = {}
    for conv in {r[0] for r in table}:
        own = sorted([r for r in table if r[0] == conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        rows = [(r[2], r[3]) for r in own]
        faults, known = faults_of(rows), sorted({r[1] for r in own if r[1] is not None})
        cost, audit, lines = cheapest(tuple(rows))
        out[conv] = (conv, known[-1] - known[0] + 1 - len(known) if known else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                     sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows)),
                     cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def damage(table):
    out = []
    for conv, turn, role, text in table:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind:
            text = "" if kind == 1 else text.translate({ord(c): None for c in ".!?"}) if kind == 2 else text
            out += [(conv, turn, "user" if kind == 4 else role, text)] * (1 + (kind == 3))
    return out


SCHEMA = "conv_id long, turn long, role string, text string"


def reports(df, **kw):
    return {r[0]: tuple(r) for r in cv.repair_report(df, **kw).collect()}


def random_table(n, seed, longest=9):
    rng, out = random.Random(seed), []
    for conv in range(n):
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", "sys"])
            text = rng.choice(["One.", "Two!", "three", " ", "", "Four?\n", "five \t", f"{turn}."])
            out.append((conv, rng.choice([turn, turn, turn, 3, None]), role, text))
    return out


def test_small_conversations_by_trying_all_edits():
    # the recursion itself, held against every sequence of edits
    texts, roles = ["x.", "y", ""], ["system", "user", "assistant", "tool"]
    rng = random.Random(5)
    for _ in range(60):
        rows = tuple((rng.choice(roles), rng.choice(texts) and f"{k}{rng.choice(texts)}") for k in range(rng.randint(0, 3)))
        faults, best = faults_of(rows), None
        for inserts in itertools.product(range(3), repeat=len(rows) + 1):
            for edits in itertools.product("KRD", repeat=len(rows)):
                state, cost, audit, ok = "", 0, "", True
                for k in range(len(rows) + 1):
                    for _ in range(inserts[k]):
                        state, cost, audit = {"": "u", "s": "u", "u": "a", "a": "u"}[state], cost + 3, audit + "I"
                    if k == len(rows):
                        break
                    audit += edits[k]
                    if edits[k] == "D":
                        cost += 4
                        continue
                    ok &= faults[k] not in ("blank", "duplicate")
                    cost += 3 * (faults[k] == "truncated") + 3 * (edits[k] == "R")
                    to = rows[k][0][:1] if edits[k] == "K" else {"": "u", "s": "u", "u": "a", "a": "u"}[state]
                    ok &= to in NEXT[state]
                    if not ok:
                        break
                    state = to
                if ok and state in ("", "a"):
                    best = min(best, (cost, audit)) if best else (cost, audit)
        assert cheapest(rows)[:2] == best


@pytest.mark.parametrize("seed", [1, 2])
def test_random_conversations(spark, seed):
    table = random_table(300, seed)
    df = spark.createDataFrame(table, SCHEMA).repartition(7)
    assert reports(df) == expected(table)


def test_state_and_backpointers_cross_batches_and_files(spark):
    rng = random.Random(3)
    table = [(9, t, rng.choice(["user", "assistant", "system"]), f"{rng.randint(0, 400)}{rng.choice(['.', '.', '', ' '])}") for t in range(700)]
    table += [(8, t, "user", "a.") for t in range(3)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "13")
    try:
        import sys
        sys.setrecursionlimit(20_000)
        assert reports(spark.createDataFrame(table, SCHEMA), spill_bytes=64) == expected(table)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_repaired_turns_are_what_the_hash_is_of(spark):
    table = random_table(120, 11)
    df = cv.turns(spark.createDataFrame(table, SCHEMA))
    report = cv.repair_report(df)
    lines = {}
    for r in sorted(cv.repaired_turns(df, report).collect(), key=lambda r: (r["conv_id"], r["position"])):
        lines.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    for r in report.collect():
        assert hashlib.sha256("\n".join(lines.get(r["conv_id"], [])).encode()).hexdigest() == r["repaired_sha256"]


def test_damage_nulls_lost_rows_and_odd_columns(spark):
    table = [(k, t, role, text) for k in range(40) for t, (role, text) in enumerate([("user", "Hi. There!"), ("assistant", "Yes."), (None, None)])]
    table += [(None, 1, "user", "a."), (None, None, "assistant", "b."), (50, None, "user", "x" * 300_000 + "."), (50, None, "user", "c.")]
    lost = next(k for k in range(1000, 2000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    table += [(lost, 0, "user", "gone.")]
    extra = spark.createDataFrame([(*r, "z", 1, True) for r in table], SCHEMA + ", audit string, _seen int, named boolean")
    got = reports(cv.damaged(extra))
    want = expected(damage(table))
    empty = hashlib.sha256(b"").hexdigest()
    assert got.pop(lost) == (lost, 0, 0, 0, 0, 0, 0, "", empty)
    assert got == want
    assert cv.repair_report(cv.damaged(spark.createDataFrame([], SCHEMA))).collect() == []


def test_query_on_the_test_table(spark):
    import __spark_entry__ as e
    d = "/root/testdata/sf0.01"
    got = {r[0]: tuple(r) for r in e.queries()["op12_conversation_repair"](spark, d).collect()}
    table = [tuple(r) for r in spark.read.parquet(f"{d}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want, empty = expected(damage(table)), hashlib.sha256(b"").hexdigest()
    assert got == {k: want.get(k, (k, 0, 0, 0, 0, 0, 0, "", empty)) for k in {r[0] for r in table}}
