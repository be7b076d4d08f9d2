"""Conversation structure repair by a dynamic program that streams over sorted turns.

Rows are dealt by conversation and sorted by turn within each partition, and ``mapInPandas`` walks
them once.  A conversation's state crosses Arrow batches, so its memory doesn't grow with its rows:
for each of the four states of the grammar ``(s?(ua)+)?`` there is the cost of the cheapest edits so
far, their place in the byte order of audits, and the running SHA-256 of what they have emitted.
Edits can be told apart by the states that they end in, so byte order is kept as a rank and no
audit is compared letter by letter.  Costs beyond the least one are bounded and ranks are a
permutation, so there are few configurations and a step is a look-up.

Which edits won is known at the end alone.  Four bytes a row, one for each state, point back to the
state, edit and insertions before it; whole megabytes of them go to the shared checkpoint folder
and are read from the last to the first.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .common import SPACE_CHARS

SPILL_BYTES = 4 << 20              # backpointers of a conversation held in memory

KEEP, REROLE, DELETE = range(3)
_LETTERS = b"KRD"
# fixed values: what edits cost, and the role that each state inserts or gives
COST = {KEEP: 0, REROLE: 3, DELETE: 4}
INSERT, TRUNCATED = 3, 3
EMPTY, SYSTEM, USER, ASSISTANT = range(4)            # what was emitted last; nothing at first
NEXT = {(EMPTY, "s"): SYSTEM, (EMPTY, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
GIVEN = {EMPTY: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
ROLES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
NONE, BLANK, DUPLICATE, CUT = range(4)               # a row's first fault
_FAR = 10                                            # two inserts and a deletion: a state dearer than this never wins
_START = ((0, 0), None, None, None)                  # (cost over the least, rank of the audit) of each state


def _moves(config: tuple, initial: str, fault: int) -> Iterator[tuple]:
    """(target, cost, rank of the audit before, letters, state before, inserts, edit)."""
    for before, own in enumerate(config):
        if own is None:
            continue
        cost, rank = own
        state = before
        for inserts in range(3):
            letters = "I" * inserts
            yield state, cost + COST[DELETE], rank, letters + "D", before, inserts, DELETE
            if fault in (NONE, CUT):
                more = cost + TRUNCATED * (fault == CUT)
                if (to := NEXT.get((state, initial))) is not None:
                    yield to, more + COST[KEEP], rank, letters + "K", before, inserts, KEEP
                yield NEXT[state, GIVEN[state]], more + COST[REROLE], rank, letters + "R", before, inserts, REROLE
            state, cost = NEXT[state, GIVEN[state]], cost + INSERT


class Steps(dict):
    """(configuration, initial, fault) -> (configuration after the row, cost added to the least, backpointers, moves)."""

    def __missing__(self, key: tuple) -> tuple:
        best: dict[int, tuple] = {}
        for to, *move in _moves(*key):
            if to not in best or move < best[to]:
                best[to] = move
        least = min(m[0] for m in best.values())
        best = {to: m for to, m in best.items() if m[0] <= least + _FAR}
        order = sorted(best, key=lambda to: best[to][1:3])
        config = tuple((best[s][0] - least, order.index(s)) if s in best else None for s in range(4))
        back = bytes((best[s][3] << 4 | best[s][4] << 2 | best[s][5]) if s in best else 0 for s in range(4))
        out = self[key] = config, least, back, [(s, *best[s][3:]) for s in best]
        return out


_steps = Steps()


class Backpointers:
    """Four bytes a row, read from the last row to the first; whole chunks are kept in ``folder``."""

    def __init__(self, folder: str, limit: int = SPILL_BYTES):
        self.folder, self.limit, self.held, self.files, self.fs = folder, limit - limit % 4 or 4, bytearray(), [], None

    def add(self, four: bytes) -> None:
        self.held += four
        if len(self.held) >= self.limit:
            if self.fs is None:
                from pyarrow import fs
                self.fs, self.path = fs.FileSystem.from_uri(self.folder if ":" in self.folder else f"file://{self.folder}")
                self.fs.create_dir(self.path, recursive=True)
            self.files.append(f"{self.path}/{uuid.uuid4().hex}")
            with self.fs.open_output_stream(self.files[-1]) as out:
                out.write(bytes(self.held))
            self.held = bytearray()

    def audit(self, state: int, inserts: int) -> str:
        """The letters of the edits that end in ``state`` with ``inserts`` more."""
        out = bytearray(b"I" * inserts)
        held = self.held
        while True:
            for k in range(len(held) - 4, -1, -4):
                b = held[k + state]
                out += _LETTERS[b & 3:(b & 3) + 1] + b"I" * (b >> 2 & 3)
                state = b >> 4
            if not self.files:
                break
            name = self.files.pop()
            with self.fs.open_input_stream(name) as source:
                held = source.read()
            self.fs.delete_file(name)
        out.reverse()
        return out.decode()


class Conversation:
    """One conversation's rows, one after another."""

    def __init__(self, conv_id: int | None, folder: str, limit: int):
        self.conv_id, self.back = conv_id, Backpointers(folder, limit)
        self.config, self.cost = _START, 0
        self.hashes = [hashlib.sha256(), None, None, None]
        self.faults, self.illegal, self.initial = [0, 0, 0, 0], 0, None
        self.first = self.turn = None
        self.turns = 0

    def add(self, turn: int | None, role: str, text: str, fault: int) -> None:
        if turn is not None and turn != self.turn:
            self.first = turn if self.turns == 0 else self.first
            self.turn, self.turns = turn, self.turns + 1
        self.faults[fault] += 1
        initial = role[:1]
        self.illegal += self.initial is not None and self.initial + initial not in LEGAL
        self.initial = initial
        self.config, more, back, moves = _steps[self.config, initial if initial in ("s", "u", "a") else "", fault]
        self.cost += more
        self.back.add(back)
        before, self.hashes = self.hashes, [None] * 4
        body = None
        for to, state, inserts, edit in moves:
            own = before[state]
            if edit != DELETE or inserts:
                own = own.copy()
                state = self._insert(own, state, inserts)
                if edit != DELETE:
                    if body is None:
                        body = (":" + text).encode()
                    own.update(("\n" * (state != EMPTY) + (role if edit == KEEP else ROLES[GIVEN[state]])).encode())
                    own.update(body)
            self.hashes[to] = own

    @staticmethod
    def _insert(own, state: int, inserts: int) -> int:
        for _ in range(inserts):
            own.update(("\n" * (state != EMPTY) + ROLES[GIVEN[state]] + ":").encode())
            state = NEXT[state, GIVEN[state]]
        return state

    def result(self) -> tuple:
        # fixed values: inserts that complete what each state has emitted
        ends = [(own[0] + INSERT * n, own[1], state, n) for state, n in ((EMPTY, 0), (SYSTEM, 2), (USER, 1), (ASSISTANT, 0))
                if (own := self.config[state]) is not None]
        cost, _, state, inserts = min(ends)
        digest = self.hashes[state].copy()
        self._insert(digest, state, inserts)
        gaps = self.turn - self.first + 1 - self.turns if self.turns else 0
        return (self.conv_id, gaps, *self.faults[1:], self.illegal, self.cost + cost, self.back.audit(state, inserts), digest.hexdigest())


REPORT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_NAMES = [c.split()[0] for c in REPORT.split(", ")]


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    return pd.DataFrame({name: pd.Series(col, dtype=object) for name, col in zip(names, zip(*rows))}) if rows else \
        pd.DataFrame({name: pd.Series([], dtype=object) for name in names})


def report_stream(folder: str, limit: int = SPILL_BYTES):
    """``mapInPandas`` function over rows sorted by conversation and turn; state crosses batches."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now: Conversation | None = None
        for frame in frames:
            done = []
            for conv, named, turn, timed, role, text, fault in zip(*(frame[c].tolist() for c in (
                    "conv", "named", "at", "timed", "role", "text", "fault"))):
                conv_id = conv if named else None
                if now is None or now.conv_id != conv_id:
                    if now is not None:
                        done.append(now.result())
                    now = Conversation(conv_id, folder, limit)
                if role is not None:                       # else a mark: the conversation is there
                    now.add(turn if timed else None, role, text, fault)
            if done:
                yield _frame(done, _NAMES)
        if now is not None:
            yield _frame([now.result()], _NAMES)

    return run


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with a space for null roles and texts; other columns are left out."""
    blank = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    return conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *blank)


def damaged(conversations: DataFrame) -> DataFrame:
    """Turns with planted faults, chosen by the checksum of ``conv_id:turn`` (null: a space).

    Of 20 remainders 0 drops the row (its role and text become null, so that the conversation is
    still known), 1 empties the text, 2 takes its full stops, exclamation and question marks, 3 repeats
    the row and 4 makes it a user's."""
    named = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    rows = turns(conversations).withColumn("_kind", F.crc32(F.concat(named[0], F.lit(":"), named[1]).cast("binary")) % 20)
    kind = F.col("_kind")
    text = F.when(kind == 0, F.lit(None)).when(kind == 1, F.lit("")).when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(kind == 0, F.lit(None)).when(kind == 4, F.lit("user")).otherwise(F.col("role"))
    times = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("_again")).drop("_again")


def _by_turn() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]


def _streamed(rows: DataFrame) -> DataFrame:
    """Rows dealt by conversation, with the columns that the streams read."""
    return rows.withColumn("named", F.col("conv_id").isNotNull()).withColumn("conv", F.coalesce("conv_id", F.lit(0).cast("long"))) \
        .withColumn("timed", F.col("turn").isNotNull()).withColumn("at", F.coalesce("turn", F.lit(0).cast("long")))


def repair_report(rows: DataFrame, spill_bytes: int = SPILL_BYTES) -> DataFrame:
    """One row per conversation of ``rows`` (``conv_id``, ``turn``, ``role``, ``text``; see ``turns``): its gaps, its
    rows by first fault, illegal neighbours, and the cheapest edits with their cost, their letters and the
    SHA-256 of the repaired ``role:text`` lines.

    Rows stand by turn, null turns first; rows of one turn stand by role and text, so copies are neighbours.
    A row with a null role only says that its conversation exists; a conversation without other rows has
    zeros, an empty audit and the hash of the empty string.  Null ids are one conversation.  A role whose first
    letter is none of s, u and a, an empty one too, is never kept as it is.  Nothing is collected: a
    conversation streams through one task, in memory that its length doesn't change but for its audit."""
    folder = f"{ensure_checkpoint_dir(rows.sparkSession).rstrip('/')}/repair-{uuid.uuid4().hex}"
    # dealt once: the window's key begins with the conversation, so it needs no second shuffle
    seen = F.row_number().over(Window.partitionBy("conv_id", "role", "text").orderBy(F.col("turn").asc_nulls_first())) > 1
    held = F.rtrim(F.col("text"), F.lit(SPACE_CHARS))
    fault = F.when(held == "", BLANK).when(F.col("_seen"), DUPLICATE) \
        .when(~F.right(held, F.lit(1)).isin(".", "!", "?"), CUT).otherwise(NONE).cast("int")
    dealt = rows.select("conv_id", "turn", "role", "text").repartition("conv_id").withColumn("_seen", seen).withColumn("fault", F.coalesce(fault, F.lit(0)))
    return _streamed(dealt).sortWithinPartitions("conv_id", *_by_turn()) \
        .select("conv", "named", "at", "timed", "role", "text", "fault").mapInPandas(report_stream(folder, spill_bytes), REPORT)


def _edited(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Applies each conversation's audit, its first row, to the rows that follow."""
    audit, at, state, out, n = "", 0, EMPTY, [], 0

    def inserted(conv_id):
        nonlocal at, state, n
        while at < len(audit) and audit[at] == "I":
            out.append((conv_id, n, ROLES[GIVEN[state]], ""))
            at, state, n = at + 1, NEXT[state, GIVEN[state]], n + 1

    last = None
    for frame in frames:
        for conv, named, head, role, text in zip(*(frame[c].tolist() for c in ("conv", "named", "audit", "role", "text"))):
            conv_id = conv if named else None
            if head is not None:
                inserted(last)
                audit, at, state, n, last = head, 0, EMPTY, 0, conv_id
            elif role is not None:
                inserted(conv_id)
                edit = audit[at]
                at += 1
                if edit != "D":
                    role = role if edit == "K" else ROLES[GIVEN[state]]
                    state = NEXT[state, role[:1]]
                    out.append((conv_id, n, role, text))
                    n += 1
        if out:
            yield _frame(out, ["conv_id", "position", "role", "text"])
            out = []
    inserted(last)
    if out:
        yield _frame(out, ["conv_id", "position", "role", "text"])


def repaired_turns(rows: DataFrame, report: DataFrame) -> DataFrame:
    """(conv_id, position, role, text): the repaired conversations, from the rows and their report."""
    heads = report.select("conv_id", F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"),
                          F.lit(None).cast("string").alias("text"), "audit")
    both = rows.select("conv_id", "turn", "role", "text", F.lit(None).cast("string").alias("audit")).filter("role is not null").unionByName(heads)
    return _streamed(both).repartition("conv_id").sortWithinPartitions("conv_id", F.col("audit").isNull(), *_by_turn()) \
        .select("conv", "named", "audit", "role", "text").mapInPandas(_edited, "conv_id long, position long, role string, text string")
