"""Conversation structure repair: the cheapest edits by a dynamic program over runs.

A conversation's rows, in turn order, become symbols: the role's initial and the first
fault (blank, duplicate, truncated). A repaired conversation's role initials follow
``(s?(ua)+)?``, an automaton of four states, and a row's edits are a 4 x 4 matrix of
costs between states, inserts before the row included. Costs compose by (min, +).
Equal consecutive symbols are one run, and a run of any length passes through the
binary powers of its matrix, which are cached. The costs to go are taken from the end;
walking from the start, the least letter that keeps to them gives the cheapest audit
that is least in ASCII order. Within a run the walk goes by blocks of powers of two,
remembered by state and by the differences of the costs to go.

Edits, by their initials: Delete 3 (the only one for blank and duplicate rows), Insert
an empty user or assistant row 2, Keep 0, Rerole to user or assistant 2; a truncated
row that stays adds 1.

Scale: everything but the repaired text works on narrow rows without texts. Equal rows
are counted first (map-side), and the first of equal (role, text) pairs comes from an
aggregate. Rows are range-sorted by conversation and turn, so a conversation of any
size is spread over tasks: what lies whole inside a partition is settled there, and
fragments (the two at the edges of a partition, and stretches of ``FRAGMENT`` rows)
give one matrix each. Costs to go pass over the matrices of a conversation, each
fragment is walked from all four states in parallel, and the states pass forward over
the exits. The digest of a repaired conversation is one SHA-256, a chain by nature: its
rows stream through one task in sorted order and are never held together.

Edge cases: null roles and texts are one space (so the text is blank and the role no
legal one); the null conversation is one of its own; null turns stand first; rows of
one turn stand in the order of role, then of a hash of the text; equal rows are
duplicates of the first one; a conversation without rows has zeros, an empty audit and
the digest of an empty text; an empty table gives an empty result; further columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache, lru_cache
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from derrick.llm.common import documents, settled
from derrick.sources.scratch import materialize

#: States of a repaired prefix: nothing yet, after s, after u, after a.
START, SYSTEM, USER, ANSWERED = range(4)
#: The state that an inserted or reroled row leads to, by the state before it: an
#: assistant answers a user, anything else is followed by a user.
NEXT = (USER, USER, ANSWERED, USER)
#: The state that a kept row leads to, by its initial and the state before it.
KEPT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ANSWERED: USER}, "a": {USER: ANSWERED}}
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
FORCED = "x"
FRAGMENT = 50_000
NEVER = 1 << 60
_WHITE = " \t\n\x0b\x0c\r"
_ROLE = {USER: "user", ANSWERED: "assistant"}

Symbol = str  # FORCED, or the initial (o: any other) with "~" if truncated


def symbol(initial: str, truncated: bool) -> Symbol:
    return (initial if initial in KEPT else "o") + ("~" if truncated else "")


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The (min, +) product of a matrix with a matrix or a vector."""
    both = a[:, :, None] + b[None, :, :] if b.ndim == 2 else a + b[None, :]
    return np.minimum(both.min(axis=1), NEVER)


def _inserts() -> np.ndarray:
    """Costs of inserting rows, none included."""
    out = np.full((4, 4), NEVER, dtype=np.int64)
    for s in range(4):
        at, cost = s, 0
        while out[s, at] > cost:
            out[s, at] = cost
            at, cost = NEXT[at], cost + INSERT
    return out


INSERTS = _inserts()
#: Costs to go after the last row.
END = _times(INSERTS, np.array([0, NEVER, NEVER, 0], dtype=np.int64))


def options(x: Symbol, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of the edits that use up a row, in ASCII order."""
    out = [("D", DELETE, state)]
    if x != FORCED:
        worse = TRUNCATED if x.endswith("~") else 0
        if state in KEPT.get(x[0], {}):
            out.append(("K", worse, KEPT[x[0]][state]))
        out.append(("R", REROLE + worse, NEXT[state]))
    return out


@cache
def power(x: Symbol, k: int) -> np.ndarray:
    """The matrix of 2^k rows of a symbol."""
    if k:
        half = power(x, k - 1)
        return _times(half, half)
    step = np.full((4, 4), NEVER, dtype=np.int64)
    for s in range(4):
        for _, cost, to in options(x, s):
            step[s, to] = min(step[s, to], cost)
    return _times(INSERTS, step)


def through(x: Symbol, length: int, togo: np.ndarray) -> np.ndarray:
    """``togo`` (a vector, or a matrix) before a run of ``length`` rows."""
    for k in range(length.bit_length()):
        if length >> k & 1:
            togo = _times(power(x, k), togo)
    return togo


@lru_cache(maxsize=20_000)
def _block(x: Symbol, k: int, state: int, togo: tuple[int, ...]) -> tuple[str, int]:
    """Letters and last state of 2^k rows from ``state``, ``togo`` being the costs to go
    behind them (less the smallest)."""
    behind = np.array(togo, dtype=np.int64)
    if k:
        middle = _relative(through(x, 1 << (k - 1), behind))
        first, state = _block(x, k - 1, state, middle)
        second, state = _block(x, k - 1, state, togo)
        return first + second, state
    before, letters = through(x, 1, behind), ""
    while True:
        ways = {letter: to for letter, cost, to in options(x, state) if cost + togo[to] == before[state]}
        if "D" in ways:
            return letters + "D", ways["D"]
        if INSERT + before[NEXT[state]] == before[state]:
            letters, state = letters + "I", NEXT[state]
            continue
        letter = min(ways)
        return letters + letter, ways[letter]


def _relative(togo: np.ndarray) -> tuple[int, ...]:
    return tuple(int(v) if v < NEVER else NEVER for v in togo - togo.min())


Runs = list[tuple[Symbol, int]]


def walk(runs: Runs, state: int, end: np.ndarray, last: bool) -> tuple[str, int, int]:
    """(audit, cost, last state) of the cheapest edits of ``runs`` from ``state``, with the costs to go
    ``end`` behind them; the last fragment also gets the inserts behind its last row."""
    behind = [end]
    for x, length in reversed(runs):
        behind.append(through(x, length, behind[-1]))
    behind.reverse()
    cost = int(behind[0][state])
    out: list[str] = []
    for (x, length), after in zip(runs, behind[1:]):
        for k in reversed(range(length.bit_length())):
            if length >> k & 1:
                rest = through(x, length & ((1 << k) - 1), after)
                letters, state = _block(x, k, state, _relative(rest))
                out.append(letters)
    if last:
        out.append("I" * int(end[state] // INSERT))
    else:
        cost -= int(end[state])
    return "".join(out), cost, state


def damaged(rows: DataFrame) -> DataFrame:
    """The rows after damage: conversation (a string key), turn, role, text and ``copies``."""
    label = F.concat(*(F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c else F.lit(":") for c in ("conv_id", "", "turn")))
    act = F.crc32(label.cast("binary")) % 20
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    return rows.filter(act != 0).select(
        conversation_key(F.col("conv_id")).alias("conv"), "turn",
        F.when(act == 4, "user").otherwise(role).alias("role"),
        F.when(act == 1, "").when(act == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(act == 3, 2).otherwise(1).alias("copies"),
    )


def conversation_key(conv_id: Column) -> Column:
    return F.when(conv_id.isNull(), "").otherwise(F.concat(F.lit("="), conv_id.cast("string")))


_ORDER = ("conv", "timed", "turn", "role", "digest")


def _ordered(rows: DataFrame) -> DataFrame:
    """``rows`` with what they are sorted by; ``timed`` is false where the turn is null."""
    digest = F.substring(F.unhex(F.sha2("text", 256)), 1, 16)
    return rows.select("conv", F.col("turn").isNotNull().alias("timed"), F.coalesce("turn", F.lit(0)).cast("long").alias("turn"),
                       "role", digest.alias("digest"), "text", "copies")


def faults(rows: DataFrame) -> DataFrame:
    """Distinct rows (``_ORDER``) of ``_ordered`` rows, with their number of ``copies`` and whether
    they are blank, truncated or seen in an earlier turn."""
    bare = F.btrim("text", F.lit(_WHITE))
    facts = rows.select(*_ORDER, "copies", (bare == "").alias("blank"), (~F.right(bare, F.lit(1)).isin(*".!?")).alias("open"))
    distinct = materialize(facts.groupBy(*_ORDER, "blank", "open").agg(F.sum("copies").alias("copies")), "rows")
    first = distinct.groupBy("conv", "role", "digest").agg(F.min(F.struct("timed", "turn")).alias("first"))
    met = distinct.join(first, ["conv", "role", "digest"])
    return met.select(*_ORDER, "copies", "blank", "open", (F.struct("timed", "turn") > F.col("first")).alias("seen"))


class _Fragment:
    """What is known of a stretch of a conversation's rows."""

    def __init__(self, conv: str, sub: int) -> None:
        self.conv, self.sub = conv, sub
        self.runs: Runs = []
        self.rows = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first_turn: int | None = None
        self.last_turn: int | None = None
        self.first_initial: str | None = None
        self.last_initial = ""

    def _run(self, x: Symbol, length: int) -> None:
        if length and self.runs and self.runs[-1][0] == x:
            self.runs[-1] = (x, self.runs[-1][1] + length)
        elif length:
            self.runs.append((x, length))

    def add(self, turn: int | None, role: str, copies: int, blank: bool, open_: bool, seen: bool) -> None:
        initial = role[:1]
        if self.first_initial is None:
            self.first_initial = initial
        else:
            self.illegal += illegal(self.last_initial, initial)
        self.illegal += copies - 1  # a role never follows itself
        self.last_initial = initial
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        self.rows += 1
        if blank:
            self.blank += copies
            self._run(FORCED, copies)
            return
        if not seen:
            self.truncated += open_
            self._run(symbol(initial, open_), 1)
            copies -= 1
        self.duplicate += copies
        self._run(FORCED, copies)

    def record(self, part: int, whole: bool) -> dict:
        audit, cost, matrix = None, None, None
        if whole:
            audit, cost, _ = walk(self.runs, START, END, True)
        else:
            matrix = np.where(np.eye(4, dtype=bool), 0, NEVER).astype(np.int64)
            for x, length in reversed(self.runs):
                matrix = through(x, length, matrix)
            matrix = matrix.ravel().tolist()
        return {
            "conv": self.conv, "part": part, "sub": self.sub, "whole": whole, "first_turn": self.first_turn,
            "last_turn": self.last_turn, "turns": self.turns, "blank": self.blank, "duplicate": self.duplicate,
            "truncated": self.truncated, "illegal": self.illegal, "first_initial": self.first_initial,
            "last_initial": self.last_initial, "audit": audit, "cost": cost, "matrix": matrix,
            "symbols": None if whole else [x for x, _ in self.runs], "lengths": None if whole else [n for _, n in self.runs],
        }


def illegal(before: str, after: str) -> int:
    return int(before + after not in {"su", "ua", "au"})


_FRAGMENT = (
    "conv string, part int, sub long, whole boolean, first_turn long, last_turn long, turns long, blank long, duplicate long, truncated long, "
    "illegal long, first_initial string, last_initial string, audit string, cost long, matrix array<long>, symbols array<string>, lengths array<long>"
)


def _records(found: list[dict]) -> pd.DataFrame:
    names = [c.split()[0] for c in _FRAGMENT.split(", ")]
    return pd.DataFrame({n: pd.Series([r[n] for r in found], dtype=object) for n in names})


def fragments(rows: DataFrame, limit: int = FRAGMENT) -> DataFrame:
    """A row per conversation and stretch of the range-sorted ``faults``. A conversation
    that neither begins nor ends its partition and fits a stretch is ``whole`` and solved."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now: _Fragment | None = None
        first, part, done = True, 0, []
        for batch in batches:
            columns = [batch[c].tolist() for c in ("part", "conv", "timed", "turn", "role", "copies", "blank", "open", "seen")]
            for part, conv, timed, turn, *facts in zip(*columns):
                if now is None or conv != now.conv or now.rows >= limit:
                    if now is not None:
                        same = conv == now.conv
                        done.append(now.record(part, not first and not same and now.sub == 0))
                        first = first and same
                        now = _Fragment(conv, now.sub + 1 if same else 0)
                    else:
                        now = _Fragment(conv, 0)
                now.add(turn if timed else None, *facts)
            if done:
                yield _records(done)
                done = []
        if now is not None:
            yield _records([now.record(part, False)])

    dealt = rows.repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER)
    return dealt.withColumn("part", F.spark_partition_id()).mapInPandas(run, _FRAGMENT)


def _costs_to_go(pieces: pd.DataFrame) -> pd.DataFrame:
    """Costs to go behind each fragment of one conversation."""
    pieces = pieces.sort_values(["part", "sub"], ascending=False)
    end, out = END, []
    for matrix in pieces["matrix"]:
        out.append(end.tolist())
        end = _times(np.asarray(matrix, dtype=np.int64).reshape(4, 4), end)
    return pieces[["conv", "part", "sub"]].assign(end=out, last=[i == 0 for i in range(len(out))])


def _walked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Audit, cost and exit of each fragment from each of the four states."""
    for batch in batches:
        ways = [
            [walk([(x, int(n)) for x, n in zip(xs, ns)], s, np.asarray(end, dtype=np.int64), last) for s in range(4)]
            for xs, ns, end, last in zip(batch["symbols"], batch["lengths"], batch["end"], batch["last"])
        ]
        yield batch[["conv", "part", "sub"]].assign(
            audits=[[w[0] for w in four] for four in ways], costs=[[w[1] for w in four] for four in ways],
            exits=[[w[2] for w in four] for four in ways],
        )


def _states(pieces: pd.DataFrame) -> pd.DataFrame:
    """The state in which each fragment of one conversation begins, and what the seams
    between fragments add or count twice."""
    pieces = pieces.sort_values(["part", "sub"])
    state, out, before = START, [], None
    for row in pieces.itertuples(index=False):
        joint = twice = 0
        if before is not None:
            joint = illegal(before[0], row.first_initial)
            twice = int(before[1] is not None and row.first_turn == before[1])
        out.append((row.conv, row.part, row.sub, state, joint, twice))
        last = row.last_turn if not pd.isna(row.last_turn) else (before[1] if before else None)
        before = (row.last_initial, last)
        state = int(row.exits[state])
    return pd.DataFrame(out, columns=["conv", "part", "sub", "state", "joint", "twice"])


_KEYS = ["conv", "part", "sub"]
_SUMS = ("turns", "blank", "duplicate", "truncated", "illegal", "cost")


def verdicts(rows: DataFrame, limit: int = FRAGMENT) -> DataFrame:
    """Per conversation of the ``damaged`` rows: gaps, the counts of faults, cost and audit."""
    found = materialize(fragments(faults(_ordered(rows)), limit), "fragments")
    split = found.filter("NOT whole")
    ends = split.select(*_KEYS, "matrix").groupBy("conv").applyInPandas(_costs_to_go, "conv string, part int, sub long, end array<long>, last boolean")
    ways = split.select(*_KEYS, "symbols", "lengths").join(ends, _KEYS).mapInPandas(
        _walked, "conv string, part int, sub long, audits array<string>, costs array<long>, exits array<int>"
    )
    ways = materialize(ways, "ways")
    seams = split.select(*_KEYS, "first_turn", "last_turn", "first_initial", "last_initial").join(ways.select(*_KEYS, "exits"), _KEYS)
    seams = seams.groupBy("conv").applyInPandas(_states, "conv string, part int, sub long, state int, joint long, twice long")
    pieces = split.drop("audit", "cost").join(ways, _KEYS).join(seams, _KEYS).select(
        *_KEYS, "first_turn", "last_turn", (F.col("turns") - F.col("twice")).alias("turns"), "blank", "duplicate", "truncated",
        (F.col("illegal") + F.col("joint")).alias("illegal"),
        F.expr("costs[state]").alias("cost"), F.expr("audits[state]").alias("audit"),
    )
    joined = pieces.groupBy("conv").agg(
        F.min("first_turn").alias("first_turn"), F.max("last_turn").alias("last_turn"), *(F.sum(c).alias(c) for c in _SUMS),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "sub", "audit"))), lambda p: p["audit"]), "").alias("audit"),
    )
    whole = found.filter("whole").select(*joined.columns)
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns"), F.lit(0))
    return whole.unionByName(joined).select("conv", gaps.alias("gaps"), *_SUMS[1:], "audit")


def edited(rows: DataFrame, audits: DataFrame, make: Callable[[], object], schema: str) -> DataFrame:
    """What ``make()`` returns makes of each conversation's edits, streamed in order: its ``row(conv,
    letter, role, text)`` is called for every edit, ``end(conv)`` behind the last one, and
    both may return a tuple of ``schema``."""
    head = audits.select("conv", F.lit(0).alias("rank"), F.lit(False).alias("timed"), F.lit(0).cast("long").alias("turn"),
                         F.lit("").alias("role"), F.lit(None).cast("binary").alias("digest"), F.col("audit").alias("text"), F.lit(0).alias("copies"))
    body = _ordered(rows).withColumn("rank", F.lit(1))
    both = head.unionByName(body).repartition("conv").sortWithinPartitions("conv", "rank", *_ORDER[1:])
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        use = make()
        conv: str | None = None
        letters, at, state, out = "", 0, START, []

        def give(made: tuple | None) -> None:
            if made is not None:
                out.append(made)

        def inserts() -> None:
            nonlocal at, state
            while at < len(letters) and letters[at] == "I":
                at, state = at + 1, NEXT[state]
                give(use.row(conv, "I", _ROLE[state], ""))

        for batch in batches:
            for key, rank, role, text, copies in zip(*(batch[c].tolist() for c in ("conv", "rank", "role", "text", "copies"))):
                if rank == 0:
                    if conv is not None:
                        inserts()
                        give(use.end(conv))
                    conv, letters, at, state = key, text, 0, START
                    continue
                for _ in range(copies):
                    inserts()
                    letter, at = letters[at], at + 1
                    if letter == "R":
                        state = NEXT[state]
                        role = _ROLE[state]
                    elif letter == "K":
                        state = KEPT[role[:1]][state]
                    give(use.row(conv, letter, role, text))
            if out:
                yield pd.DataFrame(out, columns=names)
                out = []
        if conv is not None:
            inserts()
            give(use.end(conv))
            yield pd.DataFrame(out, columns=names)

    return both.select("conv", "rank", "role", "text", "copies").mapInPandas(run, schema)


class _Digest:
    """SHA-256 of a conversation's repaired rows, ``role:text`` joined by newlines."""

    def __init__(self) -> None:
        self.sha, self.some = sha256(), False

    def row(self, conv: str, letter: str, role: str, text: str) -> None:
        if letter != "D":
            self.sha.update(f"{chr(10) if self.some else ''}{role}:{text}".encode())
            self.some = True

    def end(self, conv: str) -> tuple:
        done = (conv, self.sha.hexdigest())
        self.__init__()
        return done


class _Rows:
    """The repaired rows themselves, with their place and the edit that made them."""

    def __init__(self) -> None:
        self.place = 0

    def row(self, conv: str, letter: str, role: str, text: str) -> tuple | None:
        if letter == "D":
            return None
        self.place += 1
        return conv, self.place - 1, role, text, letter

    def end(self, conv: str) -> None:
        self.place = 0


def repaired(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """The repaired conversations of the ``damaged`` rows, by their ``verdicts``."""
    return edited(rows, audits, _Rows, "conv string, place long, role string, text string, edit string")


def repair(rows: DataFrame, limit: int = FRAGMENT) -> DataFrame:
    """Per conversation of the ``damaged`` rows its verdict and the digest of its repair."""
    found = materialize(verdicts(rows, limit), "verdicts")
    return found.join(edited(rows, found, _Digest, "conv string, repaired_sha256 string"), "conv")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    done = settled(spark, "repaired", lambda: repair(damaged(rows)))
    every = rows.select("conv_id").distinct().withColumn("key", conversation_key(F.col("conv_id")))
    met = every.join(done, F.col("key") == F.col("conv"), "left")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return met.select(
        "conv_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts), F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
