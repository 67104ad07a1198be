"""Conversation repair against a plain program without runs, powers or fragments."""

from __future__ import annotations

import hashlib
import random
import zlib
from functools import lru_cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from derrick.llm import conversation_repair as cr

WHITE = " \t\n\x0b\x0c\r"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        label = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        act = zlib.crc32(label.encode()) % 20
        if act == 1:
            text = ""
        elif act == 2:
            text = "".join(c for c in text if c not in ".!?")
        elif act == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(act, 1)
    return out


def cheapest(symbols):
    """(cost, audit) by trying every edit at every place; symbols are (initial, fault)."""

    @lru_cache(None)
    def best(i, role, inserted):
        ways = []
        turn = "a" if role == "u" else "u"
        if i == len(symbols) and role in ("", "a"):
            ways.append((0, ""))
        if inserted < 4:
            cost, rest = best(i, turn, inserted + 1)
            ways.append((cost + 2, "I" + rest))
        if i < len(symbols):
            initial, fault = symbols[i]
            cost, rest = best(i + 1, role, 0)
            ways.append((cost + 3, "D" + rest))
            if fault not in ("blank", "duplicate"):
                worse = fault == "truncated"
                if initial == turn or (initial == "s" and role == ""):
                    cost, rest = best(i + 1, initial, 0)
                    ways.append((cost + worse, "K" + rest))
                cost, rest = best(i + 1, turn, 0)
                ways.append((cost + worse + 2, "R" + rest))
        return min(ways) if ways else (10**9, "")

    for i in reversed(range(len(symbols) + 1)):  # from the end, so that nothing recurses deep
        for role in ("", "s", "u", "a"):
            best(i, role, 0)
    return best(0, "", 0)


def brute(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted(
            damage([r for r in rows if r[0] == conv]),
            key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.sha256(r[3].encode()).digest()),
        )
        seen, symbols = set(), []
        for _, _, role, text in mine:
            bare = text.strip(WHITE)
            if not bare:
                fault = "blank"
            elif (role, text) in seen:
                fault = "duplicate"
            else:
                fault = "" if bare[-1] in ".!?" else "truncated"
            seen.add((role, text))
            symbols.append((role[:1], fault))
        cost, audit = cheapest(tuple(symbols))
        lines, i, last = [], 0, ""
        for letter in audit:
            turn = "assistant" if last == "user" else "user"
            if letter == "I":
                lines.append(f"{turn}:")
                last = turn
                continue
            _, _, role, text = mine[i]
            i += 1
            if letter == "R":
                role = turn
            if letter != "D":
                lines.append(f"{role}:{text}")
                last = {"u": "user", "a": "assistant"}.get(role[:1], "s")
        turns = [r[1] for r in mine if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        pairs = zip(mine, mine[1:])
        wrong = sum((a[2][:1] + b[2][:1]) not in ("su", "ua", "au") for a, b in pairs)
        counts = [sum(f == k for _, f in symbols) for k in ("blank", "duplicate", "truncated")]
        out[conv] = (gaps, *counts, wrong, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def random_rows(seed, convs, longest):
    rng = random.Random(seed)
    rows = []
    for conv in convs:
        for turn in range(rng.randrange(longest)):
            role = rng.choice(["user", "assistant"] * 5 + ["system", "tool", "", None, "User"])
            text = rng.choice(["Yes.", "No", "What? ", " \t", None, f"text {rng.random()}.", f"cut {rng.random()}"])
            rows.append((conv, None if rng.random() < 0.02 else turn * rng.choice([1, 1, 1, 3]), role, text))
    return rows


AWKWARD = [
    (7, None, None, None),
    (7, None, None, None),
    (None, 1, "user", "An id is missing."),
    (None, None, "assistant", "long " * 40_000 + "end."),
    (8, 5, "system", "Only a system row."),
    (9, 2**40, "user", "Far away"),
    (9, -3, "assistant", "Before zero."),
]


def table(spark, sf_dir, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for name, kind in (("conv", "string"), ("copies", "int"), ("rank", "int"), ("part", "int"), ("digest", "binary"), ("key", "long"), ("cost", "long")):
        df = df.withColumn(name, F.lit(None).cast(kind))
    df.repartition(3).write.mode("overwrite").parquet(f"{sf_dir}/conversations.parquet")
    return str(sf_dir)


def answer(df):
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return {r["conv_id"]: tuple(r[n] for n in names) for r in df.collect()}


def test_query_equals_plain_program(spark, tmp_path):
    rows = random_rows(1, range(100, 160), 14) + AWKWARD + AWKWARD[:3]
    sf_dir = table(spark, tmp_path, rows)
    assert answer(cr.op12_conversation_repair(spark, sf_dir)) == brute(rows)


def test_given_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert answer(cr.op12_conversation_repair(spark, sf_dir)) == brute(rows)


@pytest.mark.parametrize("limit", [1, 3, 50_000])
def test_fragments_change_nothing(spark, limit):
    """One conversation over many stretches and partitions, and some short ones."""
    rows = random_rows(2, [1], 2) + random_rows(3, [5] * 4, 90) + random_rows(4, range(10, 20), 9)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = cr.repair(cr.damaged(df), limit)
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    got = {r["conv"]: tuple(r[n] for n in names) for r in found.collect()}
    want = {f"={k}": v for k, v in brute(rows).items() if damage([r for r in rows if r[0] == k])}
    assert got == want


def test_empty_table_and_repaired_rows(spark, tmp_path):
    assert answer(cr.op12_conversation_repair(spark, table(spark, tmp_path, []))) == {}
    rows = cr.damaged(spark.createDataFrame(random_rows(5, range(30), 9), "conv_id long, turn long, role string, text string"))
    found = cr.verdicts(rows)
    for conv, roles in {r["conv"]: r["roles"] for r in cr.repaired(rows, found).groupBy("conv").agg(
        F.expr("transform(sort_array(collect_list(struct(place, role))), r -> left(r.role, 1))").alias("roles")
    ).collect()}.items():
        text = "".join(roles)
        assert text.removeprefix("s") == "ua" * (len(text.removeprefix("s")) // 2) and text != "s", conv


def test_long_runs_equal_single_steps():
    rng = random.Random(6)
    for _ in range(60):
        runs = [(rng.choice(["x", "s", "u", "u~", "a", "a~", "o", "o~"]), rng.randrange(1, 40)) for _ in range(rng.randrange(6))]
        symbols = []
        for x, n in runs:
            symbols += [(x[0], "blank" if x == "x" else "truncated" if x.endswith("~") else "")] * n
        audit, cost, _ = cr.walk(runs, cr.START, cr.END, True)
        assert (cost, audit) == cheapest(tuple(symbols))


def test_powers_reach_lengths_that_steps_cannot():
    before = cr.through("u", 10**12, cr.END)
    assert before[cr.START] == 10**12  # each second row is reroled to an answer
    assert np.array_equal(before, cr.through("u", 10**12 - 7, cr.through("u", 7, cr.END)))
