"""Quality rules, mixing and decontamination against plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from derrick.llm import decontaminate, mix_curriculum, quality_hosts
from derrick.sources.scratch import materialize
from llm_rows import AWKWARD

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measures(text):
    text = text or ""
    w = WORD.findall(text)
    win = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    hit = {i + k for i in range(len(w) - 4) if win[tuple(w[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit))


def test_measures_of_awkward_texts(awkward):
    out = quality_hosts.measure(awkward).select("__row.doc_id", "__row.text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    rows = out.collect()
    assert len(rows) == len(AWKWARD)
    for r in rows:
        assert tuple(r)[2:] == measures(r["text"])


def test_repeats_found_in_random_texts(docs):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice("ab") for _ in range(rng.randrange(40))), "s") for i in range(60)]
    for r in quality_hosts.measure(docs(rows)).select("__row.text", "n_repeat_words").collect():
        assert r["n_repeat_words"] == measures(r["text"])[4]


def test_a_host_is_convicted_and_clean_documents_stay(docs):
    clean = " ".join(f"word{i}" for i in range(30))
    noisy = clean + " ##########"
    rows = [(i, noisy if i % 2 else clean, "bad") for i in range(40)]
    rows += [(100 + i, noisy if i == 0 else clean, "good") for i in range(40)]
    rows += [(200, "too short", "good")]
    out = quality_hosts.judge(materialize(quality_hosts.measure(docs(rows)), "m"))
    kept = {r["doc_id"]: r["kept"] for r in out.select("__row.doc_id", "kept").collect()}
    assert [kept[i] for i in range(40)] == [i % 2 == 0 for i in range(40)]
    assert all(kept[100 + i] for i in range(40)) and not kept[200]


def test_quality_stage_keeps_columns_and_stands_emptiness(spark, docs, awkward):
    out = quality_hosts.quality_stage(spark, awkward, "")
    assert out.columns == awkward.columns
    assert quality_hosts.quality_stage(spark, docs([]), "").collect() == []


# --- mixing -----------------------------------------------------------------------


def targets(sizes, weights=(5, 2, 1)):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), {}
    while True:
        left = total - sum(full.values())
        open_ = [s for s in names if s not in full]
        heavy = sum(w[s] for s in open_)
        got = {s: left * w[s] / heavy for s in open_} if open_ else {}
        over = [s for s in open_ if got[s] > 3 * sizes[s]]
        if not over:
            return full | got
        full |= {s: 3 * sizes[s] for s in over}


@pytest.mark.parametrize("seed", range(3))
def test_mix_meets_its_targets(docs, seed):
    rng = random.Random(seed)
    rows = [(i, "w " * rng.choice([0, 1, 7, 40, 200]), rng.choice(["a", "b", "B", "é", None, "c"])) for i in range(150)]
    rows += [(1000 + i, "w " * 30, "hot") for i in range(150)]
    planned = mix_curriculum.plan(materialize(mix_curriculum.sized(docs(rows)), "s")).collect()
    assert len(planned) == len(rows)
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in planned:
        sizes[r["__source"]] += r["size"]
        taken[r["__source"]] += r["taken"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    want = targets(sizes)
    for r in planned:
        assert r["target"] == pytest.approx(want[r["__source"]], rel=1e-12)
        assert r["source_size"] == sizes[r["__source"]]
    for s, n in taken.items():
        assert n == math.floor(want[s] + 1e-9) or abs(n - want[s]) < 1


def test_training_order_follows_the_schedules(docs):
    rows = [(i, "w " * 20, s) for i in range(400) for s in "abc"]
    planned = mix_curriculum.plan(materialize(mix_curriculum.sized(docs(rows)), "s"))
    order = mix_curriculum.training_order(materialize(planned, "p")).collect()
    at = [r["position"] for r in order]
    assert at == sorted(at) and 0 <= at[0] and at[-1] <= 1
    given, total = defaultdict(int), defaultdict(int)
    for r in order:
        total[r["__source"]] += r["words"]
        given[r["__source"]] += r["words"] * (r["position"] < 0.5)
    # By half of the run a fades out: (1.5 + 1.0) / 2 * 0.5 of its demand; c fades in.
    for s, share in (("a", 0.625), ("b", 0.5), ("c", 0.375)):
        assert given[s] / total[s] == pytest.approx(share, abs=0.02)


def test_mix_of_awkward_rows(spark, awkward, docs):
    out = mix_curriculum.plan(materialize(mix_curriculum.sized(awkward), "s"))
    assert out.count() == len(AWKWARD)
    mixed = mix_curriculum.mix_stage(spark, awkward, "")
    assert all(r["taken"] > 0 for r in mixed.collect())
    assert mix_curriculum.mix_stage(spark, docs([]), "").collect() == []


@pytest.mark.parametrize("knots", [(1.0, 1.0), (0.0, 2.0), (2.0, 0.0, 1.0), (1.5, 1.0, 0.5)])
def test_inverse_demand(spark, knots):
    def demand(t):
        n = len(knots) - 1
        total = 0.0
        for k, (a, b) in enumerate(zip(knots, knots[1:])):
            x = min(max(t * n - k, 0.0), 1.0)
            total += a * x + (b - a) * x * x / 2
        return total

    us = [i / 50 for i in range(51)]
    df = spark.createDataFrame([(u,) for u in us], "u double")
    for r in df.select("u", F.expr(mix_curriculum.inverse_demand("u", knots)).alias("t")).collect():
        assert demand(r["t"]) / demand(1.0) == pytest.approx(r["u"], abs=1e-9)


# --- decontamination --------------------------------------------------------------

BENCH = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def contaminated(docs_, items):
    wins = defaultdict(set)
    for i, t in items:
        w = BENCH.findall((t or "").translate(LOWER))
        for s in range(max(len(w) - 12, 1) if w else 0):
            wins[tuple(w[s : s + 13])].add("" if i is None else str(i))
    out = []
    for d, t in docs_:
        w = BENCH.findall((t or "").translate(LOWER))
        hit, names = set(), set()
        for n in {len(x) for x in wins}:
            for s in range(len(w) - n + 1):
                if found := wins.get(tuple(w[s : s + n])):
                    hit |= set(range(s, s + n))
                    names |= found
        sha = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((d, len(w), len(hit), len(names), sha, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", range(2))
def test_decontamination_equals_brute_force(spark, docs, seed):
    rng = random.Random(seed)
    text = lambda n: " ".join(rng.choice(["ab", "Cd", "é9", "x", "The", "of"]) for _ in range(n))
    items = [(i, text(rng.choice([1, 2, 3, 5, 13, 14, 30]))) for i in range(25)]
    items += [(90, items[0][1]), (None, items[1][1]), (91, None), (92, " . "), (93, "")]
    rows = [(i, text(rng.choice([0, 1, 3, 30])), "s") for i in range(30)]
    rows += [(100 + i, f"{text(9)}, {items[rng.randrange(25)][1]}! {text(200)}", "s") for i in range(15)]
    rows += [*AWKWARD, rows[3]]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.verdicts(docs(rows, clash=True), bench)
    want = contaminated([(d, t) for d, t, _ in rows], items)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want


def test_decontamination_by_shuffle_gives_the_same(spark, docs, monkeypatch):
    bench = spark.createDataFrame([(1, "one two three four five"), (2, "six")], "item_id long, text string")
    df = docs([(i, f"zero one two three four five six {i}", "s") for i in range(20)])
    first = sorted(map(str, decontaminate.verdicts(df, bench).collect()))
    monkeypatch.setattr("derrick.llm.common.BROADCAST_BYTES", -1)
    assert sorted(map(str, decontaminate.verdicts(df, bench).collect())) == first


def test_decontamination_of_empty_tables(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r["n_items"] for r in decontaminate.verdicts(docs(AWKWARD), none).collect()] == [0] * len(AWKWARD)
    some = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert decontaminate.verdicts(docs([]), some).collect() == []
