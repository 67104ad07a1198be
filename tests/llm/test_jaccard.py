"""The Jaccard join against all pairs, at every way a province can be joined."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from derrick.llm import jaccard_metric as jm
from derrick.llm.components import components
from llm_rows import AWKWARD


def shingles(text, n):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + n]) for i in range(max(len(w) - n + 1, 1))} if w else set()


def brute(rows, n, percent):
    sets = [shingles(t, n) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * len(a | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        ids = least.setdefault(find(i), [])
        if d is not None:
            ids.append(d)
    return sorted(
        ((d, len(sets[i]), min(least[find(i)]) if sets[i] and least[find(i)] else d) for i, (d, _) in enumerate(rows)),
        key=str,
    )


def near_copies(rng, n, words=60, change=2):
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randrange(change + 1)):
            copy[rng.randrange(words)] = f"v{rng.randrange(10**6)}"
        out.append(" ".join(copy))
    return out


def sample(seed):
    rng = random.Random(seed)
    texts = [t for _ in range(6) for t in near_copies(rng, rng.randrange(1, 6))]
    texts += near_copies(rng, 40, 90, 3) + near_copies(rng, 25, 200, 6)
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randrange(1, 30))) for _ in range(40)]
    texts += [" ".join(f"u{rng.randrange(10**6)}" for _ in range(50)) for _ in range(20)]
    texts += texts[:5]
    rng.shuffle(texts)
    return list(enumerate(texts)) + [(d, t) for d, t, _ in AWKWARD if d is None or d < 0]


def got(docs, rows, metric):
    df = docs([(d, t, "s") for d, t in rows], clash=True)
    out = jm.clusters(df, metric).select("doc_id", "n_shingles", "component_id").collect()
    return sorted((tuple(r) for r in out), key=str)


def test_stage_keeps_unrelated_texts_that_share_an_id(spark, docs):
    rng = random.Random(6)
    a, b, c = (" ".join(f"{x}{rng.randrange(10**6)}" for _ in range(80)) for x in "abc")
    near = b + " end"
    rows = [(5, a, "s"), (5, b, "s"), (9, near, "s"), (6, c, "s"), (6, c + " " + a, "s"), (6, c, "s")]
    kept = jm.near_duplicate_stage(spark, docs(rows), "").collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == sorted([(5, a), (5, b), (6, c), (6, c + " " + a)])


@pytest.mark.parametrize("metric", [jm.Metric(3, 90), jm.NEAR])
def test_components_equal_all_pairs(docs, metric):
    rows = sample(1)
    assert got(docs, rows, metric) == brute(rows, metric.n, metric.percent)


@pytest.mark.parametrize("limit,pivots", [(3_000, 4), (1_500, 2)])
def test_large_provinces_are_cut_and_blocked_exactly(docs, monkeypatch, limit, pivots):
    monkeypatch.setattr(jm, "TASK_SHINGLES", limit)
    monkeypatch.setattr(jm, "PIVOTS", pivots)
    rows = sample(2)
    assert got(docs, rows, jm.Metric(3, 90)) == brute(rows, 3, 90)


def test_awkward_rows_and_empty_table(spark, docs):
    rows = [(d, t) for d, t, _ in AWKWARD]
    assert got(docs, rows, jm.Metric(3, 90)) == brute(rows, 3, 90)
    assert got(docs, [], jm.Metric(3, 90)) == []


def test_stage_keeps_one_of_each_group(spark, docs, awkward):
    rng = random.Random(5)
    copies = near_copies(rng, 6, 80, 1)
    rows = [(i, t, "s") for i, t in enumerate(copies)] + [(50, "something else entirely here now", "s"), (50, "something else entirely here now", "s")]
    kept = jm.near_duplicate_stage(spark, docs(rows), "").collect()
    assert sorted(r["doc_id"] for r in kept) == [0, 50]
    out = jm.near_duplicate_stage(spark, awkward, "")
    assert out.columns == awkward.columns
    ids = [r["doc_id"] for r in out.collect()]
    assert {1, 2, 3, None} <= set(ids)  # nothing without words or id goes
    assert jm.near_duplicate_stage(spark, docs([]), "").collect() == []


@pytest.mark.parametrize("metric", [jm.Metric(3, 90), jm.NEAR, jm.Metric(2, 60)])
def test_linked_sets_agree_in_a_part(metric):
    rng = np.random.default_rng(3)
    for _ in range(300):
        n = int(rng.integers(1, 300))
        x = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        drop, add = int(rng.integers(0, n // 6 + 1)), int(rng.integers(0, n // 6 + 1))
        y = np.unique(np.concatenate([x[drop:], rng.integers(0, 2**63, add).astype(np.uint64)]))
        shared = len(np.intersect1d(x, y))
        if len(y) and metric.linked(shared, len(x), len(y)):
            assert set(jm.part_signatures(x, metric)) & set(jm.part_signatures(y, metric))


def test_sweep_equals_all_pairs():
    rng, metric = random.Random(9), jm.Metric(3, 90)
    arrays = [jm.shingle_set(t, jm._Words(), 3).view(np.int64) for t in near_copies(rng, 60, 70, 4)]
    label = jm.sweep(arrays, metric)
    sets = [set(a.tolist()) for a in arrays]
    for i in range(60):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j]):
                assert label[i] == label[j]


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, k) for k in range(200, 240)] + [(7, 7), (301, 300)]
    out = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(out[i] == 0 for i in range(61)) and all(out[k] == 100 for k in range(200, 240))
    assert (out[300], out[301]) == (300, 300) and 7 in out and len(out) == 61 + 41 + 2
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


@pytest.mark.parametrize("limit", [10**9, 40_000])
def test_crowded_cells_give_spanning_edges(spark, monkeypatch, limit):
    """Copies that differ more and more from a pivot: many pairs link, few edges come."""
    monkeypatch.setattr(jm, "TASK_SHINGLES", limit)
    rng, metric, n = np.random.default_rng(4), jm.Metric(3, 90), 500
    base = rng.integers(0, 2**62, 150)
    sets = [np.unique(np.concatenate([base[int(rng.integers(0, 12)):], rng.integers(0, 2**62, int(rng.integers(0, 12)))])) for _ in range(n)]
    rows = [(b"c", i.to_bytes(4, "big"), s.tolist()) for i, s in enumerate(sets)]
    cells = spark.createDataFrame(rows, "cell binary, cls binary, s array<long>").repartition(3)
    found = jm._in_blocks(cells, jm._weights(cells), metric)
    edges = [(int.from_bytes(a, "big"), int.from_bytes(b, "big")) for part in found for a, b in part.collect()]
    blocks = max(1, -(-sum(map(len, sets)) // (limit // 4)))
    assert len(edges) < n * (1 if blocks == 1 else blocks)
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        assert metric.linked(len(np.intersect1d(sets[a], sets[b])), len(sets[a]), len(sets[b]))
        root[find(a)] = find(b)
    plain = {(i, j) for i in range(n) for j in range(i) if 10 * len(np.intersect1d(sets[i], sets[j])) >= 9 * len(np.union1d(sets[i], sets[j]))}
    assert len(plain) > 20 * n and all(find(i) == find(j) for i, j in plain)


def test_sets_with_empty_parts_alone_in_common_are_no_province(spark):
    """Small parts are often empty, and all sets agree in the same empty part."""
    rng, metric = np.random.default_rng(8), jm.NEAR
    base = [rng.integers(0, 2**62, 60) for _ in range(80)]
    rows = [b[: 60 - 3 * k] for b in base for k in range(2)]
    full = [(i.to_bytes(2, "big"), len(s), sorted(s.tolist())) for i, s in enumerate(rows)]
    df = spark.createDataFrame(full, "cls binary, n long, s array<long>")
    found = {}
    for r in jm.provinces(df, metric).collect():
        found.setdefault(bytes(r["province"]), []).append(int.from_bytes(r["cls"], "big"))
    assert sorted(sorted(v) for v in found.values()) == [[2 * i, 2 * i + 1] for i in range(80)]


@pytest.mark.parametrize("metric", [jm.Metric(3, 90), jm.NEAR, jm.Metric(2, 60)])
def test_linked_sets_share_a_rare_shingle(spark, metric):
    rng = np.random.default_rng(12)
    pool = rng.integers(0, 2**62, 500)
    sets = [np.unique(rng.choice(pool, int(rng.integers(1, 80)))) for _ in range(30)]
    for x in list(sets):
        for _ in range(4):
            cut, add = (int(rng.integers(0, len(x) * (100 - metric.percent) // 100 + 2)) for _ in range(2))
            y = np.unique(np.concatenate([x[cut:], rng.choice(pool, add)]))
            sets += [y] if len(y) else []
    sets = [np.array(s) for s in sorted({tuple(s.tolist()) for s in sets})]
    rows = [(i.to_bytes(2, "big"), len(s), s.tolist()) for i, s in enumerate(sets)]
    df = spark.createDataFrame(rows, "cls binary, n long, s array<long>")
    names = {r["c"]: int.from_bytes(r["cls"], "big") for r in df.select("cls", F.xxhash64("cls").alias("c")).collect()}
    keys = {}
    for r in jm.rare_shingles(df, metric).collect():
        keys.setdefault(names[r["c"]], set()).add((r["s"], r["size"]))
    linked = 0
    for i, x in enumerate(sets):
        for j in range(i):
            if metric.linked(len(np.intersect1d(x, sets[j])), len(x), len(sets[j])):
                linked += 1
                assert keys.get(i, set()) & keys.get(j, set())
    assert linked > 50


def test_a_cut_returns_each_set_once(spark):
    """However many pivots are near a set, a task holds and returns it once."""
    rng, metric = np.random.default_rng(13), jm.NEAR
    rows = [(b"c", i.to_bytes(2, "big"), sorted(rng.integers(0, 2**62, 40).tolist())) for i in range(300)]
    cells = spark.createDataFrame(rows, "cell binary, cls binary, s array<long>")
    cut = jm._cut(cells, jm._weights(cells), metric)
    near = {bytes(r["cls"]): (len(r["near"]), r["s"]) for r in cut.collect()}
    assert cut.count() == 300 and {k: s for k, (_, s) in near.items()} == {c: s for _, c, s in rows}
    assert max(n for n, _ in near.values()) == jm.PIVOTS
    assert jm._spread(cut).count() == sum(n for n, _ in near.values())
