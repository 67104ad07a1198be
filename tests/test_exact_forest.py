"""The exact forest against a plain learner that tries every cut."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from derrick.operators import exact_forest as ef

DIMS = ["a", "b", "c"]


def brute(x, y, w, depth=10**9):
    """A tree as nested tuples, by trying every cut of every feature."""
    if depth == 0 or len(set(y)) == 1:
        return float(np.average(y, weights=w))
    best = None
    for f in range(x.shape[1]):
        values = sorted(set(x[:, f]))
        for low, high in zip(values, values[1:]):
            goes = x[:, f] <= low
            error = 0.0
            for side in (goes, ~goes):
                mean = np.average(y[side], weights=w[side])
                error += float((w[side] * (y[side] - mean) ** 2).sum())
            if best is None or error < best[0] - 1e-9:
                best = (error, f, ef.middle(low, high))
    if best is None:
        return float(np.average(y, weights=w))
    _, f, cut = best
    goes = x[:, f] <= cut
    return f, cut, brute(x[goes], y[goes], w[goes], depth - 1), brute(x[~goes], y[~goes], w[~goes], depth - 1)


def nested(t, node=0):
    if t["feature"][node] < 0:
        return t["value"][node]
    return t["feature"][node], t["threshold"][node], nested(t, t["left"][node]), nested(t, t["right"][node])


def close(p, q):
    if isinstance(p, tuple) != isinstance(q, tuple):
        return False
    if not isinstance(p, tuple):
        return abs(p - q) < 1e-9
    return p[:2] == q[:2] and close(p[2], q[2]) and close(p[3], q[3])


def ask(tree, row):
    while isinstance(tree, tuple):
        f, cut, low, high = tree
        tree = low if row[f] <= cut else high
    return tree


def made(seed, n=90, kinds=40):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.integers(0, kinds, n), rng.integers(0, 5, n), rng.normal(size=n).round(3)]).astype(float)
    y = (x[:, 0] * 7 % 11 + x[:, 1] * rng.integers(0, 3, n)).round(2)
    return x, y


@pytest.mark.parametrize("depth", [float("inf"), 3])
def test_trees_equal_a_plain_learner(depth):
    for seed in range(6):
        x, y = made(seed)
        w = np.random.default_rng(seed).integers(1, 4, len(y)).astype(float)
        assert close(nested(ef.grow(x, y, w, depth)), brute(x, y, w, min(depth, 10**9)))


def frame(spark, x, y):
    return spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)], "a double, b double, c double, y double")


def test_large_nodes_are_cut_like_small_ones(spark, monkeypatch):
    """With a tiny limit Spark cuts the upper nodes; the predictions are the plain trees'."""
    monkeypatch.setattr(ef, "BLOCKS", 8)
    x, y = made(7, 120)
    df = frame(spark, x, y)
    rows = ef.materialize(ef.entries(df, DIMS, "y", 3, 42), "drawn")
    plain = []
    for t in range(3):
        part = [(r["x"], r["y"], r["w"]) for r in rows.filter(F.col("tree") == t).collect()]
        part.sort()
        plain.append(brute(np.array([p[0] for p in part]), np.array([p[1] for p in part]), np.array([p[2] for p in part], dtype=float)))
    want = sorted(round(float(np.mean([ask(t, r) for t in plain])), 9) for r in x)
    for local in (25, 10**6):
        model = ef.fit_exact_forest(df, DIMS, "y", trees=3, rows=rows, local=local)
        assert (max(len(t[0]) for t in model.tops) > 1) == (local == 25)
        for nodes in (10**6, 0):  # broadcast, and by shuffle
            monkeypatch.setattr(ef, "SLICE_ROWS", 50)
            out = ef.predict_exact(model, df, DIMS, broadcast_nodes=nodes)
            assert out.columns == [*df.columns, "predicted"]
            assert sorted(round(r["predicted"], 9) for r in out.collect()) == pytest.approx(want, abs=1e-8)


def test_deep_trees_have_no_limit(spark):
    """A target that alternates at 150 values needs all cuts, and more than 30 levels."""
    y = [float(i % 2 * (i + 1)) for i in range(150)]
    df = spark.createDataFrame([(float(i), 0.0, 0.0, t) for i, t in enumerate(y) for _ in range(30)], "a double, b double, c double, y double")
    model = ef.fit_exact_forest(df, DIMS, "y", trees=3)
    out = ef.predict_exact(model, df, DIMS).filter("abs(predicted - y) > 1e-9")
    assert out.count() == 0
    assert all(r["n"] >= 2 * 150 - 1 for r in model.subtrees.select(F.size("value").alias("n")).collect())


def test_missing_values_and_no_rows(spark):
    rows = [(1.0, 2.0, 3.0, 5.0), (None, 2.0, 3.0, 9.0), (1.0, float("nan"), 3.0, 9.0), (2.0, 2.0, 3.0, None), (4.0, 2.0, 3.0, 7.0)] * 9
    df = spark.createDataFrame(rows, "a double, b double, c double, y double")
    model = ef.fit_exact_forest(df, DIMS, "y", trees=5)
    got = {(r["a"], r["y"]): r["predicted"] for r in ef.predict_exact(model, df, DIMS).collect() if r["b"] == 2.0}
    assert got[(1.0, 5.0)] == 5.0 and got[(4.0, 7.0)] == 7.0 and got[(None, 9.0)] is None and got[(2.0, None)] in (5.0, 7.0)
    empty = ef.fit_exact_forest(df.limit(0), DIMS, "y", trees=2)
    assert {r["predicted"] for r in ef.predict_exact(empty, df, DIMS).collect()} == {None}


def test_draws_have_mean_one_and_do_not_depend_on_partitions(spark):
    df = spark.range(4_000).select(F.col("id").cast("double").alias("a"), F.lit(0.0).alias("b"), F.lit(0.0).alias("c"), F.lit(1.0).alias("y"))
    one, two = (sorted((r["tree"], r["x"][0], r["w"]) for r in ef.entries(df.repartition(p), DIMS, "y", 4, 42).collect()) for p in (2, 7))
    assert one == two
    per = [sum(w for t, _, w in one if t == k) / 4_000 for k in range(4)]
    assert all(abs(m - 1) < 0.06 for m in per)
    means = np.array([1.0, 30.0, 90.0, 150.0, 5_000.0])[:, None]
    drawn = ef.poisson(means, np.random.default_rng(1).random((5, 20_000)))
    assert np.allclose(drawn.mean(axis=1), means[:, 0], rtol=0.03) and np.allclose(drawn.var(axis=1), means[:, 0], rtol=0.06)
