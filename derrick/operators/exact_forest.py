"""Regression forest with exact splits: no limit on depth, every cut of every feature.

A node is cut where the squared error of its two sides is smallest, at the middle
between two neighbouring values; among equal cuts the first feature and the lowest
value win. Trees grow until a node's targets are equal or its features are. Each tree
draws every training row as often as a Poisson variable of mean one says.

Equal rows are counted first, so a repeated row is one entry with a count. The draws
are hashes of the entry and the tree, the same for any partitioning.

Nodes of more than ``LOCAL`` entries are cut by Spark, all nodes of a level together:
entries are summed per distinct value, and the sums left of a cut come from block sums
(``BLOCKS`` quantile blocks a feature) and from a window inside the block, so no window
holds a node. Smaller nodes are grown whole, one group each. The upper nodes are few
(about entries x trees / LOCAL) and stay with the driver; the subtrees are a written
table, as a forest grown to the end has as many leaves as entries.

Edge cases: rows with a missing feature or target (null or NaN) train nothing, and a
row with a missing feature is predicted null; a training set without rows predicts null.
Targets are summed as decimals of nine places, so reruns agree.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from derrick.functions import valid
from derrick.sources.scratch import materialize

# Ship the helpers inside the task, so that workers need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LOCAL, BLOCKS = 200_000, 256
#: Tasks that grow small nodes, at least.
GROW_TASKS = 16
#: Nodes of a forest that is broadcast for prediction; a larger one meets the rows by shuffle.
BROADCAST_NODES = 1_000_000
#: Rows of one slice that meets a subtree there.
SLICE_ROWS = 200_000
#: Part of a gain below which two gains are equal.
TIE = 1e-9
_TREE = "feature array<int>, threshold array<double>, left array<int>, right array<int>, value array<double>"
_ENTRY = "tree int, node int, w long, y double, x array<double>"


@dataclass
class _Top:
    """The upper nodes of one tree; a node without a feature is the root of a subtree."""

    feature: list[int] = field(default_factory=lambda: [-1])
    threshold: list[float] = field(default_factory=lambda: [0.0])
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    depth: list[int] = field(default_factory=lambda: [0])

    def cut(self, node: int, feature: int, threshold: float) -> tuple[int, int]:
        below = len(self.feature), len(self.feature) + 1
        self.feature[node], self.threshold[node], (self.left[node], self.right[node]) = feature, threshold, below
        for _ in below:
            for column, blank in ((self.feature, -1), (self.threshold, 0.0), (self.left, -1), (self.right, -1)):
                column.append(blank)
            self.depth.append(self.depth[node] + 1)
        return below

    def arrays(self) -> tuple[np.ndarray, ...]:
        return np.array(self.feature), np.array(self.threshold), np.array(self.left), np.array(self.right)


@dataclass(frozen=True)
class ExactForest:
    """Upper nodes by tree, and the written subtrees (tree, node and the arrays of a tree)."""

    tops: list[tuple[np.ndarray, ...]]
    subtrees: DataFrame


def descend(x: np.ndarray, feature: np.ndarray, threshold: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The last node of each row of ``x``."""
    node = np.zeros(len(x), dtype=np.int64)
    at = np.arange(len(x))
    while len(at := at[feature[node[at]] >= 0]):
        here = node[at]
        goes = x[at, feature[here]] <= threshold[here]
        node[at] = np.where(goes, left[here], right[here])
    return node


def best_cut(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[int, float] | None:
    """(feature, threshold) of the cut with the smallest squared error; None without one."""
    y = y - np.average(y, weights=w)
    best, found = 0.0, None
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        v = x[order, f]
        cuts = np.flatnonzero(v[1:] > v[:-1])
        if len(cuts):
            lw, ls = np.cumsum(w[order]), np.cumsum((w * y)[order])
            left, rest = ls[cuts], ls[-1] - ls[cuts]
            gain = left * left / lw[cuts] + rest * rest / (lw[-1] - lw[cuts])
            near = TIE * max(1.0, float(gain.max()))  # sums of doubles: what is nearly equal is
            k = int(np.argmax(gain >= gain.max() - near))
            if found is None or gain[k] > best + near:
                best, found = gain[k], (f, middle(v[cuts[k]], v[cuts[k] + 1]))
    return found


def middle(a: float, b: float) -> float:
    """A value from ``a`` on and below ``b``."""
    half = a / 2 + b / 2
    return float(half) if a <= half < b else float(a)


def grow(x: np.ndarray, y: np.ndarray, w: np.ndarray, depth: float) -> dict[str, list]:
    """The whole tree of some entries, as arrays by node."""
    out: dict[str, list] = {c.split()[0]: [] for c in _TREE.split(", ")}
    stack = [(np.arange(len(y)), 0, None, "")]
    while stack:
        rows, level, parent, side = stack.pop()
        node = len(out["value"])
        if parent is not None:
            out[side][parent] = node
        here = y[rows]
        cut = None
        if level < depth and len(rows) > 1 and here.min() < here.max():
            cut = best_cut(x[rows], here, w[rows])
        f, threshold = cut or (-1, 0.0)
        value = float(here[0]) if here.min() == here.max() else float(np.average(here, weights=w[rows]))
        for name, v in (("feature", f), ("threshold", threshold), ("left", -1), ("right", -1), ("value", value)):
            out[name].append(v)
        if cut:
            goes = x[rows, f] <= threshold
            stack.append((rows[~goes], level + 1, node, "right"))
            stack.append((rows[goes], level + 1, node, "left"))
    return out


def poisson(mean: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Poisson variables of the given means, by inversion of the uniform ``u``."""
    out = np.zeros(u.shape, dtype=np.int64)
    low = np.broadcast_to(mean <= 100, u.shape)
    p = np.where(low, np.exp(-np.minimum(mean, 100)), 0.0) * np.ones(u.shape)
    total, k = p.copy(), 0
    while (more := low & (u > total) & (k < 400)).any():
        k += 1
        p = p * mean / k
        total += p
        out[more] += 1
    high = ~low
    if high.any():  # many copies: the normal variable with that mean and variance
        m = np.broadcast_to(mean, u.shape)[high]
        a = np.clip(u[high], 1e-15, 1 - 1e-15)
        z = 4.91 * (a**0.14 - (1 - a) ** 0.14)  # Tukey's lambda form of the normal quantile
        out[high] = np.maximum(np.rint(m + np.sqrt(m) * z), 0).astype(np.int64)
    return out


def _mixed(h: np.ndarray) -> np.ndarray:
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return h ^ (h >> np.uint64(31))


def entries(train: DataFrame, features: Sequence[str], target: str, trees: int, seed: int) -> DataFrame:
    """What each tree draws: (tree, node, w, y, x), the node being the root."""
    x = F.array(*(valid(c) + 0.0 for c in features))
    rows = train.select(x.alias("x"), (valid(target) + 0.0).alias("y")).filter("y IS NOT NULL AND NOT exists(x, v -> v IS NULL)")
    counted = rows.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n")).withColumn("h", F.xxhash64("x", "y"))
    numbers = np.arange(trees, dtype=np.uint64) + np.uint64(seed) * np.uint64(1_000_003)

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            h = rows["h"].to_numpy(np.int64).view(np.uint64)[:, None] + _mixed(numbers * np.uint64(0x9E3779B97F4A7C15))[None, :]
            u = (_mixed(h) >> np.uint64(11)).astype(np.float64) / 2.0**53
            w = poisson(rows["n"].to_numpy(np.float64)[:, None], u)
            at, tree = np.nonzero(w)
            yield pd.DataFrame({"tree": tree.astype(np.int32), "node": np.int32(0), "w": w[at, tree],
                                "y": rows["y"].to_numpy()[at], "x": rows["x"].to_numpy()[at]})

    return counted.mapInPandas(draw, _ENTRY)


def _exact(value: Column) -> Column:
    return value.cast("decimal(28,9)")


def large_cuts(rows: DataFrame, large: DataFrame, blocks: Sequence[Sequence[float]]) -> DataFrame:
    """The best cut (tree, node, f, a, b) of each of the ``large`` nodes, between the
    neighbouring values a and b of feature f."""
    here = rows.join(F.broadcast(large), ["tree", "node"])
    spread = here.select("tree", "node", F.posexplode("x").alias("f", "v"), "w", (_exact(F.col("y")) * F.col("w").cast("decimal(10,0)")).alias("wy"))
    values = spread.groupBy("tree", "node", "f", "v").agg(F.sum("w").alias("w"), F.sum("wy").alias("wy"))
    edges = F.array(*(F.array(*map(F.lit, cuts)) for cuts in blocks))
    block = F.size(F.filter(F.get(edges, F.col("f")), lambda e: e < F.col("v")))
    values = materialize(values.withColumn("block", block), "forest-values")
    key = ["tree", "node", "f"]
    before = Window.partitionBy(*key).orderBy("block")
    past = before.rowsBetween(Window.unboundedPreceding, -1)
    summed = values.groupBy(*key, "block").agg(F.sum("w").alias("bw"), F.sum("wy").alias("bs"), F.min("v").alias("first"))
    summed = summed.select(
        *key, "block", F.coalesce(F.sum("bw").over(past), F.lit(0)).alias("base_w"), F.coalesce(F.sum("bs").over(past), F.lit(0)).alias("base_s"),
        F.lead("first").over(before).alias("after"),
        F.sum("bw").over(Window.partitionBy(*key)).alias("all_w"), F.sum("bs").over(Window.partitionBy(*key)).alias("all_s"),
    )
    inside = Window.partitionBy(*key, "block").orderBy("v")
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    cuts = values.join(summed, [*key, "block"]).select(
        *key, F.col("v").alias("a"), F.coalesce(F.lead("v").over(inside), "after").alias("b"), "all_w", "all_s",
        (F.col("base_w") + F.sum("w").over(upto)).alias("lw"), (F.col("base_s") + F.sum("wy").over(upto)).alias("ls"),
    ).filter("b IS NOT NULL")
    # Both sides' squared sums over weights, about the node's mean, as in the small nodes.
    mean = F.col("all_s").cast("double") / F.col("all_w")
    left = F.col("ls").cast("double") - mean * F.col("lw")
    gain = left * left / F.col("lw") + left * left / (F.col("all_w") - F.col("lw"))
    best = F.max(F.struct(F.round(gain, 9).alias("gain"), (-F.col("f")).alias("f"), (-F.col("a")).alias("a"), "b"))
    return cuts.groupBy("tree", "node").agg(best.alias("best")).select(
        "tree", "node", (-F.col("best.f")).alias("f"), (-F.col("best.a")).alias("a"), "best.b"
    )


def fit_exact_forest(
    train: DataFrame, features: Sequence[str], target: str, trees: int = 100, depth: int | None = None, seed: int = 42,
    rows: DataFrame | None = None, local: int | None = None,
) -> ExactForest:
    """Grow the forest; ``depth`` None is no limit. ``rows`` may give the draws (from ``entries``)."""
    local = LOCAL if local is None else local
    limit = float("inf") if depth is None else depth
    rows = materialize(entries(train, features, target, trees, seed) if rows is None else rows, "forest-rows")
    spark = rows.sparkSession
    tops = [_Top() for _ in range(trees)]
    share = [i / BLOCKS for i in range(1, BLOCKS)]
    blocks: list[list[float]] | None = None
    solid: set[tuple[int, int]] = set()  # large nodes that cannot be cut
    while True:
        found = rows.groupBy("tree", "node").agg(F.count(F.lit(1)).alias("n"), F.min("y").alias("low"), F.max("y").alias("high"))
        found = found.filter(F.col("n") > local).collect()
        solid |= {(r["tree"], r["node"]) for r in found if r["low"] == r["high"] or tops[r["tree"]].depth[r["node"]] >= limit}
        large = [(r["tree"], r["node"]) for r in found if (r["tree"], r["node"]) not in solid]
        if not large:
            break
        if blocks is None:  # where to part the values; any places give the same cuts
            places = rows.agg(*(F.percentile_approx(F.get("x", F.lit(i)), share, 10 * BLOCKS).alias(f"q{i}") for i in range(len(features)))).first()
            blocks = [sorted(set(q)) for q in places]
        cuts = large_cuts(rows, spark.createDataFrame(large, "tree int, node int"), blocks).collect()
        solid |= set(large) - {(c["tree"], c["node"]) for c in cuts}
        moves = []
        for c in sorted(cuts, key=lambda c: (c["tree"], c["node"])):
            threshold = middle(c["a"], c["b"])
            moves.append((c["tree"], c["node"], c["f"], threshold, *tops[c["tree"]].cut(c["node"], c["f"], threshold)))
        if moves:
            moved = spark.createDataFrame(moves, "tree int, node int, f int, threshold double, l int, r int")
            side = F.when(F.get("x", F.col("f")) <= F.col("threshold"), F.col("l")).otherwise(F.col("r"))
            rows = materialize(rows.join(F.broadcast(moved), ["tree", "node"], "left").select(
                "tree", F.when(F.col("f").isNull(), F.col("node")).otherwise(side).alias("node"), "w", "y", "x"
            ), "forest-rows")
    depths = {(t, n): d for t, top in enumerate(tops) for n, d in enumerate(top.depth)}

    def subtree(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        x, y, w = np.array(part["x"].tolist(), dtype=float), part["y"].to_numpy(float), part["w"].to_numpy(float)
        order = np.lexsort((y, *x.T[::-1]))
        made = grow(x[order], y[order], w[order], limit - depths[key])
        return pd.DataFrame({"tree": [key[0]], "node": [key[1]], **{k: [v] for k, v in made.items()}})

    schema = f"tree int, node int, {_TREE}"
    whole = spark.createDataFrame(sorted(solid), "tree int, node int")
    # A given number of tasks: growing takes longer than the size of its rows tells.
    tasks = max(GROW_TASKS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.join(F.broadcast(whole), ["tree", "node"], "left_anti").repartition(tasks, "tree", "node")
    grown = dealt.groupBy("tree", "node").applyInPandas(subtree, schema)
    if solid:  # one leaf each, whatever they hold
        mean = F.sum(_exact(F.col("y")) * F.col("w").cast("decimal(10,0)")).cast("double") / F.sum("w")
        leaves = rows.join(F.broadcast(whole), ["tree", "node"]).groupBy("tree", "node").agg(mean.alias("mean"))
        blank, none = F.array(F.lit(-1)), F.array(F.lit(0.0))
        grown = grown.unionByName(leaves.select(
            "tree", "node", blank.alias("feature"), none.alias("threshold"), blank.alias("left"), blank.alias("right"), F.array("mean").alias("value")
        ))
    return ExactForest([t.arrays() for t in tops], materialize(grown, "forest"))


def _walk(x: np.ndarray, tree: Sequence) -> np.ndarray:
    feature, threshold, left, right, value = (np.asarray(a) for a in tree)
    return value[descend(x, feature, threshold, left, right)]


def predict_exact(model: ExactForest, df: DataFrame, features: Sequence[str], output: str = "predicted",
                  broadcast_nodes: int | None = None) -> DataFrame:
    """``df`` with the mean of the trees' leaves."""
    size = model.subtrees.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("value")).alias("nodes")).first()
    if not size["n"]:
        return df.withColumn(output, F.lit(None).cast("double"))
    if size["nodes"] <= (BROADCAST_NODES if broadcast_nodes is None else broadcast_nodes):
        return _predict_broadcast(model, df, features, output)
    return _predict_shuffled(model, df, features, output)


def _vector(features: Sequence[str]) -> Column:
    x = F.array(*(valid(c) for c in features))
    return F.when(~F.exists(x, lambda v: v.isNull()), x)


def _predict_broadcast(model: ExactForest, df: DataFrame, features: Sequence[str], output: str) -> DataFrame:
    trees: dict[int, dict[int, tuple]] = {}
    for r in model.subtrees.collect():
        trees.setdefault(r["tree"], {})[r["node"]] = (r["feature"], r["threshold"], r["left"], r["right"], r["value"])
    parts = sorted(trees.items())
    shared = df.sparkSession.sparkContext.broadcast(([model.tops[t] for t, _ in parts], [p for _, p in parts]))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tops, below = shared.value
        for rows in batches:
            total = np.full(len(rows), np.nan)
            full = np.flatnonzero(rows.notna())
            if len(full):
                x = np.array(rows.iloc[full].tolist(), dtype=float)
                total[full] = 0.0
                for top, subtrees in zip(tops, below):
                    node = descend(x, *top)
                    for n in np.unique(node):
                        mine = np.flatnonzero(node == n)
                        total[full[mine]] += _walk(x[mine], subtrees[n])
            yield pd.Series(total / len(tops))

    return df.withColumn(output, valid(score(_vector(features))))


def _predict_shuffled(model: ExactForest, df: DataFrame, features: Sequence[str], output: str) -> DataFrame:
    staged = materialize(df.select(F.struct(*(df[f"`{c}`"] for c in df.columns)).alias("row"), _vector(features).alias("x"),
                                   F.monotonically_increasing_id().alias("id")), "forest-asked")
    slices = max(1, -(-staged.count() // SLICE_ROWS))
    tops = staged.sparkSession.sparkContext.broadcast(model.tops)

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            if len(rows):
                x = np.array(rows["x"].tolist(), dtype=float)
                for t, top in enumerate(tops.value):
                    yield rows.assign(tree=np.int32(t), node=descend(x, *top).astype(np.int32), slice=rows["id"] % slices)

    def leaves(rows: pd.DataFrame, tree: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(tree):
            return pd.DataFrame({"id": [], "tree": [], "value": []})
        t = tree.iloc[0]
        value = _walk(np.array(rows["x"].tolist(), dtype=float), (t["feature"], t["threshold"], t["left"], t["right"], t["value"]))
        return pd.DataFrame({"id": rows["id"].to_numpy(), "tree": rows["tree"].to_numpy(), "value": value})

    asked = staged.filter("x IS NOT NULL").select("id", "x").mapInPandas(route, "id long, x array<double>, tree int, node int, slice long")
    spread = model.subtrees.withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long"))))
    keys = ("tree", "node", "slice")
    found = asked.groupBy(*keys).cogroup(spread.groupBy(*keys)).applyInPandas(leaves, "id long, tree int, value double")
    # In the order of the trees, as sums of doubles depend on it.
    listed = found.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("tree", "value"))).alias("all"))
    mean = F.aggregate("all", F.lit(0.0), lambda s, v: s + v["value"]) / F.size("all")
    met = staged.join(listed.select("id", mean.alias("mean")), "id", "left")
    return met.select("row.*", F.col("mean").alias(output))
