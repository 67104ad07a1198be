"""Isolation forest (Liu, Ting and Zhou, 2008) as Spark jobs.

Each tree sees at most ``SAMPLE`` rows, chosen by a hash of the row key, so the
forest does not depend on the partitioning. Trees are grown one group per tree;
the finished forest has at most trees x 511 nodes, a constant size, and is
broadcast for vectorised scoring of all rows.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from derrick.functions import fraction_hash, split_hash, valid
from derrick.operators.quantile import exact_quantiles
from derrick.sources.scratch import materialize

# Ship the helpers inside the task, so that workers need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SAMPLE = 256
DEPTH = 8  # ceil(log2(SAMPLE))
#: Tasks that grow the trees, at most.
TREE_TASKS = 16
_EULER = 0.5772156649015329
_TREE_DDL = "tree int, feature array<int>, threshold array<double>, path array<double>"


@dataclass(frozen=True)
class Forest:
    """Complete binary trees of fixed depth: children of node i are 2i+1, 2i+2.

    A leaf above the last level fills its subtree with thresholds no value
    exceeds, so every row walks exactly ``DEPTH`` steps.
    """

    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray  # trees x inner nodes
    path: np.ndarray  # trees x last-level leaves
    normal_path: float


def mean_path(n: float) -> float:
    """Expected depth of an unsuccessful search among n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + _EULER) - 2.0 * (n - 1.0) / n


def grow_tree(points: np.ndarray, rng: np.random.Generator) -> tuple[list, list, list]:
    """Random axis cuts down to single points or the depth limit."""
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    feature = np.zeros(inner, dtype=np.int64)
    threshold = np.full(inner, np.inf)
    path = np.zeros(leaves)
    stack = [(0, 0, points)]
    while stack:
        node, depth, rows = stack.pop()
        low, high = rows.min(axis=0), rows.max(axis=0)
        usable = np.flatnonzero(high > low)
        if depth < DEPTH and len(rows) > 1 and len(usable):
            f = int(rng.choice(usable))
            cut = rng.uniform(low[f], high[f])
            left = rows[:, f] <= cut
            if left.all():  # the cut fell on the upper end
                left = rows[:, f] < high[f]
                cut = rows[left, f].max()
            feature[node], threshold[node] = f, cut
            stack.append((2 * node + 1, depth + 1, rows[left]))
            stack.append((2 * node + 2, depth + 1, rows[~left]))
        else:
            span = 2 ** (DEPTH - depth)
            first = (node + 1) * span - 1 - inner
            path[first : first + span] = depth + mean_path(len(rows))
    return feature.tolist(), threshold.tolist(), path.tolist()


def anomaly_scores(
    points: np.ndarray,
    features: np.ndarray,
    thresholds: np.ndarray,
    paths: np.ndarray,
    normal_path: float,
) -> np.ndarray:
    """Negative anomaly score per row: near -1 is isolated, near 0 is ordinary."""
    n, width = points.shape
    flat = np.ascontiguousarray(points).ravel()
    base = np.arange(n) * width
    total = np.zeros(n)
    inner = 2**DEPTH - 1
    for feature, threshold, path in zip(features, thresholds, paths):
        node = np.zeros(n, dtype=np.int64)
        for _ in range(DEPTH):
            right = flat.take(base + feature.take(node)) > threshold.take(node)
            node = 2 * node + 1 + right
        total += path.take(node - inner)
    return -np.exp2(-(total / len(features)) / normal_path)


def tree_samples(
    df: DataFrame, features: Sequence[str], keys: Sequence[str], rows: int, trees: int, seed: int
) -> DataFrame:
    """(tree, place, times, features): a little more than ``SAMPLE`` rows per tree.

    Every tree draws every row with one probability. As a draw is rare in a large table,
    one hash serves a stratum of trees: it names the tree of the stratum that draws the
    row, if any. A stratum has as many trees as the probability allows, so a large table
    takes one hash per row and no copies, a small one several, by the same rule. Rows
    that share a key are one draw that counts as often as they occur.
    """
    share = min(1.0, (SAMPLE + 8 * math.sqrt(SAMPLE)) / max(rows, 1))
    width = min(trees, math.floor(1 / share))
    strata = F.sequence(F.lit(0), F.lit(-(-trees // width) - 1))
    values = [valid(c).alias(c) for c in features]
    spread = df.select(*keys, *values, F.explode(strata).alias("stratum"))
    within = F.floor(fraction_hash(keys, seed, F.col("stratum")) / share).cast("int")
    tree = F.col("stratum") * width + within
    drawn = spread.select(
        tree.alias("tree"), within.alias("within"), *keys, *features
    ).filter((F.col("within") < width) & (F.col("tree") < trees))
    placed = drawn.withColumn("place", split_hash(keys, seed + 1, F.col("tree")))
    firsts = [F.min(c).alias(c) for c in features]
    return placed.groupBy("tree", "place").agg(F.count(F.lit(1)).alias("times"), *firsts)


def fit_forest(
    df: DataFrame,
    features: Sequence[str],
    keys: Sequence[str],
    trees: int = 200,
    seed: int = 42,
    rows: int | None = None,
) -> Forest:
    """Grow the forest from the rows that have all measures; ``keys`` identify a row."""
    df = df.filter(complete(features))
    rows = df.count() if rows is None else rows
    columns = list(features)

    def build(group: pd.DataFrame) -> pd.DataFrame:
        tree = int(group["tree"].iloc[0])
        sample = group.sort_values("place").head(SAMPLE)
        sample = sample.loc[sample.index.repeat(sample["times"].clip(upper=SAMPLE))].head(SAMPLE)
        rng = np.random.default_rng([seed, tree])
        points = sample[columns].to_numpy(dtype=float)
        feature, threshold, path = grow_tree(points, rng)
        return pd.DataFrame(
            {"tree": [tree], "feature": [feature], "threshold": [threshold], "path": [path]}
        )

    grown = (
        tree_samples(df, columns, keys, rows, trees, seed)
        # A fixed number of tasks: samples are too small for adaptive execution to part.
        .repartition(min(trees, TREE_TASKS), "tree")
        .groupBy("tree")
        .applyInPandas(build, _TREE_DDL)
        .collect()
    )
    grown.sort(key=lambda r: r["tree"])
    return Forest(
        np.array([r["feature"] for r in grown], dtype=np.int64),
        np.array([r["threshold"] for r in grown]),
        np.array([r["path"] for r in grown]),
        mean_path(min(SAMPLE, rows)) or 1.0,
    )


def complete(features: Sequence[str]) -> Column:
    """True where no measure is missing."""
    return reduce(Column.__and__, (valid(c).isNotNull() for c in features))


def score_column(df: DataFrame, features: Sequence[str], forest: Forest) -> Column:
    """Score expression; only the feature columns travel to Python."""
    # Plain arrays: a broadcast value is unpickled before any code is shipped.
    shared = df.sparkSession.sparkContext.broadcast(
        (forest.feature, forest.threshold, forest.path, forest.normal_path)
    )

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        model = shared.value
        for batch in batches:
            points = batch.to_numpy(dtype=float)
            scores = anomaly_scores(np.nan_to_num(points), *model)
            yield pd.Series(np.where(np.isnan(points).any(axis=1), np.nan, scores))

    return score(F.struct(*(valid(c).alias(c) for c in features)))


def isolation_scores(
    df: DataFrame,
    features: Sequence[str],
    keys: Sequence[str],
    trees: int = 200,
    contamination: float = 0.05,
    seed: int = 42,
    flag_column: str = "is_isolation_anomaly",
    score_column_name: str = "isolation_score",
) -> DataFrame:
    """Flag the ``contamination`` share of rows that are easiest to isolate.

    ``isolation_score`` is the offset minus the row's score, positive for
    flagged rows. A row without all measures has no score and no flag, and grows no
    tree. Scores are written once, then read for the exact threshold and for the result.
    """
    rows = df.filter(complete(features)).count()
    if not rows:
        return df.withColumns(
            {
                score_column_name: F.lit(None).cast("double"),
                flag_column: F.lit(False),
            }
        )
    forest = fit_forest(df, features, keys, trees, seed, rows)
    scored = materialize(df.withColumn("_score", valid(score_column(df, features, forest))), "isolation")
    offset = exact_quantiles(scored, ["_score"], [contamination])["_score"][0]
    return scored.select(
        *df.columns,
        (F.lit(offset) - F.col("_score")).alias(score_column_name),
        F.coalesce(F.col("_score") < F.lit(offset), F.lit(False)).alias(flag_column),
    )
