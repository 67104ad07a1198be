"""Connected components of a written edge table, by alternating stars.

Each round hangs every node's larger neighbours on its smallest one, then its smaller
ones; edges of a settled graph are stars around the smallest node, and nothing moves
any more. Rounds grow with the logarithm of the graph, not with its diameter; each is
written, so a lost executor repeats one round at most. No node's neighbours are
gathered: minima are aggregated with map-side combine and joined back, and adaptive
execution splits a hot node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from derrick.sources.scratch import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in ``edges`` (``a``, ``b``, any orderable type); the
    root is the smallest node that can be reached."""
    stars = _clean(edges)
    while True:
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = materialize(_clean(large), "large-star")
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a")
        hung = small.select(F.col("b").alias("a"), F.col("low").alias("b")).filter("a <> b")
        kept = low.select("a", F.col("low").alias("b"))
        after = materialize(_clean(hung.unionByName(kept)), "small-star")
        moved = after.join(large, ["a", "b"], "left_anti").isEmpty() and large.join(after, ["a", "b"], "left_anti").isEmpty()
        settled = moved and after.select("a").intersect(after.select("b")).isEmpty()
        stars = after
        if settled:
            roots = stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            return roots.unionByName(stars.select(F.col("a").alias("node"), F.col("b").alias("root")))


def _clean(edges: DataFrame) -> DataFrame:
    """Distinct edges from the larger to the smaller node."""
    return edges.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).distinct()
