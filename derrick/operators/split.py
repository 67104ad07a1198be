"""Repeatable train/test splits of exact size.

A row is test if the hash of its key is among the smallest. The limit is an exact
order statistic of the hash, found by aggregates, so no row is moved or sorted
and a class that holds most rows is no special case. Where rows share the key at
the limit, a hash of the whole row decides, so the size is exact with any keys.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from derrick.functions import split_hash
from derrick.operators.quantile import places


def class_quotas(counts: dict[object, int], fraction: float) -> dict[object, int]:
    """Test rows per class: proportional, summing to ceil(fraction * rows).

    Whole parts first; what is left goes to the largest remainders.
    """
    total = sum(counts.values())
    wanted = math.ceil(fraction * total)
    exact = {c: wanted * n / total for c, n in counts.items()}
    quotas = {c: math.floor(x) for c, x in exact.items()}
    left = wanted - sum(quotas.values())
    for c in sorted(exact, key=lambda c: (quotas[c] - exact[c], str(c)))[:left]:
        quotas[c] += 1
    return quotas


def _marked(
    df: DataFrame, group: Column, quotas: dict[object, int], hashed: Column, output: str
) -> DataFrame:
    """Mark per group the rows with the smallest hashes, exactly as many as asked. Rows
    that share the hash at the limit are told apart by a hash of the whole row, and
    rows that share that too, which are equal, by their place."""
    columns = [F.col(c) for c in df.columns]
    ranks = {
        "_h0": hashed.cast("double"),
        "_h1": (F.pmod(F.xxhash64(*columns), F.lit(1 << 52))).cast("double"),
        "_h2": F.monotonically_increasing_id().cast("double"),
    }
    staged = df.withColumns({"_group": group, **ranks})
    open_ = {i: (g, k) for i, (g, k) in enumerate(quotas.items()) if k > 0}
    inside = {i: F.col("_group").eqNullSafe(F.lit(g)) for i, (g, _) in open_.items()}
    is_test = F.lit(False)
    for level in ranks:
        if not open_:
            break
        h = F.col(level)
        asked = staged.select(*(F.when(inside[i], h).alias(f"_r{i}") for i in open_))
        found = places(asked, asked.columns, lambda c, rows: [open_[int(c[2:])][1] - 1]).at
        after = {}
        for i, (g, k) in open_.items():
            limit = found[f"_r{i}"][k - 1]
            if k == limit.below + limit.equal:
                is_test |= inside[i] & (h <= F.lit(limit.value))
            else:
                is_test |= inside[i] & (h < F.lit(limit.value))
                inside[i] = inside[i] & (h == F.lit(limit.value))
                after[i] = (g, k - limit.below)
        open_ = after
    return staged.withColumn(output, F.coalesce(is_test, F.lit(False))).drop("_group", *ranks)


def random_split(
    df: DataFrame,
    keys: Sequence[str],
    fraction: float = 0.2,
    seed: int = 42,
    hashed: Column | None = None,
    output: str = "is_test",
) -> DataFrame:
    """Mark ceil(fraction * rows) rows as test."""
    rows = df.count()
    quotas = {0: math.ceil(fraction * rows)} if rows else {}
    hashed = split_hash(keys, seed) if hashed is None else hashed
    return _marked(df, F.lit(0), quotas, hashed, output)


def stratified_split(
    df: DataFrame,
    keys: Sequence[str],
    label: str,
    fraction: float = 0.25,
    seed: int = 42,
    hashed: Column | None = None,
    output: str = "is_test",
    max_classes: int = 10_000,
) -> DataFrame:
    """As :func:`random_split`, with each class in proportion. One count per class
    reaches the driver; more than ``max_classes`` are an error, as a key given for a
    label would be."""
    lines = df.groupBy(label).count().limit(max_classes + 1).collect()
    if len(lines) > max_classes:
        raise ValueError(f"{label} has more than {max_classes} classes")
    quotas = class_quotas({r[label]: r["count"] for r in lines}, fraction) if lines else {}
    hashed = split_hash(keys, seed) if hashed is None else hashed
    return _marked(df, F.col(label), quotas, hashed, output)
