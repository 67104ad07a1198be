"""Global scores. Whole-table statistics are one row, combined on the map side and
put back as literals: no join, no window over the whole table, and every further
pass stays a plain projection. A costly input should be materialised first."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from derrick.functions import clamp, row_max_abs, valid


def whole_table(df: DataFrame, aggregates: Mapping[str, Column]) -> Row:
    """One row of aggregates over all rows of ``df``."""
    return df.agg(*(a.alias(n) for n, a in aggregates.items())).first()


def _ratio(x: Column, by: float | None) -> Column:
    """Null where there is nothing, or zero, to divide by."""
    return x / F.lit(by) if by else F.lit(None).cast("double")


def zscore(df: DataFrame, columns: Sequence[str], suffix: str = "_zscore") -> DataFrame:
    """Distance from the mean in population standard deviations, over all rows.

    A constant column is divided by one, so its score is zero.
    """
    stats = whole_table(
        df,
        {f"mean_{c}": F.avg(valid(c)) for c in columns}
        | {f"std_{c}": F.stddev_pop(valid(c)) for c in columns},
    )
    return df.withColumns(
        {
            f"{c}{suffix}": (valid(c) - F.lit(stats[f"mean_{c}"])) / F.lit(stats[f"std_{c}"] or 1.0)
            for c in columns
        }
    )


def zscore_flags(
    df: DataFrame,
    columns: Sequence[str],
    threshold: float = 3.0,
    max_column: str = "zscore_max",
    flag_column: str = "is_zscore_anomaly",
    suffix: str = "_zscore",
) -> DataFrame:
    """Largest absolute z-score of a row and whether it exceeds the threshold."""
    scored = zscore(df, columns, suffix)
    largest = row_max_abs([f"{c}{suffix}" for c in columns])
    return scored.withColumn(max_column, largest).withColumn(
        flag_column, F.coalesce(F.col(max_column) > threshold, F.lit(False))
    )


def minmax_score(df: DataFrame, column: str, output: str) -> DataFrame:
    """Scale to 0..1 over all rows; a constant column gives null."""
    x = valid(column)
    s = whole_table(df, {"low": F.min(x), "high": F.max(x)})
    width = None if s["low"] is None else s["high"] - s["low"]
    return df.withColumn(output, _ratio(x - F.lit(s["low"]), width))


def risk_score(
    df: DataFrame,
    probability: str = "failure_probability",
    flag: str = "is_isolation_anomaly",
    deviation: str = "zscore_max",
    output: str = "risk_score",
    weights: tuple[float, float, float] = (0.4, 0.3, 0.3),
) -> DataFrame:
    """Weighted probability, anomaly flag and relative deviation, within 0..1."""
    top = whole_table(df, {"top": F.max(valid(deviation))})["top"]
    w_prob, w_flag, w_dev = (F.lit(w) for w in weights)
    mixed = (
        w_prob * F.col(probability)
        + w_flag * F.col(flag).cast("int")
        + w_dev * _ratio(F.col(deviation), top)
    )
    return df.withColumn(output, clamp(mixed))
