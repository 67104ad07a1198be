"""Filling gaps and removing outlier rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from derrick.functions import absent, valid
from derrick.operators.quantile import ColumnSize, column_sizes, exact_quantiles


def _existing(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c in df.columns]


def impute_median(
    df: DataFrame,
    columns: Sequence[str],
    sizes: Mapping[str, ColumnSize] | None = None,
) -> DataFrame:
    """Fill nulls and NaN with the column's exact median over all rows.

    Columns the frame does not have are passed over, and so are complete ones;
    one without any value stays as it is.
    """
    columns = _existing(df, columns)
    sizes = column_sizes(df, columns) if sizes is None else sizes
    gaps = [c for c in columns if sizes[c].missing and sizes[c].rows]
    if not gaps:
        return df
    medians = exact_quantiles(df, gaps, [0.5])
    return df.withColumns({c: F.coalesce(valid(c), F.lit(medians[c][0])) for c in gaps})


def iqr_bounds(
    df: DataFrame,
    column: str,
    k: float = 1.5,
) -> tuple[float, float] | None:
    q1, q3 = exact_quantiles(df, [column], [0.25, 0.75])[column]
    if q1 is None or q3 is None:
        return None
    reach = k * (q3 - q1)
    return q1 - reach, q3 + reach


def filter_iqr(
    df: DataFrame,
    columns: Sequence[str],
    k: float = 1.5,
    sizes: Mapping[str, ColumnSize] | None = None,
) -> DataFrame:
    """Drop rows outside [q1 - k iqr, q3 + k iqr], one column after another.

    The quartiles of a column come from the rows that passed the columns before
    it, so the order matters. Missing values pass. The bounds of a complete
    column reach the scan as pushed filters. ``df`` is read once per column, so a
    costly input should be materialised first.
    """
    columns = _existing(df, columns)
    sizes = column_sizes(df, columns) if sizes is None else sizes
    for c in columns:
        bounds = iqr_bounds(df, c, k)
        if bounds:
            inside = F.col(c).between(*map(F.lit, bounds))
            df = df.filter(inside | absent(c) if sizes[c].missing else inside)
    return df


def fill_missing(df: DataFrame, columns: Sequence[str], value: float = 0.0) -> DataFrame:
    return df.na.fill(value, subset=list(columns))
