"""Tables to a Parquet lake, one ``year=/month=/day=`` folder per day."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from derrick.functions import date_parts
from derrick.schemas import TABLES, as_measures
from derrick.sources.stores import Store

PART_KEYS = ("year", "month", "day")


def partition_by_day(df: DataFrame, date_column: str) -> DataFrame:
    """Add the partition keys; they are null for a row without a date, which goes to the
    default partition of the format."""
    return df.withColumns(date_parts(date_column))


def export_table(
    df: DataFrame,
    path: str,
    date_column: str | None = None,
    refresh: str = "days",
) -> bool:
    """Write one table; an empty one is skipped and gives False.

    The rebalance hint gathers each day into few files but lets the adaptive
    planner cut a day that holds a large share of all rows into several tasks.
    ``refresh="days"`` replaces only the days present in ``df``; ``"full"``
    also removes days that are gone.
    """
    if refresh not in ("days", "full"):
        raise ValueError(f"refresh must be 'days' or 'full', not {refresh!r}")
    if df.isEmpty():
        return False
    if date_column is None:
        df.write.mode("overwrite").parquet(path)
        return True
    (
        partition_by_day(df, date_column)
        .hint("rebalance", *(F.col(k) for k in PART_KEYS))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if refresh == "days" else "static")
        .partitionBy(*PART_KEYS)
        .parquet(path)
    )
    return True


def export_all(
    source: Store,
    root: str,
    date_columns: Mapping[str, str | None] | None = None,
    refresh: str = "days",
) -> dict[str, bool]:
    """Export every registered table; returns which ones had rows."""
    dates = (
        date_columns
        if date_columns is not None
        else {name: spec.export_date for name, spec in TABLES.items()}
    )
    return {
        name: export_table(
            as_measures(source.read(name)), f"{root.rstrip('/')}/{name}", date, refresh
        )
        for name, date in dates.items()
    }
