"""Grouped means, sums and table counts; all combine on the map side."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from derrick.functions import measure, per_unit, round_exact, round_half_up, to_day, valid


def group_means(df: DataFrame, keys: Sequence[str], means: Mapping[str, str]) -> DataFrame:
    """Mean per group; ``means`` maps a new column to its measure."""
    return df.groupBy(*keys).agg(*(F.avg(valid(c)).alias(n) for n, c in means.items()))


def group_sums(df: DataFrame, keys: Sequence[str], sums: Mapping[str, str]) -> DataFrame:
    """Sum per group; a group without any value sums to zero."""
    return df.groupBy(*keys).agg(
        *(F.coalesce(F.sum(valid(c)), F.lit(0.0)).alias(n) for n, c in sums.items())
    )


def service_kpi(
    df: DataFrame,
    key: str,
    means: Mapping[str, str],
    maxima: Mapping[str, str],
    ratios: Mapping[str, tuple[str, str]],
    sums: Mapping[str, str],
    count: str = "deliveries_count",
    digits: int = 2,
) -> DataFrame:
    """Rounded count, means, maxima, means of row ratios and sums per key. Decimal
    columns are summed, averaged and divided as decimals, others as doubles."""

    def rounded(agg: Callable[[Column], Column], c: str) -> Column:
        return round_exact(df, agg(measure(df, c)), c, digits)

    def ratio(a: str, b: str) -> Column:
        if {type(df.schema[c].dataType) for c in (a, b)} == {DecimalType}:
            return F.round(F.avg(F.col(a) / F.nullif(F.col(b), F.lit(0))), digits)
        return round_half_up(F.avg(per_unit(valid(a), b)), digits)

    aggs = [F.count(F.lit(1)).alias(count)]
    aggs += [rounded(F.avg, c).alias(n) for n, c in means.items()]
    aggs += [rounded(F.max, c).alias(n) for n, c in maxima.items()]
    aggs += [ratio(a, b).alias(n) for n, (a, b) in ratios.items()]
    aggs += [rounded(F.sum, c).alias(n) for n, c in sums.items()]
    return df.groupBy(key).agg(*aggs)


def daily_targets(
    production: DataFrame,
    telemetry: DataFrame,
    entity: str,
    day: str,
    ts: str,
    carried: str,
    means: Mapping[str, str],
    sums: Mapping[str, str],
    digits: int = 2,
) -> DataFrame:
    """Readings summed up per entity and day next to the day's carried value.

    Both sides are aggregated before the join. Repeated (entity, day, value)
    rows would each have met all readings, so sums are scaled by their number.
    """
    days = production.groupBy(entity, day, carried).agg(F.count(F.lit(1)).alias("_copies"))
    readings = (
        telemetry.withColumn(day, to_day(ts))
        .groupBy(entity, day)
        .agg(
            *(F.avg(valid(c)).alias(n) for n, c in means.items()),
            *(F.sum(valid(c)).alias(n) for n, c in sums.items()),
        )
    )
    return days.join(readings, [entity, day], "inner").select(
        entity,
        day,
        carried,
        *(round_half_up(n, digits).alias(n) for n in means),
        *(round_half_up(F.col(n) * F.col("_copies"), digits).alias(n) for n in sums),
    )


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def table_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, rows_count), one line per table."""
    return union_all(
        [
            df.agg(F.count(F.lit(1)).alias("rows_count")).select(
                F.lit(name).alias("table_name"), "rows_count"
            )
            for name, df in frames.items()
        ]
    )


def date_ranges(frames: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """(table_name, min_date, max_date), one line per table."""
    return union_all(
        [
            df.agg(
                F.min(to_day(c)).alias("min_date"), F.max(to_day(c)).alias("max_date")
            ).select(F.lit(name).alias("table_name"), "min_date", "max_date")
            for name, (df, c) in frames.items()
        ]
    )
