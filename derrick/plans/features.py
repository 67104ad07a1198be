"""Cleaned daily features per well and their rollup."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from derrick.functions import clamp, to_day
from derrick.operators.aggregates import group_means, group_sums
from derrick.operators.clean import filter_iqr, impute_median
from derrick.operators.joins import attach_dimension
from derrick.operators.quantile import column_sizes
from derrick.schemas import as_measures

PRODUCTION_MEASURES = ("oil_tons", "water_tons", "gas_m3", "downtime_hours")
TELEMETRY_MEASURES = ("pressure_atm", "temperature_c", "pump_power_kw", "pump_runtime_hours")
DAY = ["well_id", "production_date"]


def clean_measures(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Median fill, then the row filter column by column.

    One pass over the raw table says which columns have gaps; a filled one has none.
    """
    columns = [c for c in columns if c in df.columns]
    sizes = column_sizes(df, columns)
    full = {c: s._replace(missing=0 if s.rows else s.missing) for c, s in sizes.items()}
    return filter_iqr(impute_median(df, columns, sizes), columns, sizes=full)


def features_daily(production: DataFrame, telemetry: DataFrame, wells: DataFrame) -> DataFrame:
    """Well-days: sums of production, means of telemetry, downtime ratio, well data.

    Wells whose telemetry was filtered away keep their days with nulls.
    """
    raw = (
        (as_measures(production), PRODUCTION_MEASURES),
        (as_measures(telemetry), TELEMETRY_MEASURES),
    )
    # The two tables do not wait for each other's small statistics jobs.
    with ThreadPoolExecutor(len(raw)) as pool:
        clean = inheritable_thread_target(production.sparkSession)(
            lambda table: clean_measures(*table)
        )
        made, read = pool.map(clean, raw)
    made_daily = group_sums(
        made.withColumn("production_date", to_day("production_date")),
        DAY,
        {
            "daily_oil_tons": "oil_tons",
            "daily_water_tons": "water_tons",
            "daily_gas_m3": "gas_m3",
            "downtime_hours": "downtime_hours",
        },
    )
    read_daily = group_means(
        read.withColumn("production_date", to_day("sensor_ts")),
        DAY,
        {
            "avg_pressure": "pressure_atm",
            "avg_temperature": "temperature_c",
            "avg_power_kw": "pump_power_kw",
            "avg_pump_runtime_hours": "pump_runtime_hours",
        },
    )
    daily = made_daily.join(read_daily, DAY, "left").withColumn(
        "downtime_ratio", clamp(F.col("downtime_hours") / 24)
    )
    return attach_dimension(daily, wells, ["well_id"])


def features_by_well(daily: DataFrame) -> DataFrame:
    return daily.groupBy("well_id").agg(
        F.avg("daily_oil_tons").alias("avg_daily_oil_tons"),
        F.sum("daily_oil_tons").alias("total_oil_tons"),
        F.avg("avg_pressure").alias("avg_pressure"),
        F.avg("avg_temperature").alias("avg_temperature"),
        F.avg("downtime_ratio").alias("downtime_ratio"),
    )
