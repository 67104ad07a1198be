"""Marts over the raw tables. Nothing is cleaned here, unlike in the features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from derrick.functions import parse_timestamp, per_unit, round_half_even, to_day
from derrick.operators.aggregates import daily_targets, group_means
from derrick.operators.joins import attach_dimension, attach_events
from derrick.schemas import as_measures

TELEMETRY_NAMES = {
    "sensor_ts": "timestamp",
    "pressure_atm": "pressure",
    "temperature_c": "temperature",
    "energy_kwh": "energy_consumption",
}
SENSOR_NAMES = {
    "sensor_ts": "timestamp",
    "vibration_mm_s": "vibration",
    "temperature_c": "temperature",
    "current_a": "current",
}


def telemetry_daily(telemetry: DataFrame) -> DataFrame:
    readings = as_measures(telemetry).withColumnsRenamed(TELEMETRY_NAMES)
    return group_means(
        readings.withColumn("date", to_day("timestamp")),
        ["date", "well_id"],
        {
            "avg_pressure": "pressure",
            "avg_temperature": "temperature",
            "avg_energy": "energy_consumption",
            "avg_power_kw": "pump_power_kw",
            "avg_runtime_hours": "pump_runtime_hours",
        },
    )


def mart_production(production: DataFrame, wells: DataFrame, telemetry: DataFrame) -> DataFrame:
    made = (
        as_measures(production)
        .withColumnRenamed("production_date", "date")
        .withColumn("date", to_day("date"))
    )
    return (
        attach_dimension(made, wells, ["well_id"])
        .join(telemetry_daily(telemetry), ["date", "well_id"], "left")
        .withColumn("downtime_pct", round_half_even(F.col("downtime_hours") / 24 * 100))
    )


def sensor_daily(sensors: DataFrame) -> DataFrame:
    readings = as_measures(sensors).withColumnsRenamed(SENSOR_NAMES)
    return group_means(
        readings.withColumn("date", to_day("timestamp")),
        ["date", "pump_id", "well_id"],
        {
            "avg_vibration": "vibration",
            "avg_temperature": "temperature",
            "avg_current": "current",
            "avg_rpm": "rpm",
        },
    )


def mart_failures(sensors: DataFrame, failures: DataFrame) -> DataFrame:
    """Pump-days next to each failure of the pump; several failures, several rows."""
    events = (
        as_measures(failures)
        .withColumnRenamed("failure_ts", "failure_date")
        .withColumn("failure_date", parse_timestamp("failure_date", strict=False))
    )
    return attach_events(sensor_daily(sensors), events, ["pump_id", "well_id"])


def mart_logistics(deliveries: DataFrame) -> DataFrame:
    """Deliveries with the columns that their own columns allow.

    ``cost_per_km`` needs a column named ``cost``; a table with ``cost_rub`` gets
    that figure from the cost view instead.
    """
    out = as_measures(deliveries)
    has = set(out.columns)
    if "delivery_date" in has:
        out = out.withColumn("delivery_date", parse_timestamp("delivery_date"))
    if {"cost", "distance_km"} <= has:
        out = out.withColumn("cost_per_km", round_half_even(per_unit("cost", "distance_km")))
    if "delay_hours" in has:
        out = out.withColumn("delay_flag", F.coalesce(F.col("delay_hours") > 0, F.lit(False)))
    return out


def mart_ml_dataset(targets: DataFrame, wells: DataFrame) -> DataFrame:
    dated = (
        as_measures(targets)
        .withColumnRenamed("target_date", "date")
        .withColumn("date", to_day("date"))
    )
    return attach_dimension(dated, wells, ["well_id"])


def well_targets(production: DataFrame, telemetry: DataFrame) -> DataFrame:
    """Daily training targets: mean readings, summed runtime, the day's oil."""
    return daily_targets(
        production,
        telemetry,
        entity="well_id",
        day="production_date",
        ts="sensor_ts",
        carried="oil_tons",
        means={
            "avg_pressure_atm": "pressure_atm",
            "avg_temperature_c": "temperature_c",
            "avg_power_kw": "pump_power_kw",
        },
        sums={"pump_runtime_hours": "pump_runtime_hours"},
    ).withColumnsRenamed({"production_date": "target_date", "oil_tons": "target_oil_tons"})


def ml_dataset(targets: DataFrame) -> DataFrame:
    """Training table under the model's column names, in date order."""
    return (
        as_measures(targets)
        .select(
            "well_id",
            F.col("target_date").alias("production_date"),
            F.col("avg_pressure_atm").alias("avg_pressure"),
            F.col("avg_temperature_c").alias("avg_temperature"),
            F.col("avg_power_kw").alias("avg_power"),
            F.col("pump_runtime_hours").alias("avg_pump_hours"),
            "target_oil_tons",
        )
        .orderBy(F.col("production_date").asc_nulls_last())
    )
