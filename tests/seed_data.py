"""Reference data set for golden tests: eight wells, 91 days, 6-hour readings.

Fixed values: names, dates and coefficients below define the expected results.
Each measure is base + per_well * well + per_hour * hour
+ height * wave(day of year / period), plus a shift before a failure.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from derrick.functions import add_hours, round_half_up
from derrick.operators.joins import calendar_grid, interval_exists
from derrick.operators.ranking import dense_row_id
from derrick.plans.marts import well_targets
from derrick.schemas import TABLES, conform

FIRST, LAST = dt.date(2024, 1, 1), dt.date(2024, 3, 31)
HOURS = (0, 6, 12, 18)

WELLS = [
    (1, "WELL-001", "North Field", "West Siberia", "2019-03-15", 2450, "active"),
    (2, "WELL-002", "North Field", "West Siberia", "2020-06-20", 2510, "active"),
    (3, "WELL-003", "North Field", "West Siberia", "2018-11-02", 2380, "maintenance"),
    (4, "WELL-004", "South Field", "Volga Region", "2021-04-10", 2200, "active"),
    (5, "WELL-005", "South Field", "Volga Region", "2021-08-18", 2275, "active"),
    (6, "WELL-006", "East Field", "Ural Region", "2022-01-25", 2600, "active"),
    (7, "WELL-007", "East Field", "Ural Region", "2020-09-30", 2550, "inactive"),
    (8, "WELL-008", "West Field", "Perm Region", "2019-12-05", 2325, "active"),
]
FAILURES = [
    (1, "PUMP-002", 2, "2024-02-15 08:00:00", "overheating", 3, 12),
    (2, "PUMP-003", 3, "2024-02-28 14:00:00", "high vibration", 4, 24),
    (3, "PUMP-006", 6, "2024-03-12 10:00:00", "current overload", 3, 10),
    (4, "PUMP-008", 8, "2024-03-24 16:00:00", "bearing wear", 5, 36),
]
WEATHER = ("clear", "rain", "snow", "storm")
SURCHARGE = (0, 3500, 7000, 12000)


@dataclass(frozen=True)
class Measure:
    base: float
    per_well: float = 0.0
    per_hour: float = 0.0
    wave: str = "sin"
    height: float = 0.0
    period: float = 1.0
    before_failure: float = 0.0
    by_status: tuple[tuple[str, float], ...] = ()

    def column(self) -> Column:
        wave = F.sin if self.wave == "sin" else F.cos
        x = F.lit(self.base) + F.col("well_id") * F.lit(self.per_well)
        if self.height:
            x += wave(F.dayofyear("day") / F.lit(self.period)) * F.lit(self.height)
        if self.per_hour:
            x += F.col("hour_step") * F.lit(self.per_hour)
        if self.before_failure:
            x += F.when(F.col("failing"), F.lit(self.before_failure)).otherwise(F.lit(0.0))
        for status, shift in self.by_status:
            x += F.when(F.col("status") == status, F.lit(shift)).otherwise(F.lit(0.0))
        return round_half_up(x)


PRODUCTION = {
    "oil_tons": Measure(
        70, 4, height=8, period=6, by_status=(("maintenance", -15), ("inactive", -35))
    ),
    "water_tons": Measure(12, 1.5, wave="cos", height=3, period=8),
    "gas_m3": Measure(900, 70, height=120, period=5),
}
TELEMETRY = {
    "pressure_atm": Measure(95, 3, 0.12, height=6, period=7),
    "temperature_c": Measure(64, 1.2, 0.05, wave="cos", height=4, period=9),
    "energy_kwh": Measure(420, 18, 3, height=20, period=4),
    "pump_power_kw": Measure(55, 2.3, height=4, period=6),
    "pump_runtime_hours": Measure(
        23 / 4, by_status=(("maintenance", -5 / 4), ("inactive", -9 / 4))
    ),
}
SENSORS = {
    "vibration_mm_s": Measure(1.2, 0.12, height=0.4, period=5, before_failure=2.7),
    "temperature_c": Measure(58, 1.4, 0.08, before_failure=9),
    "current_a": Measure(32, 1.7, height=2, period=4, before_failure=7),
    "rpm": Measure(1450, 12, before_failure=-120),
}


def _pick(index: Column, choices) -> Column:
    return F.element_at(F.array(*map(F.lit, choices)), (index + 1).cast("int"))


def _padded(prefix: str, number: Column, width: int) -> Column:
    return F.concat(F.lit(prefix), F.lpad(number.cast("string"), width, "0"))


def _deliveries(spark: SparkSession) -> DataFrame:
    n = F.col("id")
    kind = (n - 1) % 4
    distance = F.lit(80) + (n * 17) % 220
    load = (n * 7) % 55
    delay = (
        F.when(kind == 0, (n % 3) * 0.5)
        .when(kind == 1, 1.5 + n % 4)
        .when(kind == 2, 3.0 + n % 5)
        .otherwise(5.0 + n % 7)
    )
    return spark.range(1, 121).select(
        n.alias("delivery_id"),
        F.date_add(F.lit(FIRST), ((n - 1) % 91).cast("int")).alias("delivery_date"),
        _padded("Route-", (n - 1) % 8 + 1, 2).alias("route"),
        distance.alias("distance_km"),
        (15 + load).alias("volume_tons"),
        round_half_up(distance * (45 + load * 0.8) + _pick(kind, SURCHARGE)).alias("cost_rub"),
        delay.alias("delay_hours"),
        _pick(kind, WEATHER).alias("weather"),
        _padded("Driver-", (n - 1) % 10 + 1, 2).alias("driver"),
    )


def seed_tables(spark: SparkSession) -> dict[str, DataFrame]:
    wells = spark.createDataFrame(
        WELLS,
        "well_id int, well_name string, field_name string, region string, "
        "start_date string, depth_m int, status string",
    )
    wells = conform(wells, TABLES["wells"])
    failures = spark.createDataFrame(
        FAILURES,
        "failure_id bigint, pump_id string, well_id int, failure_ts string, "
        "failure_type string, severity int, repair_hours int",
    )
    failures = conform(failures, TABLES["pump_failures"])

    grid = calendar_grid(
        wells.select("well_id", "status"), F.lit(FIRST), F.lit(LAST), HOURS
    ).withColumn("sensor_ts", add_hours("day", "hour_step"))
    days = grid.filter("hour_step = 0").withColumnRenamed("day", "production_date")
    odd_day = (F.col("well_id") * 13 + F.dayofmonth("production_date")) % 11 == 0
    downtime = (
        F.when(F.col("status") == "maintenance", 4.0)
        .when(F.col("status") == "inactive", 10.0)
        .when(odd_day, 2.0)
        .otherwise(0.5)
    )
    production = days.withColumn("day", F.col("production_date")).select(
        "well_id",
        "production_date",
        *(m.column().alias(n) for n, m in PRODUCTION.items()),
        downtime.alias("downtime_hours"),
    )
    telemetry = grid.select(
        "well_id", "sensor_ts", *(m.column().alias(n) for n, m in TELEMETRY.items())
    )
    pumps = grid.withColumn("pump_id", _padded("PUMP-", F.col("well_id"), 3))
    near = interval_exists(pumps, failures, "pump_id", "sensor_ts", "failure_ts", "failing")
    sensors = near.select(
        "pump_id", "well_id", "sensor_ts", *(m.column().alias(n) for n, m in SENSORS.items())
    )

    made = {
        "production": (production, ["well_id", "production_date"]),
        "telemetry": (telemetry, ["well_id", "sensor_ts"]),
        "pump_sensors": (sensors, ["pump_id", "sensor_ts"]),
    }
    tables = {"wells": wells, "pump_failures": failures}
    for name, (df, order) in made.items():
        spec = TABLES[name]
        df = dense_row_id(df, order, spec.surrogate)
        if spec.stamp:
            df = df.withColumn(spec.stamp, F.lit(dt.datetime(2024, 4, 1)))
        tables[name] = conform(df, spec)
    targets = well_targets(tables["production"], tables["telemetry"])
    targets = dense_row_id(targets, ["well_id", "target_date"], "target_id")
    tables["well_targets"] = conform(targets, TABLES["well_targets"])
    tables["deliveries"] = conform(_deliveries(spark), TABLES["deliveries"])
    return tables
