"""The seven source tables: columns, keys, rules and export dates.

Fixed values: table and column names, types and allowed ranges are the data
contract and must stay as they are.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class TableSpec:
    """Contract of one table; ``ranges`` maps a column to (low, high, strict_low)."""

    name: str
    ddl: str
    keys: tuple[tuple[str, ...], ...]
    export_date: str | None = None
    surrogate: str | None = None
    stamp: str | None = None
    ranges: dict[str, tuple[float | None, float | None, bool]] = field(default_factory=dict)
    allowed: dict[str, tuple[str, ...]] = field(default_factory=dict)
    parents: dict[str, tuple[str, str]] = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)

    @property
    def columns(self) -> list[str]:
        """Names alone, known without a session."""
        return [part.split()[0] for part in self.ddl.split(", ")]


_WELL = {"well_id": ("wells", "well_id")}
_NOT_NEGATIVE = (0, None, False)
_POSITIVE = (0, None, True)
_DAY_HOURS = (0, 24, False)

TABLES: dict[str, TableSpec] = {
    spec.name: spec
    for spec in (
        TableSpec(
            "wells",
            "well_id int, well_name string, field_name string, region string, "
            "start_date date, depth_m int, status string",
            keys=(("well_id",), ("well_name",)),
            ranges={"depth_m": _POSITIVE},
            allowed={"status": ("active", "maintenance", "inactive")},
        ),
        TableSpec(
            "production",
            "production_id bigint, well_id int, production_date date, "
            "oil_tons decimal(10,2), water_tons decimal(10,2), gas_m3 decimal(12,2), "
            "downtime_hours decimal(5,2), created_at timestamp_ntz",
            keys=(("production_id",), ("well_id", "production_date")),
            export_date="production_date",
            surrogate="production_id",
            stamp="created_at",
            ranges={
                "oil_tons": _NOT_NEGATIVE,
                "water_tons": _NOT_NEGATIVE,
                "gas_m3": _NOT_NEGATIVE,
                "downtime_hours": _DAY_HOURS,
            },
            parents=_WELL,
        ),
        TableSpec(
            "telemetry",
            "telemetry_id bigint, well_id int, sensor_ts timestamp_ntz, "
            "pressure_atm decimal(10,2), temperature_c decimal(10,2), "
            "energy_kwh decimal(12,2), pump_power_kw decimal(10,2), "
            "pump_runtime_hours decimal(5,2), created_at timestamp_ntz",
            keys=(("telemetry_id",), ("well_id", "sensor_ts")),
            export_date="sensor_ts",
            surrogate="telemetry_id",
            stamp="created_at",
            ranges={
                "energy_kwh": _NOT_NEGATIVE,
                "pump_power_kw": _NOT_NEGATIVE,
                "pump_runtime_hours": _DAY_HOURS,
            },
            parents=_WELL,
        ),
        TableSpec(
            "well_targets",
            "target_id bigint, well_id int, target_date date, "
            "avg_pressure_atm decimal(10,2), avg_temperature_c decimal(10,2), "
            "avg_power_kw decimal(10,2), pump_runtime_hours decimal(5,2), "
            "target_oil_tons decimal(10,2)",
            keys=(("target_id",), ("well_id", "target_date")),
            export_date="target_date",
            surrogate="target_id",
            parents=_WELL,
        ),
        TableSpec(
            "pump_sensors",
            "sensor_id bigint, pump_id string, well_id int, sensor_ts timestamp_ntz, "
            "vibration_mm_s decimal(10,2), temperature_c decimal(10,2), "
            "current_a decimal(10,2), rpm decimal(10,2)",
            keys=(("sensor_id",), ("pump_id", "sensor_ts")),
            export_date="sensor_ts",
            surrogate="sensor_id",
            parents=_WELL,
        ),
        TableSpec(
            "pump_failures",
            "failure_id bigint, pump_id string, well_id int, failure_ts timestamp_ntz, "
            "failure_type string, severity int, repair_hours decimal(6,2)",
            keys=(("failure_id",),),
            export_date="failure_ts",
            surrogate="failure_id",
            ranges={"severity": (1, 5, False), "repair_hours": _NOT_NEGATIVE},
            parents=_WELL,
        ),
        TableSpec(
            "deliveries",
            "delivery_id bigint, delivery_date date, route string, "
            "distance_km decimal(10,2), volume_tons decimal(10,2), "
            "cost_rub decimal(14,2), delay_hours decimal(6,2), weather string, "
            "driver string",
            keys=(("delivery_id",),),
            export_date="delivery_date",
            surrogate="delivery_id",
            ranges={
                "distance_km": _POSITIVE,
                "volume_tons": _POSITIVE,
                "cost_rub": _NOT_NEGATIVE,
                "delay_hours": _NOT_NEGATIVE,
            },
        ),
    )
}

# Child tables after their parents.
LOAD_ORDER = tuple(TABLES)


def as_measures(df: DataFrame) -> DataFrame:
    """Decimals become doubles: everything behind the source layer is double."""
    wide = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)]
    return df.withColumns({c: F.col(c).cast("double") for c in wide})


def conform(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Project to the table's columns and types."""
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in spec.schema.fields))
