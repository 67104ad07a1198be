"""Plans that must hold at any size: no step may gather a table in one task."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from derrick.operators.joins import interval_exists, pre_event_label
from derrick.operators.ranking import dense_row_id
from derrick.operators.rolling import rolling_mean
from derrick.operators.scoring import risk_score, zscore_flags
from derrick.operators.split import stratified_split
from derrick.plans import marts, views
from derrick.plans.failure_risk import FEATURES, sensor_readings

BANNED = ("SinglePartition", "CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, seed, tmp_path_factory):
    root = tmp_path_factory.mktemp("stored")
    out = {}
    for name, df in seed.items():
        df.write.parquet(str(root / name))
        out[name] = spark.read.parquet(str(root / name))
    return out


def _plans(t):
    mart = marts.mart_production(t["production"], t["wells"], t["telemetry"])
    readings = sensor_readings(t["pump_sensors"])
    labelled = pre_event_label(
        readings, t["pump_failures"], "pump_id", "sensor_date", "failure_ts", "y"
    )
    return {
        "mart_production": mart,
        "mart_failures": marts.mart_failures(t["pump_sensors"], t["pump_failures"]),
        "well_targets": marts.well_targets(t["production"], t["telemetry"]),
        "well_kpi": views.well_kpi(mart),
        "heatmap": views.heatmap(mart),
        "driver_kpi": views.driver_kpi(t["deliveries"]),
        "labels": labelled,
        "intervals": interval_exists(
            readings, t["pump_failures"], "pump_id", "sensor_datetime", "failure_ts", "hit"
        ),
        "zscores": zscore_flags(readings, FEATURES),
        "rolling": rolling_mean(readings, ["pump_id"], ["sensor_datetime"], {"m": "rpm"}),
        "rolling_hot": rolling_mean(
            readings, ["pump_id"], ["sensor_datetime"], {"m": "rpm"}, max_entity_rows=100
        ),
        "dense_id": dense_row_id(t["production"], ["production_date"]),
        "split": stratified_split(labelled, ["pump_id", "sensor_datetime"], "y"),
        "risk": risk_score(
            zscore_flags(readings, FEATURES).withColumns(
                {"failure_probability": F.lit(0.5), "is_isolation_anomaly": F.lit(True)}
            )
        ),
    }


def test_no_gathering_step(stored):
    for name, df in _plans(stored).items():
        text = plan(df)
        assert not [b for b in BANNED if b in text], (name, text)


def test_without_broadcast_joins_still_shuffle_by_key(spark, stored):
    """With every side too large to broadcast, joins are equi-joins on keys."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        mart = marts.mart_production(stored["production"], stored["wells"], stored["telemetry"])
        text = plan(mart)
        assert "SortMergeJoin" in text or "ShuffledHashJoin" in text
        assert "Broadcast" not in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_scan_reads_only_what_it_needs(stored):
    mart = marts.mart_production(stored["production"], stored["wells"], stored["telemetry"])
    text = plan(views.daily_production(mart))
    assert "oil_tons" in text and "gas_m3" not in text and "pressure_atm" not in text
