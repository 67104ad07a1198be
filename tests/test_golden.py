"""Golden values of the reference data set (FIXTURES.md, section 2)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from derrick.operators.aggregates import date_ranges, table_counts
from derrick.operators.clean import filter_iqr
from derrick.operators.joins import interval_exists
from derrick.operators.quality import check_table
from derrick.operators.quantile import exact_quantiles
from derrick.plans import marts, views
from derrick.plans.failure_risk import FEATURES, sensor_readings
from derrick.plans.features import (
    PRODUCTION_MEASURES,
    TELEMETRY_MEASURES,
    features_by_well,
    features_daily,
)
from derrick.operators.joins import pre_event_label
from derrick.operators.scoring import zscore_flags
from derrick.schemas import TABLES, as_measures

ROWS = {
    "wells": 8,
    "production": 728,
    "telemetry": 2912,
    "well_targets": 728,
    "pump_sensors": 2912,
    "pump_failures": 4,
    "deliveries": 120,
}


@pytest.fixture(scope="module")
def mart(seed):
    return marts.mart_production(seed["production"], seed["wells"], seed["telemetry"]).cache()


def test_row_counts(seed):
    got = {r["table_name"]: r["rows_count"] for r in table_counts(seed).collect()}
    assert got == ROWS


def test_date_ranges(seed):
    frames = {n: (seed[n], TABLES[n].export_date) for n in ("production", "telemetry")}
    for r in date_ranges(frames).collect():
        assert (str(r["min_date"]), str(r["max_date"])) == ("2024-01-01", "2024-03-31")


def test_seed_breaks_no_rule(seed):
    for name, spec in TABLES.items():
        bad = check_table(seed[name], spec, seed).filter("violations > 0").collect()
        assert bad == [], name


def test_total_oil(seed):
    assert float(seed["production"].agg(F.sum("oil_tons")).first()[0]) == 60241.92


def test_quartiles(seed):
    got = exact_quantiles(
        as_measures(seed["production"]), ["oil_tons", "water_tons", "gas_m3"], [0.25, 0.75]
    )
    assert got["oil_tons"] == pytest.approx([70.975, 94.0])
    assert got["water_tons"] == pytest.approx([15.435, 21.425])
    assert got["gas_m3"] == pytest.approx([1076.2625, 1356.0475])


@pytest.mark.parametrize(
    "table,columns,left",
    [
        ("production", PRODUCTION_MEASURES, [728, 728, 728, 637]),
        ("telemetry", TELEMETRY_MEASURES, [2912, 2912, 2912, 2184]),
    ],
)
def test_iqr_survivors(seed, table, columns, left):
    df = as_measures(seed[table])
    got = [filter_iqr(df, columns[: i + 1]).count() for i in range(len(columns))]
    assert got == left


def test_features(seed):
    daily = features_daily(seed["production"], seed["telemetry"], seed["wells"]).cache()
    assert daily.count() == 637
    missing = daily.filter("avg_pressure is null")
    assert missing.count() == 91
    assert [r[0] for r in missing.select("well_id").distinct().collect()] == [3]
    by_well = features_by_well(daily)
    assert by_well.count() == 7
    assert by_well.columns == [
        "well_id",
        "avg_daily_oil_tons",
        "total_oil_tons",
        "avg_pressure",
        "avg_temperature",
        "downtime_ratio",
    ]


def test_well_kpi(mart):
    rows = {r["well_id"]: r for r in views.well_kpi(mart).collect()}
    oil = [rows[w]["avg_oil_tons"] for w in range(1, 9)]
    assert oil == [75.0, 79.0, 68.0, 87.0, 91.0, 95.0, 64.0, 103.0]
    down = [rows[w]["downtime_percent"] for w in range(1, 9)]
    assert down == [2.63, 2.70, 16.67, 2.70, 2.70, 2.49, 41.67, 2.70]


def test_best_and_worst(mart):
    kpi = views.well_kpi(mart)
    assert [r["well_id"] for r in views.best_wells(kpi).collect()] == [8, 6, 5, 4, 2]
    assert [r["well_id"] for r in views.worst_wells(kpi).collect()] == [7, 3, 1, 2, 4]


def test_bands_and_heatmap(mart):
    groups = {
        r["pressure_group"]: r["count"]
        for r in views.pressure_temperature(mart).groupBy("pressure_group").count().collect()
    }
    assert groups == {"medium": 371, "high": 357}
    assert views.heatmap(mart).count() == 223


def test_zscores(seed):
    readings = sensor_readings(seed["pump_sensors"])
    stats = readings.agg(
        *(F.round(F.avg(c), 4) for c in FEATURES), *(F.round(F.stddev_pop(c), 4) for c in FEATURES)
    ).first()
    assert tuple(stats)[:4] == (1.847, 65.3662, 40.0625, 1499.3846)
    assert tuple(stats)[4:] == (0.6624, 3.717, 4.3695, 35.5085)
    flagged = zscore_flags(readings, FEATURES)
    assert flagged.filter("is_zscore_anomaly").count() == 112
    assert round(flagged.agg(F.max("zscore_max")).first()[0], 4) == 4.7904


def test_labels(seed):
    readings = sensor_readings(seed["pump_sensors"])
    by_day = pre_event_label(
        readings, seed["pump_failures"], "pump_id", "sensor_date", "failure_ts", "y"
    )
    assert by_day.count() == 2912
    assert by_day.filter("y = 1").count() == 128
    by_time = interval_exists(
        readings, seed["pump_failures"], "pump_id", "sensor_datetime", "failure_ts", "hit"
    )
    assert by_time.filter("hit").count() == 112


def test_mart_failures(seed):
    m = marts.mart_failures(seed["pump_sensors"], seed["pump_failures"]).cache()
    assert m.count() == 728
    assert m.filter("has_failure").count() == 364
    assert m.filter("failure_window_7d").count() == 32
    assert m.filter("days_before_failure < 0").count() == 103
    assert m.filter("failure_window_7d is null").count() == 0


def test_logistics(seed):
    m = marts.mart_logistics(seed["deliveries"])
    assert "cost_per_km" not in m.columns
    assert m.filter("delay_flag").count() == 110
    weather = {
        r["weather"]: (r["deliveries_count"], float(r["avg_delay_hours"]), float(r["max_delay_hours"]))
        for r in views.weather_delay(seed["deliveries"]).collect()
    }
    assert weather == {
        "clear": (30, 0.5, 1.0),
        "rain": (30, 3.5, 3.5),
        "snow": (30, 5.0, 7.0),
        "storm": (30, 7.97, 11.0),
    }
    first = {r["driver"]: r for r in views.driver_kpi(seed["deliveries"]).collect()}["Driver-01"]
    assert tuple(float(first[c]) for c in (
        "deliveries_count", "avg_delay_hours", "max_delay_hours", "avg_cost_per_km",
        "total_volume_tons",
    )) == (12, 2.25, 4.0, 85.62, 484.0)
    routes = {r["route"]: r for r in views.route_analytics(seed["deliveries"]).collect()}
    assert [float(routes[f"Route-{i:02d}"]["avg_delay_hours"]) for i in range(1, 9)] == [
        0.5, 3.5, 5.0, 8.07, 0.5, 3.5, 5.0, 7.87,
    ]
    assert {r["deliveries_count"] for r in routes.values()} == {15}


def test_daily_runtime_is_a_sum(seed):
    rows = seed["well_targets"].groupBy("well_id").agg(F.avg("pump_runtime_hours")).collect()
    assert {r[0]: float(r[1]) for r in rows} == dict(
        zip(range(1, 9), (23, 23, 18, 23, 23, 23, 14, 23))
    )
