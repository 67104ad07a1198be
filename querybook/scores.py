"""Global scores, risk and the views on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from derrick.operators.joins import pre_event_label
from derrick.operators.scoring import minmax_score, risk_score, zscore, zscore_flags
from derrick.plans import views
from derrick.plans.failure_risk import FEATURES, pump_risk_daily, sensor_readings
from querybook import roles
from querybook.book import day, flag, moment, plain, query, r, table
from querybook.roles import with_roles


@query(
    "zscore",
    f"""SELECT event_id, {r('(value - m) / s')} AS value_zscore
        FROM events, (SELECT avg(value) AS m, stddev_pop(value) AS s FROM events)""",
)
def zscore_query(spark, d):
    events = table(spark, d, "events").select("event_id", "value")
    return plain(zscore(events, ["value"]).drop("value"))


def _z(column: str) -> str:
    return (
        f"abs(({column} - (SELECT avg({column}) FROM s)) / "
        f"coalesce(nullif((SELECT stddev_pop({column}) FROM s), 0), 1))"
    )


_READINGS = """
s AS (SELECT pump_id, well_id, sensor_ts AS sensor_datetime,
      CAST(sensor_ts AS DATE) AS sensor_date, sensor_id, vibration_mm_s AS vibration,
      temperature_c AS temperature, current_a AS current_amp, rpm FROM pump_sensors)"""

# A rule stands in for the two model scores, so that SQL can follow all the way.
_SCORED = f"""
WITH {_READINGS},
z AS (SELECT *, greatest({', '.join(_z(c) for c in FEATURES)}) AS zscore_max FROM s),
scored AS (
    SELECT z.*, zscore_max > 3 AS is_zscore_anomaly,
           vibration > 100 AS is_isolation_anomaly,
           vibration / 400.0::DOUBLE AS isolation_score,
           CAST(EXISTS (SELECT 1 FROM pump_failures f WHERE f.pump_id = z.pump_id
               AND z.sensor_date BETWEEN CAST(f.failure_ts AS DATE) - 7
               AND CAST(f.failure_ts AS DATE)) AS BIGINT) AS failure_next_7d,
           (vibration - (SELECT min(vibration) FROM z))
               / nullif((SELECT max(vibration) - min(vibration) FROM z), 0)
               AS failure_probability
    FROM z),
risky AS (
    SELECT *, least(greatest(0.4::DOUBLE * failure_probability
        + 0.3::DOUBLE * CAST(is_isolation_anomaly AS INTEGER)
        + 0.3::DOUBLE * (zscore_max / (SELECT max(zscore_max) FROM scored)), 0), 1) AS risk_score
    FROM scored)
"""


def _anomalies(spark, d):
    readings = zscore_flags(sensor_readings(roles.pump_sensors(spark, d)), FEATURES)
    labelled = pre_event_label(
        readings,
        roles.pump_failures(spark, d),
        "pump_id",
        "sensor_date",
        "failure_ts",
        "failure_next_7d",
    )
    ruled = labelled.withColumns(
        {
            "is_isolation_anomaly": F.col("vibration") > 100,
            "isolation_score": F.col("vibration") / 400.0,
        }
    )
    return risk_score(minmax_score(ruled, "vibration", "failure_probability"))


@query(
    "zscore_flags",
    with_roles(
        "pump_sensors pump_failures",
        f"""{_SCORED} SELECT sensor_id, {r('zscore_max')} AS zscore_max,
            {flag('is_zscore_anomaly')} AS is_zscore_anomaly FROM risky""",
    ),
)
def zscore_flags_query(spark, d):
    flagged = zscore_flags(sensor_readings(roles.pump_sensors(spark, d)), FEATURES)
    return plain(flagged.select("sensor_id", "zscore_max", "is_zscore_anomaly"))


@query(
    "minmax_score",
    f"""SELECT event_id, {r('(value - low) / nullif(high - low, 0)')} AS score
        FROM events, (SELECT min(value) AS low, max(value) AS high FROM events)""",
)
def minmax_score_query(spark, d):
    events = table(spark, d, "events").select("event_id", "value")
    return plain(minmax_score(events, "value", "score").drop("value"))


@query(
    "risk_score",
    with_roles(
        "pump_sensors pump_failures",
        f"""{_SCORED} SELECT sensor_id, {r('failure_probability')} AS failure_probability,
            {r('risk_score')} AS risk_score FROM risky""",
    ),
)
def risk_score_query(spark, d):
    return plain(_anomalies(spark, d).select("sensor_id", "failure_probability", "risk_score"))


@query(
    "risk_daily",
    with_roles(
        "pump_sensors pump_failures",
        f"""{_SCORED} SELECT {day('sensor_date')} AS sensor_date, pump_id, well_id,
            {r('avg(vibration)')} AS avg_vibration, {r('avg(temperature)')} AS avg_temperature,
            {r('avg(current_amp)')} AS avg_current_amp, {r('avg(rpm)')} AS avg_rpm,
            CAST(sum(CAST(is_isolation_anomaly AS BIGINT)) AS BIGINT) AS anomalies_count,
            {r('avg(risk_score)')} AS avg_risk_score, {r('max(risk_score)')} AS max_risk_score,
            {r('avg(failure_probability)')} AS failure_probability
            FROM risky GROUP BY 1, 2, 3""",
    ),
)
def risk_daily(spark, d):
    return plain(views.pump_risk_score(pump_risk_daily(_anomalies(spark, d))))


@query(
    "view_filter",
    with_roles(
        "pump_sensors pump_failures",
        f"""{_SCORED} SELECT {moment('sensor_datetime')} AS sensor_datetime,
            {day('sensor_date')} AS sensor_date, pump_id, well_id, {r('vibration')} AS vibration,
            failure_next_7d, {r('risk_score')} AS risk_score
            FROM risky WHERE failure_next_7d = 1""",
    ),
)
def view_filter(spark, d):
    return plain(views.vibration_before_failure(_anomalies(spark, d)))


@query(
    "view_anomalies",
    with_roles(
        "pump_sensors pump_failures",
        f"""{_SCORED} SELECT {moment('sensor_datetime')} AS sensor_datetime,
            {day('sensor_date')} AS sensor_date, pump_id, well_id, {r('vibration')} AS vibration,
            {r('temperature')} AS temperature, {r('current_amp')} AS current_amp,
            {r('rpm')} AS rpm, {r('zscore_max')} AS zscore_max,
            {flag('is_zscore_anomaly')} AS is_zscore_anomaly,
            {flag('is_isolation_anomaly')} AS is_isolation_anomaly,
            {r('risk_score')} AS risk_score, {r('failure_probability')} AS failure_probability
            FROM risky""",
    ),
)
def view_anomalies(spark, d):
    return plain(views.pump_anomalies_time(_anomalies(spark, d)))
