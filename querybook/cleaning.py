"""Median fill, outlier filter and the features built on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from derrick.functions import clamp
from derrick.operators.clean import fill_missing, filter_iqr, impute_median
from derrick.plans.features import (
    PRODUCTION_MEASURES,
    TELEMETRY_MEASURES,
    features_by_well,
    features_daily,
)
from derrick.sources.scratch import materialize
from querybook import roles
from querybook.book import day, plain, query, r, table
from querybook.roles import with_roles


def iqr_ctes(source: str, columns: list[str], out: str) -> str:
    """SQL for the filter, column after column on what is left."""
    ctes, last = [], source
    for i, c in enumerate(columns):
        name = out if i == len(columns) - 1 else f"{out}_{i}"
        ctes.append(
            f"""{out}_q{i} AS (SELECT quantile_cont({c}, 0.25) AS q1,
                quantile_cont({c}, 0.75) AS q3 FROM {last}),
            {name} AS (SELECT t.* FROM {last} t, {out}_q{i}
                WHERE t.{c} IS NULL OR t.{c} BETWEEN q1 - 1.5::DOUBLE * (q3 - q1)
                AND q3 + 1.5::DOUBLE * (q3 - q1))"""
        )
        last = name
    return ",\n".join(ctes)


def fill_cte(source: str, columns: list[str], out: str) -> str:
    fills = ", ".join(
        f"coalesce({c}, (SELECT median({c}) FROM {source})) AS {c}" for c in columns
    )
    return f"{out} AS (SELECT * REPLACE ({fills}) FROM {source})"


@query(
    "median_impute",
    f"""WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey,
            nullif(l_discount, 0.0::DOUBLE) AS discount,
            CASE WHEN l_linestatus = 'O' THEN l_extendedprice END AS price FROM lineitem)
        SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey,
            {r('coalesce(discount, (SELECT median(discount) FROM t))')} AS discount,
            {r('coalesce(price, (SELECT median(price) FROM t))')} AS price FROM t""",
)
def median_impute(spark, d):
    lines = table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.nullif("l_discount", F.lit(0.0)).alias("discount"),
        F.when(F.col("l_linestatus") == "O", F.col("l_extendedprice")).alias("price"),
    )
    return plain(impute_median(lines, ["discount", "price"]))


@query(
    "fill_missing",
    f"""SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey,
        {r('coalesce(nullif(l_discount, 0.03::DOUBLE), 0)')} AS discount FROM lineitem""",
)
def fill_missing_query(spark, d):
    lines = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.nullif("l_discount", F.lit(0.03)).alias("discount")
    )
    return plain(fill_missing(lines, ["discount"]))


@query(
    "iqr_filter",
    f"WITH {iqr_ctes('events', ['value'], 'kept')} SELECT event_id, {r('value')} AS value FROM kept",
)
def iqr_filter(spark, d):
    events = table(spark, d, "events").select("event_id", "value")
    return plain(filter_iqr(events, ["value"]))


@query(
    "iqr_filter_seq",
    f"""WITH t AS (SELECT event_id, value, value * value AS power FROM events),
        {iqr_ctes('t', ['value', 'power'], 'kept')}
        SELECT event_id, {r('value')} AS value, {r('power')} AS power FROM kept""",
)
def iqr_filter_seq(spark, d):
    events = table(spark, d, "events").select(
        "event_id", "value", (F.col("value") * F.col("value")).alias("power")
    )
    return plain(filter_iqr(events, ["value", "power"]))


@query(
    "ratio_clip",
    f"""SELECT event_id, {r('least(greatest((value - 20) / 24, 0), 1)')} AS ratio
        FROM events""",
)
def ratio_clip(spark, d):
    return plain(
        table(spark, d, "events").select(
            "event_id", clamp((F.col("value") - 20) / 24).alias("ratio")
        )
    )


_FEATURES = f"""
WITH {fill_cte('production', list(PRODUCTION_MEASURES), 'p_full')},
{iqr_ctes('p_full', list(PRODUCTION_MEASURES), 'p_kept')},
{fill_cte('telemetry', list(TELEMETRY_MEASURES), 't_full')},
{iqr_ctes('t_full', list(TELEMETRY_MEASURES), 't_kept')},
made AS (
    SELECT well_id, production_date, sum(oil_tons) AS daily_oil_tons,
           sum(water_tons) AS daily_water_tons, sum(gas_m3) AS daily_gas_m3,
           sum(downtime_hours) AS downtime_hours
    FROM p_kept GROUP BY ALL),
seen AS (
    SELECT well_id, CAST(sensor_ts AS DATE) AS production_date,
           avg(pressure_atm) AS avg_pressure, avg(temperature_c) AS avg_temperature,
           avg(pump_power_kw) AS avg_power_kw,
           avg(pump_runtime_hours) AS avg_pump_runtime_hours
    FROM t_kept GROUP BY ALL),
features AS (
    SELECT m.*, s.avg_pressure, s.avg_temperature, s.avg_power_kw, s.avg_pump_runtime_hours,
           least(greatest(m.downtime_hours / 24, 0), 1) AS downtime_ratio,
           w.well_name, w.field_name, w.region, w.start_date, w.depth_m, w.status
    FROM made m LEFT JOIN seen s USING (well_id, production_date)
    LEFT JOIN wells w USING (well_id))
"""


def _features(spark, d):
    """Telemetry is a join here and read once per measure, so it is stored first."""
    telemetry = materialize(roles.telemetry(spark, d), "telemetry")
    return features_daily(roles.production(spark, d), telemetry, roles.wells(spark, d))


@query(
    "features_daily",
    with_roles(
        "production telemetry wells",
        f"""{_FEATURES} SELECT well_id, {day('production_date')} AS production_date,
            {r('daily_oil_tons')} AS daily_oil_tons, {r('daily_water_tons')} AS daily_water_tons,
            {r('daily_gas_m3')} AS daily_gas_m3, {r('downtime_hours')} AS downtime_hours,
            {r('avg_pressure')} AS avg_pressure, {r('avg_temperature')} AS avg_temperature,
            {r('avg_power_kw')} AS avg_power_kw,
            {r('avg_pump_runtime_hours')} AS avg_pump_runtime_hours,
            {r('downtime_ratio')} AS downtime_ratio, well_name, field_name, region,
            {day('start_date')} AS start_date, depth_m, status FROM features""",
    ),
)
def features_daily_query(spark, d):
    return plain(_features(spark, d))


@query(
    "features_by_well",
    with_roles(
        "production telemetry wells",
        f"""{_FEATURES} SELECT well_id, {r('avg(daily_oil_tons)')} AS avg_daily_oil_tons,
            {r('sum(daily_oil_tons)', 2)} AS total_oil_tons,
            {r('avg(avg_pressure)')} AS avg_pressure,
            {r('avg(avg_temperature)')} AS avg_temperature,
            {r('avg(downtime_ratio)')} AS downtime_ratio FROM features GROUP BY 1""",
    ),
)
def features_by_well_query(spark, d):
    return plain(features_by_well(_features(spark, d)))
