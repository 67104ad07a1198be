"""KPI, chart and logistics views."""

from __future__ import annotations

from pyspark.sql import functions as F

from derrick.operators.aggregates import group_sums, union_all
from derrick.plans import marts, views
from querybook import roles
from querybook.book import day, plain, query, r, table
from querybook.roles import with_roles

_KPI = f"""
kpi AS (
    SELECT well_id, well_name, {r('avg(oil_tons)', 2)} AS avg_oil_tons,
           {r('avg(downtime_pct)', 2)} AS downtime_percent,
           {r('avg(avg_pressure)', 2)} AS avg_pressure,
           {r('avg(avg_temperature)', 2)} AS avg_temperature
    FROM mart_production GROUP BY well_id, well_name)"""


@query(
    "daily_totals",
    f"""SELECT {day('l_shipdate')} AS date, {r('sum(l_extendedprice)', 2)} AS total_oil_tons,
        {r('avg(l_extendedprice)', 2)} AS avg_oil_tons FROM lineitem GROUP BY 1""",
)
def daily_totals(spark, d):
    lines = table(spark, d, "lineitem").select(
        F.to_date("l_shipdate").alias("date"), F.col("l_extendedprice").alias("oil_tons")
    )
    return plain(views.daily_production(lines), 2)


@query(
    "daily_means",
    with_roles(
        "pump_sensors",
        f"""SELECT {day('sensor_ts')} AS date, pump_id, well_id,
            {r('avg(vibration_mm_s)')} AS avg_vibration,
            {r('avg(temperature_c)')} AS avg_temperature,
            {r('avg(current_a)')} AS avg_current, {r('avg(rpm)')} AS avg_rpm
            FROM pump_sensors GROUP BY 1, 2, 3""",
    ),
)
def daily_means(spark, d):
    return plain(marts.sensor_daily(roles.pump_sensors(spark, d)))


@query(
    "telemetry_daily",
    with_roles(
        "telemetry_daily",
        f"""SELECT {day('date')} AS date, well_id, {r('avg_pressure')} AS avg_pressure,
            {r('avg_temperature')} AS avg_temperature, {r('avg_energy')} AS avg_energy,
            {r('avg_power_kw')} AS avg_power_kw, {r('avg_runtime_hours')} AS avg_runtime_hours
            FROM telemetry_daily""",
    ),
)
def telemetry_daily(spark, d):
    return plain(marts.telemetry_daily(roles.telemetry(spark, d)))


@query(
    "entity_rollup",
    f"""WITH daily AS (
            SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, sum(o_totalprice) AS total
            FROM orders GROUP BY ALL)
        SELECT o_custkey AS well_id, {r('avg(total)')} AS avg_daily, {r('sum(total)', 2)} AS total,
               count(*) AS days
        FROM daily GROUP BY 1""",
)
def entity_rollup(spark, d):
    daily = group_sums(
        roles.production(spark, d), ["well_id", "production_date"], {"daily": "oil_tons"}
    )
    rolled = daily.groupBy("well_id").agg(
        F.avg("daily").alias("avg_daily"),
        F.round(F.sum("daily").cast("decimal(38,9)"), 2).alias("total"),
        F.count(F.lit(1)).alias("days"),
    )
    return plain(rolled)


@query("entity_kpi", with_roles("mart_production", f"WITH {_KPI} SELECT * FROM kpi"))
def entity_kpi(spark, d):
    return plain(views.well_kpi(roles.mart_production(spark, d)))


def _ranked(direction: str) -> str:
    return with_roles(
        "mart_production",
        f"WITH {_KPI} SELECT * FROM kpi ORDER BY avg_oil_tons {direction}, well_id LIMIT 5",
    )


@query("top5_entities", _ranked("DESC NULLS FIRST"))
def top5_entities(spark, d):
    return plain(views.best_wells(views.well_kpi(roles.mart_production(spark, d))))


@query("bottom5_entities", _ranked("ASC NULLS LAST"))
def bottom5_entities(spark, d):
    return plain(views.worst_wells(views.well_kpi(roles.mart_production(spark, d))))


@query(
    "banding_case",
    with_roles(
        "mart_production",
        f"""SELECT {day('date')} AS date, well_id, well_name,
            {r('avg_pressure')} AS avg_pressure, {r('avg_temperature')} AS avg_temperature,
            {r('oil_tons')} AS oil_tons,
            CASE WHEN avg_pressure < 90 THEN 'low' WHEN avg_pressure < 110 THEN 'medium'
                 ELSE 'high' END AS pressure_group
            FROM mart_production""",
    ),
)
def banding_case(spark, d):
    return plain(views.pressure_temperature(roles.mart_production(spark, d)))


@query(
    "line_series",
    with_roles(
        "production",
        f"""SELECT {day('production_date')} AS date, {r('sum(oil_tons)', 2)} AS total_oil_tons
            FROM production GROUP BY 1""",
    ),
)
def line_series(spark, d):
    made = roles.production(spark, d).withColumnRenamed("production_date", "date")
    return plain(views.line_chart(views.daily_production(made)))


@query(
    "bar_series",
    with_roles(
        "mart_production",
        f"WITH {_KPI} SELECT well_name, avg_oil_tons, downtime_percent FROM kpi",
    ),
)
def bar_series(spark, d):
    return plain(views.bar_chart(views.well_kpi(roles.mart_production(spark, d))))


@query(
    "heatmap_cells",
    with_roles(
        "mart_production",
        f"""SELECT {r('avg_pressure', 0)} AS pressure_bucket,
            {r('avg_temperature', 0)} AS temperature_bucket,
            {r('avg(oil_tons)', 2)} AS avg_oil_tons
            FROM mart_production GROUP BY 1, 2""",
    ),
)
def heatmap_cells(spark, d):
    return plain(views.heatmap(roles.mart_production(spark, d)))


@query(
    "category_delay",
    with_roles(
        "deliveries",
        f"""SELECT weather, count(*) AS deliveries_count,
            {r('avg(delay_hours)', 2)} AS avg_delay_hours,
            {r('max(delay_hours)', 2)} AS max_delay_hours FROM deliveries GROUP BY 1""",
    ),
)
def category_delay(spark, d):
    return plain(views.weather_delay(roles.deliveries(spark, d)))


@query(
    "unit_cost",
    with_roles(
        "deliveries",
        f"""SELECT delivery_id, {day('delivery_date')} AS delivery_date, route, driver, weather,
            {r('distance_km')} AS distance_km, {r('volume_tons')} AS volume_tons,
            {r('cost_rub')} AS cost_rub, {r('delay_hours')} AS delay_hours,
            {r('cost_rub / nullif(distance_km, 0)', 2)} AS cost_per_km FROM deliveries""",
    ),
)
def unit_cost(spark, d):
    return plain(views.cost_distance(roles.deliveries(spark, d)))


@query(
    "unit_cost_kpi",
    with_roles(
        "deliveries",
        f"""SELECT driver, count(*) AS deliveries_count,
            {r('avg(delay_hours)', 2)} AS avg_delay_hours,
            {r('max(delay_hours)', 2)} AS max_delay_hours,
            {r('avg(cost_rub)', 2)} AS avg_delivery_cost_rub,
            {r('avg(cost_rub / nullif(distance_km, 0))', 2)} AS avg_cost_per_km,
            {r('sum(volume_tons)', 2)} AS total_volume_tons FROM deliveries GROUP BY 1""",
    ),
)
def unit_cost_kpi(spark, d):
    return plain(views.driver_kpi(roles.deliveries(spark, d)))


@query(
    "route_kpi",
    with_roles(
        "deliveries",
        f"""SELECT route, count(*) AS deliveries_count,
            {r('avg(distance_km)', 2)} AS avg_distance_km,
            {r('avg(delay_hours)', 2)} AS avg_delay_hours,
            {r('max(delay_hours)', 2)} AS max_delay_hours,
            {r('avg(cost_rub)', 2)} AS avg_cost_rub,
            {r('avg(cost_rub / nullif(distance_km, 0))', 2)} AS avg_cost_per_km,
            {r('sum(volume_tons)', 2)} AS total_volume_tons FROM deliveries GROUP BY 1""",
    ),
)
def route_kpi(spark, d):
    return plain(views.route_analytics(roles.deliveries(spark, d)))


@query(
    "view_replace",
    with_roles(
        "mart_production",
        f"""WITH {_KPI.replace("FROM mart_production GROUP", "FROM mart_production WHERE downtime_pct < 50 GROUP")},
            ranked AS (SELECT *, row_number() OVER (ORDER BY avg_oil_tons DESC, well_id) AS high,
                row_number() OVER (ORDER BY avg_oil_tons, well_id) AS low, count(*) OVER () AS n FROM kpi)
            SELECT 'vw_best_wells' AS view_name, well_name, avg_oil_tons FROM ranked WHERE high <= 5
            UNION ALL SELECT 'vw_worst_wells', well_name, avg_oil_tons FROM ranked WHERE low <= 5
            UNION ALL SELECT 'vw_bar_chart_top_wells', well_name, avg_oil_tons FROM ranked""",
    ),
)
def view_replace(spark, d):
    """``vw_well_kpi`` is given another definition; the three views over it follow."""
    mart = marts.mart_production(roles.production(spark, d), roles.wells(spark, d), roles.telemetry(spark, d))
    graph = views.view_graph({"mart_production": mart})
    graph.create()
    changed = graph.replace("vw_well_kpi", lambda m: views.well_kpi(m.filter("downtime_pct < 50")))
    return plain(union_all([
        spark.table(name).select(F.lit(name).alias("view_name"), "well_name", "avg_oil_tons") for name in changed[1:]
    ]), 2)
