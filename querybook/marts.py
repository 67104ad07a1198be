"""Marts and training tables."""

from __future__ import annotations

from derrick.plans import marts
from querybook import roles
from querybook.book import day, moment, flag, plain, query, r
from querybook.roles import with_roles


@query(
    "mart_production",
    with_roles(
        "mart_production",
        f"""SELECT production_id, well_id, {day('date')} AS date, {r('oil_tons')} AS oil_tons,
            {r('water_tons')} AS water_tons, {r('gas_m3')} AS gas_m3,
            {r('downtime_hours')} AS downtime_hours, well_name, field_name, region,
            {day('start_date')} AS start_date, depth_m, status,
            {r('avg_pressure')} AS avg_pressure, {r('avg_temperature')} AS avg_temperature,
            {r('avg_energy')} AS avg_energy, {r('avg_power_kw')} AS avg_power_kw,
            {r('avg_runtime_hours')} AS avg_runtime_hours, {r('downtime_pct')} AS downtime_pct
            FROM mart_production""",
    ),
)
def mart_production(spark, d):
    return plain(roles.mart_production(spark, d))


@query(
    "mart_logistics",
    with_roles(
        "deliveries",
        f"""SELECT delivery_id, {moment('delivery_date')} AS delivery_date, route,
            {r('distance_km')} AS distance_km, {r('volume_tons')} AS volume_tons,
            {r('cost_rub')} AS cost_rub, {r('delay_hours')} AS delay_hours, weather, driver,
            {flag('delay_hours > 0')} AS delay_flag FROM deliveries""",
    ),
)
def mart_logistics(spark, d):
    return plain(marts.mart_logistics(roles.deliveries(spark, d)))


@query(
    "mart_logistics_cost",
    with_roles(
        "deliveries",
        f"""SELECT delivery_id, {r('cost_rub')} AS cost,
            {r("round_even(cost_rub / nullif(distance_km, 0) * 100.0::DOUBLE, 0) / 100.0::DOUBLE")}
                AS cost_per_km, {flag('delay_hours > 0')} AS delay_flag FROM deliveries""",
    ),
)
def mart_logistics_cost(spark, d):
    """The same mart for a table whose cost column has the expected name."""
    priced = roles.deliveries(spark, d).withColumnRenamed("cost_rub", "cost")
    mart = marts.mart_logistics(priced)
    return plain(mart.select("delivery_id", "cost", "cost_per_km", "delay_flag"))


@query(
    "mart_targets",
    with_roles(
        "well_targets wells",
        f"""SELECT well_id, {day('target_date')} AS date, avg_pressure_atm, avg_temperature_c,
            avg_power_kw, pump_runtime_hours, {r('target_oil_tons')} AS target_oil_tons,
            well_name, field_name, region, {day('start_date')} AS start_date, depth_m, status
            FROM well_targets LEFT JOIN wells USING (well_id)""",
    ),
)
def mart_targets(spark, d):
    return plain(marts.mart_ml_dataset(roles.well_targets(spark, d), roles.wells(spark, d)))


@query(
    "ml_dataset",
    with_roles(
        "well_targets",
        f"""SELECT well_id, {day('target_date')} AS production_date,
            avg_pressure_atm AS avg_pressure, avg_temperature_c AS avg_temperature,
            avg_power_kw AS avg_power, pump_runtime_hours AS avg_pump_hours,
            {r('target_oil_tons')} AS target_oil_tons FROM well_targets""",
    ),
)
def ml_dataset(spark, d):
    return plain(marts.ml_dataset(roles.well_targets(spark, d)))
