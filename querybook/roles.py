"""The given tables in the shape of the seven source tables, twice: as frames
and as SQL for the check.

customer, nation, region -> wells; orders -> production; lineitem with orders ->
telemetry and deliveries; events -> pump sensors, its large errors -> failures.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from derrick.plans import marts
from querybook.book import table

SQL = {
    "wells": """
        SELECT c_custkey AS well_id, c_name AS well_name, n_name AS field_name,
               r_name AS region,
               DATE '2015-01-01' + CAST(c_custkey % 1000 AS INTEGER) AS start_date,
               1000 + c_custkey % 2000 AS depth_m,
               CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'maintenance'
                    WHEN 'MACHINERY' THEN 'inactive' ELSE 'active' END AS status
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "production": """
        SELECT o_orderkey AS production_id, o_custkey AS well_id,
               CAST(o_orderdate AS DATE) AS production_date,
               o_totalprice AS oil_tons,
               o_totalprice * o_totalprice / 1000000.0::DOUBLE AS water_tons,
               CASE WHEN o_orderpriority = '1-URGENT' THEN NULL
                    ELSE o_totalprice / 10.0::DOUBLE END AS gas_m3,
               CAST(o_orderkey % 31 AS DOUBLE) AS downtime_hours
        FROM orders""",
    "telemetry": """
        SELECT o_custkey AS well_id,
               o_orderdate + to_hours(CAST(l_linenumber AS INTEGER)) AS sensor_ts,
               80.0::DOUBLE + l_quantity AS pressure_atm,
               CASE WHEN l_quantity >= 49 THEN 110.0::DOUBLE
                    ELSE 50.0::DOUBLE + l_tax * 100.0::DOUBLE END AS temperature_c,
               l_extendedprice AS energy_kwh,
               nullif(l_discount, 0.0::DOUBLE) * 100.0::DOUBLE AS pump_power_kw,
               l_quantity / 4.0::DOUBLE AS pump_runtime_hours
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "pump_sensors": """
        SELECT event_id AS sensor_id,
               concat('PUMP-', lpad(CAST(user_id AS VARCHAR), 9, '0')) AS pump_id,
               user_id AS well_id, ts AS sensor_ts, value AS vibration_mm_s,
               value * value AS temperature_c,
               CAST(event_id * 37 % 101 AS DOUBLE) AS current_a,
               CAST(1500 - event_id * 13 % 17 AS DOUBLE) AS rpm
        FROM events""",
    "pump_failures": """
        SELECT event_id AS failure_id,
               concat('PUMP-', lpad(CAST(user_id AS VARCHAR), 9, '0')) AS pump_id,
               user_id AS well_id, ts AS failure_ts, event_type AS failure_type,
               1 + event_id % 5 AS severity, value / 10.0::DOUBLE AS repair_hours
        FROM events WHERE event_type = 'error' AND value > 200""",
    "deliveries": """
        SELECT l_orderkey * 8 + l_linenumber AS delivery_id,
               CAST(l_shipdate AS DATE) AS delivery_date,
               concat('Route-', lpad(CAST(l_partkey % 8 + 1 AS VARCHAR), 2, '0')) AS route,
               l_discount * 1000.0::DOUBLE AS distance_km, l_quantity AS volume_tons,
               l_extendedprice AS cost_rub,
               CAST(greatest(CAST(l_shipdate AS DATE) - CAST(o_orderdate AS DATE), 0)
                    AS DOUBLE) AS delay_hours,
               concat(l_returnflag, l_linestatus) AS weather,
               concat('Driver-', CAST(l_suppkey AS VARCHAR)) AS driver
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
}

_DERIVED = {
    "telemetry_daily": (
        ("telemetry",),
        """
        SELECT CAST(sensor_ts AS DATE) AS date, well_id,
               avg(pressure_atm) AS avg_pressure, avg(temperature_c) AS avg_temperature,
               avg(energy_kwh) AS avg_energy, avg(pump_power_kw) AS avg_power_kw,
               avg(pump_runtime_hours) AS avg_runtime_hours
        FROM telemetry GROUP BY ALL""",
    ),
    "mart_production": (
        ("production", "wells", "telemetry_daily"),
        """
        SELECT p.production_id, p.well_id, p.production_date AS date, p.oil_tons,
               p.water_tons, p.gas_m3, p.downtime_hours, w.well_name, w.field_name,
               w.region, w.start_date, w.depth_m, w.status, t.avg_pressure,
               t.avg_temperature, t.avg_energy, t.avg_power_kw, t.avg_runtime_hours,
               round_even(p.downtime_hours / 24 * 100 * 100.0::DOUBLE, 0) / 100.0::DOUBLE
                   AS downtime_pct
        FROM production p LEFT JOIN wells w ON p.well_id = w.well_id
        LEFT JOIN telemetry_daily t
          ON t.date = p.production_date AND t.well_id = p.well_id""",
    ),
    "well_targets": (
        ("production", "telemetry"),
        """
        SELECT p.well_id, p.production_date AS target_date,
               CAST(round(CAST(avg(t.pressure_atm) AS DECIMAL(38,9)), 2) AS DOUBLE)
                   AS avg_pressure_atm,
               CAST(round(CAST(avg(t.temperature_c) AS DECIMAL(38,9)), 2) AS DOUBLE)
                   AS avg_temperature_c,
               CAST(round(CAST(avg(t.pump_power_kw) AS DECIMAL(38,9)), 2) AS DOUBLE)
                   AS avg_power_kw,
               CAST(round(CAST(sum(t.pump_runtime_hours) AS DECIMAL(38,9)), 2) AS DOUBLE)
                   AS pump_runtime_hours,
               p.oil_tons AS target_oil_tons
        FROM production p JOIN telemetry t
          ON t.well_id = p.well_id AND CAST(t.sensor_ts AS DATE) = p.production_date
        GROUP BY p.well_id, p.production_date, p.oil_tons""",
    ),
}


def _needs(name: str) -> tuple[str, ...]:
    return _DERIVED[name][0] if name in _DERIVED else ()


def with_roles(names: str, body: str) -> str:
    """Prefix ``body`` with the CTEs it reads, in dependency order."""
    order: list[str] = []

    def add(name: str) -> None:
        for parent in _needs(name):
            add(parent)
        if name not in order:
            order.append(name)

    for name in names.split():
        add(name)
    ctes = [f"{n} AS ({_DERIVED[n][1] if n in _DERIVED else SQL[n]})" for n in order]
    body = body.strip()
    more = body[5:].lstrip() if body.upper().startswith("WITH ") else None
    return "WITH " + ",\n".join(ctes) + (f",\n{more}" if more else f"\n{body}")


def wells(spark: SparkSession, d: str) -> DataFrame:
    nations = table(spark, d, "nation").join(
        table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    status = (
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", "maintenance")
        .when(F.col("c_mktsegment") == "MACHINERY", "inactive")
        .otherwise("active")
    )
    return (
        table(spark, d, "customer")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").alias("well_id"),
            F.col("c_name").alias("well_name"),
            F.col("n_name").alias("field_name"),
            F.col("r_name").alias("region"),
            F.date_add(F.lit("2015-01-01").cast("date"), (F.col("c_custkey") % 1000).cast("int")).alias(
                "start_date"
            ),
            (1000 + F.col("c_custkey") % 2000).alias("depth_m"),
            status.alias("status"),
        )
    )


def production(spark: SparkSession, d: str) -> DataFrame:
    total = F.col("o_totalprice")
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("production_id"),
        F.col("o_custkey").alias("well_id"),
        F.to_date("o_orderdate").alias("production_date"),
        total.alias("oil_tons"),
        (total * total / 1e6).alias("water_tons"),
        F.when(F.col("o_orderpriority") != "1-URGENT", total / 10.0).alias("gas_m3"),
        (F.col("o_orderkey") % 31).cast("double").alias("downtime_hours"),
    )


def _shipped(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").join(
        table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )


def telemetry(spark: SparkSession, d: str) -> DataFrame:
    quantity = F.col("l_quantity")
    return _shipped(spark, d).select(
        F.col("o_custkey").alias("well_id"),
        (F.col("o_orderdate") + F.make_dt_interval(hours=F.col("l_linenumber"))).alias("sensor_ts"),
        (F.lit(80.0) + quantity).alias("pressure_atm"),
        F.when(quantity >= 49, 110.0).otherwise(50.0 + F.col("l_tax") * 100.0).alias("temperature_c"),
        F.col("l_extendedprice").alias("energy_kwh"),
        (F.nullif("l_discount", F.lit(0.0)) * 100.0).alias("pump_power_kw"),
        (quantity / 4.0).alias("pump_runtime_hours"),
    )


def _pump_id():
    return F.concat(F.lit("PUMP-"), F.lpad(F.col("user_id").cast("string"), 9, "0"))


def pump_sensors(spark: SparkSession, d: str) -> DataFrame:
    value = F.col("value")
    return table(spark, d, "events").select(
        F.col("event_id").alias("sensor_id"),
        _pump_id().alias("pump_id"),
        F.col("user_id").alias("well_id"),
        F.col("ts").alias("sensor_ts"),
        value.alias("vibration_mm_s"),
        (value * value).alias("temperature_c"),
        (F.col("event_id") * 37 % 101).cast("double").alias("current_a"),
        (1500 - F.col("event_id") * 13 % 17).cast("double").alias("rpm"),
    )


def pump_failures(spark: SparkSession, d: str) -> DataFrame:
    return (
        table(spark, d, "events")
        .filter((F.col("event_type") == "error") & (F.col("value") > 200))
        .select(
            F.col("event_id").alias("failure_id"),
            _pump_id().alias("pump_id"),
            F.col("user_id").alias("well_id"),
            F.col("ts").alias("failure_ts"),
            F.col("event_type").alias("failure_type"),
            (1 + F.col("event_id") % 5).alias("severity"),
            (F.col("value") / 10.0).alias("repair_hours"),
        )
    )


def deliveries(spark: SparkSession, d: str) -> DataFrame:
    late = F.datediff(F.to_date("l_shipdate"), F.to_date("o_orderdate"))
    return _shipped(spark, d).select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("delivery_id"),
        F.to_date("l_shipdate").alias("delivery_date"),
        F.concat(
            F.lit("Route-"), F.lpad((F.col("l_partkey") % 8 + 1).cast("string"), 2, "0")
        ).alias("route"),
        (F.col("l_discount") * 1000.0).alias("distance_km"),
        F.col("l_quantity").alias("volume_tons"),
        F.col("l_extendedprice").alias("cost_rub"),
        F.greatest(late, F.lit(0)).cast("double").alias("delay_hours"),
        F.concat("l_returnflag", "l_linestatus").alias("weather"),
        F.concat(F.lit("Driver-"), F.col("l_suppkey").cast("string")).alias("driver"),
    )


def mart_production(spark: SparkSession, d: str) -> DataFrame:
    return marts.mart_production(production(spark, d), wells(spark, d), telemetry(spark, d))


def well_targets(spark: SparkSession, d: str) -> DataFrame:
    return marts.well_targets(production(spark, d), telemetry(spark, d))
