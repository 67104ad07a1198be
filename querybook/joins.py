"""Joins, grids, event windows and row numbers."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from derrick.functions import add_hours, to_day
from derrick.operators.joins import (
    attach_dimension,
    attach_events,
    calendar_grid,
    date_spine,
    interval_exists,
    pre_event_label,
)
from derrick.operators.ranking import dense_row_id
from derrick.operators.rolling import rolling_mean
from derrick.plans import marts
from querybook import roles
from querybook.book import day, moment, flag, plain, query, r, table
from querybook.roles import with_roles


@query(
    "dim_join_left",
    with_roles(
        "production wells",
        f"""SELECT production_id, well_id, {r('oil_tons')} AS oil_tons, well_name, region, status
            FROM production LEFT JOIN wells USING (well_id)""",
    ),
)
def dim_join_left(spark, d):
    joined = attach_dimension(roles.production(spark, d), roles.wells(spark, d), ["well_id"])
    return plain(
        joined.select("production_id", "well_id", "oil_tons", "well_name", "region", "status")
    )


@query(
    "daily_join_left",
    with_roles(
        "production telemetry_daily",
        f"""SELECT production_id, p.well_id, {day('production_date')} AS date,
            {r('avg_pressure')} AS avg_pressure, {r('avg_energy')} AS avg_energy
            FROM production p LEFT JOIN telemetry_daily t
              ON t.well_id = p.well_id AND t.date = p.production_date""",
    ),
)
def daily_join_left(spark, d):
    made = roles.production(spark, d).withColumnRenamed("production_date", "date")
    read = marts.telemetry_daily(roles.telemetry(spark, d))
    return plain(
        made.join(read, ["date", "well_id"], "left").select(
            "production_id", "well_id", "date", "avg_pressure", "avg_energy"
        )
    )


@query(
    "fanout_join",
    with_roles(
        "pump_sensors pump_failures",
        f"""WITH daily AS (
                SELECT CAST(sensor_ts AS DATE) AS date, pump_id, well_id,
                       avg(vibration_mm_s) AS avg_vibration, avg(temperature_c) AS avg_temperature,
                       avg(current_a) AS avg_current, avg(rpm) AS avg_rpm
                FROM pump_sensors GROUP BY ALL),
            joined AS (
                SELECT s.*, f.failure_id, f.failure_ts, f.failure_type, f.severity,
                       f.repair_hours,
                       date_diff('day', s.date, CAST(f.failure_ts AS DATE)) AS before
                FROM daily s LEFT JOIN pump_failures f
                  ON s.pump_id = f.pump_id AND s.well_id = f.well_id)
            SELECT {day('date')} AS date, pump_id, well_id, {r('avg_vibration')} AS avg_vibration,
                {r('avg_temperature')} AS avg_temperature, {r('avg_current')} AS avg_current,
                {r('avg_rpm')} AS avg_rpm, CAST(failure_id AS DOUBLE) AS failure_id,
                {moment('failure_ts')} AS failure_date, failure_type,
                CAST(severity AS DOUBLE) AS severity, {r('repair_hours')} AS repair_hours,
                CAST(before AS DOUBLE) AS days_before_failure,
                {flag('coalesce(before BETWEEN 0 AND 7, false)')} AS failure_window_7d,
                {flag('failure_ts IS NOT NULL')} AS has_failure
            FROM joined""",
    ),
)
def fanout_join(spark, d):
    mart = marts.mart_failures(roles.pump_sensors(spark, d), roles.pump_failures(spark, d))
    nullable = ["failure_id", "severity", "days_before_failure"]
    return plain(mart.withColumns({c: F.col(c).cast("double") for c in nullable}))


@query(
    "days_before_event",
    f"""SELECT o_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey,
        CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS DOUBLE)
            AS days_before_failure,
        {flag("coalesce(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) BETWEEN 0 AND 7, false)")}
            AS failure_window_7d,
        {flag('l_orderkey IS NOT NULL')} AS has_failure
        FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey""",
)
def days_before_event(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", to_day("o_orderdate").alias("date"))
    shipped = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_shipdate"
    )
    joined = attach_events(orders, shipped, ["o_orderkey"], event_ts="l_shipdate")
    return plain(
        joined.select(
            "o_orderkey",
            "l_linenumber",
            "l_partkey",
            F.col("days_before_failure").cast("double").alias("days_before_failure"),
            "failure_window_7d",
            "has_failure",
        )
    )


@query(
    "sample_join_limit",
    with_roles(
        "production wells",
        f"""SELECT {day('production_date')} AS production_date, well_name,
            {r('oil_tons')} AS oil_tons, {r('downtime_hours')} AS downtime_hours
            FROM (SELECT production_date, well_name, oil_tons, downtime_hours
                  FROM production JOIN wells USING (well_id)
                  ORDER BY production_date, well_id, production_id LIMIT 10)""",
    ),
)
def sample_join_limit(spark, d):
    return plain(
        roles.production(spark, d)
        .join(roles.wells(spark, d), "well_id")
        .orderBy("production_date", "well_id", "production_id")
        .limit(10)
        .select("production_date", "well_name", "oil_tons", "downtime_hours")
    )


@query(
    "expr_key_join",
    with_roles(
        "production telemetry",
        f"""SELECT p.well_id, count(*) AS readings, {r('sum(t.pump_runtime_hours)')} AS runtime
            FROM production p JOIN telemetry t
              ON t.well_id = p.well_id AND CAST(t.sensor_ts AS DATE) = p.production_date
            GROUP BY 1""",
    ),
)
def expr_key_join(spark, d):
    made, read = roles.production(spark, d).alias("p"), roles.telemetry(spark, d).alias("t")
    same_day = (F.col("t.well_id") == F.col("p.well_id")) & (
        to_day("t.sensor_ts") == F.col("p.production_date")
    )
    return plain(
        made.join(read, same_day)
        .groupBy("p.well_id")
        .agg(
            F.count(F.lit(1)).alias("readings"), F.sum("t.pump_runtime_hours").alias("runtime")
        )
    )


@query(
    "daily_target",
    with_roles(
        "well_targets",
        f"""SELECT well_id, {day('target_date')} AS target_date, avg_pressure_atm,
            avg_temperature_c, avg_power_kw, pump_runtime_hours,
            {r('target_oil_tons')} AS target_oil_tons FROM well_targets""",
    ),
)
def daily_target(spark, d):
    targets = roles.well_targets(spark, d)
    return plain(
        targets.select(
            "well_id",
            "target_date",
            "avg_pressure_atm",
            "avg_temperature_c",
            "avg_power_kw",
            "pump_runtime_hours",
            "target_oil_tons",
        )
    )


@query(
    "entity_calendar_grid",
    f"""SELECT s_suppkey AS well_id, {day('d')} AS day, h::BIGINT AS hour_step,
        strftime(d + to_hours(h), '%Y-%m-%d %H') AS sensor_hour
        FROM supplier
        CROSS JOIN (SELECT CAST(unnest(generate_series(DATE '2024-01-01', DATE '2024-03-31',
                           INTERVAL 1 DAY)) AS DATE) AS d)
        CROSS JOIN (SELECT unnest([0, 6, 12, 18]) AS h)""",
)
def entity_calendar_grid(spark, d):
    suppliers = table(spark, d, "supplier").select(F.col("s_suppkey").alias("well_id"))
    first, last = (F.lit(x).cast("date") for x in ("2024-01-01", "2024-03-31"))
    grid = calendar_grid(suppliers, first, last, (0, 6, 12, 18))
    stamp = F.date_format(add_hours("day", "hour_step"), "yyyy-MM-dd HH")
    return plain(grid.withColumn("sensor_hour", stamp))


@query(
    "date_spine",
    f"""WITH bounds AS (
            SELECT event_type, min(CAST(ts AS DATE)) AS low, max(CAST(ts AS DATE)) AS high
            FROM events GROUP BY 1)
        SELECT event_type, {day('unnest(generate_series(low, high, INTERVAL 1 DAY))')} AS day
        FROM bounds""",
)
def date_spine_query(spark, d):
    bounds = (
        table(spark, d, "events")
        .groupBy("event_type")
        .agg(F.min(to_day("ts")).alias("low"), F.max(to_day("ts")).alias("high"))
    )
    return plain(date_spine(bounds, "low", "high"))


@query(
    "lateral_row",
    f"""SELECT o_orderkey, strftime(s.sensor_ts, '%Y-%m-%d %H') AS sensor_hour
        FROM orders, LATERAL (
            SELECT o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS sensor_ts) s""",
)
def lateral_row(spark, d):
    """A lateral row that only computes is a projection."""
    stamp = add_hours(F.to_date("o_orderdate"), F.col("o_orderkey") % 24)
    return (
        table(spark, d, "orders")
        .select("o_orderkey", stamp.alias("sensor_ts"))
        .select("o_orderkey", F.date_format("sensor_ts", "yyyy-MM-dd HH").alias("sensor_hour"))
    )


@query(
    "interval_exists",
    with_roles(
        "pump_sensors pump_failures",
        f"""SELECT sensor_id, pump_id, {flag('''EXISTS (
                SELECT 1 FROM pump_failures f WHERE f.pump_id = s.pump_id
                AND s.sensor_ts BETWEEN f.failure_ts - INTERVAL 7 DAY AND f.failure_ts)''')} AS near
            FROM pump_sensors s""",
    ),
)
def interval_exists_query(spark, d):
    marked = interval_exists(
        roles.pump_sensors(spark, d),
        roles.pump_failures(spark, d),
        "pump_id",
        "sensor_ts",
        "failure_ts",
        "near",
    )
    return plain(marked.select("sensor_id", "pump_id", "near"))


_SPANS = {"near_10m": timedelta(minutes=10), "near_36h": timedelta(hours=36), "near_20d": timedelta(days=20, seconds=1)}


@query(
    "interval_any_length",
    with_roles(
        "pump_sensors pump_failures",
        "SELECT sensor_id, pump_id, " + ", ".join(
            flag(f"""EXISTS (SELECT 1 FROM pump_failures f WHERE f.pump_id = s.pump_id
                AND s.sensor_ts BETWEEN f.failure_ts - to_seconds({span.total_seconds():.0f}) AND f.failure_ts)""") + f" AS {name}"
            for name, span in _SPANS.items()
        ) + " FROM pump_sensors s",
    ),
)
def interval_any_length(spark, d):
    """Readings before a failure, from ten minutes to twenty days and a second."""
    marked = roles.pump_sensors(spark, d)
    for name, span in _SPANS.items():
        marked = interval_exists(marked, roles.pump_failures(spark, d), "pump_id", "sensor_ts", "failure_ts", name, span=span)
    return plain(marked.select("sensor_id", "pump_id", *_SPANS))


_FANNED = """CASE WHEN o_orderkey % 2 = 0 THEN 0 ELSE o_custkey END"""


@query(
    "fanout_hot_entity",
    f"""WITH days AS (SELECT DISTINCT {_FANNED} AS k, CAST(o_orderdate AS DATE) AS date FROM orders WHERE dayofyear(o_orderdate) = 1),
        events AS (SELECT {_FANNED} AS k, o_orderkey AS failure_id, CAST(o_orderdate AS DATE) AS f FROM orders)
        SELECT days.k, {day('date')} AS date, CAST(failure_id AS DOUBLE) AS failure_id,
            CAST(date_diff('day', date, f) AS DOUBLE) AS days_before_failure,
            {flag("coalesce(date_diff('day', date, f) BETWEEN 0 AND 7, false)")} AS failure_window_7d,
            {flag('f IS NOT NULL')} AS has_failure
        FROM days LEFT JOIN events ON days.k = events.k""",
)
def fanout_hot_entity(spark, d):
    """One entity has half of all events; its slices give what an undivided join gives."""
    key = F.when(F.col("o_orderkey") % 2 == 0, 0).otherwise(F.col("o_custkey")).alias("k")
    orders = table(spark, d, "orders")
    days = orders.filter(F.dayofyear("o_orderdate") == 1).select(key, to_day("o_orderdate").alias("date")).distinct()
    events = orders.select(key, F.col("o_orderkey").alias("failure_id"), to_day("o_orderdate").alias("at"))
    joined = attach_events(days, events, ["k"], event_ts="at", max_events=100).drop("at")
    return plain(joined.withColumns({c: F.col(c).cast("double") for c in ("failure_id", "days_before_failure")}))


@query(
    "pre_event_label",
    with_roles(
        "pump_sensors pump_failures",
        f"""SELECT sensor_id, pump_id, {flag('''EXISTS (
                SELECT 1 FROM pump_failures f WHERE f.pump_id = s.pump_id
                AND CAST(s.sensor_ts AS DATE) BETWEEN CAST(f.failure_ts AS DATE) - 7
                    AND CAST(f.failure_ts AS DATE))''')} AS failure_next_7d
            FROM pump_sensors s""",
    ),
)
def pre_event_label_query(spark, d):
    readings = roles.pump_sensors(spark, d).withColumn("sensor_date", to_day("sensor_ts"))
    labelled = pre_event_label(
        readings,
        roles.pump_failures(spark, d),
        "pump_id",
        "sensor_date",
        "failure_ts",
        "failure_next_7d",
    )
    return plain(labelled.select("sensor_id", "pump_id", "failure_next_7d"))


@query(
    "rolling_24",
    with_roles(
        "pump_sensors",
        f"""SELECT sensor_id, {r('avg(vibration_mm_s) OVER w')} AS vibration_mean,
            {r('avg(rpm) OVER w')} AS rpm_mean FROM pump_sensors
            WINDOW w AS (PARTITION BY pump_id ORDER BY sensor_ts
                         ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)""",
    ),
)
def rolling_24(spark, d):
    rolled = rolling_mean(
        roles.pump_sensors(spark, d),
        ["pump_id"],
        ["sensor_ts"],
        {"vibration_mean": "vibration_mm_s", "rpm_mean": "rpm"},
    )
    return plain(rolled.select("sensor_id", "vibration_mean", "rpm_mean"))


@query(
    "rolling_24_hot",
    with_roles(
        "production",
        f"""SELECT production_id, {r('avg(oil_tons) OVER w')} AS oil_mean FROM production
            WINDOW w AS (ORDER BY production_date, production_id
                         ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)""",
    ),
)
def rolling_24_hot(spark, d):
    """One entity owns the whole table; the row limit makes the stretches take over."""
    one = roles.production(spark, d).withColumn("field", F.lit("all"))
    rolled = rolling_mean(
        one,
        ["field"],
        ["production_date", "production_id"],
        {"oil_mean": "oil_tons"},
        max_entity_rows=4_000,
    )
    return plain(rolled.select("production_id", "oil_mean"))


@query(
    "dense_row_id",
    """SELECT row_number() OVER (ORDER BY o_orderdate, o_custkey, o_orderkey) AS id, o_orderkey
       FROM orders""",
)
def dense_row_id_query(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return dense_row_id(orders, ["o_orderdate", "o_custkey", "o_orderkey"]).select(
        "id", "o_orderkey"
    )
