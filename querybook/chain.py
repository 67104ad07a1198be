"""The model chain on planted answers, so that SQL can state what models must find.

Orders become training rows whose target is a step function of a few feature values:
full trees predict it exactly. Events become readings in which one in twenty lies far
from all others, which the isolation forest must flag, and whose ``rpm`` parts those
before a failure from the rest, which the classifier must learn.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from derrick.operators.isolation import isolation_scores
from derrick.operators.joins import pre_event_label
from derrick.plans import views
from derrick.plans.failure_risk import FEATURES, KEY, sensor_readings, train_failure_model
from derrick.plans.production_model import train_production_model
from derrick.sources.scratch import materialize
from querybook import roles
from querybook.book import day, flag, moment, plain, query, r, table

# --- production model -------------------------------------------------------------

_STEP = {1: 10.0, 2: 40.0, 3: 25.0, 4: 90.0, 5: 5.0}
_BUSY = (3, 7, 8, 12)


def _target_rows(seasonal: bool) -> str:
    """SQL for the training rows and the production split (the smallest MD5 hashes)."""
    steps = " ".join(f"WHEN {k} THEN {v}::DOUBLE" for k, v in _STEP.items())
    extra = f" + CASE WHEN month(o_orderdate) IN {_BUSY} THEN 50.0::DOUBLE ELSE 0 END" if seasonal else ""
    month = "month(o_orderdate)::DOUBLE" if seasonal else "6.0::DOUBLE"
    hours = "(o_orderkey % 3)::DOUBLE" if seasonal else "8.0::DOUBLE"
    return f"""
    rows_ AS (SELECT o_orderkey AS well_id, CAST(o_orderdate AS DATE) AS production_date,
        substr(o_orderpriority, 1, 1)::DOUBLE AS avg_pressure, {month} AS avg_temperature,
        5.0::DOUBLE AS avg_power, {hours} AS avg_pump_hours,
        CASE substr(o_orderpriority, 1, 1)::INT {steps} END{extra} AS actual FROM orders),
    split_ AS (SELECT *, row_number() OVER (ORDER BY
        ('0x' || substr(md5(concat_ws('|', '42', well_id, production_date)), 1, 13))::BIGINT)
        <= ceil(0.2::DOUBLE * count(*) OVER ()) AS is_test FROM rows_)"""


def _targets(spark, d, seasonal: bool):
    orders = table(spark, d, "orders")
    kind = F.substring("o_orderpriority", 1, 1).cast("int")
    month = F.month("o_orderdate")
    target = F.element_at(F.create_map(*(F.lit(x) for kv in _STEP.items() for x in kv)), kind)
    if seasonal:
        target = target + F.when(month.isin(*_BUSY), 50.0).otherwise(0.0)
    return materialize(
        orders.select(
            F.col("o_orderkey").alias("well_id"),
            F.to_date("o_orderdate").alias("production_date"),
            kind.cast("double").alias("avg_pressure"),
            (month.cast("double") if seasonal else F.lit(6.0)).alias("avg_temperature"),
            F.lit(5.0).alias("avg_power"),
            ((F.col("o_orderkey") % 3).cast("double") if seasonal else F.lit(8.0)).alias("avg_pump_hours"),
            target.alias("target_oil_tons"),
        ),
        "planted-targets",
    )


@query(
    "rf_regress",
    f"""WITH {_target_rows(True)}
        SELECT row_number() OVER (ORDER BY production_date, well_id) AS id, well_id,
            {day('production_date')} AS production_date, {r('actual')} AS actual,
            {r('actual')} AS predicted, 0.0::DOUBLE AS error, avg_pressure, avg_temperature,
            avg_power, avg_pump_hours FROM split_ WHERE is_test""",
)
def rf_regress(spark, d):
    """Numbered test predictions of the full forest: every tree finds every step."""
    return plain(views.ml_predictions(train_production_model(_targets(spark, d, True)).predictions))


@query(
    "reg_model_metrics",
    f"""WITH {_target_rows(False)},
        line AS (SELECT regr_slope(actual, avg_pressure) AS b, regr_intercept(actual, avg_pressure) AS a
            FROM split_ WHERE NOT is_test),
        gap AS (SELECT actual - (a + b * avg_pressure) AS e FROM split_, line WHERE is_test)
        SELECT 'LinearRegression' AS model_name, {r('avg(abs(e))', 3)} AS mae,
            {r('sqrt(avg(e * e))', 3)} AS rmse FROM gap
        UNION ALL SELECT 'RandomForest', 0.0::DOUBLE, 0.0::DOUBLE""",
)
def reg_model_metrics(spark, d):
    """Errors of both full models; one feature tells, so the line is plain regression."""
    return plain(views.ml_metrics(train_production_model(_targets(spark, d, False)).metrics), 3)


_CUTS = 61


@query(
    "rf_many_cuts",
    f"""WITH rows_ AS (SELECT o_orderkey AS well_id, CAST(o_orderdate AS DATE) AS production_date,
            (o_orderkey % {_CUTS})::DOUBLE AS x, (o_orderkey % {_CUTS} * 17 % {_CUTS})::DOUBLE AS actual FROM orders),
        split_ AS (SELECT *, row_number() OVER (ORDER BY
            ('0x' || substr(md5(concat_ws('|', '42', well_id, production_date)), 1, 13))::BIGINT)
            <= ceil(0.2::DOUBLE * count(*) OVER ()) AS is_test FROM rows_),
        known AS (SELECT DISTINCT x FROM split_ WHERE NOT is_test)
        SELECT well_id, {day('production_date')} AS production_date, {r('x')} AS avg_pressure,
            {r('actual')} AS actual, {r('actual')} AS predicted FROM split_ JOIN known USING (x) WHERE is_test""",
)
def rf_many_cuts(spark, d):
    """A target that jumps at each of 60 cut points, all of which every tree must find."""
    orders = table(spark, d, "orders")
    value = F.col("o_orderkey") % _CUTS
    rows = materialize(
        orders.select(
            F.col("o_orderkey").alias("well_id"), F.to_date("o_orderdate").alias("production_date"),
            value.cast("double").alias("avg_pressure"), F.lit(60.0).alias("avg_temperature"),
            F.lit(5.0).alias("avg_power"), F.lit(8.0).alias("avg_pump_hours"),
            (value * 17 % _CUTS).cast("double").alias("target_oil_tons"),
        ),
        "many-cuts",
    )
    made = train_production_model(rows)
    return plain(made.predictions.select("well_id", "production_date", "avg_pressure", "actual", "predicted"))


# --- failure model ----------------------------------------------------------------

_FAILURES = "event_type = 'error' AND event_id % 7 = 0"
_PUMP = "concat('PUMP-', lpad(CAST(user_id AS VARCHAR), 9, '0'))"
# Far readings are the first twentieth of the events, as many as the threshold flags.
_PLANTED = f"""
    fail AS (SELECT DISTINCT user_id AS u, CAST(ts AS DATE) AS f FROM events WHERE {_FAILURES}),
    base AS (SELECT *, event_id < ceil(0.05::DOUBLE * ((SELECT count(*) FROM events) - 1)) AS far,
        EXISTS (SELECT 1 FROM fail WHERE u = user_id AND CAST(ts AS DATE) BETWEEN f - 7 AND f) AS near
        FROM events),
    read_ AS (SELECT event_id AS sensor_id, {_PUMP} AS pump_id, user_id AS well_id, ts AS sensor_datetime,
        CAST(ts AS DATE) AS sensor_date, far, near,
        CASE WHEN far THEN 100 + event_id * 17 % 1000 ELSE 2 END::DOUBLE AS vibration,
        CASE WHEN far THEN 500 + event_id * 31 % 2003 ELSE 60 END::DOUBLE AS temperature,
        CASE WHEN far THEN 300 + event_id * 7 % 307 ELSE 30 END::DOUBLE AS current_amp,
        CASE WHEN far THEN (CASE WHEN near THEN -1 ELSE 1 END) * (9000 + event_id * 13 % 5003)
            WHEN near THEN 1400 ELSE 1500 END::DOUBLE AS rpm FROM base)"""


def _failures(spark, d):
    kept = table(spark, d, "events").filter(_FAILURES)
    return kept.select(
        F.col("event_id").alias("failure_id"), roles._pump_id().alias("pump_id"),
        F.col("user_id").alias("well_id"), F.col("ts").alias("failure_ts"),
    )


def _sensors(spark, d):
    events = table(spark, d, "events")
    limit = -(-5 * (events.count() - 1) // 100)
    key, far = F.col("sensor_id"), F.col("sensor_id") < limit
    base = events.select(
        F.col("event_id").alias("sensor_id"), roles._pump_id().alias("pump_id"),
        F.col("user_id").alias("well_id"), F.col("ts").alias("sensor_ts"),
        F.to_date("ts").alias("_day"),
    )
    base = pre_event_label(base, _failures(spark, d), "pump_id", "_day", "failure_ts", "_near")
    near = F.col("_near") == 1
    away = F.when(near, -1).otherwise(1) * (9000 + key * 13 % 5003)
    return materialize(
        base.select(
            "sensor_id", "pump_id", "well_id", "sensor_ts",
            F.when(far, 100 + key * 17 % 1000).otherwise(2).cast("double").alias("vibration_mm_s"),
            F.when(far, 500 + key * 31 % 2003).otherwise(60).cast("double").alias("temperature_c"),
            F.when(far, 300 + key * 7 % 307).otherwise(30).cast("double").alias("current_a"),
            F.when(far, away).when(near, 1400).otherwise(1500).cast("double").alias("rpm"),
        ),
        "planted-sensors",
    )


@query(
    "iforest_scores",
    f"""WITH {_PLANTED} SELECT sensor_id, pump_id, {day('sensor_date')} AS sensor_date,
        {flag('far')} AS positive_score, {flag('far')} AS is_isolation_anomaly FROM read_""",
)
def iforest_scores(spark, d):
    """The planted readings, and only they, lie beyond the threshold."""
    scored = isolation_scores(sensor_readings(_sensors(spark, d)), FEATURES, KEY)
    return plain(
        scored.select(
            "sensor_id", "pump_id", "sensor_date",
            (F.col("isolation_score") > 0).alias("positive_score"), "is_isolation_anomaly",
        )
    )


def _z(column: str) -> str:
    return f"abs(({column} - avg({column}) OVER ()) / coalesce(nullif(stddev_pop({column}) OVER (), 0), 1))"


@query(
    "mart_pump_anomalies",
    f"""WITH {_PLANTED} SELECT pump_id, well_id, {moment('sensor_datetime')} AS sensor_datetime,
        {day('sensor_date')} AS sensor_date, vibration, temperature, current_amp, rpm,
        {r(f"greatest({', '.join(map(_z, FEATURES))})")} AS zscore_max,
        {flag(f"greatest({', '.join(map(_z, FEATURES))}) > 3")} AS is_zscore_anomaly,
        {flag('far')} AS is_isolation_anomaly, {flag('near')} AS failure_next_7d,
        {flag('near')} AS likely, 1::BIGINT AS in_range FROM read_""",
)
def mart_pump_anomalies(spark, d):
    """Every reading through the whole chain; the classifier finds the planted label."""
    made = train_failure_model(_sensors(spark, d), _failures(spark, d)).anomalies
    shares = [F.col(c).between(0, 1) for c in ("failure_probability", "risk_score")]
    return plain(
        made.withColumns({"likely": F.col("failure_probability") > 0.5, "in_range": shares[0] & shares[1]})
        .drop("isolation_score", "failure_probability", "risk_score")
    )


@query(
    "rf_classify",
    f"""WITH {_PLANTED} SELECT {day('sensor_date')} AS sensor_date, pump_id, well_id,
        {r('avg(vibration)')} AS avg_vibration, {r('avg(temperature)')} AS avg_temperature,
        {r('avg(current_amp)')} AS avg_current_amp, {r('avg(rpm)')} AS avg_rpm,
        count(*) FILTER (WHERE far) AS anomalies_count, {flag('bool_or(near)')} AS likely,
        1::BIGINT AS in_order FROM read_ GROUP BY sensor_date, pump_id, well_id""",
)
def rf_classify(spark, d):
    """Daily pump risk from the isolation forest, the classifier and the z-scores."""
    daily = views.pump_risk_score(train_failure_model(_sensors(spark, d), _failures(spark, d)).daily)
    in_order = (F.col("avg_risk_score") <= F.col("max_risk_score") + 1e-9) & (F.col("max_risk_score") <= 1)
    return plain(
        daily.withColumns({"likely": F.col("failure_probability") > 0.5, "in_order": in_order})
        .drop("avg_risk_score", "max_risk_score", "failure_probability")
    )


@query(
    "ml_failure_metrics",
    f"""WITH {_PLANTED} SELECT 'RandomForest failure risk' AS model_name, 1.0::DOUBLE AS accuracy,
        1.0::DOUBLE AS roc_auc, count(*) AS rows_count, count(*) FILTER (WHERE near) AS positive_rows
        FROM read_""",
)
def ml_failure_metrics(spark, d):
    """A label that the readings part must be learned without error."""
    return plain(train_failure_model(_sensors(spark, d), _failures(spark, d)).metrics)


@query(
    "one_class_risk",
    f"""WITH {_PLANTED} SELECT 'Isolation fallback failure risk' AS model_name, NULL::DOUBLE AS accuracy,
        NULL::DOUBLE AS roc_auc, count(*) AS rows_count, 0::BIGINT AS positive_rows,
        0.0::DOUBLE AS lowest, 1.0::DOUBLE AS highest, count(*) FILTER (WHERE far) AS flagged FROM read_""",
)
def one_class_risk(spark, d):
    """Without failures nothing can be learned: scaled isolation scores stand in."""
    none = _failures(spark, d).filter("failure_id < 0")
    made = train_failure_model(_sensors(spark, d), none)
    spread = made.anomalies.agg(
        F.min("failure_probability").alias("lowest"), F.max("failure_probability").alias("highest"),
        F.count_if("is_isolation_anomaly").alias("flagged"),
    )
    return plain(made.metrics.join(spread))
