"""Pump anomalies, failure probability and daily risk."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from derrick.functions import to_day
from derrick.operators.clean import fill_missing
from derrick.operators.isolation import isolation_scores
from derrick.operators.joins import pre_event_label
from derrick.operators.models import (
    accuracy,
    classifier_metrics,
    fit_forest_classifier,
    predict_probability,
    roc_auc,
)
from derrick.operators.rolling import rolling_mean
from derrick.operators.scoring import minmax_score, risk_score, zscore_flags
from derrick.operators.split import stratified_split
from derrick.schemas import as_measures
from derrick.sources.scratch import materialize

# Columns and names of the data contract.
FEATURES = ("vibration", "temperature", "current_amp", "rpm")
ROLLING = {f"{c}_rolling_mean_24h": c for c in FEATURES}
MODEL_FEATURES = (*FEATURES, *ROLLING, "zscore_max", "isolation_score")
KEY = ("pump_id", "sensor_datetime")
LABEL = "failure_next_7d"
SENSOR_NAMES = {
    "sensor_ts": "sensor_datetime",
    "vibration_mm_s": "vibration",
    "temperature_c": "temperature",
    "current_a": "current_amp",
}
ANOMALY_COLUMNS = (
    "pump_id",
    "well_id",
    "sensor_datetime",
    "sensor_date",
    *FEATURES,
    "zscore_max",
    "is_zscore_anomaly",
    "is_isolation_anomaly",
    "isolation_score",
    LABEL,
    "failure_probability",
    "risk_score",
)


class FailureRisk(NamedTuple):
    anomalies: DataFrame  # mart_pump_anomalies
    daily: DataFrame  # mart_pump_risk_daily
    metrics: DataFrame  # ml_failure_metrics


def sensor_readings(sensors: DataFrame) -> DataFrame:
    renamed = as_measures(sensors).withColumnsRenamed(SENSOR_NAMES)
    return renamed.withColumn("sensor_date", to_day("sensor_datetime"))


def model_frame(
    sensors: DataFrame, failures: DataFrame, trees: int = 200, seed: int = 42
) -> DataFrame:
    """Readings with z-scores, isolation score, 7-day label and rolling means.

    The rolling means span 24 rows of a pump, whatever their spacing.
    """
    scored = isolation_scores(sensor_readings(sensors), FEATURES, KEY, trees, seed=seed)
    flagged = zscore_flags(scored, FEATURES)
    labelled = pre_event_label(flagged, failures, "pump_id", "sensor_date", "failure_ts", LABEL)
    rolled = rolling_mean(labelled, ["pump_id"], ["sensor_datetime"], ROLLING)
    return materialize(rolled, "risk-frame")


def has_two_classes(df: DataFrame, label: str) -> bool:
    low, high = df.agg(F.min(label), F.max(label)).first()
    return low != high


def train_failure_model(
    sensors: DataFrame,
    failures: DataFrame,
    test_fraction: float = 0.25,
    trees: int = 200,
    depth: int = 6,
    seed: int = 42,
) -> FailureRisk:
    """Score all readings, training rows included; measure on the test rows only.

    Without both classes there is nothing to learn, and the isolation score
    scaled to 0..1 stands in for the probability.
    """
    frame = model_frame(sensors, failures, trees, seed)
    if has_two_classes(frame, LABEL):
        split = stratified_split(frame, KEY, LABEL, test_fraction, seed)
        matrix = materialize(fill_missing(split, MODEL_FEATURES), "risk-matrix")
        model = fit_forest_classifier(
            matrix.filter(~F.col("is_test")), MODEL_FEATURES, LABEL, trees, depth, seed
        )
        probable = materialize(
            predict_probability(
                model, matrix, MODEL_FEATURES, "failure_probability", "_predicted"
            ),
            "risk-probability",
        )
        test = probable.filter("is_test")
        scores = (
            accuracy(test, LABEL, "_predicted"),
            roc_auc(test, LABEL, "failure_probability"),
        )
        metrics = classifier_metrics(probable, "RandomForest failure risk", scores, LABEL)
    else:
        probable = minmax_score(frame, "isolation_score", "failure_probability")
        metrics = classifier_metrics(
            frame, "Isolation fallback failure risk", (None, None), LABEL
        )
    anomalies = risk_score(probable).select(*ANOMALY_COLUMNS)
    return FailureRisk(anomalies, pump_risk_daily(anomalies), metrics)


def pump_risk_daily(anomalies: DataFrame) -> DataFrame:
    return anomalies.groupBy("sensor_date", "pump_id", "well_id").agg(
        F.avg("vibration").alias("avg_vibration"),
        F.avg("temperature").alias("avg_temperature"),
        F.avg("current_amp").alias("avg_current_amp"),
        F.avg("rpm").alias("avg_rpm"),
        F.sum(F.col("is_isolation_anomaly").cast("bigint")).alias("anomalies_count"),
        F.avg("risk_score").alias("avg_risk_score"),
        F.max("risk_score").alias("max_risk_score"),
        F.avg("failure_probability").alias("failure_probability"),
    )
