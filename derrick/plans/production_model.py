"""Oil output models: linear regression and random forest."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from derrick.operators.models import (
    fit_forest_regressor,
    fit_linear,
    predict,
    regression_metrics,
)
from derrick.operators.split import random_split
from derrick.sources.scratch import materialize

# Columns of the data contract.
FEATURES = ("avg_pressure", "avg_temperature", "avg_power", "avg_pump_hours")
TARGET = "target_oil_tons"
KEY = ("well_id", "production_date")


class ProductionModel(NamedTuple):
    predictions: DataFrame  # ml_predictions
    metrics: DataFrame  # ml_metrics


def train_production_model(
    dataset: DataFrame,
    test_fraction: float = 0.2,
    trees: int = 100,
    depth: int | None = None,
    seed: int = 42,
) -> ProductionModel:
    """Fit both models on the training rows; the forest's test predictions are kept."""
    split = materialize(random_split(dataset, KEY, test_fraction, seed), "ml-split")
    train, test = (split.filter(c) for c in (~F.col("is_test"), F.col("is_test")))
    held_out = test.select(*KEY, *FEATURES, F.col(TARGET).alias("actual"))

    linear = predict(fit_linear(train, FEATURES, TARGET), held_out, FEATURES)
    forest_model = fit_forest_regressor(train, FEATURES, TARGET, trees, depth, seed)
    forest = materialize(predict(forest_model, held_out, FEATURES), "ml-predictions")

    metrics = regression_metrics(linear, "LinearRegression").unionByName(
        regression_metrics(forest, "RandomForest")
    )
    error = F.abs(F.col("actual") - F.col("predicted"))
    return ProductionModel(forest.withColumn("error", error), metrics)
