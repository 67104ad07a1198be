"""Training, prediction and evaluation on ``pyspark.ml``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from derrick.operators.exact_forest import ExactForest, fit_exact_forest, predict_exact

_VECTOR = "_features"
# Room for the statistics of the nodes that one pass over the data splits; with
# too little, a level of the forest takes several passes.
_NODE_MEMORY_MB = 1024
#: Partitions a training set is dealt to, whatever the cluster: more executors than
#: this do not shorten a training. Part of the model, like its seed.
TRAIN_PARTITIONS = 64
#: Rows of a partition from which on a training set gets more of them, and equal rows
#: that are dealt together.
TRAIN_ROWS, TOGETHER = 200_000, 100
#: Values of a feature that a split of the classifier tells apart.
MAX_BINS = 32


def feature_vector(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=_VECTOR).transform(df)


def training_set(train: DataFrame, features: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The columns a training reads, in a number of partitions that the number of rows fixes,
    by row hash and in a fixed order, as bagging and bin sampling are seeded per partition. So
    the same rows give the same model on any cluster and in any input order.

    Equal rows are counted, and travel as counts of at most ``TOGETHER`` that are dealt
    apart, so a value that most rows have burdens no partition."""
    names = [*features, *columns]
    keys = [F.col(c).alias(f"_k{i}") for i, c in enumerate(names)]
    counts = train.select(*keys).groupBy(*(f"_k{i}" for i in range(len(names)))).agg(F.count(F.lit(1)).alias("_n"))
    parts = max(TRAIN_PARTITIONS, -(-train.count() // TRAIN_ROWS))
    rows = counts.select(
        *(F.col(f"_k{i}").alias(c) for i, c in enumerate(names)), "_n",
        F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / TOGETHER))).alias("_part"),
    )
    row = F.xxhash64(*names)
    spread = rows.repartition(parts, F.when(F.col("_part") == 0, row).otherwise(F.xxhash64(row, "_part")))
    times = F.least(F.col("_n") - F.col("_part") * TOGETHER, F.lit(TOGETHER)).cast("int")
    each = spread.select(*names, F.explode(F.sequence(F.lit(1), times)).alias("_copy")).drop("_copy")
    return feature_vector(each.sortWithinPartitions(*names), features)


def fit_linear(train: DataFrame, features: Sequence[str], target: str):
    """Ordinary least squares with intercept."""
    return LinearRegression(
        featuresCol=_VECTOR, labelCol=target, regParam=0.0, solver="normal"
    ).fit(training_set(train, features, [target]))


def fit_forest_regressor(
    train: DataFrame,
    features: Sequence[str],
    target: str,
    trees: int = 100,
    depth: int | None = None,
    seed: int = 42,
) -> ExactForest:
    """Every split may use every feature and any cut of it. Trees grow until their leaves
    are pure, or to ``depth``."""
    return fit_exact_forest(train, features, target, trees, depth, seed)


def balanced_weights(train: DataFrame, label: str, weight: str = "_weight") -> DataFrame:
    """Weight rows / (classes * class rows), from the training rows. The counts are
    joined back, so there may be any number of classes; a null label is one."""
    counts = train.groupBy(F.col(label).alias("_class")).agg(F.count(F.lit(1)).alias("_n"))
    rows, classes = counts.agg(F.sum("_n"), F.count(F.lit(1))).first()
    share = F.lit(float(rows or 0)) / (F.lit(float(classes or 1)) * F.col("_n"))
    weights = counts.select("_class", share.alias(weight))
    return train.join(weights, F.col(label).eqNullSafe(F.col("_class")), "left").drop("_class")


def fit_forest_classifier(
    train: DataFrame,
    features: Sequence[str],
    label: str,
    trees: int = 200,
    depth: int = 6,
    seed: int = 42,
    bins: int = MAX_BINS,
):
    weighted = balanced_weights(train, label)
    model = RandomForestClassifier(
        featuresCol=_VECTOR,
        labelCol=label,
        weightCol="_weight",
        numTrees=trees,
        maxDepth=depth,
        maxBins=bins,
        seed=seed,
        maxMemoryInMB=_NODE_MEMORY_MB,
    ).fit(training_set(weighted, features, [label, "_weight"]))
    # A copy leaves out the training summary, which would travel to every task
    # and cannot once the session has observed a write.
    return model.copy()


def predict(model, df: DataFrame, features: Sequence[str], output: str = "predicted") -> DataFrame:
    if isinstance(model, ExactForest):
        return predict_exact(model, df, features, output)
    scored = model.transform(feature_vector(df, features))
    return scored.withColumn(output, F.col("prediction")).select(*df.columns, output)


def predict_probability(
    model, df: DataFrame, features: Sequence[str], probability: str, predicted: str
) -> DataFrame:
    """Probability of class 1 and predicted class for every row."""
    scored = model.transform(feature_vector(df, features))
    return scored.withColumns(
        {
            probability: vector_to_array("probability")[1],
            predicted: F.col("prediction").cast("int"),
        }
    ).select(*df.columns, probability, predicted)


def regression_metrics(
    df: DataFrame, model_name: str, actual: str = "actual", predicted: str = "predicted"
) -> DataFrame:
    gap = F.col(actual) - F.col(predicted)
    return df.agg(
        F.avg(F.abs(gap)).alias("mae"), F.sqrt(F.avg(gap * gap)).alias("rmse")
    ).select(F.lit(model_name).alias("model_name"), "mae", "rmse")


def accuracy(df: DataFrame, label: str, predicted: str) -> float | None:
    return df.agg(F.avg((F.col(label) == F.col(predicted)).cast("double"))).first()[0]


def roc_auc(df: DataFrame, label: str, score: str) -> float:
    """Exact area under the curve: every distinct score is its own threshold."""
    return BinaryClassificationEvaluator(
        rawPredictionCol=score, labelCol=label, metricName="areaUnderROC", numBins=0
    ).evaluate(df.select(F.col(label).cast("double").alias(label), F.col(score).cast("double").alias(score)))


def classifier_metrics(
    df: DataFrame,
    model_name: str,
    scores: tuple[float | None, float | None],
    label: str,
) -> DataFrame:
    """One line: name, accuracy, ROC-AUC, rows and positive rows of the whole table."""
    acc, auc = scores
    return df.agg(
        F.count(F.lit(1)).alias("rows_count"),
        F.coalesce(F.sum(F.col(label).cast("bigint")), F.lit(0)).cast("bigint").alias("positive_rows"),
    ).select(
        F.lit(model_name).alias("model_name"),
        F.lit(acc).cast("double").alias("accuracy"),
        F.lit(auc).cast("double").alias("roc_auc"),
        "rows_count",
        "positive_rows",
    )
