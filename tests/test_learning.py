from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from derrick.operators.isolation import fit_forest, isolation_scores, mean_path
from derrick.operators.models import (
    balanced_weights,
    fit_forest_regressor,
    fit_linear,
    predict,
    regression_metrics,
    roc_auc,
    training_set,
)
from derrick.operators.split import class_quotas, random_split, stratified_split
from derrick.plans import marts
from derrick.plans.failure_risk import train_failure_model
from derrick.plans.production_model import train_production_model


@pytest.fixture(scope="module")
def cloud(spark):
    """1,000 ordinary points and 10 far ones in four dimensions."""
    rng = np.random.default_rng(1)
    points = rng.normal(size=(1_000, 4)).tolist() + (rng.normal(size=(10, 4)) + 12).tolist()
    rows = [(i, *map(float, p)) for i, p in enumerate(points)]
    return spark.createDataFrame(rows, "i long, a double, b double, c double, d double").cache()


DIMS = ["a", "b", "c", "d"]


def test_mean_path():
    assert [mean_path(n) for n in (0, 1, 2)] == [0.0, 0.0, 1.0]
    assert mean_path(256) == pytest.approx(10.244, abs=1e-3)


def test_isolation_share_outliers_and_repeatability(cloud):
    runs = []
    for parts in (1, 8):
        out = isolation_scores(cloud.repartition(parts), DIMS, ["i"], trees=60)
        runs.append({r["i"]: (r["is_isolation_anomaly"], r["isolation_score"]) for r in out.collect()})
    assert runs[0].keys() == runs[1].keys()
    for i, (hit, score) in runs[0].items():
        assert runs[1][i] == (hit, pytest.approx(score, abs=1e-12))
    flagged = {i for i, (hit, _) in runs[0].items() if hit}
    assert len(flagged) in (50, 51)
    assert set(range(1_000, 1_010)) <= flagged
    assert all(score > 0 for hit, score in runs[0].values() if hit)
    assert {i for i, _ in sorted(runs[0].items(), key=lambda kv: -kv[1][1])[:10]} == set(
        range(1_000, 1_010)
    )


def test_dealt_samples_find_the_outliers_too(spark):
    """A rare draw: one hash deals each row to one of all trees, or to none."""
    df = spark.range(6_000).select(
        "id", *(F.rand(s).alias(c) for s, c in enumerate(DIMS))
    )
    far = spark.range(6_000, 6_030).select("id", *(F.lit(9.0).alias(c) for c in DIMS))
    both = df.unionByName(far).cache()
    out = isolation_scores(both, DIMS, ["id"], trees=8)
    flagged = out.filter("is_isolation_anomaly")
    assert flagged.filter("id >= 6000").count() == 30
    assert 250 <= flagged.count() <= 303


def test_forest_of_one_row_and_of_none(spark):
    one = spark.createDataFrame([(1, 2.0)], "i int, a double")
    assert isolation_scores(one, ["a"], ["i"], trees=3).count() == 1
    assert isolation_scores(one.filter("i > 1"), ["a"], ["i"], trees=3).count() == 0
    assert len(fit_forest(one, ["a"], ["i"], trees=3).feature) == 3


def test_quotas():
    assert class_quotas({0: 58, 1: 341}, 0.25) == {0: 15, 1: 85}
    assert class_quotas({"x": 4}, 0.2) == {"x": 1}


def test_random_split_is_exact_and_repeatable(spark):
    df = spark.range(728)
    marks = [
        {r["id"] for r in random_split(df.repartition(p), ["id"]).filter("is_test").collect()}
        for p in (1, 6)
    ]
    assert len(marks[0]) == 146 and marks[0] == marks[1]
    assert random_split(df.limit(0), ["id"]).count() == 0


def test_stratified_split(spark):
    df = spark.range(1_000).withColumn("y", (F.col("id") % 23 == 0).cast("int"))
    out = stratified_split(df, ["id"], "y").cache()
    assert out.count() == 1_000
    got = {(r["y"], r["is_test"]): r["count"] for r in out.groupBy("y", "is_test").count().collect()}
    assert got[1, True] + got[0, True] == 250
    assert got[1, True] == 11
    single = stratified_split(df.filter("y = 0"), ["id"], "y")
    assert single.filter("is_test").count() == 239
    with pytest.raises(ValueError):
        stratified_split(df, ["id"], "id", max_classes=100)


def test_splits_are_exact_with_repeated_keys(spark):
    same = spark.range(1_000).select(F.lit(7).alias("k"), (F.col("id") % 10).alias("v"))
    for parts in (1, 4):
        df = same.repartition(parts, "v")
        assert random_split(df, ["k"], 0.2).filter("is_test").count() == 200
        marked = stratified_split(df, ["k"], "v", 0.25)
        assert {r["count"] for r in marked.filter("is_test").groupBy("v").count().collect()} == {25}


def test_many_classes_need_no_cap(spark):
    df = spark.range(600).select("id", (F.col("id") % 150).alias("c"))
    assert stratified_split(df, ["id"], "c", 0.25).filter("is_test").count() == 150
    with pytest.raises(ValueError):
        stratified_split(df, ["id"], "c", 0.25, max_classes=149)


def test_one_model_on_any_number_of_partitions(spark):
    rng = np.random.default_rng(5)
    x = rng.uniform(size=(400, 3))
    y = (x[:, 0] > 0.5) * 3.0 + x[:, 1] * x[:, 2]
    rows = [(*map(float, v), float(t)) for v, t in zip(x, y)]
    df = spark.createDataFrame(rows, "a double, b double, c double, y double")
    got = []
    for parts in (2, 4, 8):
        model = fit_forest_regressor(df.repartition(parts), ["a", "b", "c"], "y", trees=5, depth=8)
        out = predict(model, df, ["a", "b", "c"]).orderBy("a").collect()
        got.append([r["predicted"] for r in out])
    assert got[0] == got[1] == got[2]


def test_incomplete_rows_have_no_isolation_score(cloud):
    gap = cloud.withColumn("a", F.when(F.col("i") == 3, F.lit(None)).otherwise(F.col("a")))
    gap = gap.withColumn("b", F.when(F.col("i") == 4, F.lit(float("nan"))).otherwise(F.col("b")))
    out = {r["i"]: r for r in isolation_scores(gap, DIMS, ["i"], trees=40).collect()}
    assert len(out) == 1_010
    for i in (3, 4):
        assert out[i]["isolation_score"] is None and out[i]["is_isolation_anomaly"] is False


def test_linear_model_matches_least_squares(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 3))
    y = x @ [1.5, -2.0, 0.5] + 4 + rng.normal(size=300)
    rows = [(*map(float, a), float(b)) for a, b in zip(x, y)]
    df = spark.createDataFrame(rows, "p double, q double, r double, y double")
    model = fit_linear(df, ["p", "q", "r"], "y")
    want, *_ = np.linalg.lstsq(np.column_stack([x, np.ones(300)]), y, rcond=None)
    assert list(model.coefficients) + [model.intercept] == pytest.approx(list(want), abs=1e-6)
    got = regression_metrics(predict(model, df, ["p", "q", "r"]), "m", "y").first()
    gap = y - (x @ want[:3] + want[3])
    assert got["mae"] == pytest.approx(np.abs(gap).mean())
    assert got["rmse"] == pytest.approx(np.sqrt((gap**2).mean()))


def test_equal_rows_burden_no_partition(spark):
    """Most rows are equal: all are there, dealt evenly, the same way from any partitions."""
    df = spark.range(26_000).select(F.when(F.col("id") < 25_000, 1.5).otherwise(F.col("id") % 400 + 0.5).alias("p"),
                                    (F.col("id") % 2).cast("double").alias("y"))
    got = []
    for parts in (2, 7):
        rows = training_set(df.repartition(parts), ["p"], ["y"])
        at = rows.groupBy(F.spark_partition_id().alias("at"), "p", "y").count().collect()
        got.append(sorted((r["at"], r["p"], r["y"], r["count"]) for r in at))
    assert got[0] == got[1]
    loads, values = {}, {}
    for at, p, y, n in got[0]:
        loads[at] = loads.get(at, 0) + n
        values[p, y] = values.get((p, y), 0) + n
    assert max(loads.values()) < 26_000 / 10
    assert values == {(r["p"], r["y"]): r["count"] for r in df.groupBy("p", "y").count().collect()}


def test_auc_counts_ties_half(spark):
    rows = [(1, 0.9), (0, 0.9), (1, 0.5), (0, 0.1), (0, 0.5), (1, 0.7)]
    pairs = [(p, n) for y, p in rows if y for z, n in rows if not z]
    want = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in pairs) / len(pairs)
    assert roc_auc(spark.createDataFrame(rows, "y int, s double"), "y", "s") == pytest.approx(want)


def test_weights_balance_classes(spark):
    df = spark.range(10).withColumn("y", (F.col("id") < 2).cast("int"))
    rows = balanced_weights(df, "y").groupBy("y").agg(F.sum("_weight")).collect()
    assert [r[1] for r in rows] == pytest.approx([5.0, 5.0])


def test_production_model(seed):
    made = train_production_model(marts.ml_dataset(seed["well_targets"]), trees=10, depth=6)
    assert made.predictions.columns == [
        "well_id", "production_date", "avg_pressure", "avg_temperature", "avg_power",
        "avg_pump_hours", "actual", "predicted", "error",
    ]
    assert made.predictions.count() == 146
    assert made.predictions.filter("abs(abs(actual - predicted) - error) > 1e-12").count() == 0
    metrics = {r["model_name"]: r for r in made.metrics.collect()}
    assert set(metrics) == {"LinearRegression", "RandomForest"}
    assert metrics["RandomForest"]["rmse"] < 5 and metrics["LinearRegression"]["mae"] < 10


def test_failure_model(seed):
    made = train_failure_model(seed["pump_sensors"], seed["pump_failures"], trees=60, depth=5)
    anomalies = made.anomalies.cache()
    assert anomalies.count() == 2912
    assert anomalies.filter("failure_next_7d = 1").count() == 128
    assert anomalies.filter("is_zscore_anomaly").count() == 112
    assert 140 <= anomalies.filter("is_isolation_anomaly").count() <= 146
    bounds = anomalies.agg(F.min("risk_score"), F.max("risk_score")).first()
    assert 0 <= bounds[0] <= bounds[1] <= 1
    daily = made.daily
    assert daily.count() == 728
    assert daily.agg(F.sum("anomalies_count")).first()[0] == anomalies.filter(
        "is_isolation_anomaly"
    ).count()
    m = made.metrics.first()
    assert (m["model_name"], m["rows_count"], m["positive_rows"]) == (
        "RandomForest failure risk", 2912, 128,
    )
    assert m["accuracy"] > 0.9 and m["roc_auc"] > 0.9


def test_without_failures_the_isolation_score_stands_in(seed):
    made = train_failure_model(
        seed["pump_sensors"], seed["pump_failures"].limit(0), trees=20, depth=3
    )
    m = made.metrics.first()
    assert (m["model_name"], m["accuracy"], m["roc_auc"], m["positive_rows"]) == (
        "Isolation fallback failure risk", None, None, 0,
    )
    low, high = made.anomalies.agg(
        F.min("failure_probability"), F.max("failure_probability")
    ).first()
    assert (low, high) == (0.0, 1.0)
