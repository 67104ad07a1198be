from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from derrick.operators.aggregates import daily_targets, group_means, group_sums, service_kpi
from derrick.operators.quality import check_foreign_key, check_table, check_unique
from derrick.operators.scoring import minmax_score, risk_score, zscore, zscore_flags
from derrick.schemas import TABLES


def test_zscore_uses_population_std_and_survives_constants(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (None, 5.0)], "a double, b double")
    rows = zscore(df, ["a", "b"]).collect()
    assert [r["a_zscore"] for r in rows] == [-1.0, 1.0, None]
    assert [r["b_zscore"] for r in rows] == [0.0, 0.0, 0.0]
    one = zscore(df.limit(1), ["a"]).first()
    assert one["a_zscore"] == 0.0
    assert zscore(df.filter("b > 9"), ["a"]).count() == 0


def test_flag_is_strict_and_skips_missing(spark):
    df = spark.createDataFrame([(float(i), None) for i in range(5)], "a double, b double")
    out = zscore_flags(df, ["a", "b"], threshold=2**0.5).orderBy("a").collect()
    assert out[4]["zscore_max"] == pytest.approx(2**0.5)
    assert [r["is_zscore_anomaly"] for r in out] == [False] * 5


def test_minmax(spark):
    df = spark.createDataFrame([(2.0,), (4.0,), (6.0,)], "x double")
    assert [r["s"] for r in minmax_score(df, "x", "s").collect()] == [0.0, 0.5, 1.0]
    flat = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    assert [r["s"] for r in minmax_score(flat, "x", "s").collect()] == [None, None]
    assert minmax_score(df.filter("x > 9"), "x", "s").count() == 0


def test_risk_score_stays_in_range(spark):
    df = spark.createDataFrame(
        [(1.0, True, 4.0), (0.0, False, 2.0), (9.0, True, 4.0), (None, False, 1.0)],
        "failure_probability double, is_isolation_anomaly boolean, zscore_max double",
    )
    got = [r["risk_score"] for r in risk_score(df).collect()]
    assert got[:3] == [pytest.approx(1.0), pytest.approx(0.15), 1.0] and got[3] is None


def test_group_sums_and_means_with_missing(spark):
    df = spark.createDataFrame([(1, None), (2, 1.0), (2, float("nan"))], "k int, x double")
    assert {r["k"]: r["s"] for r in group_sums(df, ["k"], {"s": "x"}).collect()} == {1: 0.0, 2: 1.0}
    assert {r["k"]: r["m"] for r in group_means(df, ["k"], {"m": "x"}).collect()} == {1: None, 2: 1.0}


def test_kpi_is_a_mean_of_ratios(spark):
    df = spark.createDataFrame([("d", 10.0, 1.0), ("d", 10.0, 10.0), ("d", 5.0, 0.0)], "k string, c double, u double")
    row = service_kpi(df, "k", {}, {}, {"per": ("c", "u")}, {"all": "c"}).first()
    assert (row["deliveries_count"], row["per"], row["all"]) == (3, 5.5, 25.0)


def test_daily_targets_match_join_then_group(spark):
    day = dt.date(2024, 1, 1)
    made = spark.createDataFrame([(1, day, 5.0), (1, day, 5.0), (1, day, 6.0)], "w int, d date, oil double")
    read = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 1, h), float(h)) for h in (0, 6, 12)], "w int, ts timestamp_ntz, x double"
    )
    got = daily_targets(made, read, "w", "d", "ts", "oil", {"m": "x"}, {"s": "x"})
    joined = made.join(read.withColumn("d", F.to_date("ts")), ["w", "d"])
    want = joined.groupBy("w", "d", "oil").agg(F.avg("x").alias("m"), F.sum("x").alias("s"))
    assert sorted(got.collect()) == sorted(want.collect())


@pytest.fixture(scope="module")
def wells(spark):
    rows = [
        (1, "W1", "f", "r", dt.date(2020, 1, 1), 100, "active"),
        (1, "W1", "f", "r", dt.date(2020, 1, 1), 0, "asleep"),
        (2, None, "f", "r", None, -5, None),
    ]
    return spark.createDataFrame(rows, TABLES["wells"].ddl)


def test_well_rules(wells):
    got = {
        (r["rule"], r["column_name"]): r["violations"]
        for r in check_table(wells, TABLES["wells"]).collect()
    }
    assert got["range", "depth_m"] == 2
    assert got["allowed", "status"] == 1
    assert got["not_null", "status"] == 1 and got["not_null", "start_date"] == 1
    assert got["unique", "well_id"] == 1 and got["unique", "well_name"] == 1
    assert got["not_null", "well_id"] == 0


def test_foreign_key_counts_rows_and_ignores_null(spark, wells):
    child = spark.createDataFrame([(1,), (9,), (9,), (None,)], "well_id int")
    got = check_foreign_key(child, "t", "well_id", wells, "well_id").first()
    assert got["violations"] == 2
    none = check_foreign_key(child.filter("well_id = 1"), "t", "well_id", wells, "well_id")
    assert none.first()["violations"] == 0
    assert check_unique(child, "t", ["well_id"]).first()["violations"] == 1
