from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from derrick.operators import quantile
from derrick.operators.clean import fill_missing, filter_iqr, impute_median
from derrick.operators.quantile import column_sizes, exact_quantiles, order_statistics

PROBS = [0.0, 0.05, 0.25, 0.5, 0.75, 1.0]


@pytest.fixture(scope="module")
def skewed(spark):
    """10,000 continuous values, a third of the rows one value, some missing."""
    rng = np.random.default_rng(7)
    x = np.concatenate([rng.lognormal(3, 2, 10_000), np.full(5_000, 12.5)])
    rows = [(float(v), float(i % 7)) for i, v in enumerate(x)]
    rows += [(None, 1.0), (float("nan"), None)]
    return spark.createDataFrame(rows, "x double, y double").repartition(5).cache(), x


def test_sizes(skewed):
    df, x = skewed
    got = column_sizes(df, ["x", "y"])
    assert (got["x"].rows, got["x"].missing, got["y"].missing) == (len(x), 2, 1)


def test_quantiles_are_exact(skewed):
    df, x = skewed
    got = exact_quantiles(df, ["x", "y"], PROBS)
    assert got["x"] == pytest.approx(list(np.quantile(x, PROBS)), rel=1e-12)
    y = [i % 7 for i in range(len(x))] + [1]
    assert got["y"] == pytest.approx(list(np.quantile(y, PROBS)))


@pytest.mark.parametrize("cells", [2, 4096])
def test_ranks_are_exact_however_fine_the_cells(skewed, monkeypatch, cells):
    df, x = skewed
    monkeypatch.setattr(quantile, "CELLS", cells)
    ranks = [0, 100, 4_999, 7_500, len(x) - 1]
    assert order_statistics(df, {"x": ranks})["x"] == {r: np.sort(x)[r] for r in ranks}
    with pytest.raises(IndexError):
        order_statistics(df, {"x": [len(x)]})


def test_extreme_values(spark):
    x = [-math.inf, -1.7e308, -5e-324, -0.0, 0.0, 5e-324, 1.0, 1.0, 1.7e308, math.inf]
    df = spark.createDataFrame([(v,) for v in x], "x double").repartition(3)
    got = order_statistics(df, {"x": range(len(x))})["x"]
    assert [got[i] for i in range(len(x))] == x
    found = quantile.places(df, ["x"], lambda c, rows: [7]).at["x"][7]
    assert (found.value, found.below, found.equal) == (1.0, 6, 2)


def test_empty_and_valueless_columns(spark):
    df = spark.createDataFrame([(None, 1.0)], "a double, b double")
    assert exact_quantiles(df, ["a", "b"], [0.5]) == {"a": [None], "b": [1.0]}
    assert exact_quantiles(df.filter("b > 1"), ["b"], [0.25, 0.75]) == {"b": [None, None]}


def test_impute(spark):
    df = spark.createDataFrame(
        [(1.0, None, 5.0), (None, None, 6.0), (float("nan"), None, 7.0), (4.0, None, 8.0)],
        "a double, b double, c double",
    )
    out = impute_median(df, ["a", "b", "c", "absent"])
    assert [r["a"] for r in out.collect()] == [1.0, 2.5, 2.5, 4.0]
    assert [r["b"] for r in out.collect()] == [None] * 4
    assert out.select("c").collect() == df.select("c").collect()


def test_iqr_is_sequential_and_passes_missing(spark):
    rows = [(float(i % 10), float(i)) for i in range(100)] + [(1e6, 5.0), (None, 5.0), (float("nan"), 5.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    left = filter_iqr(df, ["a", "b", "absent"])
    assert left.count() == 102
    assert left.filter("a is null or isnan(a)").count() == 2


def test_second_column_sees_survivors_only(spark):
    # b's outlier row leaves with a, which narrows b and drops one more row.
    a = [1.0, 1.1, 1.2, 1.3, 1.4, 1.5, 1.6, 99.0, 99.0]
    b = [1.0, 1.1, 1.2, 1.3, 1.4, 1.5, 2.4, 9.0, 9.0]
    df = spark.createDataFrame(list(zip(a, b)), "a double, b double")

    def numpy_filter(rows, cols):
        for c in cols:
            q1, q3 = np.quantile(rows[:, c], [0.25, 0.75])
            reach = 1.5 * (q3 - q1)
            rows = rows[(rows[:, c] >= q1 - reach) & (rows[:, c] <= q3 + reach)]
        return len(rows)

    data = np.array(list(zip(a, b)))
    assert filter_iqr(df, ["a", "b"]).count() == numpy_filter(data, [0, 1])
    assert filter_iqr(df, ["b", "a"]).count() == numpy_filter(data, [1, 0])


def test_constant_column_keeps_all(spark):
    df = spark.range(10).select(F.lit(3.0).alias("a"))
    assert filter_iqr(df, ["a"]).count() == 10


def test_bounds_reach_the_scan(spark, tmp_path):
    spark.range(100).select(F.col("id").cast("double").alias("a"), "id").write.parquet(
        str(tmp_path / "t")
    )
    plan = filter_iqr(spark.read.parquet(str(tmp_path / "t")), ["a"])._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(a," in plan and "LessThanOrEqual(a," in plan


def test_fill_missing(spark):
    df = spark.createDataFrame([(None, 1.0), (float("nan"), 2.0)], "a double, b double")
    assert [r["a"] for r in fill_missing(df, ["a"]).collect()] == [0.0, 0.0]
