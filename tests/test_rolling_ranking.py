from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from derrick.operators.ranking import dense_row_id, top_n
from derrick.operators.rolling import rolling_mean


@pytest.fixture(scope="module")
def readings(spark):
    rng = random.Random(3)
    rows = [("hot", i, None if i % 11 == 0 else rng.random() * 100) for i in range(700)]
    rows += [(f"p{i % 5}", i, rng.random()) for i in range(200)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "pump string, ts int, x double").repartition(7).cache()


def brute(rows, width):
    out, groups = {}, {}
    for p, t, x in rows:
        groups.setdefault(p, []).append((t, x))
    for p, g in groups.items():
        g.sort()
        for i, (t, _) in enumerate(g):
            frame = [x for _, x in g[max(0, i - width + 1) : i + 1] if x is not None]
            out[p, t] = sum(frame) / len(frame) if frame else None
    return out


@pytest.mark.parametrize("limit,width", [(10**6, 24), (100, 24), (30, 24), (5, 24), (100, 1)])
def test_rolling_mean(readings, limit, width):
    rolled = rolling_mean(readings, ["pump"], ["ts"], {"m": "x"}, width, max_entity_rows=limit)
    got = {(r["pump"], r["ts"]): r["m"] for r in rolled.collect()}
    want = brute([tuple(r) for r in readings.collect()], width)
    assert rolled.count() == 900 and rolled.columns == ["pump", "ts", "x", "m"]
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert got[k] == (pytest.approx(v) if v is not None else None)


def test_rolling_ties_and_null_entities_are_the_same_at_any_limit(spark):
    rows = [(None if i % 3 else "p", i // 4, float(i * 37 % 101)) for i in range(200)]
    df = spark.createDataFrame(rows, "pump string, ts int, x double")
    runs = [
        sorted(map(str, rolling_mean(df.repartition(n), ["pump"], ["ts"], {"m": "x"}, 5, limit).collect()))
        for n, limit in ((1, 10**6), (5, 10**6), (3, 40))
    ]
    assert runs[0] == runs[1] == runs[2]


def test_dense_id_equals_row_number(spark, readings):
    numbered = dense_row_id(readings, ["pump", "ts"])
    plain = readings.withColumn("want", F.row_number().over(Window.orderBy("pump", "ts")))
    both = numbered.join(plain, ["pump", "ts"])
    assert both.filter("id = want").count() == 900


def test_dense_id_of_one_hot_value(spark):
    """A third of the rows are the same; ids stay dense and spread over tasks."""
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), "id")
    got = dense_row_id(df, ["k"], "n", start=10).select("n", "k").orderBy("n").collect()
    assert [r["n"] for r in got] == list(range(10, 3010))
    ks = [r["k"] for r in got]
    assert ks == sorted(ks)


def test_dense_id_puts_nulls_last(spark):
    df = spark.createDataFrame([(2,), (None,), (1,)], "k int")
    assert [r["k"] for r in dense_row_id(df, ["k"]).orderBy("id").collect()] == [1, 2, None]


def test_dense_id_of_nothing(spark):
    assert dense_row_id(spark.range(0), ["id"], "n").count() == 0


def test_top_n_nulls_and_ties(spark):
    df = spark.createDataFrame(
        [(1, 5.0), (2, None), (3, 5.0), (4, 1.0), (5, 5.0), (6, 2.0)], "k int, x double"
    )
    assert [r["k"] for r in top_n(df, "x", ["k"], 3).collect()] == [2, 1, 3]
    assert [r["k"] for r in top_n(df, "x", ["k"], 3, largest=False).collect()] == [4, 6, 1]
    assert "TakeOrderedAndProject" in top_n(df, "x", ["k"])._jdf.queryExecution().toString()
