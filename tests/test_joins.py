from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from derrick.functions import to_day
from derrick.operators.joins import (
    attach_events,
    calendar_grid,
    date_spine,
    interval_exists,
    pre_event_label,
)

T = dt.datetime


@pytest.fixture(scope="module")
def events(spark):
    rows = [("a", T(2024, 2, 15, 8)), ("a", T(2024, 2, 18, 20)), ("c", T(2024, 3, 1, 0))]
    return spark.createDataFrame(rows, "pump string, at timestamp_ntz")


def readings(spark, rows):
    return spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)], "i int, pump string, ts timestamp_ntz"
    ).withColumn("day", to_day("ts"))


def test_day_rule_at_its_edges(spark, events):
    df = readings(
        spark,
        [
            ("a", T(2024, 2, 7, 23)),  # 8 days before the first
            ("a", T(2024, 2, 8, 0)),  # 7 days before
            ("a", T(2024, 2, 15, 23)),  # same day, after the hour
            ("a", T(2024, 2, 16, 1)),  # in both windows' union
            ("a", T(2024, 2, 19, 0)),  # after the last
            ("b", T(2024, 2, 15, 8)),  # another pump
        ],
    )
    out = pre_event_label(df, events, "pump", "day", "at", "y")
    assert [r["y"] for r in out.orderBy("i").collect()] == [0, 1, 1, 1, 0, 0]


def test_time_rule_at_its_edges(spark, events):
    df = readings(
        spark,
        [
            ("a", T(2024, 2, 8, 7, 59, 59)),
            ("a", T(2024, 2, 8, 8)),
            ("a", T(2024, 2, 15, 8)),
            ("a", T(2024, 2, 18, 20)),
            ("a", T(2024, 2, 18, 20, 0, 1)),
            ("c", T(2024, 3, 1, 0)),
            ("c", T(2024, 2, 23, 0)),
            ("c", T(2024, 2, 22, 23, 59)),
            ("b", T(2024, 2, 15, 8)),
        ],
    )
    out = interval_exists(df, events, "pump", "ts", "at", "hit").orderBy("i").collect()
    assert [r["hit"] for r in out] == [False, True, True, True, False, True, True, False, False]


@pytest.mark.parametrize("days", [1, 2, 7])
def test_time_rule_against_brute_force(spark, days):
    rng = random.Random(days)
    start = T(2024, 1, 1)
    ev = [(f"p{rng.randrange(3)}", start + dt.timedelta(minutes=rng.randrange(60 * 24 * 60))) for _ in range(12)]
    rd = [(f"p{rng.randrange(4)}", start + dt.timedelta(minutes=rng.randrange(60 * 24 * 60))) for _ in range(400)]
    df = readings(spark, rd)
    events = spark.createDataFrame(ev, "pump string, at timestamp_ntz")
    out = interval_exists(df, events, "pump", "ts", "at", "hit", days).orderBy("i").collect()
    span = dt.timedelta(days=days)
    assert [r["hit"] for r in out] == [
        any(p == q and e - span <= t <= e for q, e in ev) for p, t in rd
    ]
    with pytest.raises(ValueError):
        interval_exists(df, events, "pump", "ts", "at", "hit", 0)


def test_labels_never_multiply_rows(spark, events):
    df = readings(spark, [("a", T(2024, 2, 14, h)) for h in range(10)])
    many = events.unionAll(events).unionAll(events)
    assert pre_event_label(df, many, "pump", "day", "at", "y").count() == 10
    assert interval_exists(df, many, "pump", "ts", "at", "hit").count() == 10


def test_events_fan_out(spark, events):
    daily = spark.createDataFrame(
        [("a", dt.date(2024, 2, 16)), ("b", dt.date(2024, 2, 16))], "pump string, date date"
    )
    out = attach_events(daily, events, ["pump"], event_ts="at")
    rows = {(r["pump"], r["days_before_failure"]): r for r in out.collect()}
    assert set(rows) == {("a", -1), ("a", 2), ("b", None)}
    assert [rows[k]["failure_window_7d"] for k in (("a", -1), ("a", 2), ("b", None))] == [
        False, True, False,
    ]
    assert [rows[k]["has_failure"] for k in (("a", -1), ("b", None))] == [True, False]


def test_grid_and_spine(spark):
    wells = spark.range(3).withColumnRenamed("id", "well_id")
    first, last = F.lit(dt.date(2024, 2, 28)), F.lit(dt.date(2024, 3, 1))
    grid = calendar_grid(wells, first, last, (0, 12))
    assert grid.count() == 3 * 3 * 2
    assert "Join" not in grid._jdf.queryExecution().toString()
    bounds = spark.createDataFrame(
        [("x", dt.date(2024, 1, 1), dt.date(2024, 1, 3))], "k string, low date, high date"
    )
    assert [str(r["day"]) for r in date_spine(bounds, "low", "high").collect()] == [
        "2024-01-01", "2024-01-02", "2024-01-03",
    ]
