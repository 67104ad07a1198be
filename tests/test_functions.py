from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from derrick.functions import (
    add_hours,
    band,
    clamp,
    date_parts,
    days_until,
    in_range_or_false,
    parse_timestamp,
    per_unit,
    round_exact,
    round_half_even,
    round_half_up,
    row_max_abs,
    to_day,
)


@pytest.fixture(scope="module")
def values(spark):
    def run(column, xs, type_="double"):
        df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], f"i int, x {type_}")
        rows = df.select("i", column(F.col("x")).alias("y")).collect()
        return [r["y"] for r in sorted(rows, key=lambda r: r["i"])]

    return run


def test_half_up_goes_away_from_zero(values):
    xs = [0.285, 1.005, 2.675, -2.675, 0.125, 70.975, 123456789.125, 0.0049, -0.0, 1e13 + 0.25]
    assert values(round_half_up, xs) == [
        0.29, 1.01, 2.68, -2.68, 0.13, 70.98, 123456789.13, 0.0, 0.0, 1e13 + 0.25,
    ]
    assert math.copysign(1, values(round_half_up, [-0.001])[0]) == 1
    assert values(lambda c: round_half_up(c, 0), [0.5, 1.5, 2.5, -0.5]) == [1.0, 2.0, 3.0, -1.0]


def test_half_up_of_large_values(values):
    xs = [2e11, 1e12 + 0.125, 1e13 + 0.125, 1e14, 1e14 + 0.5, 1e30]
    assert values(lambda c: round_half_up(c, 4), xs[:1]) == [2e11]
    assert values(round_half_up, xs) == [2e11, 1e12 + 0.13, 1e13 + 0.13, 1e14, 1e14 + 0.5, 1e30]


def test_decimals_are_rounded_as_decimals(spark):
    df = spark.sql("select cast('90000000000000000.125' as decimal(22,3)) as x union all select 0.010")
    out = df.select(round_exact(df, F.sum("x"), "x").alias("y")).first()["y"]
    assert str(out) == "90000000000000000.14"


def test_half_up_of_missing(values):
    assert values(round_half_up, [None, float("nan")]) == [None, None]


def test_half_even_goes_to_the_even_neighbour(values):
    assert values(lambda c: round_half_even(c, 0), [0.5, 1.5, 2.5]) == [0.0, 2.0, 2.0]
    assert values(round_half_even, [0.125, 0.375, 2.0833333]) == [0.12, 0.38, 2.08]


def test_clamp_keeps_missing(values):
    assert values(clamp, [-1.0, 0.5, 7.0, None, float("nan")]) == [0.0, 0.5, 1.0, None, None]


def test_band_sends_null_to_the_last_group(values):
    got = values(lambda c: band(c, [(90, "low"), (110, "medium")], "high"), [89.9, 90.0, 110.0, None])
    assert got == ["low", "medium", "high", "high"]


def test_range_flag_is_never_null(values):
    got = values(lambda c: in_range_or_false(c, 0, 7), [-1.0, 0.0, 7.0, 8.0, None])
    assert got == [False, True, True, False, False]


def test_per_unit_guards_zero(spark):
    df = spark.createDataFrame([(10.0, 4.0), (1.0, 0.0), (1.0, None)], "a double, b double")
    assert [r[0] for r in df.select(per_unit("a", "b")).collect()] == [2.5, None, None]


def test_row_max_skips_missing(spark):
    df = spark.createDataFrame(
        [(1.0, -3.0), (None, 2.0), (float("nan"), -1.0), (None, None)], "a double, b double"
    )
    assert [r[0] for r in df.select(row_max_abs(["a", "b"])).collect()] == [3.0, 2.0, 1.0, None]


def test_dates(spark):
    ts = dt.datetime(2024, 3, 5, 8, 0)
    df = spark.createDataFrame([(ts, dt.date(2024, 3, 6))], "ts timestamp_ntz, d date")
    row = df.select(
        to_day("ts").alias("day"),
        add_hours("d", F.lit(18)).alias("later"),
        days_until("d", "ts").alias("before"),
        *(c.alias("part" if n == "day" else n) for n, c in date_parts("ts").items()),
    ).first()
    assert row["day"] == dt.date(2024, 3, 5)
    assert row["later"] == dt.datetime(2024, 3, 6, 18)
    assert row["before"] == -1  # 16 hours before midnight, floored
    assert (row["year"], row["month"], row["part"]) == (2024, "03", "05")


def test_parsing(spark, values):
    lenient = values(lambda c: parse_timestamp(c, strict=False), ["2024-02-30", "2024-02-29"], "string")
    assert lenient == [None, dt.datetime(2024, 2, 29)]
    with pytest.raises(Exception):
        values(parse_timestamp, ["no date"], "string")
