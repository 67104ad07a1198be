"""Row-level expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from derrick.functions import (
    add_hours,
    clamp,
    date_parts,
    days_until,
    parse_timestamp,
    per_unit,
    round_half_even,
    round_half_up,
    row_max_abs,
)
from querybook import roles
from querybook.book import day, moment, even, plain, query, r, table
from querybook.roles import with_roles


@query(
    "simple_case",
    with_roles(
        "wells",
        "SELECT region, status, count(*) AS wells_count, min(depth_m) AS min_depth "
        "FROM wells GROUP BY 1, 2",
    ),
)
def simple_case(spark, d):
    return plain(
        roles.wells(spark, d)
        .groupBy("region", "status")
        .agg(F.count(F.lit(1)).alias("wells_count"), F.min("depth_m").alias("min_depth"))
    )


@query(
    "scalar_funcs",
    f"""SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber,
        {r('l_extendedprice * l_tax', 2)} AS half_up,
        {even('l_extendedprice * l_discount')} AS half_even,
        {r('l_extendedprice / nullif(l_discount, 0)', 2)} AS guarded,
        {r('greatest(abs(l_discount - l_tax), abs(l_quantity - 25))')} AS widest,
        {r('least(greatest(l_quantity / 24, 0), 1)')} AS clamped,
        {r('sin(dayofyear(l_shipdate) / 6.0::DOUBLE) + cos(dayofyear(l_shipdate) / 8.0::DOUBLE)')}
            AS wave,
        l_partkey % 11 AS remainder,
        concat('L-', lpad(CAST(l_linenumber AS VARCHAR), 3, '0')) AS label,
        dayofmonth(l_shipdate)::BIGINT AS month_day,
        {day('CAST(l_shipdate AS DATE) + CAST(l_linenumber AS INTEGER)')} AS later_day,
        {moment("l_shipdate - INTERVAL 7 DAY")} AS week_before,
        hour(CAST(l_shipdate AS DATE) + to_hours(CAST(l_linenumber AS INTEGER)))::BIGINT
            AS hour_of_day,
        date_diff('day', DATE '1998-01-01', CAST(l_shipdate AS DATE))::BIGINT AS days_after,
        year(l_shipdate)::BIGINT AS year, strftime(l_shipdate, '%m') AS month,
        strftime(l_shipdate, '%d') AS day,
        {moment("try_cast(concat('2024-0', CAST(l_linenumber AS VARCHAR), '-', CAST((25 + l_linenumber) AS VARCHAR), ' 10:00:00') AS TIMESTAMP)")} AS parsed
        FROM lineitem""",
)
def scalar_funcs(spark, d):
    ship, line = F.col("l_shipdate"), F.col("l_linenumber")
    doy = F.dayofyear(ship)
    text = F.concat(
        F.lit("2024-0"), line.cast("string"), F.lit("-"), (25 + line).cast("string"), F.lit(" 10:00:00")
    )
    parts = date_parts(ship)
    df = table(spark, d, "lineitem").select(
        "l_orderkey",
        line.cast("bigint").alias("l_linenumber"),
        round_half_up(F.col("l_extendedprice") * F.col("l_tax")).alias("half_up"),
        round_half_even(F.col("l_extendedprice") * F.col("l_discount")).alias("half_even"),
        round_half_up(per_unit("l_extendedprice", "l_discount")).alias("guarded"),
        round_half_up(
            row_max_abs([F.col("l_discount") - F.col("l_tax"), F.col("l_quantity") - 25]), 4
        ).alias("widest"),
        round_half_up(clamp(F.col("l_quantity") / 24), 4).alias("clamped"),
        round_half_up(F.sin(doy / F.lit(6.0)) + F.cos(doy / F.lit(8.0)), 4).alias("wave"),
        (F.col("l_partkey") % 11).alias("remainder"),
        F.concat(F.lit("L-"), F.lpad(line.cast("string"), 3, "0")).alias("label"),
        F.dayofmonth(ship).cast("bigint").alias("month_day"),
        F.date_add(F.to_date(ship), line).alias("later_day"),
        (ship - F.expr("interval 7 days")).alias("week_before"),
        F.hour(add_hours(F.to_date(ship), line)).cast("bigint").alias("hour_of_day"),
        days_until(F.lit("1998-01-01").cast("date"), ship).cast("bigint").alias("days_after"),
        *(c.alias(n) for n, c in parts.items()),
        parse_timestamp(text, strict=False).alias("parsed"),
    )
    return plain(df)
