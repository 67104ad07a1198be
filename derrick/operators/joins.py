"""Joins with event logs, dimensions and calendars."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from derrick.functions import days_until, in_range_or_false, micros, to_day

def attach_dimension(fact: DataFrame, dimension: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join of a fact with attributes; no hint, so Catalyst broadcasts the
    dimension only if its measured size allows."""
    return fact.join(dimension, list(on), "left")


def event_days(events: DataFrame, entity: str, event_ts: str, days: int, day: str) -> DataFrame:
    """Distinct (entity, day) with an event on that day or within ``days`` after it."""
    return (
        events.select(entity, to_day(event_ts).alias("_last"))
        .distinct()
        .select(
            entity,
            F.explode(F.sequence(F.date_sub("_last", days), F.col("_last"))).alias(day),
        )
        .distinct()
    )


def pre_event_label(
    readings: DataFrame,
    events: DataFrame,
    entity: str,
    day: str,
    event_ts: str,
    label: str,
    days: int = 7,
) -> DataFrame:
    """1 where the entity has an event on the reading's day or in the ``days``
    days after it, else 0.

    Every event is spread over its days and made distinct, so the range test
    becomes a plain equi-join that never multiplies readings.
    """
    marks = event_days(events, entity, event_ts, days, day).withColumn("_hit", F.lit(1))
    joined = readings.join(marks, [entity, day], "left")
    return joined.withColumn(label, F.coalesce("_hit", F.lit(0))).drop("_hit")


def interval_exists(
    readings: DataFrame,
    events: DataFrame,
    entity: str,
    ts: str,
    event_ts: str,
    flag: str,
    days: float = 7,
    span: timedelta | None = None,
) -> DataFrame:
    """True where ``event_ts - span <= ts <= event_ts`` for some event of the entity; the
    span is ``days`` times 24 hours unless it is given, and may be of any length.

    Time is cut into bins as long as the span. A reading in bin b is covered by an event of
    its own bin that is not earlier, or by one of the next bin at most a span later, and by
    no other. So the latest event of a bin and the earliest of the next say everything:
    one row per (entity, bin) with events, however long the span or many the events, and one
    equi-join on unique keys that never multiplies readings.
    """
    length = (timedelta(days=days) if span is None else span) // timedelta(microseconds=1)
    if length <= 0:
        raise ValueError("the span must be positive")
    bin_of = F.expr(f"(_at - pmod(_at, {length}L)) div {length}L")
    happened = events.select(F.col(entity), micros(events, event_ts).alias("_at")).filter("_at IS NOT NULL").withColumn("_bin", bin_of)
    none = F.lit(None).cast("long")
    ends = happened.groupBy(entity, "_bin").agg(F.min("_at").alias("_first"), F.max("_at").alias("_last"))
    here = ends.select(entity, "_bin", "_last", none.alias("_next"))
    before = ends.select(entity, (F.col("_bin") - 1).alias("_bin"), none.alias("_last"), F.col("_first").alias("_next"))
    cover = here.unionByName(before).groupBy(entity, "_bin").agg(F.max("_last").alias("_last"), F.min("_next").alias("_next"))
    hit = (F.col("_at") <= F.col("_last")) | (F.col("_next") - F.col("_at") <= F.lit(length))
    return (
        readings.withColumn("_at", micros(readings, ts))
        .withColumn("_bin", bin_of)
        .join(cover, [entity, "_bin"], "left")
        .withColumn(flag, F.coalesce(hit, F.lit(False)))
        .select(*readings.columns, flag)
    )


def attach_events(
    daily: DataFrame,
    events: DataFrame,
    on: Sequence[str],
    day: str = "date",
    event_ts: str = "failure_date",
    window_days: int = 7,
    max_events: int = 10_000,
) -> DataFrame:
    """Left join with fan-out: one row per day and event of the same entity.

    The output has days x events rows per entity, as this join is defined. An entity with
    more than ``max_events`` events is dealt to slices of about so many, by a hash of the event,
    and its days are copied to each slice: no task makes more than days x ``max_events``
    rows of one entity, which splitting one side at run time cannot bring about.
    ``days_before_failure`` counts whole days to the event (negative after it),
    ``failure_window_7d`` marks 0..window_days of them, ``has_failure`` a match.
    """
    before = days_until(day, event_ts)
    heavy = events.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > max_events)
    heavy = heavy.select(*on, F.ceil(F.col("_n") / max_events).cast("int").alias("_slices"))
    slices = F.coalesce("_slices", F.lit(1))
    days = daily.join(heavy, list(on), "left").withColumn("_slice", F.explode(F.sequence(F.lit(0), slices - 1)))
    dealt = events.join(heavy, list(on), "left").withColumn("_slice", F.pmod(F.xxhash64(*events.columns), slices).cast("int"))
    dealt = dealt.drop("_slices").withColumn("_met", F.lit(True))
    joined = days.join(dealt, [*on, "_slice"], "left")
    # An entity with slices has events, so a slice of it without one says nothing.
    joined = joined.filter(F.col("_met") | F.col("_slices").isNull())
    columns = [*daily.columns, *(c for c in events.columns if c not in on)]
    return joined.select(*columns).withColumns(
        {
            "days_before_failure": before,
            f"failure_window_{window_days}d": in_range_or_false(before, 0, window_days),
            "has_failure": F.col(event_ts).isNotNull(),
        }
    )


def date_spine(bounds: DataFrame, low: str, high: str, name: str = "day") -> DataFrame:
    """One row per day from ``low`` to ``high`` for every row of ``bounds``."""
    return bounds.withColumn(name, F.explode(F.sequence(F.col(low), F.col(high)))).drop(low, high)


def calendar_grid(
    entities: DataFrame,
    first_day: Column,
    last_day: Column,
    hours: Sequence[int],
    day: str = "day",
    hour: str = "hour_step",
) -> DataFrame:
    """Every entity on every day at every given hour.

    Each entity generates its own rows in place: no join and no shuffle.
    """
    return entities.withColumn(day, F.explode(F.sequence(first_day, last_day))).withColumn(
        hour, F.explode(F.array(*map(F.lit, hours)))
    )
