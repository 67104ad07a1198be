"""Dense row ids and top-n without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from derrick.sources.scratch import materialize

# monotonically_increasing_id keeps the row's place in its partition in the low
# 33 bits and the partition number above them.
_PLACE_BITS = 33


def _sort_key(c: Column | str) -> Column:
    return F.col(c).asc_nulls_last() if isinstance(c, str) else c


def dense_row_id(
    df: DataFrame,
    order_by: Sequence[Column | str],
    id_column: str = "id",
    start: int = 1,
) -> DataFrame:
    """``ROW_NUMBER() OVER (ORDER BY ...)`` as a distributed sort.

    Rows are range-partitioned and sorted once, written with their place in
    their partition, and read back with the rows of all earlier partitions added.
    Ties are broken by a hash of the whole row and then by the input partition,
    so that one hot key value still spreads over many tasks. Writing first is
    what makes it safe: a range sort that is run again may cut differently.
    """
    tie = {"_row_hash": F.xxhash64(*df.columns), "_from": F.spark_partition_id()}
    keys = [*map(_sort_key, order_by), *map(F.col, tie)]
    placed = (
        df.withColumns(tie)
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .select(*df.columns, F.monotonically_increasing_id().alias("_place"))
    )
    written = materialize(placed, "dense-id").select(
        *df.columns,
        F.shiftright("_place", _PLACE_BITS).cast("int").alias("_part"),
        F.col("_place").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)).alias("_place"),
    )
    # One line per written partition, a number fixed by the shuffle settings.
    sizes = written.groupBy("_part").agg(F.count(F.lit(1)).alias("rows")).collect()
    offsets, before = [], start
    for part, rows in sorted((r["_part"], r["rows"]) for r in sizes):
        offsets.append((part, before))
        before += rows
    spark = df.sparkSession
    table = spark.createDataFrame(offsets, "_part int, _before bigint")
    return written.join(F.broadcast(table), "_part").select(
        (F.col("_before") + F.col("_place")).alias(id_column), *df.columns
    )


def top_n(
    df: DataFrame, measure: str, key: Sequence[str], n: int = 5, largest: bool = True
) -> DataFrame:
    """First n rows by a measure: descending puts nulls first, ascending last;
    equal measures are ordered by the key."""
    order = F.col(measure).desc_nulls_first() if largest else F.col(measure).asc_nulls_last()
    return df.orderBy(order, *(F.col(k).asc_nulls_last() for k in key)).limit(n)
