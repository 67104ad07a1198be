"""Rolling means over a fixed number of rows per entity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from derrick.functions import valid
from derrick.operators.ranking import dense_row_id
from derrick.sources.scratch import materialize

# An entity with more rows than this is cut into stretches.
MAX_ENTITY_ROWS = 5_000_000


def rolling_mean(
    df: DataFrame,
    entity: Sequence[str],
    order_by: Sequence[str],
    outputs: Mapping[str, str],
    rows: int = 24,
    max_entity_rows: int = MAX_ENTITY_ROWS,
) -> DataFrame:
    """Mean of the current and the ``rows - 1`` earlier rows of the entity.

    ``outputs`` maps a new column to the measure it averages. Missing values are
    skipped; the first rows average what there is. Equal order keys are ordered by a hash
    of the row, so every row has one place at any size; a null entity is an entity.
    Ordinary entities need one shuffle. An entity too large for a task is numbered by a distributed sort and
    cut into stretches of equal row count; each stretch also gets copies of the
    ``rows - 1`` rows before it, so that every frame is whole.
    """
    entity, order_by = list(entity), list(order_by)
    before = rows - 1
    columns = df.columns
    df = df.withColumn("_tie", F.xxhash64(*columns))
    order_by = [*order_by, "_tie"]
    frame = Window.partitionBy(*entity).orderBy(*order_by).rowsBetween(-before, 0)
    large = df.groupBy(*entity).agg(F.count(F.lit(1)).alias("n")).filter(
        F.col("n") > max_entity_rows
    )
    if large.isEmpty():
        plain = df.withColumns({new: F.avg(valid(c)).over(frame) for new, c in outputs.items()})
        return plain.drop("_tie")

    keys = [F.col(k).alias(f"_hot{i}") for i, k in enumerate(entity)]
    hot_keys = materialize(large.select(*keys), "hot-entities")
    is_hot = reduce(
        Column.__and__, (F.col(k).eqNullSafe(F.col(f"_hot{i}")) for i, k in enumerate(entity))
    )
    ordinary = df.join(hot_keys, is_hot, "left_anti").withColumns(
        {new: F.avg(valid(c)).over(frame) for new, c in outputs.items()}
    ).drop("_tie")

    stretch_rows = max(max_entity_rows, rows)
    hot = dense_row_id(
        df.join(hot_keys, is_hot, "left_semi"), [*entity, *order_by], "_pos", start=0
    ).withColumn("_home", F.expr(f"_pos div {stretch_rows}"))
    at_end = F.col("_pos") % stretch_rows >= stretch_rows - before
    homes = F.when(at_end, F.array("_home", F.col("_home") + 1)).otherwise(F.array("_home"))
    stretch = (
        Window.partitionBy(*entity, "_stretch").orderBy("_pos").rowsBetween(-before, 0)
    )
    whole = (
        hot.withColumn("_stretch", F.explode(homes))
        .withColumns({new: F.avg(valid(c)).over(stretch) for new, c in outputs.items()})
        .filter(F.col("_stretch") == F.col("_home"))
    )
    return ordinary.unionByName(whole.select(*columns, *outputs))
