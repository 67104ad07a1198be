"""Rows that keep the rules to one table, rows that break one to another, with reasons."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from derrick.operators.quality import broken_names, judged_rows
from derrick.schemas import TableSpec
from derrick.sources.scratch import materialize, scratch_scope
from derrick.sources.stores import Store, replace_counted


def quarantine(
    df: DataFrame, spec: TableSpec, clean: Store, held: Store, parents: Mapping[str, DataFrame] | None = None,
    reasons: str = "broken_rules",
) -> dict[str, int]:
    """Write the good rows to ``spec.name`` of ``clean`` and the others, with the names of the
    rules that they break, to the same name of ``held``; rows written to each. The rows
    are judged once, so both tables come from one verdict and each row is in one of them."""
    with scratch_scope(df.sparkSession):
        rows, names = judged_rows(df, spec, parents, "_mask")
        rows = materialize(rows, "judged")
        good = rows.filter("_mask = 0").drop("_mask")
        bad = rows.filter("_mask <> 0").withColumn(reasons, broken_names("_mask", names)).drop("_mask")
        return {"clean": replace_counted(clean, spec.name, good), "held": replace_counted(held, spec.name, bad)}
