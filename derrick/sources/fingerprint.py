"""A table's content in three numbers that do not depend on the order of its rows.

Every row is hashed over all its columns, by name and with nulls told from values; the
rows' hashes are added, so equal tables have equal sums, copies count, and a changed,
lost or doubled row changes them (two sums of 64 bits: a chance hit is out of reach).
The sums are aggregates, so they can be observed while a table is written.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Fingerprint:
    """Rows, and the two sums of their hashes (texts, as they pass 64 bits)."""

    rows: int
    first: str
    second: str


def _hashable(c: Column, kind: T.DataType) -> Column:
    """Maps as sorted entries, -0.0 as 0.0; all other values as they are."""
    if isinstance(kind, T.MapType):
        return F.sort_array(F.map_entries(c))
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return c + F.lit(0.0).cast(kind)
    return c


def _row_hashes(df: DataFrame) -> tuple[Column, Column]:
    parts: list[Column] = []
    for field in sorted(df.schema.fields, key=lambda f: f.name):
        c = _hashable(F.col(f"`{field.name.replace('`', '``')}`"), field.dataType)
        parts += [F.lit(field.name), c.isNull(), c]
    first = F.xxhash64(*parts)
    return first, F.xxhash64(F.lit("second"), first, *parts)


def sums(df: DataFrame) -> list[Column]:
    """The aggregates ``rows``, ``first`` and ``second``; also for ``DataFrame.observe``."""
    first, second = (F.coalesce(F.sum(h.cast("decimal(20,0)")), F.lit(0)).cast("string") for h in _row_hashes(df))
    return [F.count(F.lit(1)).alias("rows"), first.alias("first"), second.alias("second")]


def fingerprint(df: DataFrame) -> Fingerprint:
    return Fingerprint(*df.agg(*sums(df)).first())
