"""What the operators of this package share: words, lines, keys and small tools.

Rows are told apart by ``(doc_id, text)``, as ids may be missing or repeated:
equal rows always get equal results, so a join back on both multiplies nothing
when the right side holds each pair once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from derrick.sources.scratch import scratch_path, scratch_scope

#: Bytes a broadcast table may have; larger ones go the shuffled way.
BROADCAST_BYTES = 32 << 20
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: White space of the contracts, as the inside of a character class.
BLANK = " \t-\r"


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cols(df: DataFrame) -> list[Column]:
    """All columns of ``df``, whatever their names hold."""
    return [df[f"`{c}`"] for c in df.columns]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also inside lambdas."""
    return F.transform(F.array(value), body)[0]


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def space_words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+``; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{BLANK}]+"), "")


def row_key(*columns: Column) -> Column:
    """64-bit key of a row's identity; nulls differ from empty texts."""
    parts = []
    for c in columns:
        parts += [c.isNull(), c]
    return F.xxhash64(*parts)


def settled(spark: SparkSession, label: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The rows of ``make()``, written; the tables that it wrote on the way are deleted."""
    path = scratch_path(spark, label)
    with scratch_scope(spark):
        out = make()
        out.write.parquet(path)
    return spark.read.schema(out.schema).parquet(path)


def hinted(df: DataFrame, row_bytes: int) -> DataFrame:
    """``df`` (a written table) with a broadcast hint if its counted rows fit
    ``BROADCAST_BYTES``; otherwise as it is, for a shuffled join."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df
