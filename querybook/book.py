"""Registry and the helpers that make both engines print the same value."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from derrick.functions import round_half_up

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}
_SCHEMAS: dict[str, T.StructType] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where SQL can say the same, its check."""

    def add(fn: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its schema is read from the file once per process."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def plain(df: DataFrame, digits: int = 4) -> DataFrame:
    """Types every engine prints alike: dates and times as text, flags and counts as
    bigint, measures as doubles rounded half up."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(f.dataType, (T.BooleanType, T.IntegerType, T.ShortType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = round_half_up(c, digits)
        out.append(c.alias(f.name))
    return df.select(*out)


def r(expr: str, digits: int = 4) -> str:
    """SQL twin of ``round_half_up``."""
    return f"CAST(round(CAST({expr} AS DECIMAL(38,9)), {digits}) AS DOUBLE)"


def even(expr: str, digits: int = 2) -> str:
    """SQL twin of ``round_half_even``."""
    return f"(round_even(({expr}) * {10**digits}.0::DOUBLE, 0) / {10**digits}.0::DOUBLE)"


def day(expr: str) -> str:
    return f"strftime(CAST({expr} AS DATE), '%Y-%m-%d')"


def moment(expr: str) -> str:
    return f"strftime(CAST({expr} AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%f')"


def flag(expr: str) -> str:
    return f"CAST(({expr}) AS BIGINT)"
