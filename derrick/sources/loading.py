"""Load rows into a source table with surrogate key and load time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from derrick.operators.ranking import dense_row_id
from derrick.schemas import TableSpec, conform
from derrick.sources.scratch import materialize
from derrick.sources.stores import Store
from derrick.sources.versioned import VersionedStore


def load_rows(
    store: Store,
    spec: TableSpec,
    df: DataFrame,
    reset: bool = False,
    order_by: Sequence[str] | None = None,
    batch: str | None = None,
) -> bool:
    """Append ``df`` (``reset`` empties the table first and restarts the key).

    Ids are dense and follow the table's natural key unless ``order_by`` is
    given, so that the same input gets the same ids again. With the name of a ``batch``
    (a versioned store keeps the ledger) a batch that was loaded before, since the last
    reset, is left alone and gives False; a load that died is simply repeated.
    """
    if batch is not None:
        return _load_batch(store, spec, df, reset, order_by, batch)
    fresh = reset or not store.exists(spec.name)
    start = 1
    if spec.surrogate and spec.surrogate not in df.columns and not fresh:
        start = (store.read(spec.name).agg(F.max(spec.surrogate)).first()[0] or 0) + 1
    rows = _numbered(spec, df, order_by, start)
    if fresh:
        store.replace(spec.name, rows)
    else:
        store.append(spec.name, rows)
    return True


def _numbered(spec: TableSpec, df: DataFrame, order_by: Sequence[str] | None, start: int) -> DataFrame:
    """``df`` in the table's form, with load time and ids from ``start``."""
    if spec.stamp and spec.stamp not in df.columns:
        df = df.withColumn(spec.stamp, F.current_timestamp().cast("timestamp_ntz"))
    if spec.surrogate and spec.surrogate not in df.columns:
        natural = next((k for k in spec.keys if spec.surrogate not in k), None)
        order = order_by or natural or [c for c in df.columns if c != spec.stamp]
        df = dense_row_id(df, order, spec.surrogate, start=start)
    return conform(df, spec)


def _load_batch(store: Store, spec: TableSpec, df: DataFrame, reset: bool, order_by: Sequence[str] | None, batch: str) -> bool:
    if not isinstance(store, VersionedStore):
        raise TypeError("batches need a versioned store")
    if reset:
        store.clear(spec.name, spec.schema)
    now = store.commit(spec.name)
    if now is not None and now.part_of(batch) is not None:
        return False
    start = now.last_id + 1 if now else 1
    rows = materialize(_numbered(spec, df, order_by, start), "batch")
    # Dense ids need no scan of the table: the ledger knows the last one.
    last = rows.agg(F.max(spec.surrogate)).first()[0] if spec.surrogate else None
    store.append(spec.name, rows, batch, last)
    return True
