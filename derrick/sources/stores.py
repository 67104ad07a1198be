"""Where named tables live. All stores share ``read``, ``replace``, ``append``
and ``exists``; locations and secrets are parameters and have no defaults."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from derrick.operators.quantile import places
from derrick.schemas import TABLES
from derrick.sources.fingerprint import Fingerprint, fingerprint, sums
from derrick.sources.versioned import VersionedStore


def _schema_of(name: str) -> T.StructType | None:
    return TABLES[name].schema if name in TABLES else None


#: SQL states for a table that does not exist (standard and PostgreSQL).
MISSING_TABLE = ("42S02", "42P01")


def sql_state(error: BaseException) -> str | None:
    """State of the database error behind ``error``, from its Java causes."""
    cause = getattr(error, "java_exception", None) or getattr(error, "_origin", None)
    while cause is not None:
        state = getattr(cause, "getSQLState", None)
        try:
            if state is not None and (found := state()):
                return str(found)
        except Exception:  # a Java object without that method answers with an error
            pass
        cause = cause.getCause()
    return None


@dataclass(frozen=True)
class ParquetStore:
    """One Parquet folder per table under ``root`` (any Hadoop file system)."""

    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def exists(self, name: str) -> bool:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        return folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder)

    def read(self, name: str) -> DataFrame:
        """A registered table is read in its declared schema."""
        reader, schema = self.spark.read, _schema_of(name)
        return (reader.schema(schema) if schema else reader).parquet(self.path(name))

    def replace(self, name: str, df: DataFrame) -> None:
        """The rows are written beside the table, which gives way when all are there; a
        write that fails leaves the old rows, and ``df`` may read the table. Between two
        renames there is a moment without the table; :class:`VersionedStore` has none."""
        fresh = f"{self.root.rstrip('/')}/_staged-{uuid4().hex}"
        jvm = self.spark._jvm
        staged, target, past = (jvm.org.apache.hadoop.fs.Path(p) for p in (fresh, self.path(name), f"{fresh}-past"))
        files = target.getFileSystem(self.spark._jsc.hadoopConfiguration())
        try:
            df.write.parquet(fresh)
        except Exception:
            files.delete(staged, True)
            raise
        old = files.exists(target)
        if old and not files.rename(target, past):
            raise RuntimeError(f"{target} cannot be moved")
        if not files.rename(staged, target):
            if old:
                files.rename(past, target)
            raise RuntimeError(f"{fresh} cannot be moved to {target}")
        if old:
            files.delete(past, True)

    def append(self, name: str, df: DataFrame) -> None:
        df.write.mode("append").parquet(self.path(name))


@dataclass(frozen=True)
class CatalogStore:
    """Managed tables of one database."""

    spark: SparkSession
    database: str = "default"

    def _full(self, name: str) -> str:
        return f"{self.database}.{name}"

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(self._full(name))

    def read(self, name: str) -> DataFrame:
        return self.spark.table(self._full(name))

    def replace(self, name: str, df: DataFrame) -> None:
        df.write.mode("overwrite").option("overwriteSchema", "true").saveAsTable(self._full(name))

    def append(self, name: str, df: DataFrame) -> None:
        df.write.mode("append").saveAsTable(self._full(name))


def cut_query(table: str, key: str, parts: int) -> str:
    """SQL (any database with window functions) for the keys that cut the rows of ``table`` into
    ``parts`` equal counts: at most ``parts`` - 1 rows."""
    numbered = f"select {key} as cut, row_number() over (order by {key}) as place, count(*) over () as rows_all from {table} where {key} is not null"
    step = f"cast(ceiling(rows_all * 1.0 / {parts}) as bigint)"
    return f"select distinct cut from ({numbered}) numbered where place % {step} = 0 and place < rows_all order by cut"


def counted_cuts(df: DataFrame, key: str, parts: int) -> list[float]:
    """The same cuts for a frame: exact order statistics of a numeric key, taken by
    aggregates alone (keys above 2^53 are cut at the nearest double)."""

    def ranks(_: str, rows: int) -> list[int]:
        step = max(1, -(-rows // parts))
        return [p - 1 for p in range(step, rows, step)]

    at = places(df.select(key), [key], ranks).at[key]
    return sorted({p.value for p in at.values()})


def range_predicates(key: str, cuts: Sequence[object]) -> list[str]:
    """Conditions that part all rows: up to and with each cut, and what lies above the last;
    null keys are in the first."""
    ordered = sorted(set(cuts))
    if not ordered:
        return ["1 = 1"]
    first = [f"{key} <= {ordered[0]} or {key} is null"]
    middle = [f"{key} > {a} and {key} <= {b}" for a, b in zip(ordered, ordered[1:])]
    return [*first, *middle, f"{key} > {ordered[-1]}"]


@dataclass(frozen=True)
class JdbcStore:
    """Tables of a relational database.

    Reads split on the table's surrogate key, so that every task fetches one key
    range. With ``counted``, the cuts are keys at equal counts of rows, which the database
    numbers by its index, so gaps and crowded stretches of ids give no empty or heavy
    tasks. Otherwise they are equal parts of the span from the smallest to the largest.
    Cuts only part the rows: all of them arrive, a null key and keys outside too.
    """

    spark: SparkSession
    url: str
    options: Mapping[str, str] = field(default_factory=dict)
    partitions: int = 32
    counted: bool = True
    fetch_rows: int = 10_000
    write_rows: int = 10_000

    def _base(self) -> dict[str, str]:
        return {"url": self.url, **self.options}

    def read_options(
        self, table: str, split_on: str | None, low: object = None, high: object = None
    ) -> dict[str, str]:
        opts = {**self._base(), "dbtable": table, "fetchsize": str(self.fetch_rows)}
        if split_on and low is not None and low != high:
            opts |= {
                "partitionColumn": split_on,
                "lowerBound": str(low),
                "upperBound": str(high),
                "numPartitions": str(self.partitions),
            }
        return opts

    def write_options(self, table: str) -> dict[str, str]:
        # truncate keeps the table, and with it the views that depend on it.
        return {
            **self._base(),
            "dbtable": table,
            "batchsize": str(self.write_rows),
            "truncate": "true",
            "numPartitions": str(self.partitions),
        }

    def query(self, sql: str) -> DataFrame:
        """Projection, filter and order are left to the database."""
        return self.spark.read.format("jdbc").options(**self._base(), query=sql).load()

    def exists(self, name: str) -> bool:
        """False only if the database says that there is no such table; any other error,
        as a lost connection, is raised."""
        try:
            self.query(f"select * from {name} where 1 = 0")
        except Exception as error:
            if sql_state(error) in MISSING_TABLE:
                return False
            raise
        return True

    def read(self, name: str) -> DataFrame:
        spec = TABLES.get(name)
        split_on = spec.surrogate if spec else None
        if split_on and self.counted:
            cuts = [r[0] for r in self.query(cut_query(name, split_on, self.partitions)).collect()]
            return self.spark.read.jdbc(
                self.url, name, predicates=range_predicates(split_on, cuts),
                properties={**self.options, "fetchsize": str(self.fetch_rows)},
            )
        low = high = None
        if split_on:
            low, high = self.query(
                f"select min({split_on}) as low, max({split_on}) as high from {name}"
            ).first()
        return (
            self.spark.read.format("jdbc")
            .options(**self.read_options(name, split_on, low, high))
            .load()
        )

    def replace(self, name: str, df: DataFrame) -> None:
        df.write.format("jdbc").options(**self.write_options(name)).mode("overwrite").save()

    def append(self, name: str, df: DataFrame) -> None:
        df.write.format("jdbc").options(**self.write_options(name)).mode("append").save()


Store = ParquetStore | CatalogStore | JdbcStore | VersionedStore


def replace_counted(store: Store, name: str, df: DataFrame) -> int:
    """Replace a table and return the rows written, counted during the write."""
    seen = Observation(f"rows_{name}")
    store.replace(name, df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return int(seen.get["rows"])


def reconcile(store: Store, written: Mapping[str, int]) -> DataFrame:
    """Rows counted while writing against rows read back, one line per table."""
    spark = store.spark
    lines = []
    for name, rows in written.items():
        lines.append(
            store.read(name).agg(F.count(F.lit(1)).alias("read_rows")).select(
                F.lit(name).alias("table_name"),
                F.lit(rows).cast("bigint").alias("written_rows"),
                "read_rows",
                (F.col("read_rows") == F.lit(rows)).alias("matches"),
            )
        )
    if not lines:
        return spark.createDataFrame(
            [], "table_name string, written_rows bigint, read_rows bigint, matches boolean"
        )
    out = lines[0]
    for line in lines[1:]:
        out = out.unionByName(line)
    return out


def replace_verified(store: Store, name: str, df: DataFrame) -> Fingerprint:
    """Replace a table and return the fingerprint of the rows, taken during the write."""
    seen = Observation(f"content_{name}")
    store.replace(name, df.observe(seen, *sums(df)))
    got = seen.get
    return Fingerprint(int(got["rows"]), got["first"], got["second"])


def reconcile_content(store: Store, written: Mapping[str, Fingerprint]) -> DataFrame:
    """Fingerprints taken while writing against those of the rows read back, one line per
    table: ``same_rows`` compares counts, ``matches`` all content. Where a store changes types
    on the way, as a database may, hand in frames of its types."""
    lines = []
    for name, was in written.items():
        now = fingerprint(store.read(name))
        lines.append((name, was.rows, now.rows, was.rows == now.rows, was == now))
    return store.spark.createDataFrame(
        lines, "table_name string, written_rows long, read_rows long, same_rows boolean, matches boolean"
    )
