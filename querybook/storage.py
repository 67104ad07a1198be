"""Writing tables and reading them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from derrick.operators.aggregates import service_kpi, union_all
from derrick.plans.jobs import run_features
from derrick.schemas import TABLES, conform
from derrick.sources.export import export_all, export_table
from derrick.sources.loading import load_rows
from derrick.sources.scratch import scratch_path
from derrick.sources.stores import (
    ParquetStore,
    counted_cuts,
    cut_query,
    range_predicates,
    reconcile,
    reconcile_content,
    replace_counted,
    replace_verified,
)
from derrick.sources.versioned import VersionedStore, ledger
from querybook import roles
from querybook.book import day, plain, query, r, table
from querybook.cleaning import _FEATURES
from querybook.roles import with_roles


@query(
    "partitioned_roundtrip",
    f"""SELECT year(ts)::BIGINT AS year, month(ts)::BIGINT AS month, day(ts)::BIGINT AS day,
        count(*) AS rows_count, {r('sum(value)', 2)} AS total FROM events GROUP BY 1, 2, 3""",
)
def partitioned_roundtrip(spark, d):
    path = scratch_path(spark, "export-events")
    export_table(table(spark, d, "events"), path, "ts")
    back = spark.read.parquet(path)
    return plain(
        back.groupBy("year", "month", "day").agg(
            F.count(F.lit(1)).alias("rows_count"), F.sum("value").alias("total")
        ),
        2,
    )


@query(
    "unpartitioned_roundtrip",
    "SELECT n_nationkey::BIGINT AS n_nationkey, n_name, r_name FROM nation "
    "JOIN region ON n_regionkey = r_regionkey",
)
def unpartitioned_roundtrip(spark, d):
    path = scratch_path(spark, "export-nation")
    joined = table(spark, d, "nation").join(
        table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    export_table(joined.select("n_nationkey", "n_name", "r_name"), path)
    return plain(spark.read.parquet(path))


@query(
    "reconcile",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS written_rows, count(*) AS read_rows, "
        f"1::BIGINT AS matches FROM {t}"
        for t in ("customer", "orders", "events")
    ),
)
def reconcile_query(spark, d):
    store = ParquetStore(spark, scratch_path(spark, "marts"))
    written = {
        t: replace_counted(store, t, table(spark, d, t)) for t in ("customer", "orders", "events")
    }
    return plain(reconcile(store, written))


@query(
    "load_and_append",
    with_roles(
        "production",
        f"""WITH early AS (SELECT * FROM production WHERE production_date < DATE '1999-01-01'),
            late AS (SELECT * FROM production WHERE production_date >= DATE '1999-01-01'),
            ids AS (
                SELECT row_number() OVER (ORDER BY well_id, production_date, oil_tons) AS n,
                       well_id, oil_tons FROM early
                UNION ALL
                SELECT (SELECT count(*) FROM early)
                       + row_number() OVER (ORDER BY well_id, production_date, oil_tons),
                       well_id, oil_tons FROM late)
            SELECT n AS production_id, well_id, {r('oil_tons', 2)} AS oil_tons FROM ids""",
    ),
)
def load_and_append(spark, d):
    """Reset and load the years before 1999, then append the rest: ids go on."""
    store = ParquetStore(spark, scratch_path(spark, "loaded"))
    spec = TABLES["production"]
    rows = roles.production(spark, d).drop("production_id").na.fill(0.0, ["gas_m3"])
    early = F.col("production_date") < "1999-01-01"
    # Equal keys are told apart by the measure, as a load file's order would.
    order = ("well_id", "production_date", "oil_tons")
    load_rows(store, spec, rows.filter(early), reset=True, order_by=order)
    load_rows(store, spec, rows.filter(~early), order_by=order)
    return plain(store.read("production").select("production_id", "well_id", "oil_tons"))


@query(
    "reset_and_stamp",
    """SELECT o_orderkey % 2 AS half, count(*) AS rows_count, 1::BIGINT AS first_id,
       count(*) AS last_id, 1::BIGINT AS stamps FROM orders WHERE o_orderkey % 2 = 1 GROUP BY 1""",
)
def reset_and_stamp(spark, d):
    """A full table is emptied and filled anew: ids restart, one load time for all rows."""
    store = ParquetStore(spark, scratch_path(spark, "reset"))
    spec = TABLES["production"]
    rows = roles.production(spark, d).drop("production_id").na.fill(0.0, ["gas_m3"])
    odd = roles.production(spark, d).filter("production_id % 2 = 1").drop("production_id")
    load_rows(store, spec, rows, reset=True)
    load_rows(store, spec, odd.na.fill(0.0, ["gas_m3"]), reset=True)
    return plain(
        store.read("production").agg(
            F.lit(1).alias("half"),
            F.count(F.lit(1)).alias("rows_count"),
            F.min("production_id").alias("first_id"),
            F.max("production_id").alias("last_id"),
            F.countDistinct("created_at").alias("stamps"),
        )
    )


@query(
    "export_registry",
    with_roles(
        "production pump_failures",
        """SELECT 'production' AS table_name, 1::BIGINT AS written, count(*) AS rows_count FROM production
           UNION ALL SELECT 'pump_failures', 1, count(*) FROM pump_failures
           UNION ALL SELECT 'wells', 0, 0""",
    ),
)
def export_registry(spark, d):
    """Registered tables to a lake; an empty one is left out."""
    source = ParquetStore(spark, scratch_path(spark, "registry"))
    root = scratch_path(spark, "lake")
    source.replace("production", conform(roles.production(spark, d).withColumn("created_at", F.current_timestamp()), TABLES["production"]))
    source.replace("pump_failures", conform(roles.pump_failures(spark, d), TABLES["pump_failures"]))
    source.replace("wells", conform(roles.wells(spark, d).filter("well_id < 0"), TABLES["wells"]))
    dates = {n: TABLES[n].export_date for n in ("production", "pump_failures", "wells")}
    lines = []
    lake = ParquetStore(spark, root)
    for name, written in export_all(source, root, dates).items():
        found = spark.read.parquet(lake.path(name)) if written else source.read(name)
        lines.append(
            found.agg(F.count(F.lit(1)).alias("rows_count"))
            .select(F.lit(name).alias("table_name"), F.lit(int(written)).alias("written"), "rows_count")
        )
    return plain(union_all(lines))


@query(
    "feature_copies",
    """SELECT t AS target, n AS table_name, 0::BIGINT AS differing
       FROM (VALUES (1::BIGINT), (2::BIGINT)) a(t), (VALUES ('features_by_well'), ('features_daily')) b(n)""",
)
def feature_copies(spark, d):
    """Features go to two stores; each copy holds the rows of the other, as often."""
    source = ParquetStore(spark, scratch_path(spark, "feature-source"))
    for name in ("production", "telemetry", "wells"):
        getattr(roles, name)(spark, d).write.parquet(source.path(name + "_"))
    plain_source = _Unregistered(source)
    copies = [ParquetStore(spark, scratch_path(spark, f"features-{i}")) for i in (1, 2)]
    run_features(plain_source, *copies)
    lines = []
    for i, (mine, other) in enumerate((copies, copies[::-1]), 1):
        for name in ("features_by_well", "features_daily"):
            more = mine.read(name).exceptAll(other.read(name))
            lines.append(
                more.agg(F.count(F.lit(1)).alias("differing"))
                .select(F.lit(i).alias("target"), F.lit(name).alias("table_name"), "differing")
            )
    return plain(union_all(lines))


@query(
    "feature_copy_rows",
    with_roles(
        "production telemetry wells",
        f"""{_FEATURES} SELECT well_id, {day('production_date')} AS production_date, {r('daily_oil_tons')} AS daily_oil_tons,
            {r('avg_pressure')} AS avg_pressure, {r('downtime_ratio')} AS downtime_ratio, well_name,
            {r('sum(daily_oil_tons) OVER (PARTITION BY well_id)', 2)} AS total_oil_tons FROM features""",
    ),
)
def feature_copy_rows(spark, d):
    """The second written copy, daily rows beside their well's totals, against features that
    SQL makes anew from the source tables."""
    source = ParquetStore(spark, scratch_path(spark, "copy-source"))
    for name in ("production", "telemetry", "wells"):
        getattr(roles, name)(spark, d).write.parquet(source.path(name + "_"))
    first, second = (ParquetStore(spark, scratch_path(spark, f"copy-{i}")) for i in (1, 2))
    run_features(_Unregistered(source), first, second)
    daily = second.read("features_daily").select("well_id", "production_date", "daily_oil_tons", "avg_pressure", "downtime_ratio", "well_name")
    wells = second.read("features_by_well").select("well_id", "total_oil_tons")
    return plain(daily.join(wells, "well_id"))


class _Unregistered:
    """A store of tables in the given types, not the declared ones."""

    def __init__(self, store: ParquetStore) -> None:
        self.store, self.spark = store, store.spark

    def read(self, name: str):
        return self.store.read(name + "_")


@query(
    "large_sums",
    """SELECT strftime(CAST(o_orderdate AS DATE), '%Y') AS year, count(*) AS rows_count,
       CAST(round(sum(CAST(o_totalprice AS DECIMAL(18,2)) * 1000000.125::DECIMAL(12,3)), 2) AS VARCHAR) AS total
       FROM orders GROUP BY 1""",
)
def large_sums(spark, d):
    """Money beyond 1e13 stays a decimal through sum and rounding."""
    orders = table(spark, d, "orders").select(
        F.date_format("o_orderdate", "yyyy").alias("year"),
        (F.col("o_totalprice").cast("decimal(18,2)") * F.lit("1000000.125").cast("decimal(12,3)")).alias("money"),
    )
    return service_kpi(orders, "year", {}, {}, {}, {"total": "money"}, count="rows_count").select(
        "year", "rows_count", F.col("total").cast("string").alias("total")
    )


@query(
    "reconcile_content",
    """SELECT 'customer' AS table_name, count(*) AS written_rows, count(*) AS read_rows, 1::BIGINT AS same_rows, 1::BIGINT AS matches FROM customer
       UNION ALL SELECT 'events', count(*), count(*), 1, 0 FROM events
       UNION ALL SELECT 'orders', count(*), count(*) - 1, 0, 0 FROM orders""",
)
def reconcile_by_content(spark, d):
    """Between writing and reading one event changes its value, one order is lost, and the
    customers are put in another order: the count misses the first, content no one."""
    store = ParquetStore(spark, scratch_path(spark, "content"))
    names = ("customer", "events", "orders")
    written = {t: replace_verified(store, t, table(spark, d, t)) for t in names}
    events, orders = store.read("events"), store.read("orders")
    changed = F.when(F.col("event_id") == 0, F.col("value") + 0.01).otherwise(F.col("value"))
    one = orders.agg(F.min("o_orderkey")).first()[0]
    store.replace("events", events.withColumn("value", changed))
    store.replace("orders", orders.filter(F.col("o_orderkey") != one))
    store.replace("customer", store.read("customer").repartition(5, "c_nationkey"))
    return plain(reconcile_content(store, written))


@query(
    "rewrite_in_place",
    f"""SELECT o_orderkey, {r('o_totalprice * 2', 2)} AS o_totalprice, 3::BIGINT AS commits FROM orders WHERE o_orderkey % 3 <> 0
        UNION ALL SELECT -o_orderkey, {r('o_totalprice', 2)}, 3 FROM orders WHERE o_orderkey % 3 = 0""",
)
def rewrite_in_place(spark, d):
    """A versioned table is rewritten from itself, then appended to; the first commit can
    still be read."""
    store = VersionedStore(spark, scratch_path(spark, "versioned"))
    store.replace("orders", table(spark, d, "orders").select("o_orderkey", "o_totalprice"))
    now = store.read("orders")
    store.replace("orders", now.filter("o_orderkey % 3 <> 0").withColumn("o_totalprice", F.col("o_totalprice") * 2))
    first = store.read("orders", 1).filter("o_orderkey % 3 = 0")
    store.append("orders", first.withColumn("o_orderkey", -F.col("o_orderkey")))
    return plain(store.read("orders").withColumn("commits", F.lit(len(store.commits("orders")))), 2)


@query(
    "load_batches",
    with_roles(
        "production",
        f"""WITH p AS (SELECT *, year(production_date) AS y FROM production),
            n AS (SELECT y, row_number() OVER (ORDER BY y) AS place, count(*) AS rows_count FROM p GROUP BY y),
            b AS (SELECT y, place, rows_count, sum(rows_count) OVER (ORDER BY y) AS last FROM n)
            SELECT row_number() OVER (ORDER BY y, well_id, production_date, oil_tons) AS production_id, well_id,
                {r('oil_tons', 2)} AS oil_tons, CAST(place - 1 AS BIGINT) AS place, CAST(y AS VARCHAR) AS batch,
                rows_count AS batch_rows, CAST(last AS BIGINT) AS last_id FROM p JOIN b USING (y)""",
    ),
)
def load_batches(spark, d):
    """One batch a year, each loaded twice: the second load changes neither rows nor ids."""
    store = VersionedStore(spark, scratch_path(spark, "batches"))
    spec = TABLES["production"]
    rows = roles.production(spark, d).drop("production_id").na.fill(0.0, ["gas_m3"])
    year = F.year("production_date")
    years = sorted(r[0] for r in rows.select(year).distinct().collect())
    order = ("well_id", "production_date", "oil_tons")
    for y in years:
        for _ in range(2):
            load_rows(store, spec, rows.filter(year == y), order_by=order, batch=str(y))
    read = store.read("production").select(
        "production_id", "well_id", "oil_tons", F.year("production_date").cast("string").alias("batch")
    )
    lines = ledger(store, "production").withColumnRenamed("rows", "batch_rows")
    return plain(read.join(F.broadcast(lines), "batch"))


@query(
    "read_splits",
    f"""WITH skewed AS (SELECT CASE WHEN o_orderkey % 5 = 0 THEN o_orderkey * o_orderkey ELSE o_orderkey END AS k FROM orders),
        cuts AS ({cut_query("skewed", "k", 12)}),
        part AS (SELECT k, (SELECT count(*) FROM cuts WHERE cut < k) AS place FROM skewed)
        SELECT place AS split, count(*) AS rows_count, min(k) AS low, max(k) AS high FROM part GROUP BY 1""",
)
def read_splits(spark, d):
    """A key with crowds and wide gaps: twelve splits of equal counts, as a database is
    asked for them, each fetched by its own condition."""
    key = F.col("o_orderkey")
    skewed = table(spark, d, "orders").select(F.when(key % 5 == 0, key * key).otherwise(key).alias("k"))
    cuts = [int(c) for c in counted_cuts(skewed, "k", 12)]
    lines = [
        skewed.filter(condition).agg(F.count(F.lit(1)).alias("rows_count"), F.min("k").alias("low"), F.max("k").alias("high"))
        .select(F.lit(i).alias("split"), "rows_count", "low", "high")
        for i, condition in enumerate(range_predicates("k", cuts))
    ]
    return plain(union_all(lines))
