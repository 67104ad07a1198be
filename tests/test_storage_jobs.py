from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from derrick.plans import jobs
from derrick.plans.marts import mart_logistics
from derrick.plans.views import VIEWS
from derrick.schemas import LOAD_ORDER, TABLES
from derrick.sources.catalog import register, tables_present, unregister
from derrick.sources.export import export_table
from derrick.sources.loading import load_rows
from derrick.sources.scratch import materialize, scratch_root, scratch_scope
from derrick.sources.stores import (
    CatalogStore,
    JdbcStore,
    ParquetStore,
    reconcile,
    replace_counted,
)


def _days(spark, days):
    rows = [(i, dt.datetime(2024, 1, d, 6)) for i, d in enumerate(days)]
    return spark.createDataFrame(rows, "i int, ts timestamp_ntz")


def test_export_layout_and_refresh(spark, tmp_path):
    path = str(tmp_path / "t")
    assert export_table(_days(spark, [1, 1, 2, 3]), path, "ts")
    assert (tmp_path / "t" / "year=2024" / "month=01" / "day=03").is_dir()
    back = spark.read.parquet(path)
    assert back.columns == ["i", "ts", "year", "month", "day"] and back.count() == 4

    export_table(_days(spark, [1, 2]), path, "ts")  # day 3 stays
    assert spark.read.parquet(path).count() == 3
    export_table(_days(spark, [1, 2]), path, "ts", refresh="full")
    assert spark.read.parquet(path).count() == 2
    with pytest.raises(ValueError):
        export_table(back, path, "ts", refresh="some")


def test_export_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    export_table(_days(spark, [1, 2, 3]), path, "ts")
    one = spark.read.parquet(path).filter("day = 2")
    assert one.count() == 1 and len(one.inputFiles()) >= 1
    assert "PartitionFilters: [isnotnull(day" in one._jdf.queryExecution().toString()


def test_export_skips_empty_and_keeps_undated(spark, tmp_path):
    assert not export_table(_days(spark, [1]).limit(0), str(tmp_path / "e"), "ts")
    assert not (tmp_path / "e").exists()
    some = _days(spark, [1]).unionAll(spark.createDataFrame([(9, None)], "i int, ts timestamp_ntz"))
    export_table(some, str(tmp_path / "n"), "ts")
    back = spark.read.parquet(str(tmp_path / "n"))
    assert back.count() == 2 and back.filter("year IS NULL").first()["i"] == 9
    export_table(some, str(tmp_path / "u"))
    assert spark.read.parquet(str(tmp_path / "u")).count() == 2


@pytest.mark.parametrize("kind", ["parquet", "catalog"])
def test_store_round_trip(spark, tmp_path, kind):
    store = ParquetStore(spark, str(tmp_path)) if kind == "parquet" else CatalogStore(spark)
    assert not store.exists("numbers")
    assert replace_counted(store, "numbers", spark.range(5)) == 5
    store.append("numbers", spark.range(2))
    assert store.exists("numbers") and store.read("numbers").count() == 7
    line = reconcile(store, {"numbers": 5}).first()
    assert (line["written_rows"], line["read_rows"], line["matches"]) == (5, 7, False)
    replace_counted(store, "numbers", spark.range(3).withColumn("extra", F.lit(1)))
    assert store.read("numbers").columns == ["id", "extra"]
    assert reconcile(store, {}).count() == 0


class _State(Exception):
    """A database error as Spark wraps it: the state is in a Java cause."""

    def __init__(self, state):
        class Cause:
            def getSQLState(self):
                return state

            def getCause(self):
                return None

        self.java_exception = Cause()


@pytest.mark.parametrize("state", ["42P01", "42S02"])
def test_jdbc_table_that_does_not_exist(spark, monkeypatch, state):
    def fail(self, sql):
        raise _State(state)

    monkeypatch.setattr(JdbcStore, "query", fail)
    assert not JdbcStore(spark, "jdbc:x://h/db").exists("production")


@pytest.mark.parametrize("state", ["08006", None, ""])
def test_jdbc_failures_are_not_taken_for_a_missing_table(spark, monkeypatch, state):
    def fail(self, sql):
        raise _State(state)

    monkeypatch.setattr(JdbcStore, "query", fail)
    store = JdbcStore(spark, "jdbc:x://h/db")
    with pytest.raises(_State):
        store.exists("production")
    with pytest.raises(_State):
        load_rows(store, TABLES["production"], spark.range(1))


def test_jdbc_options(spark):
    """Options only: no database is started here."""
    store = JdbcStore(spark, "jdbc:x://h/db", {"user": "u"}, partitions=8)
    opts = store.read_options("production", "production_id", 1, 900)
    assert opts["partitionColumn"] == "production_id"
    assert (opts["lowerBound"], opts["upperBound"], opts["numPartitions"]) == ("1", "900", "8")
    assert opts["user"] == "u" and opts["fetchsize"] == "10000"
    for low, high in ((None, None), (3, 3)):  # empty table, single key
        assert "partitionColumn" not in store.read_options("t", "k", low, high)
    assert "partitionColumn" not in store.read_options("wells", None)
    assert store.write_options("m")["truncate"] == "true"


def test_load_resets_then_continues_ids(spark, seed, tmp_path):
    store = ParquetStore(spark, str(tmp_path))
    spec = TABLES["production"]
    rows = seed["production"].drop("production_id", "created_at")
    early = F.col("production_date") < "2024-02-01"
    load_rows(store, spec, rows.filter(early), reset=True)
    load_rows(store, spec, rows.filter(~early))
    back = store.read("production")
    stats = back.agg(
        F.count("*"), F.countDistinct("production_id"), F.min("production_id"),
        F.max("production_id"), F.count("created_at"),
    ).first()
    assert tuple(stats) == (728, 728, 1, 728, 728)
    assert back.filter(early).agg(F.max("production_id")).first()[0] == 8 * 31
    assert [f.dataType for f in back.schema] == [f.dataType for f in spec.schema]
    load_rows(store, spec, rows.limit(5), reset=True)
    assert store.read("production").agg(F.max("production_id")).first()[0] == 5


def test_scratch(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    kept = materialize(spark.range(3), "kept")
    with scratch_scope(spark):
        gone = materialize(spark.range(4), "gone")
        assert gone.count() == 4
    assert kept.count() == 3
    with pytest.raises(Exception):
        gone.collect()


def test_catalog(spark):
    register({"tmp_one": spark.range(1), "tmp_two": spark.range(2)})
    assert tables_present(spark, ["tmp_two", "tmp_one", "tmp_gone"]) == ["tmp_one", "tmp_two"]
    unregister(spark, ["tmp_one"])
    assert tables_present(spark, ["tmp_one", "tmp_two"]) == ["tmp_two"]


def test_logistics_columns_depend_on_the_table(spark):
    df = spark.createDataFrame([(7.0, 0.0), (7.0, 3.0)], "cost double, distance_km double")
    out = mart_logistics(df)
    assert out.columns == ["cost", "distance_km", "cost_per_km"]
    assert [r["cost_per_km"] for r in out.collect()] == [None, 2.33]


def test_all_jobs_end_to_end(spark, seed, tmp_path):
    source = ParquetStore(spark, str(tmp_path / "source"))
    target = ParquetStore(spark, str(tmp_path / "target"))
    copy = ParquetStore(spark, str(tmp_path / "copy"))
    for name in LOAD_ORDER:
        source.replace(name, seed[name])

    exported = jobs.run_export(source, str(tmp_path / "lake"))
    assert exported == {name: True for name in TABLES}
    assert spark.read.parquet(str(tmp_path / "lake" / "pump_sensors")).count() == 2912

    assert jobs.run_features(source, target, copy) == {"features_daily": 637, "features_by_well": 7}
    assert copy.read("features_daily").count() == 637
    assert jobs.run_marts(source, target) == {
        "mart_production": 728, "mart_failures": 728, "mart_logistics": 120,
        "mart_ml_dataset": 728,
    }
    assert jobs.run_ml_dataset(source, target) == 728
    assert jobs.run_production_model(target, trees=5, depth=4) == {
        "ml_predictions": 146, "ml_metrics": 2,
    }
    assert jobs.run_failure_model(source, target, trees=20, depth=4) == {
        "mart_pump_anomalies": 2912, "mart_pump_risk_daily": 728, "ml_failure_metrics": 1,
    }
    names = jobs.run_views(source, target)
    assert set(names) == set(VIEWS)
    assert spark.table("vw_ml_predictions").agg(F.min("id"), F.max("id")).first()[:] == (1, 146)
    best = [r["well_id"] for r in spark.sql("select * from vw_best_wells").collect()]
    assert best == [8, 6, 5, 4, 2]
    days = [r["date"] for r in spark.sql("select * from vw_line_chart_production").collect()]
    assert days == sorted(days) and len(days) == 91
    assert spark.table("vw_vibration_before_failure").count() == 128
    assert spark.table("vw_pump_risk_score").count() == 728
