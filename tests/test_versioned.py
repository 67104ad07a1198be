"""Commits, conflicts, batches and fingerprints."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from derrick.schemas import TABLES
from derrick.sources import CommitConflict, ParquetStore, VersionedStore, fingerprint, reconcile_content, replace_verified
from derrick.sources.loading import load_rows
from derrick.sources.versioned import ledger


@pytest.fixture(params=[ParquetStore, VersionedStore])
def store(request, spark, tmp_path):
    return request.param(spark, str(tmp_path / "lake"))


def numbers(spark, n, step=1):
    return spark.range(n).select((F.col("id") * step).alias("k"), F.concat(F.lit("v"), F.col("id")).alias("v"))


def keys(df):
    return sorted(r["k"] for r in df.collect())


def test_a_failing_write_leaves_the_old_rows(spark, store, tmp_path):
    store.replace("t", numbers(spark, 50))
    bad = numbers(spark, 60).withColumn("v", F.when(F.col("k") == 41, F.raise_error(F.lit("a task dies"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="a task dies"):
        store.replace("t", bad)
    assert keys(store.read("t")) == list(range(50))
    if isinstance(store, ParquetStore):
        assert [p.name for p in (tmp_path / "lake").iterdir()] == ["t"]
    store.replace("t", numbers(spark, 5))  # and the next one works
    assert keys(store.read("t")) == list(range(5))


def test_a_table_is_rewritten_from_itself(spark, store):
    store.replace("t", numbers(spark, 50))
    store.replace("t", store.read("t").filter("k % 2 = 1"))
    store.replace("t", store.read("t").unionByName(store.read("t").withColumn("k", F.col("k") + 100)))
    assert keys(store.read("t")) == [*range(1, 50, 2), *range(101, 150, 2)]


def test_readers_keep_the_rows_they_started_with(spark, tmp_path):
    store = VersionedStore(spark, str(tmp_path))
    store.replace("t", numbers(spark, 10))
    reader = store.read("t")
    store.replace("t", numbers(spark, 3, 7))
    store.append("t", numbers(spark, 2, 100))
    assert keys(reader) == list(range(10)) and keys(store.read("t", 1)) == list(range(10))
    assert keys(store.read("t")) == [0, 0, 7, 14, 100]
    assert store.commit("t").fingerprint == fingerprint(store.read("t"))
    assert store.vacuum("t", keep=1) == 1 and store.commits("t") == [3]
    assert keys(store.read("t")) == [0, 0, 7, 14, 100] and store.vacuum("t", keep=1) == 0


def test_the_second_of_two_writers_is_told(spark, tmp_path):
    store = VersionedStore(spark, str(tmp_path))
    store.replace("t", numbers(spark, 4))
    now = store.commit("t")
    store.append("t", numbers(spark, 1))
    with pytest.raises(CommitConflict):
        store._put("t", now.number + 1, numbers(spark, 1).schema, now.parts)
    assert store.commit("t").fingerprint.rows == 5
    with pytest.raises(ValueError):
        store.append("t", spark.range(2))
    with pytest.raises(FileNotFoundError):
        store.read("none")


def test_batches_are_loaded_once(spark, tmp_path):
    store, spec = VersionedStore(spark, str(tmp_path)), TABLES["well_targets"]

    def batch(first, n):
        return spark.range(first, first + n).selectExpr(
            "cast(id % 3 as int) as well_id", "date_add(date '2024-01-01', cast(id as int)) as target_date", "1.0 as avg_pressure_atm",
            "2.0 as avg_temperature_c", "3.0 as avg_power_kw", "4.0 as pump_runtime_hours", "cast(id as double) as target_oil_tons",
        )

    assert load_rows(store, spec, batch(0, 20), batch="one")
    assert load_rows(store, spec, batch(20, 10), batch="two")
    before = sorted(map(str, store.read("well_targets").collect()))
    assert not load_rows(store, spec, batch(0, 20), batch="one")
    assert not load_rows(store, spec, batch(500, 3), batch="two")  # the name decides
    assert sorted(map(str, store.read("well_targets").collect())) == before
    assert [r["target_id"] for r in store.read("well_targets").orderBy("target_id").collect()] == list(range(1, 31))
    store.compact("well_targets")
    assert not load_rows(store, spec, batch(20, 10), batch="two")
    assert load_rows(store, spec, batch(40, 5), batch="three")
    got = store.read("well_targets")
    assert sorted(r["target_id"] for r in got.collect()) == list(range(1, 36))
    assert {r["batch"]: r["last_id"] for r in ledger(store, "well_targets").collect() if r["batch"]} == {"one": 20, "two": 30, "three": 35}
    assert load_rows(store, spec, batch(0, 4), reset=True, batch="one")  # a reset forgets all
    assert sorted(r["target_id"] for r in store.read("well_targets").collect()) == [1, 2, 3, 4]
    with pytest.raises(TypeError):
        load_rows(ParquetStore(spark, str(tmp_path / "p")), spec, batch(0, 1), batch="x")


def test_a_batch_that_died_is_repeated(spark, tmp_path):
    store, spec = VersionedStore(spark, str(tmp_path)), TABLES["wells"]
    good = spark.createDataFrame([(1, "W1"), (2, "W2")], "well_id int, well_name string")
    full = good.selectExpr("*", "'f' as field_name", "'r' as region", "date '2020-01-01' as start_date", "5 as depth_m", "'active' as status")
    with pytest.raises(Exception, match="dies"):
        load_rows(store, spec, full.withColumn("region", F.raise_error(F.lit("dies")).cast("string")), batch="b")
    assert not store.exists("wells")
    assert load_rows(store, spec, full, batch="b") and store.read("wells").count() == 2


def test_fingerprints_see_content_not_order(spark):
    rows = [(1, "a", 0.0, [1, 2]), (2, None, -0.0, None), (2, None, 0.0, None), (None, "2", 3.5, [])]
    df = spark.createDataFrame(rows, "i int, s string, x double, l array<int>").withColumn("m", F.create_map(F.lit("k"), F.col("i"), F.lit("j"), F.lit(1)))
    one = fingerprint(df)
    assert one == fingerprint(df.repartition(4).orderBy("x")) == fingerprint(df.select("m", "l", "x", "s", "i"))
    assert one.rows == 4
    others = [
        df.filter("i = 1"), df.unionByName(df.limit(1)), df.withColumn("s", F.coalesce("s", F.lit(""))),
        df.withColumn("i", F.when(F.col("x") == 3.5, 2).otherwise(F.col("i"))), df.withColumnRenamed("s", "t"),
        df.withColumn("l", F.coalesce("l", F.array().cast("array<int>"))),
        df.withColumn("i", F.lit(None).cast("int")), df.select("m", "l", "x", F.col("i").cast("string").alias("s"), F.col("i")),
    ]
    seen = {fingerprint(o) for o in others}
    assert one not in seen and len(seen) == len(others)
    empty = fingerprint(df.limit(0))
    assert (empty.rows, empty.first, empty.second) == (0, "0", "0")


def test_content_is_reconciled_in_both_layouts(spark, store):
    written = {"a": replace_verified(store, "a", numbers(spark, 30)), "b": replace_verified(store, "b", numbers(spark, 30))}
    store.replace("b", store.read("b").withColumn("v", F.when(F.col("k") == 7, "w").otherwise(F.col("v"))))
    got = {r["table_name"]: (r["same_rows"], r["matches"]) for r in reconcile_content(store, written).collect()}
    assert got == {"a": (True, True), "b": (True, False)}
    assert reconcile_content(store, {}).count() == 0
