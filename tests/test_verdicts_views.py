"""Row verdicts and quarantine, view dependencies, spans of any length, hot fan-out, counted ranges."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from derrick.operators.joins import attach_events, interval_exists
from derrick.operators.quality import _key, broken_names, check_table, check_tables, judged_rows
from derrick.plans import views
from derrick.schemas import TableSpec
from derrick.sources.catalog import ViewGraph
from derrick.sources.quarantine import quarantine
from derrick.sources.stores import ParquetStore, counted_cuts, cut_query, range_predicates

T = dt.datetime
SPEC = TableSpec(
    "parts", "id int, code string, well_id int, size double, kind string",
    keys=(("id",), ("code", "kind")), ranges={"size": (0, 10, True)}, allowed={"kind": ("a", "b")},
    parents={"well_id": ("wells", "well_id")},
)
ROWS = [
    (1, "x", 1, 5.0, "a"), (2, "y", 2, 0.0, "a"), (2, "z", 9, 11.0, "c"), (None, "w", None, None, "b"),
    (None, "v", 1, 1.0, "b"), (3, "q", 1, 1.0, None), (4, "q", 1, 1.0, None), (5, "only", 2, 10.0, "b"),
]


def brute(rows, wells=(1, 2)):
    ids, codes = Counter(r[0] for r in rows), Counter((r[1], r[4]) for r in rows)
    out = []
    for r in rows:
        i, code, well, size, kind = r
        broken = [f"not_null:{c}" for c, v in zip(("id", "code", "well_id", "size", "kind"), r) if v is None]
        broken += ["range:size"] if size is not None and not 0 < size <= 10 else []
        broken += ["allowed:kind"] if kind is not None and kind not in "ab" else []
        broken += ["unique:id"] if ids[i] > 1 else []
        broken += ["unique:code,kind"] if codes[code, kind] > 1 else []
        broken += ["foreign_key:well_id"] if well is not None and well not in wells else []
        out.append((r, broken))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def parts(spark):
    return spark.createDataFrame(ROWS, SPEC.ddl)


@pytest.fixture(scope="module")
def wells(spark):
    return spark.createDataFrame([(1,), (2,), (2,)], "well_id int")


def test_every_row_gets_its_verdict(parts, wells):
    rows, names = judged_rows(parts, SPEC, {"wells": wells})
    assert rows.columns == [*parts.columns, "broken"] and len(names) == 10
    got = [(tuple(r)[:5], r["names"]) for r in rows.withColumn("names", broken_names("broken", names)).collect()]
    assert sorted(got, key=str) == brute(ROWS)


def test_quarantine_parts_the_rows(spark, parts, wells, tmp_path):
    clean, held = (ParquetStore(spark, str(tmp_path / k)) for k in ("clean", "held"))
    counts = quarantine(parts, SPEC, clean, held, {"wells": wells})
    want = brute(ROWS)
    assert counts == {"clean": sum(not b for _, b in want), "held": sum(bool(b) for _, b in want)}
    assert sorted((tuple(r) for r in clean.read("parts").collect()), key=str) == [r for r, b in want if not b]
    assert sorted(((tuple(r)[:5], r["broken_rules"]) for r in held.read("parts").collect()), key=str) == [w for w in want if w[1]]


def test_tables_checked_together_count_the_same(spark, parts, wells):
    spec = TableSpec("wells", "well_id int", keys=(("well_id",),))
    frames, specs = {"wells": wells, "parts": parts}, {"wells": spec, "parts": SPEC}
    line = lambda r: (r["rule"], r["table_name"], r["column_name"], r["violations"])
    one = sorted(line(r) for n, df in frames.items() for r in check_table(df, specs[n], frames).collect())
    assert sorted(map(line, check_tables(frames, specs).collect())) == one
    empty = {n: df.limit(0) for n, df in frames.items()}
    assert {r["violations"] for r in check_tables(empty, specs).collect()} == {0}


def test_narrow_keys_travel_as_they_are(spark):
    """Whole numbers, days and moments are their own keys, nulls apart from zeros; the counts
    equal those of single tables, also where a foreign key is wider than what it names."""
    rows = [(0, None), (None, 0), (None, None), (None, None), (0, 0), (0, 0), (7, 2), (7, 3), (9, 0)]
    days = spark.createDataFrame(rows, "well_id bigint, n int").select(
        "well_id", F.date_add(F.lit("1970-01-01").cast("date"), F.col("n")).alias("day"),
        (F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.col("n"))).alias("at"),
    )
    key = days.select(_key(days, ["well_id", "at"]).alias("k")).collect()[6]["k"]
    assert (key["h1"], key["h2"], key["nulls"]) == (7, 2 * 86_400_000_000, 0)
    spec = TableSpec("days", "well_id bigint, day date, at timestamp_ntz", keys=(("well_id",), ("well_id", "day"), ("day", "at"), ("well_id", "day", "at")),
                     parents={"well_id": ("wells", "well_id")})
    frames = {"wells": spark.createDataFrame([(0,), (9,), (None,)], "well_id int"), "days": days}
    specs = {"wells": TableSpec("wells", "well_id int", keys=(("well_id",),)), "days": spec}
    line = lambda r: (r["rule"], r["table_name"], r["column_name"], r["violations"])
    one = sorted(line(r) for n, df in frames.items() for r in check_table(df, specs[n], frames).collect())
    assert sorted(map(line, check_tables(frames, specs).collect())) == one
    assert ("foreign_key", "days", "well_id", 2) in one and ("unique", "days", "well_id,day", 2) in one


def test_a_mask_has_its_limit(spark):
    names = [f"c{i}" for i in range(64)]
    wide = spark.range(1).select(*(F.lit(1).alias(n) for n in names))
    with pytest.raises(ValueError):
        judged_rows(wide, TableSpec("wide", ", ".join(f"{n} int" for n in names), keys=()))


def test_replaced_view_takes_its_dependants_along(spark, seed):
    from derrick.plans import marts

    mart = marts.mart_production(seed["production"], seed["wells"], seed["telemetry"])
    graph = views.view_graph({"mart_production": mart})
    graph.create()
    before = [r["well_id"] for r in spark.table("vw_best_wells").collect()]
    assert graph.dependants("vw_well_kpi") == ["vw_best_wells", "vw_worst_wells", "vw_bar_chart_top_wells"]
    changed = graph.replace("vw_well_kpi", lambda m: views.well_kpi(m.filter(~F.col("well_id").isin(before[:1]))))
    assert changed == ["vw_well_kpi", *graph.dependants("vw_well_kpi")]
    after = [r["well_id"] for r in spark.table("vw_best_wells").collect()]
    assert after[:4] == before[1:] and before[0] not in after
    with pytest.raises(Exception, match="UNRESOLVED|cannot be resolved"):  # a dependant misses its column
        graph.replace("vw_well_kpi", lambda m: m.select("well_id"))
    assert [r["well_id"] for r in spark.table("vw_best_wells").collect()] == after
    with pytest.raises(ValueError, match="is read by"):
        graph.drop("vw_well_kpi")
    assert graph.drop("vw_well_kpi", cascade=True)[-1] == "vw_well_kpi"
    assert not spark.catalog.tableExists("vw_best_wells") and spark.catalog.tableExists("vw_daily_production")
    graph.reload("mart_production", mart.limit(0))
    assert spark.table("vw_daily_production").count() == 0
    graph.drop("vw_line_chart_production")


def test_graphs_refuse_cycles_and_unknown_names(spark):
    graph = ViewGraph({"t": spark.range(3)})
    graph.define("b", ["a"], lambda a: a.filter("id > 1"))  # before its source
    with pytest.raises(KeyError):
        graph.order()
    graph.define("a", ["t"], lambda t: t.filter("id > 0"))
    assert graph.order() == ["a", "b"]
    with pytest.raises(ValueError):
        graph.replace("a", lambda b: b, sources=["b"])
    with pytest.raises(ValueError):
        graph.define("a", ["t"], lambda t: t)
    assert graph.create() == ["t", "a", "b"] and spark.table("b").count() == 1


@pytest.mark.parametrize("span", [dt.timedelta(microseconds=1), dt.timedelta(seconds=90), dt.timedelta(hours=5), dt.timedelta(days=30, seconds=7)])
@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_spans_of_any_length(spark, span, kind):
    rng = random.Random(str(span))
    start = T(1969, 12, 20)  # across the epoch
    reach = 4 * span + dt.timedelta(microseconds=5)

    def moments(n):
        return [(f"p{rng.randrange(3)}", start + dt.timedelta(days=10, hours=rng.choice([0, 36])) + reach * rng.random()) for _ in range(n)]

    ev, rd = moments(15), moments(150)
    rd += [(p, e - d) for p, e in ev for d in (dt.timedelta(0), span, span + dt.timedelta(microseconds=1), -dt.timedelta(microseconds=1))]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rd)] + [(10**6, "p0", None), (10**6 + 1, None, start)], "i int, pump string, ts timestamp_ntz")
    events = spark.createDataFrame([*ev, ("p1", None), (None, start)], "pump string, at timestamp_ntz")
    df, events = df.withColumn("ts", F.col("ts").cast(kind)), events.withColumn("at", F.col("at").cast(kind))
    out = interval_exists(df, events, "pump", "ts", "at", "hit", span=span).orderBy("i").collect()
    assert [r["hit"] for r in out[: len(rd)]] == [any(p == q and e - span <= t <= e for q, e in ev) for p, t in rd]
    assert [r["hit"] for r in out[len(rd):]] == [False, False]


def test_a_hot_entity_is_spread_over_tasks(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    try:
        day = dt.date(2024, 1, 1)
        key = F.when(F.col("id") % 2 == 0, 0).otherwise(1 + F.col("id") % 400).cast("long").alias("k")
        events = spark.range(24_000).select(key, F.lit(day).alias("at"), F.col("id").alias("e"))
        daily = spark.range(401).select(F.col("id").alias("k")).crossJoin(spark.range(6).select(F.date_add(F.lit(day), -F.col("id").cast("int")).alias("date")))
        daily = daily.unionByName(spark.createDataFrame([(-1, day)], "k long, date date"))
        plain = daily.join(events, "k", "left")
        out = attach_events(daily, events, ["k"], event_ts="at", max_events=120)
        assert out.columns[:4] == ["k", "date", "at", "e"]
        assert out.select("k", "date", "at", "e").exceptAll(plain).isEmpty() and plain.exceptAll(out.select("k", "date", "at", "e")).isEmpty()

        def heaviest(df):
            sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
            return max(sizes) / sorted(sizes)[len(sizes) // 2]

        assert heaviest(out) <= 2 < heaviest(plain)
    finally:
        for name in ("autoBroadcastJoinThreshold", "adaptive.coalescePartitions.enabled"):
            spark.conf.unset(f"spark.sql.{name}")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.mark.parametrize("parts", [1, 5, 64])
def test_counted_ranges_part_all_rows(spark, parts):
    duckdb = pytest.importorskip("duckdb")
    rng = random.Random(parts)
    keys = [rng.choice([7, rng.randrange(50), 10**6 + rng.randrange(10**7)]) for _ in range(400)] + [None, None]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    cuts = [int(c) for c in counted_cuts(df, "k", parts)]
    con = duckdb.connect()
    con.execute("create table t(k bigint)")
    con.executemany("insert into t values (?)", [(k,) for k in keys])
    assert [r[0] for r in con.execute(cut_query("t", "k", parts)).fetchall()] == cuts and len(cuts) < max(parts, 1)
    predicates = range_predicates("k", cuts)
    sizes = [df.filter(p).count() for p in predicates]
    assert sum(sizes) == len(keys) and len(predicates) <= parts
    common = Counter(keys).most_common(1)[0][1]
    assert max(sizes) <= -(-400 // parts) + common + 2
    assert range_predicates("k", []) == ["1 = 1"] and counted_cuts(df.limit(0), "k", parts) == []
