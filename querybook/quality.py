"""Counts, coverage and data-quality rules."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import functions as F

from derrick.operators.aggregates import date_ranges, table_counts, union_all
from derrick.operators.quality import (
    allowed_rules,
    check_foreign_key,
    check_tables,
    check_unique,
    count_rules,
    not_null_rules,
    range_rules,
)
from derrick.plans import marts
from derrick.schemas import TABLES
from derrick.sources.catalog import register, tables_present
from derrick.sources.quarantine import quarantine
from derrick.sources.scratch import materialize, scratch_path
from derrick.sources.stores import ParquetStore
from querybook import roles
from querybook.book import day, plain, query, table

COUNTED = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)
DATED = {"orders": "o_orderdate", "lineitem": "l_shipdate", "events": "ts"}
RANGES = {
    "l_quantity": (0, None, True),
    "l_discount": (0, 0.09, False),
    "l_tax": (0.01, None, False),
    "l_linenumber": (1, 5, False),
}
STATUS = ("O", "F")


@query(
    "union_counts",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS rows_count FROM {t}" for t in COUNTED
    ),
)
def union_counts(spark, d):
    return table_counts({t: table(spark, d, t) for t in COUNTED}).orderBy("table_name")


@query(
    "date_ranges",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, {day(f'min({c})')} AS min_date, {day(f'max({c})')} AS max_date "
        f"FROM {t}"
        for t, c in DATED.items()
    ),
)
def date_ranges_query(spark, d):
    return plain(date_ranges({t: (table(spark, d, t), c) for t, c in DATED.items()}))


@query(
    "label_summary",
    """SELECT count(*) AS rows_count, count(DISTINCT quality) AS classes,
       CAST(sum(quality) AS BIGINT) AS positive_rows,
       CAST(count(DISTINCT quality) > 1 AS BIGINT) AS trainable FROM labels""",
)
def label_summary(spark, d):
    return plain(
        table(spark, d, "labels").agg(
            F.count(F.lit(1)).alias("rows_count"),
            F.countDistinct("quality").alias("classes"),
            F.sum("quality").alias("positive_rows"),
            (F.countDistinct("quality") > 1).alias("trainable"),
        )
    )


def _lines(rule: str, tbl: str, conditions: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{rule}' AS rule, '{tbl}' AS table_name, '{c}' AS column_name, "
        f"count(*) FILTER (WHERE {broken}) AS violations FROM {tbl}"
        for c, broken in conditions.items()
    )


_LINE_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]


@query("dq_nulls", _lines("not_null", "lineitem", {c: f"{c} IS NULL" for c in _LINE_COLUMNS}))
def dq_nulls(spark, d):
    return count_rules(table(spark, d, "lineitem"), "lineitem", not_null_rules(_LINE_COLUMNS))


@query(
    "dq_unique",
    """SELECT 'unique' AS rule, 'lineitem' AS table_name, 'l_orderkey,l_linenumber' AS column_name,
       count(*) AS violations FROM (
           SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
       UNION ALL SELECT 'unique', 'orders', 'o_orderkey', count(*) FROM (
           SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1)""",
)
def dq_unique(spark, d):
    return union_all(
        [
            check_unique(table(spark, d, "lineitem"), "lineitem", ["l_orderkey", "l_linenumber"]),
            check_unique(table(spark, d, "orders"), "orders", ["o_orderkey"]),
        ]
    )


@query(
    "dq_range",
    _lines(
        "range",
        "lineitem",
        {
            "l_quantity": "l_quantity <= 0",
            "l_discount": "l_discount < 0 OR l_discount > 0.09",
            "l_tax": "l_tax < 0.01",
            "l_linenumber": "l_linenumber < 1 OR l_linenumber > 5",
        },
    ),
)
def dq_range(spark, d):
    return count_rules(table(spark, d, "lineitem"), "lineitem", range_rules(RANGES))


@query("dq_values", _lines("allowed", "orders", {"o_orderstatus": "o_orderstatus NOT IN ('O', 'F')"}))
def dq_values(spark, d):
    return count_rules(
        table(spark, d, "orders"), "orders", allowed_rules({"o_orderstatus": STATUS})
    )


@query(
    "dq_fk",
    """SELECT 'foreign_key' AS rule, 'lineitem' AS table_name, 'l_orderkey' AS column_name,
       count(*) AS violations FROM lineitem
       WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus = 'O')
       UNION ALL SELECT 'foreign_key', 'orders', 'o_custkey', count(*) FROM orders
       WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey)""",
)
def dq_fk(spark, d):
    orders = table(spark, d, "orders")
    still_open = orders.filter(F.col("o_orderstatus") == "O")
    return union_all(
        [
            check_foreign_key(
                table(spark, d, "lineitem"), "lineitem", "l_orderkey", still_open, "o_orderkey"
            ),
            check_foreign_key(orders, "orders", "o_custkey", table(spark, d, "customer"), "c_custkey"),
        ]
    )


@query(
    "tables_present",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS rows_count FROM {t}" for t in ("events", "orders")
    ),
)
def tables_present_query(spark, d):
    """Of four expected tables the catalog knows two; those are counted."""
    known = {f"given_{t}": table(spark, d, t) for t in ("orders", "events")}
    register(known)
    expected = [*known, *(f"given_{t}_backup" for t in ("orders", "events"))]
    found = tables_present(spark, expected)
    return table_counts({name.removeprefix("given_"): spark.table(name) for name in found})


# Columns the given tables have no counterpart for.
_ABSENT = {
    "production": ("created_at",),
    "telemetry": ("telemetry_id", "created_at"),
    "well_targets": ("target_id",),
}
_CHECKED = (
    "wells", "production", "telemetry", "pump_sensors", "pump_failures", "deliveries", "well_targets",
)


def _rules_sql(name: str) -> list[str]:
    """SQL for every rule of a source table."""
    spec = TABLES[name]
    columns = [c for c in spec.columns if c not in _ABSENT.get(name, ())]
    conditions = [("not_null", c, f"{c} IS NULL") for c in columns]
    for c, (low, high, strict) in spec.ranges.items():
        broken = [f"{c} {'<=' if strict else '<'} {low}"] if low is not None else []
        broken += [f"{c} > {high}"] if high is not None else []
        conditions.append(("range", c, " OR ".join(broken)))
    for c, values in spec.allowed.items():
        listed = ", ".join(f"'{v}'" for v in values)
        conditions.append(("allowed", c, f"{c} NOT IN ({listed})"))
    out = [
        f"SELECT '{rule}' AS rule, '{name}' AS table_name, '{c}' AS column_name, "
        f"count(*) FILTER (WHERE {broken}) AS violations FROM {name}"
        for rule, c, broken in conditions
    ]
    out += [
        f"SELECT 'unique', '{name}', '{','.join(key)}', count(*) FROM "
        f"(SELECT 1 FROM {name} GROUP BY {', '.join(key)} HAVING count(*) > 1)"
        for key in spec.keys
        if set(key) <= set(columns)
    ]
    out += [
        f"SELECT 'foreign_key', '{name}', '{c}', count(*) FROM {name} x WHERE x.{c} IS NOT NULL "
        f"AND NOT EXISTS (SELECT 1 FROM {parent} y WHERE y.{key} = x.{c})"
        for c, (parent, key) in spec.parents.items()
    ]
    return out


@query(
    "dq_source_tables",
    roles.with_roles(
        " ".join(_CHECKED), " UNION ALL ".join(line for n in _CHECKED for line in _rules_sql(n))
    ),
)
def dq_source_tables(spark, d):
    """Every rule of the source tables on the given tables in their shape, each written
    once as its source table would be; the targets are made of the written ones."""
    frames = {name: materialize(getattr(roles, name)(spark, d), name) for name in _CHECKED if name != "well_targets"}
    frames["well_targets"] = materialize(marts.well_targets(frames["production"], frames["telemetry"]), "well_targets")
    return check_tables(frames, TABLES)


def _verdicts_sql(name: str) -> str:
    """SQL for the rows of a source table that break rules, with the names of these."""
    spec = TABLES[name]
    columns = [c for c in spec.columns if c not in _ABSENT.get(name, ())]
    broken = [(f"not_null:{c}", f"{c} IS NULL") for c in columns]
    for c, (low, high, strict) in spec.ranges.items():
        ends = [f"{c} {'<=' if strict else '<'} {low}"] if low is not None else []
        ends += [f"{c} > {high}"] if high is not None else []
        broken.append((f"range:{c}", " OR ".join(ends)))
    for c, values in spec.allowed.items():
        broken.append((f"allowed:{c}", f"{c} NOT IN ({', '.join(map(repr, values))})"))
    for key in spec.keys:
        if set(key) <= set(columns):
            broken.append((f"unique:{','.join(key)}", f"count(*) OVER (PARTITION BY {', '.join(key)}) > 1"))
    for c, (parent, key) in spec.parents.items():
        broken.append((f"foreign_key:{c}", f"{c} IS NOT NULL AND {c} NOT IN (SELECT {key} FROM {parent} WHERE {key} IS NOT NULL)"))
    listed = ", ".join(f"CASE WHEN {b} THEN '{n}' END" for n, b in broken)
    return f"SELECT *, array_to_string([x FOR x IN [{listed}] IF x IS NOT NULL], ' ') AS broken_rules FROM {name}"


@query(
    "dq_rows",
    roles.with_roles(
        "wells production deliveries pump_failures",
        f"""SELECT 'production' AS table_name, production_id AS id, broken_rules FROM ({_verdicts_sql('production')}) WHERE broken_rules <> ''
            UNION ALL SELECT 'deliveries', delivery_id, broken_rules FROM ({_verdicts_sql('deliveries')}) WHERE broken_rules <> ''
            UNION ALL SELECT 'pump_failures', failure_id, broken_rules FROM ({_verdicts_sql('pump_failures')}) WHERE broken_rules <> ''""",
    ),
)
def dq_rows(spark, d):
    """The rows of three source tables that break a rule, as the quarantine holds them."""
    wells = roles.wells(spark, d)
    lines = []
    for name, key in (("production", "production_id"), ("deliveries", "delivery_id"), ("pump_failures", "failure_id")):
        rows = getattr(roles, name)(spark, d)
        clean, held = (ParquetStore(spark, scratch_path(spark, f"{kind}-{name}")) for kind in ("clean", "held"))
        # The given tables lack some of the contract's columns, so they are read as they are.
        quarantine(rows, TABLES[name], _AsIs(clean), _AsIs(held), {"wells": wells})
        bad = _AsIs(held).read(name)
        lines.append(bad.select(F.lit(name).alias("table_name"), F.col(key).alias("id"), F.array_join("broken_rules", " ").alias("broken_rules")))
    return plain(union_all(lines))


class _AsIs(NamedTuple):
    """A store that reads a table in the types it was written in."""

    store: ParquetStore

    def replace(self, name, df):
        self.store.replace(name + "_", df)

    def read(self, name):
        return self.store.read(name + "_")
