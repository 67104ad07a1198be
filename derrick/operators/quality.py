"""Data-quality rules: counts as (rule, table_name, column_name, violations), and the
verdict on every row as a bit mask."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from derrick.functions import micros
from derrick.operators.aggregates import union_all
from derrick.schemas import TableSpec


def count_rules(
    df: DataFrame, table: str, rules: Sequence[tuple[str, str, Column]]
) -> DataFrame:
    """Rows that break each (rule, column, condition), all rules in one pass."""
    counts = df.agg(
        *(F.count_if(broken).alias(f"_{i}") for i, (_, _, broken) in enumerate(rules))
    )
    lines = F.array(
        *(
            F.struct(
                F.lit(rule).alias("rule"),
                F.lit(column).alias("column_name"),
                F.col(f"_{i}").alias("violations"),
            )
            for i, (rule, column, _) in enumerate(rules)
        )
    )
    return counts.select(F.explode(lines).alias("v")).select(
        "v.rule", F.lit(table).alias("table_name"), "v.column_name", "v.violations"
    )


def not_null_rules(columns: Sequence[str]) -> list[tuple[str, str, Column]]:
    return [("not_null", c, F.col(c).isNull()) for c in columns]


def range_rules(
    ranges: Mapping[str, tuple[float | None, float | None, bool]],
) -> list[tuple[str, str, Column]]:
    """A null breaks no range; ``strict`` excludes the lower end itself."""
    rules = []
    for c, (low, high, strict) in ranges.items():
        broken = F.lit(False)
        if low is not None:
            broken |= (F.col(c) <= low) if strict else (F.col(c) < low)
        if high is not None:
            broken |= F.col(c) > high
        rules.append(("range", c, broken))
    return rules


def allowed_rules(allowed: Mapping[str, Sequence[str]]) -> list[tuple[str, str, Column]]:
    return [("allowed", c, ~F.col(c).isin(*values)) for c, values in allowed.items()]


def check_unique(df: DataFrame, table: str, key: Sequence[str]) -> DataFrame:
    """Key values that occur more than once; copies are combined before the shuffle."""
    repeated = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    return repeated.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit("unique").alias("rule"),
        F.lit(table).alias("table_name"),
        F.lit(",".join(key)).alias("column_name"),
        "violations",
    )


def check_foreign_key(
    child: DataFrame, table: str, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Child rows whose key has no parent. Rows are counted per key first, so a
    key that holds much of the table joins as one row."""
    used = (
        child.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("_key"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    known = parent.select(F.col(parent_column).alias("_key"))
    orphans = used.join(known, "_key", "left_anti")
    return orphans.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("violations")).select(
        F.lit("foreign_key").alias("rule"),
        F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"),
        "violations",
    )


def _row_rules(df: DataFrame, spec: TableSpec) -> list[tuple[str, str, Column]]:
    present = [c for c in spec.columns if c in df.columns]
    return not_null_rules(present) + range_rules(spec.ranges) + allowed_rules(spec.allowed)


def _keys(df: DataFrame, spec: TableSpec) -> list[tuple[str, ...]]:
    return [key for key in spec.keys if set(key) <= set(df.columns)]


def _parents(spec: TableSpec, parents: Mapping[str, DataFrame] | None) -> list[tuple[str, str, str]]:
    """(column, parent, its column) of the foreign keys whose parent is given."""
    return [(c, p, k) for c, (p, k) in spec.parents.items() if parents and p in parents]


def _key_hash(columns: Sequence[Column]) -> Column:
    """128 bits for a key; nulls are values of their own."""
    parts = [x for c in columns for x in (c.isNull(), c)]
    first = F.xxhash64(*parts)
    return F.struct(first.alias("h1"), F.xxhash64(F.lit(1), first, *parts).alias("h2"), F.lit(0).alias("nulls"))


_MOMENTS = (T.TimestampType, T.TimestampNTZType)
_NARROW = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType, *_MOMENTS)


def _is_narrow(df: DataFrame, key: Sequence[str]) -> bool:
    return len(key) <= 2 and all(isinstance(df.schema[c].dataType, _NARROW) for c in key)


def _key(df: DataFrame, key: Sequence[str]) -> Column:
    """128 bits for a key: up to two whole numbers, days or moments as they are, which
    shuffles pack better than hashes, with a mask of their nulls; the hash of any other."""
    if not _is_narrow(df, key):
        return _key_hash([F.col(c) for c in key])
    parts = []
    for c in key:
        kind = df.schema[c].dataType
        value = micros(df, c) if isinstance(kind, _MOMENTS) else F.unix_date(c) if isinstance(kind, T.DateType) else F.col(c)
        parts.append(F.coalesce(value.cast("long"), F.lit(0).cast("long")))
    parts += [F.lit(0).cast("long")] * (2 - len(parts))
    nulls = sum((F.col(c).isNull().cast("int") * (1 << i) for i, c in enumerate(key)), F.lit(0))
    return F.struct(parts[0].alias("h1"), parts[1].alias("h2"), nulls.alias("nulls"))


def check_tables(frames: Mapping[str, DataFrame], specs: Mapping[str, TableSpec]) -> DataFrame:
    """All rules of several tables. Each table is read once for its row rules and once
    for its keys: every unique key, foreign key and referenced key of all tables goes
    as 128 bits into one aggregation, where equal keys meet (counted map-side, so a hot
    key is one row a task), and a second one counts what is broken."""
    parts, keyed, kinds = [], [], []
    for name, df in frames.items():
        spec = specs[name]
        parts.append(count_rules(df, name, _row_rules(df, spec)))
        asked = []
        for key in _keys(df, spec):
            asked.append((len(kinds), _key(df, key), F.lit(True), F.lit(False)))
            kinds.append(("unique", name, ",".join(key)))
        for column, parent, parent_column in _parents(spec, frames):
            # One type on both sides, so that equal keys have equal bits.
            whole = all(isinstance(t.schema[c].dataType, T.IntegralType) for t, c in ((df, column), (frames[parent], parent_column)))
            own, other = (
                _key(t, [c]) if whole else _key_hash([F.col(c).cast("string")]) for t, c in ((df, column), (frames[parent], parent_column))
            )
            asked.append((len(kinds), own, F.col(column).isNotNull(), F.lit(False)))
            used = frames[parent].select(F.struct(F.lit(len(kinds)).alias("kind"), other.alias("key"), F.lit(True).alias("known")).alias("k"))
            keyed.append(used)
            kinds.append(("foreign_key", name, column))
        if asked:
            held = F.array(*(
                F.when(there, F.struct(F.lit(kind).alias("kind"), key.alias("key"), known.alias("known")))
                for kind, key, there, known in asked
            ))
            keyed.append(df.select(F.explode(F.array_compact(held)).alias("k")))
    if keyed:
        rows = union_all(keyed).groupBy("k.kind", "k.key").agg(
            F.count_if(~F.col("k.known")).alias("n"), F.max("k.known").alias("known")
        )
        unique = [i for i, kind in enumerate(kinds) if kind[0] == "unique"]
        broken = F.when(F.col("kind").isin(unique), (F.col("n") > 1).cast("long")).when(~F.col("known"), F.col("n")).otherwise(0)
        counts = rows.agg(*(F.coalesce(F.sum(F.when(F.col("kind") == i, broken)), F.lit(0)).alias(f"_{i}") for i in range(len(kinds))))
        lines = F.array(*(
            F.struct(F.lit(rule).alias("rule"), F.lit(t).alias("table_name"), F.lit(c).alias("column_name"), F.col(f"_{i}").alias("violations"))
            for i, (rule, t, c) in enumerate(kinds)
        ))
        parts.append(counts.select(F.explode(lines).alias("v")).select("v.*"))
    return union_all(parts)


def check_table(
    df: DataFrame, spec: TableSpec, parents: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """All rules of a source table: one pass for the row rules, one aggregate per
    key, one join per foreign key whose parent is given."""
    parts = [count_rules(df, spec.name, _row_rules(df, spec))]
    parts += [check_unique(df, spec.name, key) for key in _keys(df, spec)]
    for column, parent, parent_column in _parents(spec, parents):
        parts.append(check_foreign_key(df, spec.name, column, parents[parent], parent_column))
    return union_all(parts)


#: Rules whose verdicts fit the bits of one mask.
MOST_RULES = 63


def judged_rows(
    df: DataFrame, spec: TableSpec, parents: Mapping[str, DataFrame] | None = None, mask: str = "broken"
) -> tuple[DataFrame, list[str]]:
    """Every row with a bit mask of the rules that it breaks (0: none), and the rules'
    names by bit. A row breaks ``unique`` if another row has its key, and ``foreign_key`` if
    its key is set and has no parent.

    Row rules are expressions of the one scan. Only broken keys are joined to the rows:
    those that repeat and those without a parent come from aggregates with map-side
    combine, and adaptive execution broadcasts them where they are few.
    """
    names: list[str] = []
    bits: list[Column] = []

    def add(rule: str, column: str, broken: Column) -> None:
        if len(names) == MOST_RULES:
            raise ValueError(f"{spec.name} has more than {MOST_RULES} rules, which a mask holds")
        bits.append(F.when(F.coalesce(broken, F.lit(False)), F.lit(1 << len(names))).otherwise(F.lit(0)).cast("long"))
        names.append(f"{rule}:{column}")

    for rule, column, broken in _row_rules(df, spec):
        add(rule, column, broken)
    rows = df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"), *(F.col(f"`{c}`").alias(c) for c in df.columns))
    marks: list[str] = []
    for key in _keys(df, spec):
        mark = f"_u{len(marks)}"
        own = [f"_k{i}" for i in range(len(key))]
        repeated = df.groupBy(*(F.col(c).alias(k) for c, k in zip(key, own))).agg(F.count(F.lit(1)).alias("_n"))
        repeated = repeated.filter("_n > 1").select(*own, F.lit(True).alias(mark))
        met = [F.col(c).eqNullSafe(F.col(k)) for c, k in zip(key, own)]
        rows = rows.join(repeated, met, "left").drop(*own)
        add("unique", ",".join(key), F.col(mark))
        marks.append(mark)
    for column, parent, parent_column in _parents(spec, parents):
        mark = f"_f{len(marks)}"
        used = df.select(F.col(column).alias("_k")).filter("_k IS NOT NULL").distinct()
        known = parents[parent].select(F.col(parent_column).alias("_k"))
        orphans = used.join(known, "_k", "left_anti").select("_k", F.lit(True).alias(mark))
        rows = rows.join(orphans, F.col(column) == F.col("_k"), "left").drop("_k")
        add("foreign_key", column, F.col(mark))
        marks.append(mark)
    total = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseOR(bit)
    return rows.select("row.*", total.alias(mask)), names


def broken_names(mask: str, names: Sequence[str]) -> Column:
    """The names of a mask's rules, in the order of the bits."""
    named = F.array(*(F.when(F.col(mask).bitwiseAND(F.lit(1 << i)) != 0, F.lit(n)) for i, n in enumerate(names)))
    return F.array_compact(named)
