"""Mixing sources to target weights along a time-varying curriculum.

Every source gets a share of the training run (weights that repeat over the sources
in code-point order, no source above ``MAX_PASSES`` times its own words, the excess
shared again) and a schedule that says how its weight moves over the run. The
schedule is piecewise linear; integrated, it is the source's cumulative demand, and
the inverse of that says at which point of the run its n-th word is due. A source's
documents form a stream in hash order, read again from the start when it runs out;
a document starts where its first word falls in that stream, so inverting the demand
there gives its training position. The last document of a stream is cut where the
target ends.

Scale: the stream's running word counts come from block sums, not from one window
over a source. Documents fall into 16^4 hash blocks per source; the block sums are
accumulated in two levels (at most 256 rows in any window), and only the rows of one
block meet in a task. Sources are one narrow row each. The result is range-sorted by
position; documents that the mix does not reach lie beyond 1 in stream order, so no
position is crowded.

Edge cases: null and empty texts have size 0 and are never taken; the null source is
the last source; ids may be missing or repeated, as the order is by a hash of id and
text; equal rows are separate copies, whose shares are the same in any order; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from derrick.llm.common import cols, documents, settled, space_words
from derrick.sources.scratch import materialize

WEIGHTS = (5, 2, 1)
#: Weight over the run at equally spaced times, by the same repeating rank as WEIGHTS:
#: heavy sources fade out, light ones fade in.
SCHEDULES = ((1.5, 1.0, 0.5), (1.0, 1.0, 1.0), (0.5, 1.0, 1.5))
MAX_PASSES = 3
COARSE, FINE = 2, 4


def inverse_demand(u: str, knots: Sequence[float]) -> str:
    """SQL for the time at which the share ``u`` (0 to 1) of a schedule's whole demand
    is due. Within a segment from weight a to b the demand after the part x of it is
    a x + (b - a) x^2 / 2, whose inverse is taken in the form without cancellation. Both engines read its literals as doubles."""
    if len(knots) < 2 or min(knots) < 0 or max(knots) <= 0:
        raise ValueError("a schedule needs two or more weights, none negative, one positive")
    pairs = list(zip(knots, knots[1:]))
    whole, before, out = sum((a + b) / 2 for a, b in pairs), 0.0, ""
    for k, (a, b) in enumerate(pairs):
        area = (a + b) / 2
        rest = f"({u} * {whole!r}e0 - {before!r}e0)"
        root = f"sqrt(greatest({a * a!r}e0 + {2 * (b - a)!r}e0 * {rest}, 0e0))"
        at = f"CASE WHEN {rest} <= 0e0 THEN {float(k)!r}e0 ELSE {float(k)!r}e0 + 2e0 * {rest} / ({a!r}e0 + {root}) END"
        last = k == len(pairs) - 1
        out += f"ELSE {at}" if last else f"WHEN {u} * {whole!r}e0 < {before + area!r}e0 THEN {at} "
        before += area
    found = f"CASE {out} END" if len(pairs) > 1 else out.removeprefix("ELSE ")
    return f"least(({found}) / {float(len(pairs))!r}e0, 1e0)"


def sized(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
          keep: bool = False) -> DataFrame:
    """Source, size and hash place of every document; with ``keep`` also ``__row``,
    the struct of its columns."""
    body = F.coalesce(F.col(text), F.lit(""))
    label = F.coalesce(F.col(doc_id).cast("string"), F.lit("?"))
    named = F.when(F.col(source).isNull(), "0").otherwise(F.concat(F.lit("1"), F.col(source)))
    return docs.select(
        F.struct(*cols(docs)).alias("__row") if keep else F.col(doc_id).alias("doc_id"),
        F.col(source).alias("__source"),
        named.alias("__src"),
        F.size(space_words(F.col(text))).cast("long").alias("size"),
        F.md5(F.concat(label, F.lit(":"), F.md5(body))).alias("__place"),
    )


def targets(blocks: DataFrame, weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """One row per source: rank, words and target. With the sources ordered by how
    soon they reach their cap, the first whose cap holds at the level that is left
    after all before it are full sets the level for the rest."""
    by_name = Window.orderBy(F.col("__source").isNull(), "__source")
    w = blocks.groupBy("__source").agg(F.sum("words").alias("source_size"))
    w = w.withColumn("rank", F.row_number().over(by_name) - 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), F.col("rank") % len(weights) + 1)
    cap = MAX_PASSES * F.col("source_size")
    w = w.select("*", weight.alias("weight"), cap.alias("cap"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    past, every = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    w = w.select(
        "*",
        F.row_number().over(order).alias("place"),
        (F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(past), F.lit(0))).alias("left"),
        (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(past), F.lit(0))).alias("heavy"),
    ).withColumn("level", F.col("left") / F.col("heavy"))
    holds = F.when(F.col("cap") >= F.col("level") * F.col("weight"), F.struct("place", "level"))
    w = w.withColumn("first", F.min(holds).over(every))
    full = F.col("place") < F.col("first.place")
    target = F.when(full, F.col("cap").cast("double")).otherwise(F.col("first.level") * F.col("weight"))
    return w.select("__source", "rank", "source_size", target.alias("target"))


def plan(rows: DataFrame, weights: Sequence[int] = WEIGHTS,
         schedules: Sequence[Sequence[float]] = SCHEDULES) -> DataFrame:
    """``rows`` (from ``sized``; read twice) with its source's words and target, the
    words taken, the words of the stream before it and its training position: in
    [0, 1] where the run reaches it, above 1 in stream order where it does not."""
    # One non-null key for the source, so that counting, joining and summing agree on
    # where a row goes and its text is shuffled once.
    rows = rows.withColumn("__fine", F.substring("__place", 1, FINE))
    blocks = rows.groupBy("__source", "__src", "__fine").agg(F.sum("size").alias("words"))
    blocks = materialize(blocks, "blocks")
    sources = targets(blocks, weights).withColumnRenamed("__source", "__of")
    blocks = blocks.join(sources, F.col("__source").eqNullSafe(F.col("__of"))).drop("__of")
    blocks = blocks.withColumn("__coarse", F.substring("__fine", 1, COARSE))
    coarse = blocks.groupBy("rank", "__coarse").agg(F.sum("words").alias("words"))
    start = Window.partitionBy("rank").orderBy("__coarse").rowsBetween(Window.unboundedPreceding, -1)
    coarse = coarse.select(
        F.col("rank").alias("__rank"), F.col("__coarse").alias("__block"),
        F.coalesce(F.sum("words").over(start), F.lit(0)).alias("__base"),
    )
    blocks = blocks.join(coarse, (F.col("rank") == F.col("__rank")) & (F.col("__coarse") == F.col("__block")))
    inner = Window.partitionBy("rank", "__coarse").orderBy("__fine").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        F.col("__src").alias("__of"), F.col("__fine").alias("__at"), "rank", "source_size", "target",
        (F.col("__base") + F.coalesce(F.sum("words").over(inner), F.lit(0))).alias("__start"),
    )
    rows = rows.join(blocks, (F.col("__src") == F.col("__of")) & (F.col("__fine") == F.col("__at")))
    own = Window.partitionBy("__src", "__fine").orderBy("__place").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn(
        "before", F.col("__start") + F.coalesce(F.sum("size").over(own), F.lit(0))
    ).withColumn("__budget", F.floor("target"))
    words = F.col("source_size")
    rest = F.col("__budget") % words - F.col("before")
    taken = F.when(words == 0, 0).otherwise(
        F.expr("__budget div source_size") * F.col("size")
        + F.greatest(F.lit(0), F.least(F.col("size"), rest))
    )
    kinds = len(schedules)
    u = "CAST(before AS DOUBLE) / target"
    due = F.coalesce(*(F.when(F.col("rank") % kinds == i, F.expr(inverse_demand(u, k))) for i, k in enumerate(schedules)))
    late = F.when(words == 0, F.lit(2.0)).otherwise(1 + F.col("before") / words)
    position = F.when((F.col("before") < F.col("target")) & (F.col("size") > 0), due).otherwise(late)
    return rows.select(
        "*", taken.cast("long").alias("taken"), position.alias("position")
    ).drop("__of", "__at", "__start", "__budget", "__fine", "__src")


def training_order(planned: DataFrame, schedules: Sequence[Sequence[float]] = SCHEDULES) -> DataFrame:
    """One row per pass over a document, with the words it gives and the position at
    which it is due, sorted by position: the order in which a trainer reads."""
    passes = F.expr("explode(sequence(0, cast(floor((taken + size - 1) / size) as int) - 1))")
    rows = planned.filter("taken > 0").select("*", passes.alias("pass"))
    u = "least(CAST(before + pass * source_size AS DOUBLE) / target, 1e0)"
    due = F.coalesce(*(F.when(F.col("rank") % len(schedules) == i, F.expr(inverse_demand(u, k))) for i, k in enumerate(schedules)))
    words = F.least(F.col("size"), F.col("taken") - F.col("pass") * F.col("size"))
    return rows.withColumn("position", due).withColumn("words", words).orderBy("position", "__place", "pass")


def op2_mix_curriculum(spark: SparkSession, sf_dir: str) -> DataFrame:
    def make() -> DataFrame:
        return plan(materialize(sized(documents(spark, sf_dir)), "sized"))

    planned = settled(spark, "planned", make).orderBy("position", "__place")
    return planned.select(
        "doc_id", "size", "source_size", "target", "taken",
        F.round(F.col("position") * 1e6).cast("long").alias("position_ppm"),
    )


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix takes, in training order: their columns, and those of the plan. A
    column of the documents that is named like one of the plan is called ``doc_`` and its name."""
    planned = settled(spark, "planned", lambda: plan(sized(docs, keep=True)).filter("taken > 0"))
    planned = planned.orderBy("position", "__place")
    names = set(docs.columns) | set(_PLAN)
    own = []
    for c in docs.columns:
        name = c
        while name in _PLAN or (name != c and name in names):
            name = f"doc_{name}"
        own.append(F.col("__row").getField(c).alias(name))
    return planned.select(*own, *_PLAN[:-1], F.round(F.col("position") * 1e6).cast("long").alias("position_ppm"))


_PLAN = ("size", "source_size", "target", "taken", "position_ppm")


def plan_sql(docs: str, keep: str) -> str:
    """DuckDB twin of the plan over ``docs``, in plain windows; ends in m_plan."""
    due = " ".join(f"WHEN {i} THEN {inverse_demand('(before / target)', k)}" for i, k in enumerate(SCHEDULES))
    return rf"""
    m_size AS (SELECT {keep}, source AS m_source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
        md5(concat(coalesce(doc_id::VARCHAR, '?'), ':', md5(coalesce(text, '')))) AS place FROM {docs}),
    m_src AS (SELECT m_source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY m_source IS NULL, m_source) - 1 AS rank FROM m_size GROUP BY m_source),
    m_cap AS (SELECT *, [{", ".join(map(str, WEIGHTS))}][(rank % {len(WEIGHTS)} + 1)::INT] AS weight, {MAX_PASSES} * source_size AS cap FROM m_src),
    m_lvl AS (SELECT *, row_number() OVER o AS k, ((sum(source_size) OVER ())::BIGINT - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)
        / ((sum(weight) OVER ())::BIGINT - coalesce(sum(weight) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT) AS level
        FROM m_cap WINDOW o AS (ORDER BY cap / weight, rank)),
    m_first AS (SELECT k AS fk, level AS fl FROM m_lvl WHERE cap >= level * weight ORDER BY k LIMIT 1),
    m_tgt AS (SELECT m_source, rank, source_size, CASE WHEN k < fk THEN cap::DOUBLE ELSE fl * weight END AS target FROM m_lvl, m_first),
    m_row AS (SELECT d.*, rank, source_size, target, coalesce(sum(size) OVER (PARTITION BY rank ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
        FROM m_size d JOIN m_tgt t ON d.m_source IS NOT DISTINCT FROM t.m_source),
    m_plan AS (SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE (floor(target)::BIGINT // source_size) * size
        + greatest(0, least(size, floor(target)::BIGINT % source_size - before)) END::BIGINT AS taken,
        round((CASE WHEN before < target AND size > 0 THEN CASE rank % {len(SCHEDULES)} {due} END
            WHEN source_size = 0 THEN 2.0 ELSE 1 + before / source_size END) * 1e6)::BIGINT AS position_ppm FROM m_row)"""


SQL = f"""WITH {plan_sql("documents", "doc_id")}
SELECT doc_id, size, source_size, target, taken, position_ppm FROM m_plan"""
