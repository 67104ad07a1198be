"""Quality rules by host: rule failures are counted per host, the rates are shrunk
towards the average host with an empirical beta prior, and what a host is convicted
of is joined back to its documents.

A document falls for what it fails itself: the base rules (too short, too
repetitive) drop it anywhere; the soft rules (symbols, repeated lines, odd word
lengths) drop it only on a host whose shrunk failure rate for that same rule is
above ``max_rate``, where the failure is a habit of the host and no accident. So a
document without failures is kept on any host.

Scale: words, lines and windows stay inside the row (no shuffle of text); the
measured rows are summed per host with map-side combine and joined with one narrow row
per host, which adaptive execution
broadcasts when it is small and splits against a hot host otherwise. The prior is
one row of sums.

Edge cases: null and empty texts have no words and fail as too short; a null host
is a host of its own; repeated rows count as often as they occur and get equal
verdicts; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from derrick.llm.common import BLANK, cols, documents, let, space_words
from derrick.sources.scratch import materialize

WINDOW = 5
SYMBOLS = "#*$%&|<>"
#: Soft rules; each is true where a document fails it.
SOFT = ("soft_symbols", "soft_lines", "soft_length")
MAX_RATE = 0.2


def _repeated(words: Column) -> Column:
    """Words inside windows that occur at least twice. Where no two windows have
    one hash, the usual case, none are equal; else the windows themselves are sorted."""

    def positions(windows: Column) -> Column:
        tagged = F.sort_array(F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))

        def mark(s: Column) -> Column:
            near = F.transform(
                s,
                lambda x, k: F.when(
                    (F.get(s, k - 1)["w"] == x["w"]) | (F.get(s, k + 1)["w"] == x["w"]), x["i"]
                ),
            )
            return F.sort_array(F.filter(near, lambda i: i.isNotNull()))

        return let(tagged, mark)

    def covered(at: Column) -> Column:
        start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n"))
        return F.aggregate(
            at,
            start,
            lambda a, i: F.struct(
                i.alias("last"), (a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n")
            ),
            lambda a: a["n"],
        )

    def texts(w: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(w) - (WINDOW - 1))
        return F.transform(starts, lambda i: F.concat_ws(" ", F.slice(w, i, WINDOW)))

    def count(w: Column) -> Column:
        hashed = F.transform(
            w, lambda x, i: F.xxhash64(x, *(F.get(w, i + k) for k in range(1, WINDOW)))
        )
        unique = F.size(F.array_distinct(hashed)) == F.size(w)
        return F.when(unique, 0).otherwise(covered(positions(texts(w))))

    return F.when(F.size(words) <= WINDOW, 0).otherwise(count(words))


def measures(text: Column) -> dict[str, Column]:
    """The measures of a text."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda s: s.rlike(f"[^{BLANK}]"))
    counted = let(
        lines,
        lambda a: F.struct(
            F.size(a).alias("n"), (F.size(a) - F.size(F.array_distinct(a))).alias("dup")
        ),
    )
    words = let(
        space_words(text),
        lambda w: F.struct(
            F.size(w).alias("n"),
            F.length(F.array_join(w, "")).alias("chars"),
            _repeated(w).alias("again"),
        ),
    )
    return {
        "__words": words,
        "__lines": counted,
        "n_symbols": F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).cast("long"),
    }


def measure(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """``docs`` reduced to ``__host`` and the measures and rules, beside ``__row``
    (a struct of the original columns)."""
    m = measures(F.col(text))
    out = docs.select(F.struct(*cols(docs)).alias("__row"), F.col(host).alias("__host"),
                      *(c.alias(n) for n, c in m.items()))
    out = out.select(
        "__row", "__host",
        F.col("__words.n").cast("long").alias("n_words"),
        F.col("__words.chars").cast("long").alias("word_chars"), "n_symbols",
        F.col("__lines.dup").cast("long").alias("n_dup_lines"),
        F.col("__words.again").cast("long").alias("n_repeat_words"),
        F.col("__lines.n").alias("__n_lines"),
    )
    n = F.col("n_words")
    return out.select(
        "*",
        ((n < 10) | (100 * F.col("n_repeat_words") > 20 * n)).alias("base_failed"),
        (10 * F.col("n_symbols") > n).alias("soft_symbols"),
        (10 * F.col("n_dup_lines") > 3 * F.col("__n_lines")).alias("soft_lines"),
        ((F.col("word_chars") < 3 * n) | (F.col("word_chars") > 12 * n)).alias("soft_length"),
    ).drop("__n_lines")


def host_verdicts(measured: DataFrame, max_rate: float = MAX_RATE) -> DataFrame:
    """One row per host: documents, and per soft rule the failures, the shrunk rate
    and whether the host is convicted of it.

    The beta prior has the mean m = failures / documents of all hosts and the size
    k = m (1 - m) / v - 1, with v the variance of the hosts' rates weighted by
    documents; k is kept between 1 and the number of documents, so hosts that all
    agree are shrunk together and hosts that differ speak for themselves.
    """
    hosts = materialize(
        measured.groupBy("__host").agg(
            F.count(F.lit(1)).alias("n_docs"),
            *(F.sum(F.col(s).cast("long")).alias(f"n_{s}") for s in SOFT),
        ),
        "hosts",
    )
    sums = hosts.agg(
        F.sum("n_docs").alias("n"),
        *(F.sum(f"n_{s}").alias(f"f_{s}") for s in SOFT),
        *(F.sum(F.col(f"n_{s}").cast("double") * F.col(f"n_{s}") / F.col("n_docs")).alias(f"q_{s}") for s in SOFT),
    ).first()
    total = sums["n"] or 0
    rates = []
    for s in SOFT:
        mean = sums[f"f_{s}"] / total if total else 0.0
        spread = sums[f"q_{s}"] / total - mean * mean if total else 0.0
        size = mean * (1 - mean) / spread - 1 if spread > 1e-12 else float(total)
        size = min(max(size, 1.0), max(float(total), 1.0))
        rates.append(((F.col(f"n_{s}") + mean * size) / (F.col("n_docs") + size)).alias(f"rate_{s}"))
    return hosts.select("*", *rates).select(
        "*", *((F.col(f"rate_{s}") > max_rate).alias(f"bad_{s}") for s in SOFT)
    )


def judge(measured: DataFrame, max_rate: float = MAX_RATE) -> DataFrame:
    """``measured`` with ``kept``; false for base failures and
    for soft failures that the document's host is convicted of."""
    verdicts = host_verdicts(measured, max_rate).select(
        F.col("__host").alias("__of"), *(f"bad_{s}" for s in SOFT)
    )
    joined = measured.join(verdicts, F.col("__host").eqNullSafe(F.col("__of")), "left")
    soft = F.lit(False)
    for s in SOFT:
        soft = soft | (F.col(s) & F.col(f"bad_{s}"))
    return joined.withColumn("kept", ~F.col("base_failed") & ~soft).drop("__of")


def op3_quality_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    measured = measure(docs).withColumn("doc_id", F.col("__row.doc_id")).drop("__row")
    out = judge(materialize(measured, "measured"))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the rules keep, all columns as they came. The measures are
    taken twice, for the hosts and for the verdicts, so no text is written for them."""
    return judge(measure(docs)).filter("kept").select("__row.*")


def base_sql(docs: str = "documents", keep: str = "doc_id") -> str:
    """DuckDB twin of the measures and verdicts over ``docs``; ``keep`` names
    further columns to carry."""
    return rf"""
    q_docs AS (SELECT row_number() OVER () AS rid, source AS host, coalesce(text, '') AS body, {keep} FROM {docs}),
    q_words AS (SELECT rid, regexp_extract_all(body, '[^\x20\x09-\x0D]+') AS w FROM q_docs),
    q_win AS (SELECT rid, i, array_to_string(w[i:i + 4], ' ') AS g
        FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS i FROM q_words WHERE len(w) >= 5)),
    q_again AS (SELECT rid, count(DISTINCT i + k) AS n FROM
        (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM q_win), range(0, 5) t(k)
        WHERE c > 1 GROUP BY rid),
    q_lines AS (SELECT rid, count(*) AS n, count(DISTINCT s) AS d FROM
        (SELECT rid, unnest(string_split(body, chr(10))) AS s FROM q_docs)
        WHERE regexp_matches(s, '[^\x20\x09-\x0D]') GROUP BY rid),
    q_m AS (SELECT d.*, CAST(len(w) AS BIGINT) AS n_words,
        CAST(length(regexp_replace(body, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(coalesce(l.n - l.d, 0) AS BIGINT) AS n_dup_lines, coalesce(l.n, 0) AS n_lines,
        CAST(coalesce(a.n, 0) AS BIGINT) AS n_repeat_words
        FROM q_docs d JOIN q_words USING (rid) LEFT JOIN q_again a USING (rid) LEFT JOIN q_lines l USING (rid)),
    q_r AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
        10 * n_symbols > n_words AS s1, 10 * n_dup_lines > 3 * n_lines AS s2,
        word_chars < 3 * n_words OR word_chars > 12 * n_words AS s3 FROM q_m),
    q_h AS (SELECT host, count(*) AS n, sum(s1::INT) AS f1, sum(s2::INT) AS f2, sum(s3::INT) AS f3 FROM q_r GROUP BY host),
    q_t AS (SELECT sum(n) AS n, {", ".join(f"sum(f{i}) / sum(n) AS m{i}, sum(f{i} * f{i} / n) / sum(n) AS q{i}" for i in (1, 2, 3))} FROM q_h),
    q_p AS (SELECT *, {", ".join(f"least(greatest(CASE WHEN q{i} - m{i} * m{i} > 1e-12 THEN m{i} * (1 - m{i}) / (q{i} - m{i} * m{i}) - 1 ELSE n END, 1.0), n) AS k{i}" for i in (1, 2, 3))} FROM q_t),
    q_v AS (SELECT host, {", ".join(f"(h.f{i} + m{i} * k{i}) / (h.n + k{i}) > {MAX_RATE} AS b{i}" for i in (1, 2, 3))} FROM q_h h, q_p),
    q_out AS (SELECT r.*, NOT base_failed AND NOT (s1 AND b1) AND NOT (s2 AND b2) AND NOT (s3 AND b3) AS kept
        FROM q_r r JOIN q_v v ON r.host IS NOT DISTINCT FROM v.host)"""


SQL = f"""WITH {base_sql()}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM q_out"""
