"""Benchmark decontamination as a prefix-filtered set join with exact verification.

A window is ``WINDOW`` consecutive words of an item (a shorter item is one window).
A window is a set of placed shingles of ``SHINGLE`` words; it occurs in a document
only if all of them do, each at its place. So:

1. every shingle of every document meets the distinct shingles of the benchmark
   (counted, and broadcast while small); what matches is written: document, place,
   shingle;
2. the matches are counted per shingle, and the shingles of each window ordered by
   rarity; as all must occur, the prefix that a document cannot avoid is the rarest one;
3. only matches of prefix shingles propose a window at its place; length and position
   bounds drop those that would leave the document;
4. each proposal is verified in full: the matches at all places of the window must be
   the window's shingles. Shingles are compared by a 64-bit hash of their words: a
   wrong window of 13 words needs eleven equal hashes in a row.

Scale: the text is read once and never shuffled; the exploded rows meet a broadcast
table, and only matches (a document key, a place and a shingle id) are written and
shuffled. Proposals are matches of rare shingles; windows with equal words are one
window, so repeated items and copied passages multiply nothing. A benchmark too large
to broadcast goes through an ordinary shuffled join.

Edge cases: null and empty texts and items have no words: no window, no hit, not
contaminated. Equal rows get equal rows; a missing id is an id like any other. Items
are told apart by their id, a null id counts as an item named ''. Empty tables give no
rows (documents) or no hits (benchmark). Further columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from derrick.llm.common import cols, documents, hinted, let, lower_ascii, row_key, settled
from derrick.sources.scratch import materialize

WINDOW, SHINGLE = 13, 3
#: A document is contaminated when one word in SHARE is hit.
SHARE = 20
CASED_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def bench_words(text: Column) -> Column:
    """Lower-cased ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` words; none for null."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), NOT_WORD), "")


def grams(words: Column, n: int) -> Column:
    """Hashes of the ``n``-word shingles by place. The last ``n - 1`` places hold
    shorter ones and are to be left out."""
    return F.transform(
        words, lambda w, i: F.xxhash64(w, *(F.get(words, i + k) for k in range(1, n)))
    )


def count_words(text: Column) -> Column:
    """Number of ``bench_words``, without lowering or cutting the text."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(CASED_WORD)).cast("long")


def windows(bench: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct (item, window text, length) of the benchmark."""
    words = bench.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"),
                         bench_words(F.col(text)).alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (WINDOW - 1), F.lit(1)))
    cut = words.select("item", F.explode(F.transform(starts, lambda i: F.slice("w", i, WINDOW))).alias("w"))
    return cut.select("item", F.concat_ws(" ", "w").alias("window"), F.size("w").alias("length")).distinct()


def occurrences(
    docs: DataFrame, bench: DataFrame, doc_id: str = "doc_id", text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """Where windows occur: document key (``doc_id``, ``key``), ``start``, ``length``
    and ``window`` id; with the table of (window, item)."""
    found = materialize(windows(bench), "windows")
    texts = found.select("window", "length").distinct()
    texts = materialize(texts.withColumn("win", F.monotonically_increasing_id()), "window-ids")
    n = F.least(F.lit(SHINGLE), F.col("length"))
    split = F.split("window", " ")
    by_size = F.coalesce(*(F.when(n == k, grams(split, k)) for k in range(1, SHINGLE + 1)))
    placed = texts.select("win", "length", n.alias("n"), F.posexplode(by_size).alias("place", "shingle"))
    placed = materialize(placed.filter(F.col("place") + F.col("n") <= F.col("length")), "placed")
    shingles = placed.select("n", "shingle").distinct().withColumn("sid", F.monotonically_increasing_id())
    shingles = materialize(shingles, "shingles")
    sizes = sorted(r["n"] for r in shingles.select("n").distinct().collect())  # 1 to SHINGLE
    placed = materialize(placed.join(shingles, ["n", "shingle"]).select("win", "length", "place", "sid"), "placed-ids")

    body = docs.select(F.col(doc_id).alias("doc_id"), row_key(F.col(doc_id), F.col(text)).alias("key"),
                       bench_words(F.col(text)).alias("w"))

    def matched(k: int) -> DataFrame:
        hashed = F.posexplode(let(F.col("w"), lambda w: grams(w, k))).alias("at", "shingle")
        known = hinted(shingles.filter(F.col("n") == k).select("shingle", "sid"), 40)
        spread = body.select("doc_id", "key", F.size("w").alias("n_words"), hashed)
        return spread.join(known, "shingle").filter(F.col("at") + k <= F.col("n_words"))

    found_at = reduce(DataFrame.unionByName, [matched(k) for k in sizes or [SHINGLE]])
    matches = materialize(found_at.select("doc_id", "key", "n_words", "at", "sid"), "matches")

    counts = matches.groupBy("sid").agg(F.count(F.lit(1)).alias("seen"))
    ranked = placed.join(counts, "sid", "left").groupBy("win", "length").agg(
        F.min(F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), "place", "sid")).alias("rare"),
        F.count(F.lit(1)).alias("parts"),
    ).filter("rare.seen > 0")
    ranked = materialize(ranked.select("win", "length", "parts", F.col("rare.place").alias("place"),
                                       F.col("rare.sid").alias("sid")), "prefixes")
    start = F.col("at") - F.col("place")
    proposed = matches.join(hinted(ranked, 40), "sid").select(
        "doc_id", "key", start.alias("start"), "win", "length", "parts", "n_words"
    ).filter((F.col("start") >= 0) & (F.col("start") + F.col("length") <= F.col("n_words"))).drop("n_words")
    asked = proposed.join(hinted(placed.select("win", "place", "sid"), 40), "win").withColumn(
        "at", F.col("start") + F.col("place")
    )
    have = matches.select(F.col("doc_id").alias("d"), F.col("key").alias("k"), F.col("at").alias("a"), F.col("sid").alias("s"))
    met = asked.join(have, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("key") == F.col("k"))
                     & (F.col("at") == F.col("a")) & (F.col("sid") == F.col("s")), "left_semi")
    held = met.groupBy("doc_id", "key", "start", "win", "length", "parts").agg(
        F.bit_or(F.expr("shiftleft(1, place)")).alias("mask")
    )
    full = held.filter(F.bit_count("mask") == F.col("parts"))
    items = found.join(texts, ["window", "length"]).select("win", "item")
    return materialize(full.select("doc_id", "key", "start", "length", "win"), "occurrences"), materialize(items, "items")


def hits(docs: DataFrame, bench: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per hit document (``doc_id``, ``key``): words hit by any occurrence,
    items that occur, and their names. Overlaps are merged over the starts of one
    document, of which there are at most as many as words."""
    found, items = occurrences(docs, bench, doc_id, text)
    spans = found.groupBy("doc_id", "key", "start").agg(F.max(F.col("start") + F.col("length")).alias("end"))
    before = Window.partitionBy("doc_id", "key").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("past", F.coalesce(F.max("end").over(before), F.lit(0)))
    n_hit = spans.groupBy("doc_id", "key").agg(
        F.sum(F.greatest(F.lit(0), F.col("end") - F.greatest("start", "past"))).cast("long").alias("n_hit")
    )
    named = found.select("doc_id", "key", "win").distinct().join(hinted(items, 60), "win")
    named = named.groupBy("doc_id", "key").agg(F.sort_array(F.collect_set("item")).alias("names"))
    right = named.select(F.col("doc_id").alias("d"), F.col("key").alias("k"), "names")
    joined = n_hit.join(right, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("key") == F.col("k")))
    return joined.select("doc_id", "key", "n_hit", "names")


def verdicts(docs: DataFrame, bench: DataFrame) -> DataFrame:
    found = settled(docs.sparkSession, "hits", lambda: hits(docs, bench)).withColumnRenamed("doc_id", "d").withColumnRenamed("key", "k")
    base = docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("key"),
                       count_words(F.col("text")).alias("n_words"))
    out = base.join(found, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("key") == F.col("k")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    names = F.coalesce("names", F.array().cast("array<string>"))
    return out.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(names).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", names), 256).alias("items_sha256"),
        ((n_hit > 0) & (SHARE * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdicts(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without a contaminated verdict, all columns as they came."""
    found = settled(spark, "hits", lambda: hits(docs, documents(spark, sf_dir, "benchmark")))
    found = found.select(F.col("doc_id").alias("d"), F.col("key").alias("k"), "n_hit")
    keyed = docs.select(F.struct(*cols(docs)).alias("row"), F.col("doc_id").alias("id"),
                        row_key(F.col("doc_id"), F.col("text")).alias("key"), count_words(F.col("text")).alias("n_words"))
    met = keyed.join(found, F.col("id").eqNullSafe(F.col("d")) & (F.col("key") == F.col("k")), "left")
    return met.filter(F.col("n_hit").isNull() | (SHARE * F.col("n_hit") < F.col("n_words"))).select("row.*")


def hits_sql(docs: str, key: str) -> str:
    """DuckDB twin over ``docs`` with a unique ``key``; ends in b_out (key, n_words,
    n_hit, items)."""
    words = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
    return rf"""
    b_item AS (SELECT coalesce(item_id::VARCHAR, '') AS item, {words} AS w FROM benchmark),
    b_win AS (SELECT DISTINCT item, w[i:i + {WINDOW - 1}] AS g FROM (SELECT item, w, unnest(range(1, greatest(len(w) - {WINDOW - 2}, 2))) AS i FROM b_item WHERE len(w) > 0)),
    b_len AS (SELECT DISTINCT len(g) AS n FROM b_win),
    b_doc AS (SELECT {key} AS k, {words} AS w FROM {docs}),
    b_at AS (SELECT k, i, n, w[i:i + n - 1] AS g FROM (SELECT k, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM b_doc, b_len WHERE len(w) >= n)),
    b_hit AS (SELECT k, i, n, item FROM b_at JOIN b_win USING (g)),
    b_sum AS (SELECT k, count(DISTINCT i + o) AS n_hit FROM (SELECT k, i, unnest(range(0, n)) AS o FROM b_hit) GROUP BY k),
    b_names AS (SELECT k, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS names FROM b_hit GROUP BY k),
    b_out AS (SELECT k, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, coalesce(names, '') AS names
        FROM b_doc LEFT JOIN b_sum USING (k) LEFT JOIN b_names USING (k))"""


SQL = f"""WITH b_docs AS (SELECT row_number() OVER () AS rid, doc_id, text FROM documents),
{hits_sql("b_docs", "rid")}
SELECT doc_id, n_words, n_hit, n_items, sha256(names) AS items_sha256, n_hit > 0 AND {SHARE} * n_hit >= n_words AS contaminated
FROM b_docs JOIN b_out ON rid = k"""
