"""Phrase collocations by stripes: a prefix keys a counter of the words that follow it.

Phrases are counted length by length. A task turns its texts into stripes - prefix
(the phrase but its last word) -> counter of next words - and stripes of one prefix are
merged elementwise. A merged stripe tells three things at once: the frequencies of the
prefix's extensions, the frequency of the prefix itself (the counter's total, as an
occurrence without a next word that counts is kept under the empty word) and the most
frequent extension, which decides whether the prefix is subsumed on its left side.

A phrase reaches the threshold only if its prefix and its suffix do, so each length
counts only what the one before leaves. What is left is known to the tasks by a bitmap
of ``BITS`` hashed places, the same size for any corpus: a place that two phrases share
lets too much through, which costs a row and changes no result, as every frequency
used is counted in full.

The score of a phrase is the lowest over its cuts of floor(1000000 a a / (l r)), in
decimals of 38 digits: exact up to 10^15 occurrences.

Scale: a task holds the stripes of about ``TOKENS`` words at a time and sends each
prefix once; equal extensions are summed there. Stripes of hot prefixes (more than one
occurrence in ``HOT``, so there are at most HOT of a length; and the empty prefix of
the single words) are dealt to slots 1 to ``SLOTS`` by their next word, all others travel
whole, in slot 0. They are merged in sorted order as a stream of Arrow batches. Only phrases at
the threshold are written. The first ``top`` of a language are taken per salt first.

Edge cases: null texts are empty, the null language is ``und``; texts without words
give nothing; repeated rows count as often as they occur; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from derrick.llm.common import documents, settled
from derrick.sources.scratch import materialize

LONGEST, LEAST, TOP = 3, 10, 2000
#: A phrase is subsumed by a longer one with at least this percentage of its occurrences.
SUBSUMED = 50
TOKENS = 1_000_000
BITS, SLICES = 1 << 27, 64
HOT, SLOTS = 500, 32
SALTS = 64
_WALL = b"\xff"  # no byte of UTF-8: stands for the end of a piece
_TABLE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz" + _WALL * 10)
_P1, _P2 = np.uint64(0x9E3779B185EBCA87), np.uint64(0xC2B2AE3D27D4EB4F)
#: A stripe that travels: its words in one text, a space between them (no word holds
#: one), and their counts as 32-bit numbers side by side.
STRIPE = "lang string, prefix string, slot int, next string, times binary"
MERGED = "lang string, prefix string, total long, next array<string>, times array<long>"
_PACKED = pa.schema([("lang", pa.string()), ("prefix", pa.string()), ("slot", pa.int32()), ("next", pa.string()), ("times", pa.binary())])
_STRIPE = pa.schema([("lang", pa.string()), ("prefix", pa.string()), ("slot", pa.int32()), ("next", pa.list_(pa.string())), ("times", pa.list_(pa.int64()))])
_MERGED = pa.schema([("lang", pa.string()), ("prefix", pa.string()), ("total", pa.int64()), ("next", pa.list_(pa.string())), ("times", pa.list_(pa.int64()))])


def tokens(text: str) -> list[bytes]:
    """Lower-cased words, with walls between pieces. ``bytes.split`` cuts at the white
    space meant: all other kinds that it knows have become walls."""
    return text.encode("utf-8").translate(_TABLE).replace(_WALL, b" \xff ").split()


def _hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word)


def _phrase_hash(seed: np.uint64, words: list[np.ndarray]) -> np.ndarray:
    """Place in the bitmap of phrases, given the hashes of their words."""
    out = np.full(len(words[0]), seed, dtype=np.uint64)
    for w in words:
        out = (out ^ w) * _P1
        out ^= out >> np.uint64(29)
    out *= _P2
    return (out ^ (out >> np.uint64(32))) % np.uint64(BITS)


def _seed(lang: str) -> np.uint64:
    return np.uint64(_hash(lang.encode()))


class _Stripes:
    """The words of one language that a task has read, and their stripes."""

    def __init__(self, lang: str, length: int, bitmap: np.ndarray | None, hot: frozenset[tuple[str, str]]) -> None:
        self.lang, self.length, self.bitmap, self.hot = lang, length, bitmap, hot
        self.parts: list[np.ndarray] = []
        self.ids: defaultdict[bytes, int] = defaultdict()
        self.ids.default_factory = self.ids.__len__
        self.ids[_WALL] = 0

    def read(self, text: str) -> int:
        found = tokens(text)
        self.parts.append(np.fromiter(map(self.ids.__getitem__, found), dtype=np.int64, count=len(found)))
        self.parts.append(np.zeros(1, dtype=np.int64))
        return len(found) + 1

    def _known(self, hashes: np.ndarray, w: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Which phrases of one word less, at places ``at``, may reach the threshold."""
        place = _phrase_hash(_seed(self.lang), [hashes[w[at + k]] for k in range(self.length - 1)])
        return (self.bitmap[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1

    def batch(self) -> pa.RecordBatch | None:
        """The stripes of all words read."""
        if not self.parts:
            return None
        names = list(self.ids)
        hashes = np.fromiter(map(_hash, names), dtype=np.uint64, count=len(names))
        n, w = self.length, np.concatenate([*self.parts, np.zeros(self.length, dtype=np.int64)])
        at = np.flatnonzero(w[: len(w) - n] > 0)
        for k in range(1, n - 1):
            at = at[w[at + k] > 0]
        if n > 1:
            at = at[self._known(hashes, w, at)]
            follows = w[at + n - 1].copy()
            more = np.flatnonzero(follows)
            follows[more[~self._known(hashes, w, at[more] + 1)]] = 0
        else:
            follows = w[at]
        if not len(at):
            return None
        code = w[at] if n > 1 else np.zeros(len(at), dtype=np.int64)
        for k in range(1, n - 1):
            code = np.unique(code, return_inverse=True)[1] * len(names) + w[at + k]
        _, first, code = np.unique(code, return_index=True, return_inverse=True)
        prefixes = [" ".join(names[w[at[f] + k]].decode() for k in range(n - 1)) for f in first]
        hot = np.array([(self.lang, p) in self.hot for p in prefixes])
        pair, times = np.unique(code * len(names) + follows, return_counts=True)
        code, follows = pair // len(names), pair % len(names)
        slot = np.where(hot[code], hashes[follows] % np.uint64(SLOTS) + np.uint64(1), 0).astype(np.int64)
        order = np.lexsort((follows, slot, code))
        code, follows, slot, times = code[order], follows[order], slot[order], times[order]
        starts = np.flatnonzero(np.r_[True, (np.diff(code) != 0) | (np.diff(slot) != 0)])
        offsets = pa.array(np.r_[starts, len(code)].astype(np.int32))
        words = pa.array(["", *(x.decode() for x in names[1:])], pa.string())
        return pa.RecordBatch.from_arrays([
            pa.array([self.lang] * len(starts), pa.string()), pa.array(prefixes, pa.string()).take(pa.array(code[starts])),
            pa.array(slot[starts], pa.int32()),
            pa.compute.binary_join(pa.ListArray.from_arrays(offsets, words.take(pa.array(follows))), " "),
            _packed(times, np.r_[starts, len(code)]),
        ], schema=_PACKED)


def _packed(times: np.ndarray, edges: np.ndarray) -> pa.Array:
    """The numbers between each two edges as one binary value; a task counts no further than 2^31."""
    buffers = [None, pa.py_buffer((4 * edges).astype(np.int32)), pa.py_buffer(times.astype(np.int32))]
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, buffers)


def _unpacked(batch: pa.RecordBatch) -> pa.Table:
    """Stripes that have travelled, with lists again."""
    lists = pa.compute.split_pattern(batch.column(3).cast(pa.string()), " ")
    offsets = pa.array(np.r_[0, np.cumsum(pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False))].astype(np.int32))
    raw = b"".join(batch.column(4).to_pylist())
    times = pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(raw, dtype=np.int32).astype(np.int64)))
    return pa.table([*(batch.column(i).cast(f.type) for i, f in enumerate(list(_STRIPE)[:3])), lists, times], schema=_STRIPE)


def stripes(docs: DataFrame, length: int, bitmap: np.ndarray | None, hot: frozenset[tuple[str, str]], tokens_held: int = TOKENS) -> DataFrame:
    """Stripes of the phrases of ``length`` words in ``docs`` (lang, text)."""
    shared = None if bitmap is None else docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if shared is None else shared.value
        held: dict[str, _Stripes] = {}
        size = 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if lang not in held:
                    held[lang] = _Stripes(lang, length, bits, hot)
                size += held[lang].read(text)
                if size >= tokens_held:
                    yield from filter(None, (s.batch() for s in held.values()))
                    held, size = {}, 0
        yield from filter(None, (s.batch() for s in held.values()))

    return docs.mapInArrow(run, STRIPE)


def merged(found: DataFrame, least: int = LEAST) -> DataFrame:
    """Stripes of one prefix (and slot) added up: the prefix's total, and the extensions
    that reach ``least``."""

    def add(batch: pa.Table) -> tuple[pa.Table, np.ndarray]:
        """Sorted stripes with equal keys merged, and where the keys begin."""
        columns = [batch.column(c).combine_chunks() for c in ("lang", "prefix", "slot")]
        new = np.ones(batch.num_rows, dtype=bool)
        if batch.num_rows > 1:
            same = [pa.compute.equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False) for c in columns]
            new[1:] = ~np.logical_and.reduce(same)
        key = np.cumsum(new) - 1
        lists, times = batch.column("next").combine_chunks(), batch.column("times").combine_chunks()
        sizes = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False)
        flat = pa.table({"key": np.repeat(key, sizes), "next": lists.flatten(), "times": times.flatten()})
        flat = flat.group_by(["key", "next"]).aggregate([("times", "sum")]).sort_by([("key", "ascending"), ("next", "ascending")])
        first = np.flatnonzero(new)
        ends = np.searchsorted(flat["key"].to_numpy(), np.arange(len(first) + 1))
        offsets = pa.array(ends.astype(np.int32))
        out = pa.table([
            *(c.take(pa.array(first)) for c in columns),
            pa.ListArray.from_arrays(offsets, flat["next"].combine_chunks()),
            pa.ListArray.from_arrays(offsets, flat["times_sum"].combine_chunks()),
        ], schema=_STRIPE)
        return out, ends

    def finish(done: pa.Table, ends: np.ndarray) -> pa.RecordBatch:
        words, times = done["next"].combine_chunks().flatten(), done["times"].combine_chunks().flatten().to_numpy()
        total = np.add.reduceat(times, ends[:-1])
        keep = (times >= least) & pa.compute.not_equal(words, "").to_numpy(zero_copy_only=False)
        counts = np.add.reduceat(keep.astype(np.int64), ends[:-1])
        stay = (counts > 0) | (done["slot"].to_numpy() > 0)  # a slot has its part of the total
        some = pa.array(np.flatnonzero(stay))
        offsets = pa.array(np.r_[0, np.cumsum(counts[stay])].astype(np.int32))
        return pa.RecordBatch.from_arrays([
            done["lang"].combine_chunks().take(some), done["prefix"].combine_chunks().take(some), pa.array(total).take(some),
            pa.ListArray.from_arrays(offsets, words.filter(pa.array(keep))),
            pa.ListArray.from_arrays(offsets, pa.array(times[keep])),
        ], schema=_MERGED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = _unpacked(batch)
            done, ends = add(table if rest is None else pa.concat_tables([rest, table]))
            rest = done.slice(done.num_rows - 1)  # its stripes may go on
            if done.num_rows > 1:
                yield finish(done.slice(0, done.num_rows - 1), ends[:-1])
        if rest is not None:
            rest, ends = add(rest)
            yield finish(rest, ends)

    dealt = found.repartition("lang", "prefix", "slot").sortWithinPartitions("lang", "prefix", "slot")
    return dealt.mapInArrow(run, MERGED)


def _bitmap(level: DataFrame) -> np.ndarray:
    """The places of the phrases of ``level`` (lang, phrase), built slice by slice: each
    of ``SLICES`` rows has BITS / SLICES bits, whatever the number of phrases."""
    width = BITS // SLICES

    def places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            split = [p.encode().split(b" ") for p in rows["phrase"]]
            seeds = rows["lang"].map(lambda x: int(_seed(x))).to_numpy(np.uint64)
            words = [np.fromiter((_hash(s[k]) for s in split), dtype=np.uint64, count=len(split)) for k in range(len(split[0]) if split else 0)]
            out = np.zeros(0, dtype=np.int64)
            if split:
                out = _phrase_hash(seeds, words).astype(np.int64)
            yield pd.DataFrame({"slice": out // width, "place": out % width})

    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(width, dtype=np.uint8)
        bits[rows["place"].to_numpy()] = 1
        return pd.DataFrame({"slice": [key[0]], "bits": [np.packbits(bits, bitorder="little").tobytes()]})

    dealt = level.select("lang", "phrase").mapInPandas(places, "slice long, place long").distinct()
    out = np.zeros(BITS // 8, dtype=np.uint8)
    for row in dealt.groupBy("slice").applyInPandas(pack, "slice long, bits binary").collect():  # at most SLICES rows
        out[row["slice"] * width // 8 : (row["slice"] + 1) * width // 8] = np.frombuffer(row["bits"], dtype=np.uint8)
    return out


def phrases(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, tokens_held: int = TOKENS) -> list[tuple[DataFrame, DataFrame]]:
    """Per length from 1 to ``longest`` the phrases of ``docs`` (lang, text) that reach
    ``least`` (lang, phrase, prefix, word, f, whole: the prefix's frequency) and, per prefix, the
    frequency of its most frequent extension (lang, prefix, most)."""
    out: list[tuple[DataFrame, DataFrame]] = []
    bitmap, hot, words = None, frozenset(), 0
    for length in range(1, longest + 1):
        if length == 1:
            langs = docs.select("lang").distinct().limit(HOT).collect()  # spreads single words; more languages need no slots
            hot = frozenset((r["lang"], "") for r in langs)
        striped = materialize(merged(stripes(docs, length, bitmap, hot, tokens_held), least), "stripes")
        sums = striped.select("lang", "prefix", "total", F.array_max("times").alias("most"))
        entries = striped.select("lang", "prefix", F.explode(F.arrays_zip("next", "times")).alias("e"))
        phrase = F.concat_ws(" ", F.nullif("prefix", F.lit("")), "e.next")
        level = entries.select("lang", phrase.alias("phrase"), "prefix", F.col("e.next").alias("word"), F.col("e.times").alias("f"))
        level = materialize(level, "phrases")
        out.append((level, sums))
        if length == longest:
            break
        if length == 1:
            words = sums.agg(F.sum("total")).first()[0] or 0
        often = level.filter(F.col("f") * HOT >= words).select("lang", "phrase")  # at most HOT
        hot = frozenset(tuple(r) for r in often.collect()) if words else frozenset()
        bitmap = _bitmap(level)
    return out


def _frequency(levels: list[tuple[DataFrame, DataFrame]], name: str, key: str) -> DataFrame:
    every = reduce(DataFrame.unionByName, (level.select("lang", "phrase", "f") for level, _ in levels))
    return every.select("lang", F.col("phrase").alias(key), F.col("f").alias(name))


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (l r)), exactly; at most 1000000, as a is at most l and r."""
    a, left, right = (c.cast("decimal(15,0)") for c in (a, left, right))
    return F.call_function("div", a * a * F.lit(1_000_000).cast("decimal(7,0)"), left * right)


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, top: int = TOP, tokens_held: int = TOKENS) -> DataFrame:
    """The first ``top`` phrases of 2 to ``longest`` words of each language of ``docs`` (lang, text)."""
    levels = phrases(docs, longest, least, tokens_held)
    kept = []
    for at in range(1, longest):
        level, _ = levels[at]
        words = F.split("phrase", " ")
        cuts = []
        for k in range(1, at + 1):  # cut after the first k words
            first = F.array_join(F.slice(words, 1, k), " ")
            rest = F.array_join(F.slice(words, k + 1, at + 1 - k), " ")
            cut = level.select("lang", "phrase", "f", F.lit(k).alias("k"), first.alias("first"), rest.alias("rest"))
            if k == at:  # the stripe itself knows its prefix
                totals = levels[at][1].groupBy("lang", "prefix").agg(F.sum("total").alias("l"))
                cut = cut.join(totals.withColumnRenamed("prefix", "first"), ["lang", "first"])
            else:
                cut = cut.join(_frequency(levels[k - 1 : k], "l", "first"), ["lang", "first"])
            cuts.append(cut.join(_frequency(levels[at - k : at - k + 1], "r", "rest"), ["lang", "rest"]).select(
                "lang", "phrase", F.col("f").alias("a"), F.struct(_score(F.col("f"), F.col("l"), F.col("r")).alias("score"), "k", "l", "r").alias("cut")
            ))
        scored = cuts[0]
        if len(cuts) > 1:
            scored = reduce(DataFrame.unionByName, cuts).groupBy("lang", "phrase", "a").agg(F.min("cut").alias("cut"))
        if at + 1 < longest:
            longer, ends = levels[at + 1]
            suffix = F.array_join(F.slice(F.split("phrase", " "), 2, at + 1), " ")
            most = ends.select("lang", F.col("prefix").alias("phrase"), "most").unionByName(longer.select("lang", suffix.alias("phrase"), F.col("f").alias("most")))
            most = most.groupBy("lang", "phrase").agg(F.max("most").alias("most"))
            scored = scored.join(most, ["lang", "phrase"], "left").filter(
                F.col("most").isNull() | (100 * F.col("most").cast("decimal(20,0)") < SUBSUMED * F.col("a").cast("decimal(20,0)"))
            ).drop("most")
        kept.append(scored)
    rows = reduce(DataFrame.unionByName, kept).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    by = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    near = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*by))).filter(F.col("rank") <= top)
    best = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*by))).filter(F.col("rank") <= top)
    n = levels[0][1].groupBy("lang").agg(F.sum("total").alias("n"))
    return best.join(n, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))


def spoken(docs: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    return docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settled(spark, "collocations", lambda: collocations(spoken(documents(spark, sf_dir))))


SQL = rf"""WITH c_piece AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
    c_words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM c_piece),
    c_gram AS (SELECT lang, n, array_to_string(w[i:i + n - 1], ' ') AS p FROM (SELECT lang, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM c_words, range(1, {LONGEST + 1}) t(n) WHERE len(w) >= n)),
    c_f AS (SELECT lang, n, p, count(*)::BIGINT AS f FROM c_gram GROUP BY ALL HAVING count(*) >= {LEAST}),
    c_n AS (SELECT lang, count(*)::BIGINT AS n FROM c_gram WHERE n = 1 GROUP BY lang),
    c_cand AS (SELECT lang, n, p, f, string_split(p, ' ') AS w FROM c_f WHERE n > 1),
    c_cut AS (SELECT c.lang, c.n, c.p, c.f AS a, k, x.f AS l, y.f AS r, 1000000::HUGEINT * c.f * c.f // (x.f::HUGEINT * y.f) AS score
        FROM (SELECT *, unnest(range(1, n)) AS k FROM c_cand) c
        JOIN c_f x ON x.lang = c.lang AND x.p = array_to_string(c.w[1:k], ' ')
        JOIN c_f y ON y.lang = c.lang AND y.p = array_to_string(c.w[k + 1:], ' ')),
    c_low AS (SELECT * FROM c_cut QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
    c_in AS (SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS p, max(f) AS most FROM
        (SELECT *, unnest(range(1, n - m + 2)) AS i FROM c_cand, range(2, {LONGEST}) t(m) WHERE m < n) GROUP BY ALL),
    c_kept AS (SELECT s.* FROM c_low s LEFT JOIN c_in USING (lang, p) WHERE most IS NULL OR 100 * most < {SUBSUMED} * a)
SELECT lang, rank, p AS phrase, a, l, r, c_n.n AS n, score::BIGINT AS score FROM
    (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, p) AS rank FROM c_kept) JOIN c_n USING (lang) WHERE rank <= {TOP}"""
