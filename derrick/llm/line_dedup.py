"""Reversible line dedup: sharded cuckoo filters in front of exact reference counts.

A line's key is the line without outer white space, A-Z lower-cased; keys of at
least ``MIN_CHARS`` code points count. An index holds three written tables:

* postings: (digest, doc_id), once per document that holds the key;
* refs: digest -> number of documents, smallest doc_id (the owner);
* filters: shard -> cuckoo filter of the digests that two or more documents hold.

``insert`` adds documents, ``delete`` takes documents out again: counts fall, owners
pass on, and digests that only one document still holds leave their shard's filter.
``dropped`` and ``without`` remove, from any documents, the lines whose key another document owns:
lines are first tried against the filters, so the great mass of single lines is never
shuffled again, and what the filters let through is settled by the exact table.

Scale: digests are 16 bytes of SHA-256; counting is two aggregations with map-side
combine, so a line that a third of all documents share is one row per task. A shard
holds about ``SHARD_KEYS`` digests at any size of the corpus. Filters are tried by
broadcast while they fit ``FILTER_BYTES`` together; beyond that the lines go to their
shards' filters by a shuffle on the digest, with equal results. A text is cut into
lines once (their digests are written), and shuffled once, by document, to meet the
list of lines it loses.

Edge cases: null and empty texts are one empty line; a null id is treated as larger
than any id and null ids together as one document, as are rows that repeat an id
(none of them loses a line to another); equal rows give equal rows; an empty table
gives an empty result; further columns are ignored, and kept by the stage.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from derrick.llm.common import cols, documents, row_key, settled
from derrick.llm.cuckoo import CuckooFilter, built
from derrick.sources.scratch import materialize

MIN_CHARS = 10
SHARD_KEYS = 50_000
FILTER_BYTES = 64 << 20
_LAST = 2**63 - 1
_BLANK = b" \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class LineIndex:
    """The written tables of an index and its number of shards."""

    postings: DataFrame
    refs: DataFrame
    filters: DataFrame
    shards: int


def line_key(line: bytes) -> bytes | None:
    """Stripped and lower-cased UTF-8; None where it is too short to count. The bytes
    methods know exactly the white space and the letters meant."""
    key = line.strip(_BLANK).lower()
    if len(key) < 4 * MIN_CHARS and len(key.decode("utf-8")) < MIN_CHARS:
        return None
    return key


def lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, key, at, digest) of every line that counts: document, row key, place."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            times, at, digests = [], [], []
            for t in rows["text"]:
                before = len(at)
                for i, line in enumerate(t.encode("utf-8").split(b"\n") if t else ()):
                    key = line_key(line)
                    if key is not None:
                        at.append(i)
                        digests.append(sha256(key).digest()[:16])
                times.append(len(at) - before)
            out = rows[["doc", "key"]]
            out = out.loc[out.index.repeat(times)].reset_index(drop=True)
            yield out.assign(at=at, digest=digests)

    body = docs.select(
        _ids(F.col(doc_id)).alias("doc"), row_key(F.col(doc_id), F.col(text)).alias("key"), F.col(text).alias("text")
    )
    return body.mapInPandas(run, "doc long, key long, at int, digest binary")


def text_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _ids(doc_id: Column) -> Column:
    return F.coalesce(doc_id, F.lit(_LAST))


def _hash(column: str) -> Column:
    return F.xxhash64(column)


def _shard(shards: int) -> Column:
    return F.pmod(F.shiftright(_hash("digest"), 3), F.lit(shards)).cast("int")


def postings(found: DataFrame) -> DataFrame:
    """Distinct (digest, doc) of lines."""
    return found.select("digest", "doc").distinct()


def _refs(found: DataFrame) -> DataFrame:
    return found.groupBy("digest").agg(F.count(F.lit(1)).alias("n_docs"), F.min("doc").alias("owner"))


_FILTER = "shard int, room int, filter binary"


def _filters(refs: DataFrame, shards: int) -> DataFrame:
    """A filter per shard over the digests that two or more documents hold."""

    def build(key: tuple, keys: pd.DataFrame) -> pd.DataFrame:
        made = built(np.sort(keys["h"].to_numpy(np.int64)))
        return pd.DataFrame({"shard": [int(key[0])], "room": [made.room], "filter": [made.dump()]})

    keys = refs.filter("n_docs >= 2").select(_shard(shards).alias("shard"), _hash("digest").alias("h"))
    return keys.groupBy("shard").applyInPandas(build, _FILTER)


def build(found: DataFrame, shard_keys: int = SHARD_KEYS) -> LineIndex:
    """The index of the documents whose ``lines`` are given."""
    found = materialize(postings(found), "postings")
    refs = materialize(_refs(found), "refs")
    shards = max(1, -(-refs.filter("n_docs >= 2").count() // shard_keys))
    return LineIndex(found, refs, materialize(_filters(refs, shards), "filters"), shards)


def _refreshed(index: LineIndex, found: DataFrame, touched: DataFrame) -> LineIndex:
    """The index over the written postings ``found``. Counts are taken anew for the
    ``touched`` digests alone, and filters change by the digests that crossed two."""
    found_t = found.join(touched, "digest", "left_semi")
    fresh = materialize(_refs(found_t), "refs-new")
    old = index.refs.join(touched, "digest", "left_semi").select("digest", F.col("n_docs").alias("was"))
    change = old.join(fresh, "digest", "full_outer").select(
        "digest", (F.coalesce("was", F.lit(0)) >= 2).alias("had"), (F.coalesce("n_docs", F.lit(0)) >= 2).alias("has")
    ).filter("had <> has")
    change = materialize(
        change.select(_shard(index.shards).alias("shard"), _hash("digest").alias("h"), "has"), "crossed"
    )
    refs = materialize(index.refs.join(touched, "digest", "left_anti").unionByName(fresh), "refs")

    def apply(key: tuple, old: pd.DataFrame, new: pd.DataFrame) -> pd.DataFrame:
        f = CuckooFilter.load(old["filter"].iloc[0]) if len(old) else CuckooFilter.sized(len(new))
        f.remove(new.loc[~new["has"], "h"].to_numpy(np.int64))
        add = np.sort(new.loc[new["has"], "h"].to_numpy(np.int64))
        room = f.room - len(add)
        kept = f.dump() if room >= 0 and f.insert(add) else None  # None: to be built anew
        return pd.DataFrame({"shard": [int(key[0])], "room": [room], "filter": [kept]})

    changed = index.filters.groupBy("shard").cogroup(change.groupBy("shard")).applyInPandas(apply, _FILTER)
    changed = materialize(changed, "filters-new")
    full = changed.filter("filter IS NULL").select("shard")
    again = refs.withColumn("shard", _shard(index.shards)).join(full, "shard", "left_semi")
    filters = changed.filter("filter IS NOT NULL").unionByName(_filters(again, index.shards))
    return LineIndex(found, refs, materialize(filters, "filters"), index.shards)


def insert(index: LineIndex, added: DataFrame) -> LineIndex:
    """The index with the documents of the lines ``added``; documents it holds already change nothing,
    lines that a known id brings anew are added to it."""
    new = postings(added).join(index.postings, ["digest", "doc"], "left_anti")
    new = materialize(new, "postings-new")
    found = materialize(index.postings.unionByName(new), "postings")
    return _refreshed(index, found, new.select("digest").distinct())


def delete(index: LineIndex, ids: DataFrame, doc_id: str = "doc_id") -> LineIndex:
    """The index without the documents named in ``ids``."""
    gone = ids.select(_ids(F.col(doc_id)).alias("doc")).distinct()
    touched = materialize(index.postings.join(gone, "doc", "left_semi").select("digest").distinct(), "touched")
    found = materialize(index.postings.join(gone, "doc", "left_anti"), "postings")
    return _refreshed(index, found, touched)


def _let_through(index: LineIndex, found: DataFrame) -> DataFrame:
    """The lines whose digest may be held by two documents."""
    schema = found.schema
    total = index.filters.agg(F.sum(F.length("filter"))).first()[0] or 0
    if total <= FILTER_BYTES:
        raw = {r["shard"]: bytes(r["filter"]) for r in index.filters.collect()}
        shared = found.sparkSession.sparkContext.broadcast(raw)

        def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            filters = {k: CuckooFilter.load(v) for k, v in shared.value.items()}
            for rows in batches:
                ok = np.zeros(len(rows), dtype=bool)
                shard, h = rows["shard"].to_numpy(), rows["h"].to_numpy(np.int64)
                for k in np.unique(shard):
                    if k in filters:
                        mine = np.flatnonzero(shard == k)
                        ok[mine] = filters[k].contains(h[mine])
                yield rows[ok]

        return found.mapInPandas(probe, schema)

    # Beyond the broadcast size: a filter's bytes travel to the lines of its shard,
    # cut into slices so that no task holds a shard's lines together.
    slices = 64
    salted = found.withColumn("slice", F.pmod(F.xxhash64("doc", "key", "at"), F.lit(slices)))
    every = F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long"))
    spread = index.filters.select("shard", "filter", F.explode(every).alias("slice"))

    def settle(key: tuple, rows: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
        if not len(filters):
            return rows.iloc[:0].drop(columns="slice")
        ok = CuckooFilter.load(filters["filter"].iloc[0]).contains(rows["h"].to_numpy(np.int64))
        return rows[ok].drop(columns="slice")

    return salted.groupBy("shard", "slice").cogroup(spread.groupBy("shard", "slice")).applyInPandas(settle, schema)


def dropped(index: LineIndex, found: DataFrame) -> DataFrame:
    """Per document key (``doc``, ``key``) the places of the lines it loses."""
    probes = found.select("*", _shard(index.shards).alias("shard"), _hash("digest").alias("h"))
    maybe = _let_through(index, probes).select("doc", "key", "at", "digest")
    owned = index.refs.filter("n_docs >= 2").select("digest", "owner")
    lost = maybe.join(owned, "digest").filter("doc <> owner")
    return lost.groupBy("doc", "key").agg(F.collect_set("at").alias("gone"))


def _met(docs: DataFrame, gone: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``row`` (a struct of the document's columns), all its ``lines``, and ``gone``: the places
    of those that it loses, null where it loses none."""
    gone = gone.select(F.col("doc").alias("in_doc"), F.col("key").alias("in_key"), "gone")
    keyed = docs.select(
        F.struct(*cols(docs)).alias("row"), _ids(F.col(doc_id)).alias("id"),
        row_key(F.col(doc_id), F.col(text)).alias("key"), F.col(text).alias("body"),
    )
    met = keyed.join(gone, (F.col("id") == F.col("in_doc")) & (F.col("key") == F.col("in_key")), "left")
    return met.select("row", text_lines(F.col("body")).alias("lines"), "gone")


def without(
    docs: DataFrame, gone: DataFrame, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``docs`` beside ``__lines`` (all lines) and ``__gone`` (places of those to go, from
    ``dropped``)."""
    met = _met(docs, gone, doc_id, text)
    return met.select("row.*", F.col("lines").alias("__lines"), F.col("gone").alias("__gone"))


def _lost(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """What ``docs`` lose to one another; only this table stays."""

    def make() -> DataFrame:
        found = materialize(lines(docs), "lines")
        return dropped(build(found), found)

    return settled(spark, "gone", make)


def kept_text(lines: str = "__lines", gone: str = "__gone") -> Column:
    """The lines that stay, joined again, of a row of ``without``."""
    stay = F.filter(lines, lambda s, i: ~F.array_contains(gone, i))
    return F.when(F.col(gone).isNull(), F.array_join(lines, "\n")).otherwise(F.array_join(stay, "\n"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    done = without(docs, _lost(spark, docs))
    return done.select(
        "doc_id",
        F.size("__lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("__gone"), F.lit(0)).cast("long").alias("n_dropped"),
        F.sha2(kept_text(), 256).alias("kept_sha256"),
    )


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its text without the lines that another document owns;
    ``n_chars``, where there is such a column, follows the text."""
    met = _met(docs, _lost(spark, docs), "doc_id", "text")
    same = F.col("gone").isNull()
    changed = met.select("row", same.alias("same"), F.when(~same, kept_text("lines", "gone")).alias("kept"))
    out = []
    for field in docs.schema.fields:
        old, new = F.col("row").getField(field.name), None
        if field.name == "text":
            new = F.col("kept")
        elif field.name == "n_chars":
            new = F.length("kept").cast(field.dataType)
        out.append((old if new is None else F.when(F.col("same"), old).otherwise(new)).alias(field.name))
    return changed.select(*out)


def lines_sql(docs: str, key: str) -> str:
    """DuckDB twin over ``docs`` with a unique ``key``; ends in l_out (key, n_lines,
    n_dropped, kept)."""
    cut = r"translate(regexp_replace(s, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
    l_line AS (SELECT *, {cut} AS g FROM (SELECT {key} AS k, coalesce(doc_id, {_LAST}) AS d, unnest(string_split(coalesce(text, ''), chr(10))) AS s,
        generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM {docs})),
    l_own AS (SELECT g, min(d) AS o FROM l_line WHERE length(g) >= {MIN_CHARS} GROUP BY g HAVING count(DISTINCT d) > 1),
    l_out AS (SELECT k, count(*)::BIGINT AS n_lines, (count(*) FILTER (o IS NOT NULL AND o <> d))::BIGINT AS n_dropped,
        coalesce(string_agg(s, chr(10) ORDER BY i) FILTER (o IS NULL OR o = d), '') AS kept FROM l_line LEFT JOIN l_own USING (g) GROUP BY k)"""


SQL = f"""WITH l_docs AS (SELECT row_number() OVER () AS rid, doc_id, text FROM documents),
{lines_sql("l_docs", "rid")}
SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM l_docs JOIN l_out ON rid = k"""
