"""Sharding by vector bin packing: bytes, words and rows are balanced jointly.

Equal texts are one group, placed as one item with the vector (bytes, words, rows),
measured in shards' capacities. An item goes to the shard where the dot product of
its vector with the shard's residual capacity is highest; that choice makes the sum
of all squared residuals smallest. Larger items go first; at the end of a node, items
change places between two shards as long as that sum falls (bytes weigh twice).

A greedy placement is one sequence, so it is cut into a tree of short ones, top down.
Items of at least ``LARGE`` of a shard are placed at the root. What they leave free
in each shard is dealt to the children in proportion to the weight below them, where
the items that are large for a child are placed, and so on; the leaves take the rest.
Which child an item belongs to is a hash of its group, and the tree's width follows
from the number of items, so the result is the same for any partitioning.

A group stays whole as long as it is no larger than a shard in any measure. Larger ones
(at most 3 x shards) are cut, by a hash of the document's id, into pieces of about
``CUT`` of a shard.

Law: ``bytes``, the shards' sums of UTF-8 bytes (plus one a document) are near equal;
words and rows are as near as the documents allow. The slot numbers the documents of
a shard in hash order, block by block.

Scale: texts are read once and never shuffled. A node places at most 3 x shards /
LARGE large items, a leaf about ``LEAF`` items, both by hash and not by any one key;
a level is one grouped map over its nodes. Documents meet the root's items by
broadcast (bounded as said) and all others, none of which holds more than a part of
LARGE of a shard, by one shuffle of narrow rows. Slots come from counted blocks of
about ``BLOCK`` documents. All sums are of whole numbers, so reruns agree.

Edge cases: null and empty texts are one group of size 1 with no words; ids may be
missing or repeated; equal rows (same id, same text) always share a shard, whatever
they weigh; an empty table gives an empty result; further columns are ignored, and
kept by ``sharded``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from derrick.llm.common import cols, documents, settled, space_words
from derrick.sources.scratch import materialize

SHARDS = 16
#: Parts of a shard's capacity: above which a group is cut, what its pieces have, and from
#: which an item is placed at a node of the tree.
WHOLE, CUT, LARGE = 1.0, 1 / 4, 1 / 64
#: Items of a leaf, children of a node, documents of a block of slots.
LEAF, FAN, BLOCK = 20_000, 256, 2_000
MOST_BLOCKS = 65_536
MEASURES = ("size", "tokens", "rows")
#: What a measure weighs in the residuals.
WEIGHTS = (2.0, 1.0, 1.0)
#: Changes of places at the end of a node, and the items of a shard tried for each.
CHANGES, TRIED = 400, 64


@dataclass(frozen=True)
class Packing:
    """Where items go: the cut groups, the shards of the root's items and, where there
    are more levels, of all others."""

    cut: DataFrame
    head: DataFrame
    rest: DataFrame | None


def measured(docs: DataFrame, *keep: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Group, spread (a hash of the id, by which a cut group is dealt) and measures of
    every document, beside the columns ``keep``."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        *keep,
        F.substring(F.unhex(F.sha2(body, 256)), 1, 16).alias("group"),
        F.xxhash64(F.col(doc_id).cast("string")).alias("spread"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.size(space_words(F.col(text))).cast("long").alias("tokens"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
    )


def tree(items: int, leaf: int = LEAF, fan: int = FAN) -> tuple[int, int]:
    """(levels below the root, children of a node) for so many items."""
    depth = 0
    while fan**depth * leaf < items:
        depth += 1
    width = 1
    while depth and width**depth * leaf < items:
        width += 1
    return depth, width


def place(vectors: np.ndarray, room: np.ndarray) -> np.ndarray:
    """Shard of each vector (rows in the order of placement); ``room`` holds the
    shards' residual capacities and is used up."""
    out = np.empty(len(vectors), dtype=np.int32)
    for i, v in enumerate(vectors):
        s = int((room @ v).argmax())
        room[s] -= v
        out[i] = s
    return out


def settle(vectors: np.ndarray, shard: np.ndarray, room: np.ndarray) -> None:
    """Changes places, in ``shard`` and ``room``: of the two shards whose residuals differ
    most (else the next two), an item against an item, or an item alone, moves where the
    sum of squared residuals falls most. What leaves a with d makes it 2 d (d + a - b) more."""
    pairs = np.transpose(np.triu_indices(len(room), 1))
    none = np.zeros((1, room.shape[1]))

    def change() -> bool:
        apart = ((room[pairs[:, 0]] - room[pairs[:, 1]]) ** 2).sum(axis=1)
        for a, b in pairs[np.argsort(-apart, kind="stable")]:
            mine, theirs = (_spaced(np.flatnonzero(shard == s)) for s in (a, b))
            d = np.vstack([vectors[mine], none])[:, None, :] - np.vstack([vectors[theirs], none])[None, :, :]
            more = 2 * (d * (d + room[a] - room[b])).sum(axis=2)
            i, j = np.unravel_index(more.argmin(), more.shape)
            if more[i, j] < -1e-12:
                room[a] += d[i, j]
                room[b] -= d[i, j]
                shard[mine[i : i + 1]] = b
                shard[theirs[j : j + 1]] = a
                return True
        return False

    for _ in range(CHANGES):
        if not change():
            return


def _spaced(items: np.ndarray) -> np.ndarray:
    """At most ``TRIED`` of a shard's items, from the largest to the smallest."""
    return items if len(items) <= TRIED else items[np.linspace(0, len(items) - 1, TRIED).astype(int)]


def _share(totals: list[int], shards: int) -> Column:
    """The largest of an item's measures, in capacities of a shard."""
    return F.greatest(*(F.col(m) * F.lit(shards / t if t else 0.0) for m, t in zip(MEASURES, totals)))


def _items(rows: DataFrame, groups: DataFrame, totals: list[int], shards: int) -> tuple[DataFrame, DataFrame]:
    """(items, cut groups): groups as they are, or in pieces."""
    share = _share(totals, shards)
    cut = groups.filter(share > WHOLE).select("group", F.ceil(share / CUT).cast("long").alias("pieces"))
    cut = materialize(cut, "cut-groups")
    whole = groups.join(F.broadcast(cut), "group", "left_anti").select("group", F.lit(0).cast("long").alias("piece"), *MEASURES)
    parts = rows.join(F.broadcast(cut), "group").groupBy(
        "group", F.pmod("spread", "pieces").alias("piece")
    ).agg(F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows"))
    return materialize(whole.unionByName(parts), "items"), cut


def _placed(here: DataFrame, room: DataFrame, scale: np.ndarray) -> DataFrame:
    """The items ``here`` with their shards; ``room`` holds a node's residuals."""

    def run(items: pd.DataFrame, node: pd.DataFrame) -> pd.DataFrame:
        v = items[list(MEASURES)].to_numpy(np.float64) * scale
        order = np.lexsort((items["piece"].to_numpy(), items["group"].to_numpy(), -v.sum(axis=1), -v.max(axis=1)))
        items, v = items.iloc[order], v[order]
        left = np.asarray(node["room"].iloc[0], dtype=np.float64).reshape(-1, len(MEASURES)) * scale
        shard = place(v, left)
        settle(v, shard, left)
        return items.assign(shard=shard)

    schema = "group binary, piece long, size long, tokens long, rows long, node long, shard int"
    return here.groupBy("node").cogroup(room.groupBy("node")).applyInPandas(
        lambda a, b: run(a, b) if len(a) else pd.DataFrame(columns=[*a.columns, "shard"]), schema
    )


def _left_over(room: DataFrame, placed: DataFrame, below: DataFrame, shards: int) -> DataFrame:
    """(node, room) of the children: the residual of a parent, by the children's weight."""
    used = placed.groupBy("node").agg(F.array(*(
        F.coalesce(F.sum(F.when(F.col("shard") == s, F.col(m))), F.lit(0)) for s in range(shards) for m in MEASURES
    )).alias("used"))
    child = below.groupBy("node", "child").agg(*(F.sum(m).alias(m) for m in MEASURES))
    child = materialize(child, "children")
    whole = child.groupBy("node").agg(*(F.sum(m).alias(f"all_{m}") for m in MEASURES))
    parts = F.array(*(F.coalesce(F.try_divide(F.col(m), F.col(f"all_{m}")), F.lit(0.0)) for m in MEASURES))
    met = child.join(whole, "node").join(room, "node").join(used, "node", "left").withColumn("parts", parts)
    left = F.transform("room", lambda r, i: (r - F.coalesce(F.get("used", i), F.lit(0))) * F.get("parts", i % len(MEASURES)))
    return met.select(F.col("child").alias("node"), left.alias("room"))


def packing(rows: DataFrame, shards: int = SHARDS, leaf: int = LEAF, fan: int = FAN) -> Packing:
    """Where the groups of ``rows`` (written; from ``measured``) go."""
    spark = rows.sparkSession
    groups = materialize(rows.groupBy("group").agg(
        F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")
    ), "groups")
    sums = groups.agg(*(F.coalesce(F.sum(m), F.lit(0)) for m in MEASURES), F.count(F.lit(1))).first()
    totals = [int(x) for x in sums[:3]]
    items, cut = _items(rows, groups, totals, shards)
    depth, width = tree(int(sums[3]), leaf, fan)
    share = _share(totals, shards)
    level = F.lit(depth)
    for k in range(depth - 1, -1, -1):
        level = F.when(share >= LARGE / width**k, F.lit(k)).otherwise(level)
    leaf_of = F.pmod(F.xxhash64("group", "piece"), F.lit(width**depth))
    items = items.select("*", level.alias("level"), leaf_of.alias("leaf"))
    scale = np.array([w * shards / t if t else 0.0 for w, t in zip(WEIGHTS, totals)])
    even = [t / shards for t in totals] * shards
    room = spark.createDataFrame([(0, even)], "node long, room array<double>")
    placed = []
    for k in range(depth + 1):
        node = F.expr(f"leaf div {width ** (depth - k)}")
        here = items.filter(F.col("level") == k).select("group", "piece", *MEASURES, node.alias("node"))
        placed.append(materialize(_placed(here, room, scale), "placed"))
        if k < depth:
            child = F.expr(f"leaf div {width ** (depth - k - 1)}")
            below = items.filter(F.col("level") > k).select(*MEASURES, node.alias("node"), child.alias("child"))
            room = materialize(_left_over(room, placed[k], below, shards), "room")
    found = [p.select("group", "piece", "shard") for p in placed]
    return Packing(cut, found[0], reduce(DataFrame.unionByName, found[1:]) if depth else None)


def located(rows: DataFrame, packed: Packing) -> DataFrame:
    """``rows`` (group, spread and any others) with their shard."""
    pieces = rows.join(F.broadcast(packed.cut), "group", "left")
    pieces = pieces.withColumn("piece", F.coalesce(F.pmod("spread", "pieces"), F.lit(0))).drop("pieces")
    head = F.broadcast(packed.head)
    found = pieces.join(head, ["group", "piece"])
    if packed.rest is not None:
        tail = pieces.join(F.broadcast(packed.head.select("group", "piece")), ["group", "piece"], "left_anti")
        found = found.unionByName(tail.join(packed.rest, ["group", "piece"]))
    return found.drop("piece")


def slotted(placed: DataFrame, total: int, shards: int = SHARDS) -> DataFrame:
    """``placed`` (written) with ``slot``: its place in the shard, from 0 without gaps."""
    blocks = max(1, min(MOST_BLOCKS, -(-total // (shards * BLOCK))))
    rows = placed.withColumn("order", F.xxhash64("spread", "group"))
    rows = rows.withColumn("block", F.pmod("order", F.lit(blocks)))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("shard", "block").agg(F.count(F.lit(1)).alias("n")).select(
        "shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    )
    own = Window.partitionBy("shard", "block").orderBy("order", "group", "spread")
    rows = rows.withColumn("at", F.row_number().over(own) - 1).join(starts, ["shard", "block"])
    return rows.withColumn("slot", (F.col("start") + F.col("at")).cast("long")).drop("order", "block", "at", "start")


def op11_shard_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    def make() -> DataFrame:
        rows = materialize(measured(documents(spark, sf_dir), F.col("doc_id")), "measured")
        placed = materialize(located(rows, packing(rows)), "located")
        return slotted(placed, placed.count())

    return settled(spark, "shards", make).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "tokens",
    )


def sharded(docs: DataFrame, shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``row`` (a struct of the document's columns), ``shard`` and ``slot`` of every
    document; the packing runs on narrow rows, and texts are shuffled to their shards."""
    def make() -> DataFrame:
        packed = packing(materialize(measured(docs, doc_id=doc_id, text=text), "measured"), shards)
        whole = measured(docs, F.struct(*cols(docs)).alias("row"), doc_id=doc_id, text=text)
        placed = materialize(located(whole, packed), "located")
        return slotted(placed, placed.count(), shards).select("row", "shard", "slot")

    return settled(docs.sparkSession, "sharded", make)


def write_shards(placed: DataFrame, path: str, shards: int = SHARDS, rows_per_file: int = 200_000) -> None:
    """A folder ``shard=N`` of Parquet files for each shard of ``sharded``, each file a
    stretch of at most ``rows_per_file`` slots in order; ``slot`` stays a column."""
    stretch = F.expr(f"slot div {rows_per_file}")
    dealt = placed.withColumn("stretch", stretch).repartition("shard", "stretch")
    dealt = dealt.sortWithinPartitions("shard", "slot").drop("stretch")
    dealt.write.option("maxRecordsPerFile", rows_per_file).partitionBy("shard").mode("errorifexists").parquet(path)
