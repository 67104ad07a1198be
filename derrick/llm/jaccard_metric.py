"""Exact n-gram Jaccard join in the metric space of shingle sets.

The Jaccard distance d = 1 - |x and y| / |x or y| is a metric. Documents link at
d <= 0.1 (a parameter), and the query returns their connected components.

In this space nearly all documents lie at a distance close to 1 from one another
(see the README for figures), so pivots alone cannot part a corpus: a window of twice
the radius around any far pivot holds everything. Three exact reductions therefore
come first, each of which a linked pair is certain to survive:

1. equal sets are one class;
2. isolation: a set more than a tenth of whose shingles occur nowhere else is further
   than 0.1 from all others. Shingles are counted in a fixed quarter of the hash space
   first, which bounds the full count from below, and among the survivors in full;
3. provinces: linked sets share 90 of 100 shingles of either, so, in any order of all
   shingles, at least one of the first tenth (and one more) of both. In the order of
   rarity few others share these. Sets of like sizes that share one are in one
   province; provinces that share a set are one.

Within a province distances vary and pivots work:

4. a province that fits a task is swept by pivots: a set joins the pivot's component
   if it lies within the radius, and sets whose distances to an earlier pivot differ by
   more than the radius are passed over (triangle inequality);
5. a larger one is parted: linked sets of sizes s and t differ in at most (s + t) / 19
   shingles (for 0.1), so of one part more than that, dealt by hash, they agree in at
   least one. (By themselves parts make no provinces: small ones are often empty, and
   all sets with the same empty part agree in it.) What is still too large is cut into
   Voronoi cells around pivots drawn by hash. A set goes to the cell of its nearest
   pivot, and also to every cell whose pivot is at most twice the radius further away:
   a linked partner has its home there or here. Cells are cut again until they fit;
6. cells that do not shrink are crowded around their pivots. What lies within the
   radius of the best of some pivots is one component with it, so only pairs with a set
   outside remain; these are compared in blocks, exactly, and yield spanning edges.

Scale: texts are read twice and shuffled at most once, for the survivors; a hot class
is one row after step 1, a hot province is cut by steps 5 and 6, never held in one
task. Everything that is gathered in a task is bounded by ``TASK_SHINGLES``.

Edge cases: null and empty texts have an empty set and link with nothing; fewer words
than a shingle make one shingle; ids may be missing (a component of such rows alone
has a null id) or repeated (each row is a document); equal rows are one class; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from derrick.llm.common import cols, documents, hinted, row_key, settled
from derrick.llm.components import components
from derrick.sources.scratch import materialize


@dataclass(frozen=True)
class Metric:
    """Words to a shingle, and the similarity of linked sets in percent."""

    n: int = 3
    percent: int = 90

    @property
    def radius(self) -> float:
        return (100 - self.percent) / 100

    @property
    def step(self) -> float:
        """Sizes of one class grow by this factor from its smallest, so a linked larger
        set is in the same class or the next."""
        return max(1.25, 100 / self.percent)

    def linked(self, shared: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
        return 100 * shared >= self.percent * (n + m - shared)


#: Where nothing else is asked for: five words, similarity 0.8.
NEAR = Metric(5, 80)
#: Part of the hash space in which isolation is first counted: one in PROBE.
PROBE = 4
#: Shingles of one province that a task may hold.
TASK_SHINGLES = 1_000_000
#: Pivots of a cell that is cut, and pivots tried in one that no longer shrinks.
PIVOTS, TRIED = 32, 8
_P1, _P2 = np.uint64(0x9E3779B185EBCA87), np.uint64(0xC2B2AE3D27D4EB4F)


class _Words(dict):
    """Word -> 64-bit hash, remembered for a while."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P1
    return h ^ (h >> np.uint64(32))


def shingle_set(text: str | None, known: dict, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``n``-word shingles of the whole text.
    bytes.split and bytes.lower know exactly the white space and letters meant."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
    size = min(n, len(h))
    out = np.full(len(h) - size + 1, size, dtype=np.uint64)
    for k in range(size):
        out = out * _P1 + h[k : len(h) - size + 1 + k]
    return np.unique(_mix(out))


def _signature(s: np.ndarray) -> bytes | None:
    return blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None


def sets(docs: DataFrame, metric: Metric, doc_id: str = "doc_id", text: str = "text", probe: int = PROBE) -> DataFrame:
    """Per row its id, key, set size, class (signature of the set, null if empty) and
    the shingles in the probed part of the hash space."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _Words()
        for rows in batches:
            found = [shingle_set(t, known, metric.n) for t in rows.pop("text")]
            rows["n"] = [len(s) for s in found]
            rows["cls"] = [_signature(s) for s in found]
            rows["probe"] = [s[s % np.uint64(probe) == 0].view(np.int64) for s in found]
            yield rows

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), row_key(F.col(doc_id), F.col(text)).alias("key"), F.col(text).alias("text"))
    return rows.mapInPandas(run, "doc_id long, key long, n long, cls binary, probe array<long>")


def _not_isolated(rows: DataFrame, shingles: str, metric: Metric) -> DataFrame:
    """Classes of ``rows`` (cls, n, shingles) of whose shingles at most a share of
    100 - percent occurs in no other class."""
    short = F.conv(F.hex(F.substring("cls", 1, 7)), 16, 10).cast("long")
    spread = rows.select(short.alias("c"), F.explode(shingles).alias("s"))
    held = spread.groupBy("s").agg(F.min("c").alias("c"), F.max("c").alias("last"))
    alone = held.filter("c = last").groupBy("c").agg(F.count(F.lit(1)).alias("own"))
    classes = rows.select("cls", "n", short.alias("c")).groupBy("cls", "n", "c").agg(F.lit(1).alias("one"))
    far = classes.join(alone.withColumnRenamed("c", "c2"), F.col("c") == F.col("c2"), "left")
    return far.filter(100 * (F.col("n") - F.coalesce("own", F.lit(0))) >= metric.percent * F.col("n")).select("cls", "n")


def survivors(rows: DataFrame, docs: DataFrame, metric: Metric, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per class that may have a link: cls, n and its sorted shingles."""
    near = _not_isolated(rows.filter("cls IS NOT NULL"), "probe", metric)
    pick = rows.groupBy("cls").agg(F.min(F.struct("doc_id", "key")).alias("row"))
    near = near.join(pick, "cls").select(F.col("row.doc_id").alias("d"), F.col("row.key").alias("k"))
    near = materialize(near, "near")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _Words()
        for rows in batches:
            found = [shingle_set(t, known, metric.n) for t in rows["text"]]
            yield pd.DataFrame({
                "cls": [_signature(s) for s in found],
                "n": [len(s) for s in found],
                "s": [s.view(np.int64) for s in found],
            })

    keyed = docs.select(F.col(doc_id).cast("long").alias("doc_id"), row_key(F.col(doc_id), F.col(text)).alias("key"), F.col(text).alias("text"))
    picked = keyed.join(hinted(near, 40), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("key") == F.col("k")), "left_semi")
    full = materialize(picked.select("text").mapInPandas(run, "cls binary, n long, s array<long>"), "sets")
    full = full.groupBy("cls", "n").agg(F.first("s").alias("s")) if _repeats(full) else full
    kept = _not_isolated(full, "s", metric).select("cls")
    return materialize(full.join(kept, "cls", "left_semi"), "survivors")


def _repeats(full: DataFrame) -> bool:
    """Whether a picked row is there more than once (equal rows in the input)."""
    return not full.groupBy("cls").count().filter("count > 1").isEmpty()


def _size_classes(most: int, step: float) -> np.ndarray:
    """Smallest sizes of the classes, up to beyond ``most``."""
    out = [1]
    while out[-1] <= most:
        out.append(max(out[-1] + 1, int(out[-1] * step)))
    return np.array(out, dtype=np.int64)


def part_signatures(s: np.ndarray, metric: Metric) -> list[int]:
    """Keys of the parts of a set, for its own size class and, where a linked larger
    set may be in it, the next one. Equal keys mean equal parts."""
    steps = _size_classes(len(s) * 2 + 2, metric.step)
    at = int(np.searchsorted(steps, len(s), side="right")) - 1
    out: list[int] = []
    spread = _mix(s ^ _P2)
    for c in (at, at + 1):
        if c > at and len(s) * 100 < metric.percent * int(steps[c]):
            break  # the smallest size of the next class is out of reach
        parts = 2 * (int(steps[c + 1]) - 1) * (100 - metric.percent) // (100 + metric.percent) + 1
        part = (spread % np.uint64(parts)).astype(np.int64)
        sums = np.zeros(parts, dtype=np.uint64)
        np.add.at(sums, part, _mix(spread))
        key = _mix(sums + _mix(np.arange(parts, dtype=np.uint64) + np.uint64(c) * np.uint64(1 << 32)))
        out += key.view(np.int64).tolist()
    return out


def rare_shingles(full: DataFrame, metric: Metric) -> DataFrame:
    """(c, s, size) of the rarest shingles of each class (c, a hash of cls) of ``full``
    (cls, n, s), as many as two linked classes cannot have without sharing one, less those
    of one class alone. ``size`` numbers the classes of sizes from the set's own to the
    largest that may be linked with it, so linked classes share an (s, size)."""
    spread = full.select(F.xxhash64("cls").alias("c"), "n", F.explode("s").alias("s"))
    often = spread.groupBy("s").agg(F.count(F.lit(1)).alias("sets"))
    order = Window.partitionBy("c").orderBy("sets", "s")
    ranked = spread.join(often, "s").withColumn("at", F.row_number().over(order))
    # Linked sets share at least percent * n / 100; all others, and one more, come first.
    first = ranked.filter(100 * (F.col("at") - 1) <= (100 - metric.percent) * F.col("n")).filter("sets > 1")

    def size_class(n: Column) -> Column:
        return F.floor(F.log(n.cast("double")) / float(np.log(metric.step)))

    most = F.floor(100 * F.col("n") / metric.percent)
    return first.select("c", "s", F.explode(F.sequence(size_class(F.col("n")), size_class(most))).alias("size"))


def _joined(keyed: DataFrame, name: str, *key: str) -> DataFrame:
    """(node, root) of the names that share a key, directly or through others."""
    heads = keyed.groupBy(*key).agg(F.min(name).alias("head"), F.max(name).alias("last")).filter("head <> last")
    edges = keyed.join(heads, list(key)).select(F.col(name).alias("a"), F.col("head").alias("b")).filter("a <> b").distinct()
    return components(materialize(edges, "province-edges"))


def provinces(full: DataFrame, metric: Metric) -> DataFrame:
    """(cls, province) of the classes that share one of their rarest shingles with
    another one of like size."""
    joined = _joined(materialize(rare_shingles(full, metric), "rare"), "c", "s", "size")
    named = full.select("cls", F.xxhash64("cls").alias("node")).join(joined, "node")
    return named.select("cls", F.col("root").cast("string").cast("binary").alias("province"))


def _parted(cells: DataFrame, metric: Metric) -> DataFrame:
    """Provinces (cell, cls, s) parted further: the classes that agree with another one
    of their cell in a part, in cells of those that such agreement joins."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            keys = [part_signatures(np.asarray(s).view(np.uint64), metric) for s in rows["s"]]
            times = [len(k) for k in keys]
            yield pd.DataFrame({"cell": rows["cell"].repeat(times), "cls": rows["cls"].repeat(times), "part": [x for k in keys for x in k]})

    parts = materialize(cells.mapInPandas(run, "cell binary, cls binary, part long"), "parts")
    joined = _joined(parts, "cls", "cell", "part")
    return cells.select("cls", "s").join(joined, F.col("cls") == F.col("node")).select(F.col("root").alias("cell"), "cls", "s")


class Sets:
    """Sets side by side in one array, for distances of one to many."""

    def __init__(self, arrays: list[np.ndarray]) -> None:
        self.n = np.array([len(a) for a in arrays], dtype=np.int64)
        self.names, flat = np.unique(np.concatenate(arrays), return_inverse=True)
        self.starts = np.concatenate([[0], np.cumsum(self.n)])
        self.flat = flat.reshape(-1)

    def shared(self, ids: np.ndarray, others: np.ndarray) -> np.ndarray:
        """Sizes of the intersections of the set of ``ids`` with those of ``others``."""
        mark = np.zeros(len(self.names), dtype=np.int64)
        mark[ids] = 1
        if len(others) == len(self.n):
            return np.add.reduceat(mark[self.flat], self.starts[:-1])
        at = np.concatenate([np.arange(self.starts[o], self.starts[o + 1]) for o in others])
        return np.add.reduceat(mark[self.flat[at]], np.concatenate([[0], np.cumsum(self.n[others])])[:-1])

    def own(self, i: int) -> np.ndarray:
        return self.flat[self.starts[i] : self.starts[i + 1]]


def distance(shared: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1.0 - shared / (n + m - shared)


def sweep(arrays: list[np.ndarray], metric: Metric) -> np.ndarray:
    """Component number of each set: pivots sweep the sets that have none yet. The
    distances to the component's first pivot rule out, by the triangle inequality,
    sets that the present one cannot reach."""
    s = Sets(arrays)
    label = np.full(len(arrays), -1)
    radius = metric.radius + 1e-9
    for first in range(len(arrays)):
        if label[first] >= 0:
            continue
        label[first] = first
        free = np.flatnonzero(label < 0)
        if not len(free):
            break
        from_first = np.zeros(len(arrays))
        shared = s.shared(s.own(first), free)
        from_first[free] = distance(shared, s.n[free], s.n[first])
        queue = free[metric.linked(shared, s.n[free], s.n[first])].tolist()
        label[queue] = first
        while queue:
            i = queue.pop()
            free = np.flatnonzero((label < 0) & (np.abs(from_first - from_first[i]) <= radius))
            if not len(free):
                continue
            shared = s.shared(s.own(i), free)
            near = free[metric.linked(shared, s.n[free], s.n[i])]
            label[near] = first
            queue += near.tolist()
    return label


_EDGE = "a binary, b binary"


def _swept(cells: DataFrame, metric: Metric) -> DataFrame:
    """Edges that connect the linked sets of each cell (cell, cls, s) that fits a task."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        label = sweep([np.asarray(s) for s in rows["s"]], metric)
        cls = rows["cls"].to_numpy(dtype=object)
        far = label != np.arange(len(label))
        return pd.DataFrame({"a": cls[far], "b": cls[label[far]]})

    return cells.groupBy("cell").applyInPandas(run, _EDGE)


_CUT = "cell binary, cls binary, s array<long>, near array<binary>, linked array<binary>"


def _cut(cells: DataFrame, weights: DataFrame, metric: Metric) -> DataFrame:
    """One Voronoi round over cells (cell, cls, s) too large for a task: each member with
    the pivots ``near`` it, whose cells it goes to, and those ``linked`` with it. Members
    are dealt to slices, each of which gets the cell's pivots. A task returns each set
    once, however many pivots are near it; ``_spread`` multiplies them on the way."""
    slices = F.ceil(F.col("weight") / (TASK_SHINGLES / 4)).cast("int")
    large = cells.join(weights.select("cell", slices.alias("slices"), "sets"), "cell")
    draw = F.pmod(F.xxhash64("cls", "cell"), F.col("sets")) < 2 * PIVOTS
    pivots = large.filter(draw).groupBy("cell", "slices").agg(
        F.slice(F.sort_array(F.collect_list(F.struct(F.xxhash64("cls", "cell").alias("h"), "cls", "s"))), 1, PIVOTS).alias("p")
    )
    pivots = pivots.select("cell", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"), "p")
    pivots = pivots.select("cell", "slice", F.explode("p").alias("p")).select("cell", "slice", F.col("p.cls").alias("cls"), F.col("p.s").alias("s"))
    pivots = materialize(pivots, "pivots")
    dealt = large.withColumn("slice", F.pmod(F.xxhash64("cls"), F.col("slices")).cast("int")).drop("slices", "sets")

    def run(members: pd.DataFrame, around: pd.DataFrame) -> pd.DataFrame:
        if not len(members) or not len(around):
            return pd.DataFrame({c: [] for c in ("cell", "cls", "s", "near", "linked")}, dtype=object)
        arrays = [np.asarray(x) for x in members["s"]] + [np.asarray(x) for x in around["s"]]
        s, g = Sets(arrays), len(members)
        every = np.arange(g)
        shared = np.stack([s.shared(s.own(g + j), np.arange(len(arrays)))[:g] for j in range(len(around))], axis=1)
        sizes = s.n[every][:, None]
        d = distance(shared, sizes, s.n[g:][None, :])
        link = metric.linked(shared, sizes, s.n[g:][None, :])
        wide = d <= d.min(axis=1)[:, None] + 2 * metric.radius + 1e-9
        names = around["cls"].tolist()
        return members[["cell", "cls", "s"]].assign(
            near=[[names[j] for j in np.flatnonzero(row)] for row in wide],
            linked=[[names[j] for j in np.flatnonzero(row)] for row in link & wide],
        )

    return dealt.groupBy("cell", "slice").cogroup(pivots.groupBy("cell", "slice")).applyInPandas(run, _CUT)


def _spread(cut: DataFrame) -> DataFrame:
    """The members of ``cut`` in each of their new cells (cell, cls, s)."""
    each = cut.select("cell", F.explode("near").alias("pivot"), "cls", "s")
    return each.select(F.unhex(F.md5(F.concat("cell", "pivot"))).alias("cell"), "cls", "s")


def _weights(cells: DataFrame) -> DataFrame:
    return cells.groupBy("cell").agg(F.sum(F.size("s")).cast("long").alias("weight"), F.count(F.lit(1)).alias("sets"))


def _crowded(cells: DataFrame, weights: DataFrame, metric: Metric) -> DataFrame:
    """The sets of cells that no longer shrink (cell, cls, s), each with the cell's pivot,
    whether it is ``inside`` its radius, and its block. Of ``TRIED`` pivots drawn by hash the one
    with most sets inside is taken; sets within its radius are one component with it."""
    size = weights.select("cell", F.ceil(F.col("weight") / (TASK_SHINGLES / 4)).cast("int").alias("blocks"), "sets")
    drawn = F.xxhash64("cls", "cell")
    rows = cells.join(size, "cell")
    near = rows.filter(F.pmod(drawn, F.col("sets")) < 2 * TRIED).groupBy("cell").agg(
        F.slice(F.sort_array(F.collect_list(F.struct(drawn.alias("h"), "cls", "s"))), 1, TRIED).alias("drawn")
    )
    first = cells.groupBy("cell").agg(F.min(F.struct(F.lit(0).cast("long").alias("h"), "cls", "s")).alias("first"))
    drawn_from = first.join(near, "cell", "left").select("cell", F.coalesce("drawn", F.array("first")).alias("drawn"))
    rows = rows.join(drawn_from, "cell")

    def linked(s: Column, p: Column) -> Column:
        shared = F.size(F.array_intersect(s, p))
        return 100 * shared >= metric.percent * (F.size(s) + F.size(p) - shared)

    rows = rows.select("cell", "cls", "s", "blocks", F.transform("drawn", lambda p: p["cls"]).alias("names"),
                       F.transform("drawn", lambda p: linked(F.col("s"), p["s"])).alias("links"))
    rows = materialize(rows, "crowded")
    counts = rows.select("cell", F.posexplode("links").alias("at", "link")).groupBy("cell", "at").agg(F.count_if("link").alias("n"))
    best = counts.groupBy("cell").agg(F.max(F.struct("n", (-F.col("at")).alias("at"))).alias("best")).select("cell", (-F.col("best.at")).alias("at"))
    rows = rows.join(best, "cell")
    return rows.select("cell", "cls", "s", F.get("names", F.col("at")).alias("pivot"), F.get("links", F.col("at")).alias("inside"),
                       "blocks", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int").alias("block"))


def _in_blocks(
    cells: DataFrame, weights: DataFrame, metric: Metric
) -> tuple[DataFrame, DataFrame]:
    """Edges that connect the linked sets of cells that no longer shrink: those to the
    pivot, and those of the sets outside its radius. The sets outside are dealt to
    blocks, and each block meets all blocks of the cell in turn; what an earlier edge of
    the two blocks connects, or the pivot, gets no further one."""
    rows = materialize(_crowded(cells, weights, metric), "blocks")
    edges = rows.filter("inside AND cls <> pivot").select(F.col("cls").alias("a"), F.col("pivot").alias("b"))
    outside = rows.filter("NOT inside").select("cell", "cls", "s", "block",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("with"))
    has = rows.filter("NOT inside").select("cell", "block").distinct().withColumnRenamed("block", "from")
    # Two sets outside meet once: in the pair of blocks whose second is not the smaller one.
    others = rows.join(has, "cell").filter("inside OR block >= from").select(
        F.col("cell").alias("in"), F.col("cls").alias("cls"), F.col("s").alias("s"), "inside",
        F.col("from").alias("mine"), F.col("block").alias("rest"),
    )

    def run(mine: pd.DataFrame, rest: pd.DataFrame) -> pd.DataFrame:
        a: list[bytes] = []
        b: list[bytes] = []
        if len(mine) and len(rest):
            arrays = [np.asarray(x) for x in rest["s"]] + [np.asarray(x) for x in mine["s"]]
            s, g = Sets(arrays), len(rest)
            names = rest["cls"].tolist()
            inside = rest["inside"].to_numpy(dtype=bool)
            root: dict[bytes, bytes] = {}

            def find(x: bytes) -> bytes:
                while x in root:
                    root[x] = x = root.get(root[x], root[x])
                return x

            for i, cls in enumerate(mine["cls"]):
                k = g + i
                hit = metric.linked(s.shared(s.own(k), np.arange(len(arrays)))[:g], s.n[:g], s.n[k])
                for j in np.flatnonzero(hit):
                    x, y = find(cls), find(b"" if inside[j] else names[j])  # all inside are one
                    if x != y:
                        root[max(x, y)] = min(x, y)
                        a.append(cls)
                        b.append(names[j])
        return pd.DataFrame({"a": a, "b": b}, dtype=object)

    pairs = outside.groupBy("cell", "block", "with").cogroup(others.groupBy("in", "mine", "rest")).applyInPandas(run, _EDGE)
    return edges, pairs


def link_edges(full: DataFrame, metric: Metric, rounds: int = 6) -> DataFrame:
    """Edges between linked classes that connect all of each component."""
    home = materialize(provinces(full, metric), "provinces")
    cells = materialize(full.join(home, "cls").select(F.col("province").alias("cell"), "cls", "s"), "cells")
    weights = materialize(_weights(cells), "weights")
    edges = []
    big = weights.filter(F.col("weight") > TASK_SHINGLES)
    if not big.isEmpty():
        small = weights.filter(F.col("weight") <= TASK_SHINGLES).select("cell")
        edges.append(materialize(_swept(cells.join(small, "cell", "left_semi"), metric), "edges"))
        cells = materialize(_parted(cells.join(big.select("cell"), "cell", "left_semi"), metric), "cells")
        weights = materialize(_weights(cells), "weights")
    for left in range(rounds, -1, -1):
        small = weights.filter(F.col("weight") <= TASK_SHINGLES).select("cell")
        edges.append(materialize(_swept(cells.join(small, "cell", "left_semi"), metric), "edges"))
        big = weights.filter(F.col("weight") > TASK_SHINGLES)
        if big.isEmpty():
            break
        big_cells = cells.join(big.select("cell"), "cell", "left_semi")
        if left == 0:
            edges += [materialize(e, "edges") for e in _in_blocks(big_cells, big, metric)]
            break
        cut = materialize(_cut(big_cells, big, metric), "cut")
        edges.append(cut.select(F.col("cls").alias("a"), F.explode("linked").alias("b")).filter("a <> b"))
        spread, held = cut.agg(F.coalesce(F.sum(F.size("near")), F.lit(0))).first()[0], big.agg(F.sum("sets")).first()[0]
        if spread > 4 * held:  # windows reach most cells: the province is crowded
            edges += [materialize(e, "edges") for e in _in_blocks(big_cells, big, metric)]
            break
        cells = materialize(_spread(cut), "cells")
        weights = materialize(_weights(cells), "weights")
    out = edges[0]
    for more in edges[1:]:
        out = out.unionByName(more)
    return out


def clusters(docs: DataFrame, metric: Metric, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row's id, key, set size, component (smallest id that links reach) and the
    component's root, which tells components apart where ids repeat (null: no words)."""
    rows = materialize(sets(docs, metric, doc_id, text), "rows")
    linked_to = settled(
        docs.sparkSession, "linked",
        lambda: components(materialize(link_edges(survivors(rows, docs, metric, doc_id, text), metric), "links")),
    )
    classes = rows.filter("cls IS NOT NULL").groupBy("cls").agg(F.min("doc_id").alias("least"))
    roots = materialize(classes.join(linked_to, F.col("cls") == F.col("node"), "left").select(
        "cls", "least", F.coalesce("root", "cls").alias("root")
    ), "roots")
    least = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    named = roots.join(least, "root").select("cls", "component_id", "root")
    out = rows.select("doc_id", "key", "n", F.col("cls").alias("c")).join(named, F.col("c") == F.col("cls"), "left")
    return out.select("doc_id", "key", F.col("n").alias("n_shingles"), F.when(F.col("c").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), "root")


def op6_jaccard_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters(documents(spark, sf_dir), Metric(3, 90)).select("doc_id", "n_shingles", "component_id")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component the document with the smallest id (of equal ids the one with
    the smallest key), equal rows once; documents without words or id stay.
    As no contract binds the stage, it takes five words and 0.8."""

    def first_of_each() -> DataFrame:
        found = clusters(docs, NEAR).filter("doc_id IS NOT NULL AND root IS NOT NULL")
        first = found.groupBy("root").agg(F.min(F.struct("doc_id", "key")).alias("m"))
        return first.select(F.col("m.doc_id").alias("d"), F.col("m.key").alias("k"))

    first = settled(spark, "kept-keys", first_of_each)
    keyed = docs.select(F.struct(*cols(docs)).alias("row"), F.col("doc_id").alias("id"), row_key(F.col("doc_id"), F.col("text")).alias("key"),
                        F.length(F.regexp_replace(F.coalesce("text", F.lit("")), "[ \\t-\\r]+", "")).alias("chars"))
    empty = keyed.filter("chars = 0 OR id IS NULL").select("row.*")
    rest = keyed.filter("chars > 0 AND id IS NOT NULL")
    kept = rest.join(hinted(first, 40), (F.col("id") == F.col("d")) & (F.col("key") == F.col("k")), "left_semi")
    return empty.unionByName(kept.dropDuplicates(["id", "key"]).select("row.*"))
