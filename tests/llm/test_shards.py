"""Shards: laws, groups, slots, and the same answer however the table is cut."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from derrick.llm import shard_packing as sp
from llm_rows import AWKWARD


def made(seed, n, longest=300):
    rng = random.Random(seed)
    rows = [(i, f"{i} " + "w é " * int(5 * rng.paretovariate(1.2) % longest), "s") for i in range(n)]
    return rows + [(n + i, f"copy of text {i % 9}", "s") for i in range(n // 5)]


def table(docs, path, rows, clash=True):
    docs(rows, clash).write.parquet(f"{path}/documents.parquet")
    return str(path)


def text_of(rows):
    return {d: t or "" for d, t, _ in rows}


def test_query_columns_and_laws(spark, docs, tmp_path):
    rows = made(1, 800) + [(None, "no id", "s")]
    got = sp.op11_shard_packing(spark, table(docs, tmp_path, rows)).collect()
    texts = text_of(rows)
    assert sorted((r["doc_id"], ) for r in got if r["doc_id"] is not None) == sorted((d,) for d in texts if d is not None)
    bytes_of, rows_of, slots, groups = Counter(), Counter(), defaultdict(list), defaultdict(set)
    for r in got:
        body = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["tokens"]) == (len(body) + 1, zlib.crc32(body), len(texts[r["doc_id"]].split()))
        assert (r["law"], r["grown_shard"]) == ("bytes", None)
        bytes_of[r["shard"]] += r["size"]
        rows_of[r["shard"]] += 1
        slots[r["shard"]].append(r["slot"])
        groups[body].add(r["shard"])
    assert set(bytes_of) == set(range(16))
    assert max(bytes_of.values()) - min(bytes_of.values()) <= 0.01 * sum(bytes_of.values()) / 16
    assert max(rows_of.values()) - min(rows_of.values()) <= 0.1 * len(rows) / 16
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    # Groups small enough are whole: the nine copies' texts hold 18 rows each of 60 a shard.
    assert sum(len(g) > 1 for g in groups.values()) <= 9


@pytest.mark.parametrize(("leaf", "fan"), [(10**9, 256), (100, 4), (150, 256)])
def test_trees_of_any_depth_place_all(spark, docs, leaf, fan):
    rows = made(2, 1500)
    frames = []
    for parts in (2, 7):
        narrow = sp.materialize(sp.measured(docs(rows).repartition(parts), sp.F.col("doc_id")), "measured")
        found = sp.located(narrow, sp.packing(narrow, leaf=leaf, fan=fan))
        frames.append(sorted((r["doc_id"], r["shard"], r["size"]) for r in found.collect()))
    assert frames[0] == frames[1]
    assert [d for d, _, _ in frames[0]] == sorted(d for d, _, _ in rows)
    sums = Counter()
    for _, shard, size in frames[0]:
        sums[shard] += size
    assert max(sums.values()) - min(sums.values()) <= 0.02 * sum(sums.values()) / 16


def test_a_third_of_rows_in_one_group_is_cut(spark, docs):
    rows = made(3, 600) + [(10_000 + i, "the one text that a third of all rows hold", "s") for i in range(400)]
    narrow = sp.materialize(sp.measured(docs(rows), sp.F.col("doc_id")), "measured")
    found = sp.located(narrow, sp.packing(narrow)).collect()
    assert len(found) == len(rows)
    per = Counter(r["shard"] for r in found)
    assert max(per.values()) - min(per.values()) <= 0.1 * len(rows) / 16


def test_awkward_rows_and_emptiness(spark, docs, awkward, tmp_path):
    awkward.write.parquet(f"{tmp_path}/some/documents.parquet")
    got = sp.op11_shard_packing(spark, f"{tmp_path}/some").collect()
    assert len(got) == len(AWKWARD)
    assert sum(r["size"] for r in got) == sum(len((t or "").encode()) + 1 for _, t, _ in AWKWARD)
    docs([]).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert sp.op11_shard_packing(spark, f"{tmp_path}/none").collect() == []


def test_files_hold_whole_documents_in_slot_order(spark, docs, tmp_path):
    rows = made(4, 200)
    df = docs(rows, clash=True)
    sp.write_shards(sp.sharded(df, shards=3), f"{tmp_path}/shards", shards=3, rows_per_file=50)
    back = spark.read.parquet(f"{tmp_path}/shards")
    assert back.select("row.*").columns == df.columns
    assert sorted((r["row"]["doc_id"], r["row"]["text"]) for r in back.collect()) == sorted((d, t) for d, t, _ in rows)
    for shard in range(3):
        slots = sorted(r["slot"] for r in back.filter(sp.F.col("shard") == shard).collect())
        assert slots == list(range(len(slots)))


def test_settling_lowers_the_sum_of_squares():
    rng = np.random.default_rng(5)
    v = rng.random((300, 3)) / 50
    room = np.tile(v.sum(axis=0) / 8, (8, 1))
    shard = sp.place(v, room)
    before = (room**2).sum()
    sp.settle(v, shard, room)
    assert (room**2).sum() < before
    for s in range(8):
        assert np.allclose(room[s], v.sum(axis=0) / 8 - v[shard == s].sum(axis=0))
