"""Line dedup against plain Python: batch, inserts, deletions, filters."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from derrick.llm import line_dedup
from derrick.llm.cuckoo import CuckooFilter, built
from derrick.sources.scratch import materialize
from llm_rows import AWKWARD

LAST = 2**63 - 1
BLANK = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return line.strip(BLANK).translate(LOWER)


def brute(rows):
    """Sorted (doc_id, n_lines, n_dropped, sha256 of what stays)."""
    held = {}
    for d, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 10:
                held.setdefault(key(line), set()).add(LAST if d is None else d)
    out = []
    for d, t in rows:
        me = LAST if d is None else d
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or len(held[key(x)]) < 2 or min(held[key(x)]) == me]
        out.append((d, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def digest_rows(index, df, found):
    done = line_dedup.without(df, line_dedup.dropped(index, found))
    rows = done.select(
        "doc_id", F.size("__lines"), F.coalesce(F.size("__gone"), F.lit(0)), F.sha2(line_dedup.kept_text(), 256)
    ).collect()
    return sorted((tuple(r) for r in rows), key=str)


def random_rows(seed, n=60):
    rng = random.Random(seed)
    pool = [f"{rng.choice(['Line', 'LINE', 'é LINE'])} number {i}" + " " * rng.randrange(3) for i in range(25)]
    pool += ["short", "", "\t pad \v", "\x85unicode edge line", "　unicode edge line", "exactly 10"]
    return [(i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(8)))) for i in range(n)]


@pytest.mark.parametrize("by_shuffle", [False, True])
def test_lines_equal_brute_force(docs, monkeypatch, by_shuffle):
    rows = [*random_rows(1), *((d, t) for d, t, _ in AWKWARD), *random_rows(1, 3)]
    if by_shuffle:
        monkeypatch.setattr(line_dedup, "FILTER_BYTES", -1)
    df = docs([(d, t, "s") for d, t in rows], clash=True)
    found = materialize(line_dedup.lines(df), "lines")
    index = line_dedup.build(found, shard_keys=7)
    assert index.shards > 1
    assert digest_rows(index, df, found) == brute(rows)


def test_insert_and_delete_are_reversible(spark, docs):
    first, second = random_rows(2, 40), [(100 + d, t) for d, t in random_rows(3, 30)]
    frame = lambda rows: docs([(d, t, "s") for d, t in rows])
    a, b = frame(first), frame(second)
    la, lb = (materialize(line_dedup.lines(x), "lines") for x in (a, b))
    index = line_dedup.build(la, shard_keys=5)
    grown = line_dedup.insert(index, lb)
    both, lboth = frame(first + second), materialize(la.unionByName(lb), "lines")
    assert digest_rows(grown, both, lboth) == brute(first + second)
    again = line_dedup.insert(grown, lb)  # known documents change nothing
    assert sorted(map(str, again.refs.collect())) == sorted(map(str, grown.refs.collect()))

    back = line_dedup.delete(grown, b)
    assert sorted(map(str, back.refs.collect())) == sorted(map(str, index.refs.collect()))
    assert digest_rows(back, a, la) == brute(first)
    # The owners of shared lines go: the lines' next holders keep them.
    gone = frame(first[:20])
    rest, lrest = frame(first[20:]), line_dedup.lines(frame(first[20:]))
    assert digest_rows(line_dedup.delete(index, gone), rest, lrest) == brute(first[20:])


def test_filters_hold_what_the_counts_say(docs):
    df = docs([(d, t, "s") for d, t in random_rows(4)])
    index = line_dedup.build(materialize(line_dedup.lines(df), "lines"), shard_keys=5)
    held = {r["shard"]: CuckooFilter.load(bytes(r["filter"])) for r in index.filters.collect()}
    twice = index.refs.filter("n_docs >= 2").select(
        line_dedup._shard(index.shards).alias("s"), F.xxhash64("digest").alias("h")
    ).collect()
    assert twice and all(held[r["s"]].contains(np.array([r["h"]]))[0] for r in twice)
    assert sum(int((f.table > 0).sum()) for f in held.values()) == len(twice)


def test_stage_keeps_columns_and_stands_emptiness(spark, docs, awkward):
    out = line_dedup.line_stage(spark, awkward, "")
    assert out.columns == awkward.columns and out.count() == len(AWKWARD)
    for r in out.collect():
        assert r["n_chars"] == (None if r["text"] is None else len(r["text"]))
    assert line_dedup.line_stage(spark, docs([]), "").collect() == []


def test_cuckoo_filter():
    rng = np.random.default_rng(1)
    keys = rng.integers(-(2**63), 2**63 - 1, 20_000)
    f = built(keys[:10_000])
    assert f.contains(keys[:10_000]).all()
    assert f.contains(keys[10_000:]).mean() < 0.01
    f = CuckooFilter.load(f.dump())
    f.remove(keys[:5_000])
    assert f.contains(keys[5_000:10_000]).all()
    assert f.contains(keys[:5_000]).mean() < 0.01
    small = CuckooFilter.sized(1)
    assert not small.insert(keys[:200])  # full: the caller builds it anew


@pytest.mark.parametrize("by_shuffle", [False, True])
def test_query_on_the_given_table(spark, monkeypatch, by_shuffle):
    if by_shuffle:
        monkeypatch.setattr(line_dedup, "FILTER_BYTES", -1)
    sf_dir = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = [tuple(r) for r in line_dedup.op7_line_dedup(spark, sf_dir).select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect()]
    assert sorted(got, key=str) == brute(rows)
