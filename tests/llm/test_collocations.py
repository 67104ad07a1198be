"""Collocations against a plain count of all phrases."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from derrick.llm import collocations as co
from llm_rows import AWKWARD

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, longest=3, least=10, top=2000):
    """rows: (lang, text)."""
    counts, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            words = re.findall(r"[^ \t]+", piece)
            n[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    counts[lang][tuple(words[i : i + size])] += 1
    out = []
    for lang, f in counts.items():
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in cand.items():
            inside = any(
                len(q) > len(p) and 100 * b >= 50 * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, b in cand.items()
            )
            if not inside:
                score, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def made(seed, n=150):
    rng = random.Random(seed)
    words = ["a", "b", "c", "DE", "é", "\x85", "x\x1cy", "\U0001f600", "fg"]
    ends = [" ", " ", " ", " ", "\t", "  ", ". ", ",", "\n", "\r", ";", " ! "]
    return [
        (rng.choice(["en", "en", "en", "fr", None, "und"]), "".join(rng.choice(words[: rng.choice([3, 9])]) + rng.choice(ends) for _ in range(rng.randrange(60))))
        for _ in range(n)
    ]


def answer(df):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


@pytest.mark.parametrize(("held", "hot", "top"), [(co.TOKENS, co.HOT, 2000), (40, 10**9, 7), (300, 1, 25)])
def test_equal_to_plain_counts(spark, monkeypatch, held, hot, top):
    """Small stripes, slots for all prefixes and for none, short lists."""
    monkeypatch.setattr(co, "HOT", hot)
    monkeypatch.setattr(co, "SALTS", 3)
    rows = made(1) + [(None if s is None else s, t) for _, t, s in AWKWARD]
    docs = co.spoken(spark.createDataFrame(rows, "lang string, text string").repartition(5))
    assert answer(co.collocations(docs, top=top, tokens_held=held)) == brute(rows, top=top)


@pytest.mark.parametrize("longest", [2, 4])
def test_other_lengths(spark, longest):
    rows = made(2, 120)
    docs = co.spoken(spark.createDataFrame(rows, "lang string, text string"))
    assert answer(co.collocations(docs, longest, least=6)) == brute(rows, longest, least=6)


def test_a_full_bitmap_changes_nothing(spark, monkeypatch):
    rows = made(3, 60)
    docs = co.spoken(spark.createDataFrame(rows, "lang string, text string"))
    monkeypatch.setattr(co, "_bitmap", lambda level: np.full(co.BITS // 8, 255, dtype=np.uint8))
    assert answer(co.collocations(docs)) == brute(rows)


def test_query_with_clashing_columns_and_empty_table(spark, tmp_path, awkward):
    df = awkward.withColumn("phrase", F.lit("x")).withColumn("next", F.lit(1)).withColumn("total", F.lit(2)).withColumn("slot", F.lit(0))
    df.write.parquet(f"{tmp_path}/some/documents.parquet")
    rows = [("en", t) for _, t, _ in AWKWARD]
    assert answer(co.op13_collocations(spark, f"{tmp_path}/some")) == brute(rows)
    df.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert co.op13_collocations(spark, f"{tmp_path}/none").collect() == []


def test_scores_beyond_64_bits(spark):
    a, left, right = 10**13 + 7, 3 * 10**13 + 1, 2 * 10**13 + 3
    score = spark.range(1).select(co._score(F.lit(a), F.lit(left), F.lit(right))).first()[0]
    assert score == 10**6 * a * a // (left * right)
