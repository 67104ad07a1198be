"""Stages keep documents' columns of any name, those used inside included."""

from __future__ import annotations

import ast
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import derrick.llm
from derrick.llm import decontaminate, jaccard_metric, line_dedup, mix_curriculum, quality_hosts

HERE = Path(derrick.llm.__file__).parent


def inner_names(*modules):
    """Every word that the modules use as a text, so every column name among them."""
    out = set()
    for module in modules:
        for node in ast.walk(ast.parse((HERE / f"{module}.py").read_text())):
            if isinstance(node, ast.Constant) and isinstance(node.value, str) and re.fullmatch(r"\w{1,20}", node.value):
                out.add(node.value.lower())
    return sorted(out - {"doc_id", "text", "lang", "source", "n_chars", "item_id"})


STAGES = {
    "quality": (quality_hosts.quality_stage, ("quality_hosts", "common")),
    "lines": (line_dedup.line_stage, ("line_dedup", "common")),
    "near": (jaccard_metric.near_duplicate_stage, ("jaccard_metric", "components", "common")),
    "benchmark": (decontaminate.decontaminate_stage, ("decontaminate", "common")),
    "mix": (mix_curriculum.mix_stage, ("mix_curriculum", "common")),
}


@pytest.mark.parametrize("name", STAGES)
def test_columns_named_like_inner_ones(spark, docs, tmp_path, name):
    stage, modules = STAGES[name]
    rows = [(i, f"document {i} " + " ".join(f"w{i * 7 + k}" for k in range(30)) + "\na line that all documents share", "s") for i in range(6)]
    names = inner_names(*modules)
    assert len(names) > 5
    df = docs(rows)
    df = df.select("*", *(F.concat(F.lit(f"{c} "), F.col("doc_id").cast("string")).alias(c) for c in names))
    spark.createDataFrame([(1, "some words that no document holds at all")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    plain = {r["doc_id"]: r["text"] for r in stage(spark, docs(rows), str(tmp_path)).collect()}
    got = stage(spark, df, str(tmp_path))
    found = got.collect()
    assert {r["doc_id"]: r["text"] for r in found} == plain and plain
    for r in found:
        for c in names:
            kept = f"doc_{c}" if name == "mix" and c in mix_curriculum._PLAN else c
            assert r[kept] == f"{c} {r['doc_id']}"
