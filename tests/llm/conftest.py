"""Frames that hold what every operator has to stand: missing values, empty and long
texts, ties, repeated rows, and further columns with names used inside."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from llm_rows import AWKWARD  # noqa: E402

CLASHING = (
    "size long, key long, row string, n_words long, n long, kept boolean, position double, "
    "rank long, target double, score double, cls string, component_id long, __row string, "
    "h long, k string, d long, spans string, taken long, doc long, at long"
)


@pytest.fixture(scope="session")
def docs(spark):
    """(doc_id, text, lang, source, n_chars) from (id, text, source) triples; with
    ``clash`` also columns whose names the operators use inside."""

    def make(rows, clash=False):
        full = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows]
        df = spark.createDataFrame(
            full, "doc_id long, text string, lang string, source string, n_chars long"
        ).repartition(3)
        if clash:
            from pyspark.sql import functions as F

            for part in CLASHING.split(", "):
                name, kind = part.split(" ")
                df = df.withColumn(name, F.lit(None).cast(kind))
        return df

    return make


@pytest.fixture(scope="session")
def awkward(docs):
    return docs(AWKWARD, clash=True)
