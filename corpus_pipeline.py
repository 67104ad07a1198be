"""The corpus pipeline: five stages from raw documents to the training mix.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps, all but the
last with the columns they came with; ``run`` writes each stage's rows to the shared
folder and hands the written table on. The stages:

1. quality rules: documents that fail the base rules, or a rule their host is convicted
   of, go;
2. line dedup: lines that an earlier document holds go, from every document;
3. n-gram Jaccard join: of each group of near duplicates (five words, 0.8) the document
   with the smallest id stays;
4. benchmark decontamination: contaminated documents go;
5. mixing: the documents that the target weights take, in training order.

Empty tables, null texts and repeated rows have the results that the operators state.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from derrick.llm.common import documents
from derrick.llm.decontaminate import decontaminate_stage
from derrick.llm.jaccard_metric import near_duplicate_stage
from derrick.llm.line_dedup import line_stage
from derrick.llm.mix_curriculum import mix_stage
from derrick.llm.pipeline_sql import PIPELINE_SQL
from derrick.llm.quality_hosts import quality_stage
from derrick.sources.scratch import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("benchmark decontamination", decontaminate_stage),
    ("mixing sources to target weights", mix_stage),
]

ORACLE_SQL: str | None = PIPELINE_SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
