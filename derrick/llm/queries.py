"""The queries of this package and, where SQL can say the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from derrick.llm import (
    brown_lm,
    collocations,
    conversation_repair,
    decontaminate,
    html_mincut,
    jaccard_metric,
    line_dedup,
    mix_curriculum,
    quality_hosts,
    secret_cnn,
    shard_packing,
    token_spans,
    toxicity_mil,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_cnn": secret_cnn.op1_secret_cnn,
    "op2_mix_curriculum": mix_curriculum.op2_mix_curriculum,
    "op3_quality_hosts": quality_hosts.op3_quality_hosts,
    "op4_decontaminate": decontaminate.op4_decontaminate,
    "op5_token_spans": token_spans.op5_token_spans,
    "op6_jaccard_metric": jaccard_metric.op6_jaccard_metric,
    "op7_line_dedup": line_dedup.op7_line_dedup,
    "op8_html_mincut": html_mincut.op8_html_mincut,
    "op9_toxicity_mil": toxicity_mil.op9_toxicity_mil,
    "op10_brown_lm": brown_lm.op10_brown_lm,
    "op11_shard_packing": shard_packing.op11_shard_packing,
    "op12_conversation_repair": conversation_repair.op12_conversation_repair,
    "op13_collocations": collocations.op13_collocations,
}
SQL: dict[str, str] = {
    "op2_mix_curriculum": mix_curriculum.SQL,
    "op3_quality_hosts": quality_hosts.SQL,
    "op4_decontaminate": decontaminate.SQL,
    "op7_line_dedup": line_dedup.SQL,
    "op13_collocations": collocations.SQL,
}
