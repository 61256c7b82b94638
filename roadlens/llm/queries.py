"""The training-data queries: one thin query per operator, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from roadlens.llm import decontamination, filter_audit, lm_scoring, packing, quality_rules, sharding, simhash_dedup, source_divergence, suffix_dedup, token_counts, token_files, toxicity, url_filters
from roadlens.llm.common import table


@dataclass
class LlmQuery:
    build: Callable[[SparkSession, str], DataFrame]
    oracle: str | None = None


QUERIES: dict[str, LlmQuery] = {
    "op1_quality_rules": LlmQuery(
        lambda spark, d: quality_rules.op1_query(table(spark, d, "documents")), quality_rules.ORACLE),
    "op2_lm_scoring": LlmQuery(lambda spark, d: lm_scoring.op2_query(table(spark, d, "documents"))),
    "op3_sharding": LlmQuery(lambda spark, d: sharding.op3_query(table(spark, d, "documents"))),
    "op4_simhash_dedup": LlmQuery(lambda spark, d: simhash_dedup.op4_query(table(spark, d, "documents"))),
    "op5_packing": LlmQuery(lambda spark, d: packing.op5_query(table(spark, d, "documents"))),
    "op6_decontamination": LlmQuery(
        lambda spark, d: decontamination.op6_query(table(spark, d, "documents"), table(spark, d, "benchmark"))),
    "op7_token_counts": LlmQuery(lambda spark, d: token_counts.op7_query(table(spark, d, "documents"))),
    "op9_token_files": LlmQuery(lambda spark, d: token_files.op9_query(table(spark, d, "documents"))),
    "op8_url_filters": LlmQuery(
        lambda spark, d: url_filters.op8_query(table(spark, d, "pages")), url_filters.ORACLE),
    "op10_suffix_dedup": LlmQuery(lambda spark, d: suffix_dedup.op10_query(table(spark, d, "documents"))),
    "op11_source_divergence": LlmQuery(
        lambda spark, d: source_divergence.op11_query(table(spark, d, "documents")), source_divergence.ORACLE),
    "op12_toxicity": LlmQuery(
        lambda spark, d: toxicity.op12_query(table(spark, d, "documents"), table(spark, d, "labels"))),
    "op13_filter_audit": LlmQuery(
        lambda spark, d: filter_audit.op13_query(table(spark, d, "documents"), table(spark, d, "labels")), filter_audit.ORACLE),
    "pipeline": LlmQuery(corpus_pipeline.run, corpus_pipeline.ORACLE_SQL),
}
