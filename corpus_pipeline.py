"""From raw documents to packed training sequences.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written and read again as the next one's docs.  All but the last return the
columns of ``documents``.

Defined cases (all stages): null and empty texts, repeated rows and ids, null
ids, very long texts, empty tables and further columns, whatever their names,
go through; what becomes of them is said at each stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roadlens.llm.common import stored, table
from roadlens.llm.decontamination import without_contaminated
from roadlens.llm.packing import pack
from roadlens.llm.quality_rules import passing
from roadlens.llm.simhash_dedup import one_of_each
from roadlens.llm.suffix_dedup import without_repeats

#: Passages of more words than this go if they repeat; 51 words of two letters and the spaces between have 152 bytes.
OVER_WORDS = 50
PASSAGE_SPAN = 150
PASSAGE_GRAM = 32


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep; those with null, empty or very short texts go."""
    return passing(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one of the least doc_id (a null one comes last)."""
    return one_of_each(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of over 50 words (or 400 bytes) that repeat; n_chars follows.  A document of
    which no word is left goes."""
    return without_repeats(docs, PASSAGE_SPAN, PASSAGE_GRAM, length_col="n_chars", over_words=OVER_WORDS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence."""
    return pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_dedup", simhash_dedup),
    ("suffix_dedup", suffix_dedup),
    ("decontamination", decontaminate),
    ("packing", packing),
]

#: SQL expresses neither the fingerprints nor the tokens; the tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
