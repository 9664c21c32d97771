"""Corpus pipeline: raw documents to packed training sequences, five operators of ``holdfast.llm`` in turn.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
stage's documents. All but the last keep the columns of ``documents``.

1. quality_rules: failing lines go; documents that fail the base rule or lose too much text go.
2. line_dedup: of similar lines across all documents the first stays; documents without a line left go.
3. ngram_jaccard_join: of each class of similar documents the one with the smallest doc_id stays.
4. benchmark_decontamination: documents that hold a benchmark item, also re-parameterised, go.
5. best_fit_packing: token sequences of at most 2048.

The pipeline has no SQL form, because its tokenizer has none; the tests hold it against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from holdfast.llm import line_dedup, line_rules, ngram_join, packing, templates
from holdfast.llm.common import stored, table

ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_rules.cleaned(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.deduplicated(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.firsts(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return templates.clean(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result is the packed pieces."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
