"""The corpus pipeline: quality rules, near-duplicate groups, decontamination, mixing to target weights, token records.

Each stage works on all rows that the one before kept. All but the last return the columns of documents; the last
returns doc_id, start, n_tokens and ids_crc32, read back from the record files.

Null and empty texts have no words, so the first stage rejects them; a stage that is given them treats them as empty. Rows
without doc_id are copies of nothing and hold no item; the mixture draws them together. Of rows that share a doc_id the
second stage keeps one. Empty tables give empty results; other columns pass through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from foldlake.llm import common, decontaminate, jaccard_join, mixing_rates, quality, token_records

#: Near duplicates share five-word shingles with a Jaccard similarity of 80 percent or more.
SHINGLE, PERCENT = 5, 80


def _stage(make: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """make, whose jobs leave short plans with the driver and start from a heap without what earlier stages left."""

    @wraps(make)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        common.spare_driver(spark)
        with common.short_plans(spark):
            return make(spark, docs, sf_dir)

    return run_stage


@_stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents by the base rules and by their distance from language references."""
    return quality.keep_good(docs, common.table(spark, sf_dir, "labels"))


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each group of near duplicates."""
    return jaccard_join.keep_one(docs, SHINGLE, PERCENT)


@_stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that hold a benchmark item, also with other numbers or names."""
    return decontaminate.drop_contaminated(docs, common.table(spark, sf_dir, "benchmark"))


@_stage
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draws documents at the rates whose expected domain totals match the target weights."""
    return mixing_rates.sample(docs, common.table(spark, sf_dir, "labels"))


@_stage
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the token ids as binary records and reads them back."""
    out = common.work_path(spark, "pipeline-tokens")
    return token_records.summarize(spark, token_records.write(docs, out, token_records.default_tokenizer()))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("tokens", tokens),
]

#: The classifier of the mixing stage and the tokenizer have no SQL form; tests/llm/test_pipeline.py compares each stage
#: with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again as the input of the next."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
