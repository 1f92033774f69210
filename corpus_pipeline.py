"""A training corpus in five stages: toxic documents go, then exact copies, near copies and
benchmark leaks, and what is left is packed into sequences.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns
a DataFrame; all but the last return the columns of ``docs`` as they came. A stage's result
is written and read back, so a lost executor costs a stage at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerguard.session import written
from llm import exact, near, packing, phrases, toxicity


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go; learned from the labelled rows of ``docs``."""
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def remove_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id stays."""
    return exact.drop_exact(docs)


def remove_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by 80 % of equal five-word shingles, the smallest doc_id stays."""
    return near.drop_near(docs, size=5, share=80)


def remove_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ten consecutive words of a benchmark item go."""
    return phrases.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document in a sequence."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", remove_toxic),
    ("exact dedup", remove_exact),
    ("near dedup", remove_near),
    ("decontamination", remove_leaks),
    ("packing", pack),
]

#: Scores and packing have no SQL form; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
