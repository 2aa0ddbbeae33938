"""Corpus pipeline: quality rules, near-duplicates, repeated spans, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``documents``. ``run`` writes each stage's result as
Parquet in the shared folder and reads it back as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ordwise.llm import minhash_forest, mixing, packing, quality_rules, suffix_dedup
from ordwise.llm.store import read, saved, ship


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    ship(spark)
    return quality_rules.apply_rules(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    ship(spark)
    return minhash_forest.dedup(docs)


def repeated_span_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans that also start earlier are cut from the texts."""
    ship(spark)
    return suffix_dedup.apply_dedup(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    ship(spark)
    return mixing.apply_mix(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequence and offset."""
    import public_tokenizers

    ship(spark)
    return packing.pack(docs, public_tokenizers.path(packing.TOKENIZER))


STAGES = [
    ("quality_rules", quality_stage),
    ("minhash_near_dedup", near_duplicate_stage),
    ("suffix_dedup", repeated_span_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

# The signatures, the knapsack and the packing plan have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
