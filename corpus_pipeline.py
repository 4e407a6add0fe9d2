"""The corpus pipeline: five operators, each on all that the one before it kept.

Every stage but the last returns the columns of ``documents``. ``run`` writes the result
of each stage to the shared folder and reads it back as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from sightline.llm import decontam, mixing, rules, simhash, toxicity
from sightline.llm.common import table
from sightline.session import small_batches, stage


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic."""
    small_batches(spark)
    return toxicity.accepted(docs, table(spark, sf_dir, "labels"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the certified cutoffs keep."""
    small_batches(spark)
    return rules.accepted(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id."""
    small_batches(spark)
    return simhash.keep_one(docs, shingle=3, max_bits=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of words with a benchmark item."""
    small_batches(spark)
    return decontam.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's share of the mix and its place in it."""
    small_batches(spark)
    return mixing.mix(docs)


STAGES = [
    ("toxicity", toxic),
    ("quality_rules", quality_rules),
    ("simhash", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixture),
]

#: Learned weights decide the first stage, so no SQL gives run()'s rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, applied to the table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
