"""A training corpus out of raw documents: five stages, each a table that the next one reads.

Every stage takes (spark, docs, sf_dir) and gives a table; all but the last give the columns of
documents. What a stage drops is gone for all later ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sheafline.llm import common, decontamination, exact_dedup, packing, set_join, toxicity


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose restored text isn't toxic."""
    return toxicity.without_toxic(docs, common.read(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the one with the largest doc_id."""
    return exact_dedup.deduplicate(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies, the one with the smallest doc_id."""
    return set_join.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no copy of a benchmark item."""
    return decontamination.without_contaminated(docs, common.read(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 ids."""
    return packing.pack(docs, *packing.vocabulary())


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact", exact_stage),
    ("near", near_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: SQL knows no language model, no alignment and no byte-pair encoding; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = common.stage(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
