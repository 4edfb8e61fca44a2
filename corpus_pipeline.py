"""The corpus pipeline: documents through five filters, each stage written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemill.llm import stages
from tidemill.llm.tables import read, stage
from tidemill.session import prepare

STAGES = [
    ("language_id", stages.language_id),
    ("near_dedup", stages.near_dedup),
    ("substring_dedup", stages.substring_dedup),
    ("decontamination", stages.decontamination),
    ("mixing", stages.mixing),
]

#: Trained classifiers and signatures are not expressible in SQL; the tests compare stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; every stage reads what its predecessor wrote."""
    docs = read(prepare(spark), sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
