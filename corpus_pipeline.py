"""A corpus pipeline: each stage works on what the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from folkmeter.llm import common, stages

STAGES = [
    ("quality", stages.quality),
    ("near_duplicates", stages.near_duplicates_stage),
    ("repeated_passages", stages.repeated_passages),
    ("benchmark_passages", stages.benchmark_passages),
    ("tokens", stages.tokens),
]

#: Learned scores, sketches and merges cannot be said in SQL; the tests hold each stage against
#: a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over ``documents``, each stored and read again."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
