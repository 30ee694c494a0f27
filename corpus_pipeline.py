"""The training-corpus pipeline: each stage works on all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import stages
from quarry.llm.blocks import scratch

STAGES = [
    ("language", stages.language),                # 3
    ("line_dedup", stages.lines),                 # 9
    ("near_duplicates", stages.near_duplicates),  # 4
    ("decontamination", stages.decontamination),  # 6
    ("bpe", stages.encoding),                     # 8
]

#: SQL can't express the centroids, the alignment or the merge replay; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
