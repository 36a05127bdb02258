"""The corpus pipeline: quality rules, near-dedup, substring dedup, mixing and packing, one after another."""

from tidemark.llm import stages

STAGES = stages.STAGES
ORACLE_SQL = None


def run(spark, sf_dir):
    """Apply the stages to `documents`; each stage's result is written as Parquet and read again by the next."""
    return stages.run(spark, sf_dir, STAGES)
