"""A training corpus from documents: quality, near-duplicates, repeated passages, packing."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from murmura.llm import stages

STAGES = stages.STAGES

#: The classifier and the packing have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    return stages.run(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), sf_dir)
