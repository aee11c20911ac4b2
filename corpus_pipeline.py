"""From raw documents to packed sequences: the training-data operators in a row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pathkin.llm import neardup, packing, quality, secrets, toxicity
from pathkin.session import scratch_path

STAGES = [
    ("quality", quality.stage),
    ("toxicity", toxicity.stage),
    ("neardup", neardup.stage),
    ("secrets", secrets.stage),
    ("packing", packing.stage),
]

# Model scores and packing can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
