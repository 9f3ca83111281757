"""The corpus pipeline: toxicity, language, near-duplicates, packing.

Each stage gets what its predecessor kept, written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillwork.llm import jaccard, language, packing, toxicity
from tillwork.session import scratch_folder

STAGES = [
    ("toxicity", toxicity.drop_toxic),
    ("language", language.drop_unidentified),
    ("near-duplicates", jaccard.keep_one_of_each),
    ("packing", packing.pack_stage),
]

# The models' verdicts can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = scratch_folder(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
