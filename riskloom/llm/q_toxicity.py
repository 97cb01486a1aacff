"""op1: toxicity of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import table
from riskloom.llm.toxicity import score_documents


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.withColumn("n_passages", F.size("passages")).select(
        "doc_id", "held_out", "score", "predicted", "n_tokens", "n_passages", "passages"
    )


QUERIES = {"op1_toxicity": op1_toxicity}
ORACLE: dict[str, str] = {}
