"""op6: all documents with surrogates for personal data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskloom.llm.common import table
from riskloom.llm.surrogates import replace_entities

# The key of the test data; a real one is a secret of the deployment.
KEY = "surrogate-key-1"


def op6_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    replaced = replace_entities(table(spark, sf_dir, "documents"), KEY)
    return replaced.select("doc_id", "text", "n_entities", "entities")


QUERIES = {"op6_surrogates": op6_surrogates}
ORACLE: dict[str, str] = {}
