"""op7: fingerprints of all documents and their near-duplicate groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import table
from riskloom.llm.simhash import near_duplicates


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return groups.select("doc_id", digits.alias("fingerprint"), "component_id")


QUERIES = {"op7_simhash": op7_simhash}
ORACLE: dict[str, str] = {}
