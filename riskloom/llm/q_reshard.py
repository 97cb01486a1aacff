"""op3: all documents from the files they are in to eight shards of equal bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.reshard import LAW, reshard, row_size
from riskloom.session import work_dir

SHARDS = 8


def op3_reshard(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = work_dir(spark, "shards")
    moved = reshard(spark, f"{sf_dir}/documents.parquet", out, SHARDS)
    return moved.select(
        "doc_id",
        row_size().alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.lit(LAW).alias("law"),
        F.col("shard").cast("int").alias("shard"),
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


QUERIES = {"op3_reshard": op3_reshard}
ORACLE: dict[str, str] = {}
