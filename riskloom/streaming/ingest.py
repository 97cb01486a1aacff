"""File streams, bronze ingest and the runner all streaming jobs use."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

FILE_COLUMNS = {
    "_file_name": "file_name",
    "_file_path": "file_path",
    "_file_size": "file_size",
    "_file_modification_time": "file_modification_time",
}


def file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    max_files_per_trigger: int | None = None,
    names: str | None = None,
) -> DataFrame:
    """Parquet files of a folder as they arrive; the schema is given, never inferred.

    ``names`` is a pattern for file names, for folders that hold several tables.
    """
    reader = spark.readStream.schema(schema)
    if names:
        reader = reader.option("pathGlobFilter", names)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def stream_ingest_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    names: str | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Rows with the name, path, size and time of their file and the ingest time."""
    rows = file_stream(spark, path, schema, max_files_per_trigger, names)
    meta = [F.col(f"_metadata.{source}").alias(name) for name, source in FILE_COLUMNS.items()]
    return rows.select("*", *meta).withColumn("_ingested_at", F.current_timestamp())


def run_available(
    stream: DataFrame,
    checkpoint: str,
    path: str | None = None,
    mode: str = "append",
    each_batch: Callable[[DataFrame, int], None] | None = None,
    partition_by: tuple[str, ...] = (),
) -> StreamingQuery:
    """Process everything available, then stop.  Restart with the same checkpoint
    to continue where the last run ended."""
    writer = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if each_batch is not None:
        query = writer.foreachBatch(each_batch).start()
    else:
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        query = writer.format("parquet").option("path", path).start()
    query.awaitTermination()
    return query


def stream_bronze(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    names: str | None = None,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Append new files to the bronze table exactly once, a backlog in several batches
    if ``max_files_per_trigger`` is given."""
    rows = stream_ingest_files(spark, source, schema, names, max_files_per_trigger)
    return run_available(rows, checkpoint, target)
