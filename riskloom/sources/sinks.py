"""Writers: overwrite, append, keyed upsert, retention and layout."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.sources.tables import PARTITION_DATE

# Compression of every table the jobs write.
CODEC = "zstd"
# Partition of the runs in a metric history.
RUN = "run"
# Size that the files of a laid out table aim at.
FILE_BYTES = 256 << 20


def with_partition_date(df: DataFrame, column: str = "prediction_timestamp") -> DataFrame:
    return df.withColumn(PARTITION_DATE, F.to_date(column))


def write_overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Replace a table including its schema, then read it back.

    With partition columns the rows are rebalanced by them first: adaptive
    execution merges small partition values into one task and splits a dominant
    one over several, by size at run time.
    """
    writer_input = df.hint("rebalance", *partition_by) if partition_by else df
    writer = writer_input.write.mode("overwrite").option("compression", CODEC)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)


def append_metric_history(df: DataFrame, path: str, run: str | None = None) -> DataFrame:
    """Add the rows of one or more runs and return the whole history.

    ``run`` names the column that tells runs apart.  Runs are then partitions, and a
    repeated run replaces its own rows; without it rows are appended as they are.
    """
    if run is None:
        df.write.mode("append").option("compression", CODEC).parquet(path)
        return df.sparkSession.read.parquet(path)
    stamped = df.withColumn(RUN, F.date_format(F.col(run).cast("timestamp_ntz"), "yyyy-MM-dd'T'HH-mm-ss"))
    (
        stamped.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", CODEC)
        .partitionBy(RUN)
        .parquet(path)
    )
    return df.sparkSession.read.parquet(path).drop(RUN)


def replace_run(df: DataFrame, path: str, moment: datetime) -> DataFrame:
    """Add the rows of one run and return the whole history.

    Runs are partitions by their moment, so a repeated run replaces itself.
    """
    marked = df.withColumn("_moment", F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz"))
    return append_metric_history(marked, path, "_moment").drop("_moment")


def folder(spark: SparkSession, path: str):
    """The folder's file system and its path there."""
    jvm = spark._jvm.org.apache.hadoop.fs
    place = jvm.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place, jvm.Path


def drop_partitions(
    spark: SparkSession, path: str, column: str, drop: Callable[[str], bool]
) -> list[str]:
    """Delete the partitions of a table whose value ``drop`` picks; returns the values."""
    files, place, _ = folder(spark, path)
    dropped = []
    if not files.exists(place):
        return dropped
    for entry in files.listStatus(place):
        name, _, value = entry.getPath().getName().partition("=")
        if name == column and drop(value):
            files.delete(entry.getPath(), True)
            dropped.append(value)
    return sorted(dropped)


def drop_expired(
    spark: SparkSession, path: str, as_of: datetime, days: int, column: str = PARTITION_DATE
) -> list[str]:
    """Retention: delete the day partitions older than ``days`` before ``as_of``."""
    oldest = f"{as_of - timedelta(days=days):%Y-%m-%d}"
    return drop_partitions(spark, path, column, lambda day: day[:10] < oldest)


def swap(spark: SparkSession, staged: str, path: str) -> None:
    """Put a written folder in the place of a table."""
    files, place, make = folder(spark, path)
    old = make(f"{path}-old-{uuid.uuid4().hex}")
    present = files.exists(place)
    if present and not files.rename(place, old):
        raise OSError(f"{path} cannot be moved")
    if not files.rename(make(staged), place):
        raise OSError(f"{staged} cannot be moved to {path}")
    if present:
        files.delete(old, True)


def upsert_table(
    spark: SparkSession, path: str, df: DataFrame, keys: Sequence[str], replace: bool = False
) -> DataFrame:
    """Merge rows by key into a stored table, which is created if it is absent.

    The new state is written beside the table and then takes its place, so the
    table that is read is never the one that is written.
    """
    files, place, _ = folder(spark, path)
    target = spark.read.parquet(path) if files.exists(place) else None
    staged = f"{path}-new-{uuid.uuid4().hex}"
    merged = feature_table_upsert(target, df, keys, replace)
    merged.write.option("compression", CODEC).parquet(staged)
    swap(spark, staged, path)
    return spark.read.parquet(path)


def merge_by_key(target: DataFrame | None, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``changes`` plus the rows of ``target`` whose key is not in it."""
    if target is None:
        return changes
    kept = target.join(changes.select(*keys), list(keys), "left_anti")
    return kept.unionByName(changes, allowMissingColumns=True)


def feature_table_upsert(
    target: DataFrame | None, df: DataFrame, keys: Sequence[str], replace: bool = False
) -> DataFrame:
    """Contents of a keyed feature table after a write.

    ``replace=True`` clears the table first, which is how the nightly feature
    job refreshes it; otherwise rows are merged by key.
    """
    return df if replace else merge_by_key(target, df, keys)


def incremental_changes(
    previous: DataFrame, current: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Keys inserted, updated or deleted between two states of a table."""
    values = [c for c in current.columns if c not in keys]
    old = previous.select(*keys, F.struct(*values).alias("_old"))
    new = current.select(*keys, F.struct(*values).alias("_new"))
    joined = old.alias("o").join(new.alias("n"), same_keys_alias(keys), "full")
    change = (
        F.when(F.col("_old").isNull(), "insert")
        .when(F.col("_new").isNull(), "delete")
        .when(~F.col("_old").eqNullSafe(F.col("_new")), "update")
    )
    return joined.select(
        *[F.coalesce(F.col(f"n.{k}"), F.col(f"o.{k}")).alias(k) for k in keys],
        change.alias("change_type"),
    ).where(F.col("change_type").isNotNull())


def same_keys_alias(keys: Sequence[str]):
    return reduce(lambda a, b: a & b, [F.col(f"o.{k}") == F.col(f"n.{k}") for k in keys])


def table_layout(df: DataFrame, path: str, column: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Rewrite a table range-partitioned and sorted by ``column``.

    Each file then covers a narrow range, so readers skip files by the
    min/max values in their footers.  The rows are stored as they come first, and
    the number of files follows the size that they took; the planner's estimate of
    a join is the product of its inputs.
    """
    spark = df.sparkSession
    staged = f"{path}-new-{uuid.uuid4().hex}"
    df.write.option("compression", CODEC).parquet(staged)
    files, place, _ = folder(spark, staged)
    size = files.getContentSummary(place).getLength()
    rows = spark.read.schema(df.schema).parquet(staged)
    (
        rows.repartitionByRange(max(1, -(-size // file_bytes)), column)
        .sortWithinPartitions(column)
        .write.mode("overwrite")
        .option("compression", CODEC)
        .parquet(path)
    )
    files.delete(place, True)
    return spark.read.parquet(path)


def analyze_table(spark: SparkSession, name: str, columns: Sequence[str] = ()) -> None:
    """Collect table (and column) statistics for the cost-based optimiser."""
    suffix = f" FOR COLUMNS {', '.join(columns)}" if columns else ""
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS{suffix}")


__all__ = [
    "CODEC",
    "analyze_table",
    "append_metric_history",
    "drop_expired",
    "drop_partitions",
    "feature_table_upsert",
    "folder",
    "incremental_changes",
    "merge_by_key",
    "replace_run",
    "swap",
    "table_layout",
    "upsert_table",
    "with_partition_date",
    "write_overwrite",
]
