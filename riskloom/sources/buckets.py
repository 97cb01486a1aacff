"""Keyed tables in buckets by a hash of the key.

An upsert rewrites only the buckets that hold changed keys.  Digests per bucket are kept
beside the table; two states of a table are compared row by row only in the buckets whose
digests differ.

Keys are unique in a table, so buckets are about equal, whatever the data; changes have one
row per key.  Null is a key value like others.  Columns of a map type cannot be hashed.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.session import work_dir
from riskloom.sources.sinks import CODEC, folder, incremental_changes

BUCKET = "key_bucket"
BUCKETS = 64
SUMS = f"{BUCKET} int, buckets int, row_count long, first_sum decimal(38,0), second_sum decimal(38,0)"


def with_bucket(df: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def digests(rows: DataFrame, buckets: int) -> DataFrame:
    """Per bucket the number of rows and two sums of row hashes, whatever the order of
    rows and columns.  Marks of nulls are hashed too, as a hash passes over nulls."""
    values = sorted(c for c in rows.columns if c != BUCKET)
    parts = [part for c in values for part in (F.isnull(c), F.col(c))]
    sums = [F.sum(F.xxhash64(F.lit(k), *parts).cast("decimal(20,0)")).cast("decimal(38,0)") for k in (1, 2)]
    return rows.groupBy(BUCKET).agg(
        F.lit(buckets).alias("buckets"), F.count(F.lit(1)).alias("row_count"),
        sums[0].alias("first_sum"), sums[1].alias("second_sum"),
    )


def _replace(rows: DataFrame, path: str, whole: bool) -> None:
    """Writes the buckets that ``rows`` has; ``whole`` drops all others."""
    (
        rows.hint("rebalance", BUCKET).write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if whole else "dynamic")
        .option("compression", CODEC)
        .partitionBy(BUCKET)
        .parquet(path)
    )


def _exists(spark: SparkSession, path: str) -> bool:
    files, place, _ = folder(spark, path)
    return files.exists(place)


def _delete(spark: SparkSession, path: str) -> None:
    files, place, _ = folder(spark, path)
    files.delete(place, True)


def _stored_buckets(spark: SparkSession, path: str) -> int | None:
    """The number of buckets that a table was made with; None if it has no rows."""
    if not _exists(spark, f"{path}-sums"):
        return None
    first = sums_of(spark, path).select("buckets").first()
    return first and first.buckets


def sums_of(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SUMS).parquet(f"{path}-sums")


def read_table(spark: SparkSession, path: str, schema: T.StructType, only: Sequence[int] | None = None) -> DataFrame:
    """The table, or some of its buckets; others are not opened."""
    fields = [f for f in schema.fields if f.name != BUCKET]
    rows = spark.read.schema(T.StructType([*fields, T.StructField(BUCKET, T.IntegerType())])).parquet(path)
    if only is not None:
        rows = rows.where(F.col(BUCKET).isin(list(only)))
    return rows.drop(BUCKET)


def write_table(df: DataFrame, path: str, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """Replaces a table and its digests."""
    spark = df.sparkSession
    # Changes that are not yet applied belong to the state that is replaced.
    _delete(spark, f"{path}-pending")
    _replace(with_bucket(df, keys, buckets), path, whole=True)
    rows = with_bucket(read_table(spark, path, df.schema), keys, buckets)
    _replace(digests(rows, buckets), f"{path}-sums", whole=True)
    return read_table(spark, path, df.schema)


def finish(spark: SparkSession, path: str) -> None:
    """Applies a completely written set of new buckets.  It is deleted only when the table
    and its digests have it, so a run that was broken off is finished by the next one."""
    pending = f"{path}-pending"
    if not _exists(spark, f"{pending}/_SUCCESS"):
        return
    rows = spark.read.parquet(pending)
    _replace(rows, path, whole=False)
    _replace(digests(rows, _stored_buckets(spark, path)), f"{path}-sums", whole=False)
    _delete(spark, pending)


def upsert(df: DataFrame, path: str, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """Merges rows by key into a table, which is created if it is absent.

    Reads and rewrites the buckets of the changed keys; all of them if the changes bring
    new columns.  Columns that the changes lack are null in changed rows.  A repeated
    upsert changes nothing.  A table keeps the number of buckets it was made with.
    """
    spark = df.sparkSession
    finish(spark, path)
    stored = _stored_buckets(spark, path)
    if stored is None:
        return write_table(df, path, keys, buckets)
    # Written once, as the changes are read for their buckets, their keys and their rows.
    place = work_dir(spark, "changes")
    with_bucket(df, keys, stored).write.parquet(place)
    changes = spark.read.parquet(place)
    touched = sorted(r[0] for r in changes.select(BUCKET).distinct().collect())
    table = spark.read.parquet(path)
    if touched:
        widened = set(changes.columns) - set(table.columns)
        old = table if widened else table.where(F.col(BUCKET).isin(touched))
        same = reduce(lambda a, b: a & b, [F.col(f"o.`{k}`").eqNullSafe(F.col(f"n.`{k}`")) for k in (BUCKET, *keys)])
        kept = old.alias("o").join(changes.select(BUCKET, *keys).alias("n"), same, "left_anti")
        _replace(kept.unionByName(changes, allowMissingColumns=True), f"{path}-pending", whole=True)
        schema = spark.read.parquet(f"{path}-pending").schema
        finish(spark, path)
    else:
        schema = table.schema
    return read_table(spark, path, schema)


def differing_buckets(spark: SparkSession, before: str, after: str) -> list[int]:
    """The buckets whose digests differ between two tables; a number per bucket at most."""
    numbers = {_stored_buckets(spark, p) for p in (before, after)} - {None}
    if len(numbers) > 1:
        raise ValueError("the tables have different numbers of buckets")
    old, new = sums_of(spark, before).alias("o"), sums_of(spark, after).alias("n")
    equal = reduce(
        lambda a, b: a & b,
        [F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}")) for c in ("row_count", "first_sum", "second_sum")],
    )
    found = old.join(new, F.col(f"o.{BUCKET}") == F.col(f"n.{BUCKET}"), "full").where(~equal)
    return sorted(r[0] for r in found.select(F.coalesce(f"o.{BUCKET}", f"n.{BUCKET}")).collect())


def state_changes(
    spark: SparkSession, before: str, after: str, keys: Sequence[str], schema: T.StructType
) -> DataFrame:
    """Keys inserted, updated or deleted between two stored states of a table.  Buckets
    with equal digests are not read."""
    differ = differing_buckets(spark, before, after)
    return incremental_changes(
        read_table(spark, before, schema, differ), read_table(spark, after, schema, differ), keys
    )


__all__ = [
    "BUCKET",
    "differing_buckets",
    "digests",
    "finish",
    "read_table",
    "state_changes",
    "upsert",
    "with_bucket",
    "write_table",
]
