"""What the text operators share: word rules, stored steps, null-safe joins."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import work_dir

# Words are runs of anything but ASCII white space, in Java's and RE2's syntax.
# ``bytes.split()`` splits by the same characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# The same for bytes.translate.
LOWER_BYTES = bytes.maketrans(UPPER.encode(), LOWER.encode())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: str | None) -> list[bytes]:
    """Words of a text as UTF-8 bytes; none for null."""
    return text.encode("utf-8", "replace").split() if text else []


def ascii_lower(column: Column) -> Column:
    """Lower-cases A-Z only.  ``lower`` does just that to texts without other letters."""
    ascii_only = F.octet_length(column) == F.length(column)
    return F.when(ascii_only, F.lower(column)).otherwise(F.translate(column, UPPER, LOWER))


def let(value: Column, then) -> Column:
    """``then(value)`` with the value made once per row, also where the expression is
    moved into a filter and used inside of other functions."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def number_of(text: Column) -> Column:
    """The first 60 bits of a text's MD5 as a number; other engines can restate it."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def without(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drops columns that a result replaces, whatever their case."""
    taken = {n.lower() for n in names}
    return df.select(*[f"`{c}`" for c in df.columns if c.lower() not in taken])


def same(left: str, right: str, keys: Sequence[str]) -> Column:
    """Null-safe equality of the keys of two aliased frames."""
    return reduce(
        lambda a, b: a & b, [F.col(f"{left}.`{k}`").eqNullSafe(F.col(f"{right}.`{k}`")) for k in keys]
    )


# Bits of the map that ``likely_in`` sends to all tasks: 8 MB, whatever the number of keys.
SLOTS = 1 << 26


def likely_in(rows: DataFrame, wanted: DataFrame, key: str, slots: int | None = None) -> DataFrame:
    """The rows but for nearly all whose key is not among the wanted ones.

    A bitmap of fixed size has a bit for the hash of each wanted key.  It keeps rows from a
    join, which decides in the end.
    """
    slot = F.pmod(F.xxhash64(key), F.lit(slots or SLOTS)) + 1
    bits = wanted.select(slot.alias("_slot")).groupBy(F.bitmap_bucket_number("_slot").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_slot")).alias("_bits")
    )
    place = F.bitmap_bit_position("_slot")
    byte = F.conv(F.hex(F.substr("_bits", (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return (
        rows.withColumn("_slot", slot)
        .join(F.broadcast(bits), F.bitmap_bucket_number("_slot") == F.col("_bucket"))
        .withColumns({"_byte": byte, "_place": place})
        .where(F.expr("(shiftright(_byte, cast(_place % 8 as int)) & 1) = 1"))
        .select(*[f"`{c}`" for c in rows.columns])
    )


def stored(df: DataFrame, purpose: str, **options: str) -> DataFrame:
    """Writes a step to the shared folder and reads it back: cuts the lineage,
    and lost executors cost only the tasks that read it."""
    path = work_dir(df.sparkSession, purpose)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# A task holds some batches of texts at once, in the JVM and in Python.
BATCH = 2 << 20


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of texts of some BATCH bytes, from here on in this session: their size
    is fixed when a frame is run, not when it is made.  One of 10,000 rows may take any memory."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH))


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is run in here leaves no shuffle files: for steps that are stored and read back."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def slices(batches, *names: str, size: int = 256):
    """Rows of the named columns of Arrow batches, a few texts at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            yield from zip(*(batch.column(n).slice(at, size).to_pylist() for n in names))
