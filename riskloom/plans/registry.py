"""Named queries and the SQL statements that check them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    name: str
    build: Build
    sql: str | None = None


ENTRIES: dict[str, Entry] = {}


def register(name: str, build: Build, sql: str | None = None) -> None:
    if name in ENTRIES:
        raise ValueError(f"query {name} registered twice")
    ENTRIES[name] = Entry(name, build, sql)


def tidy(df: DataFrame) -> DataFrame:
    """Decimals as doubles and doubles to six places, for comparison across engines."""
    out = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            column = F.round(column, 6)
        out.append(column.alias(field.name))
    return df.select(*out)


def runnable(entry: Entry) -> Build:
    return lambda spark, sf_dir: tidy(entry.build(spark, sf_dir))
