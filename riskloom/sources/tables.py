"""Scans and table-level checks.

Time filters compare the raw column with a literal of the column's own type,
so they reach the Parquet reader; a date partition column, when present, is
filtered as well so that whole folders are skipped.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions import rules
from riskloom.functions.stats import n_rows

PARTITION_DATE = "prediction_date"


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    """Whole-table scan of a catalog table or, for a path, a Parquet folder."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def current_records(df: DataFrame, flag: str = "is_current_record") -> DataFrame:
    """Rows flagged current; a null flag counts as not current."""
    return df.where(F.col(flag))


def time_literal(df: DataFrame, column: str, moment: datetime) -> Column:
    """``moment`` in the type of ``column``: no cast lands on the column side."""
    return F.lit(moment.isoformat(sep=" ")).cast(df.schema[column].dataType)


def time_range(
    df: DataFrame, column: str, start: datetime | None, end: datetime | None = None
) -> DataFrame:
    """Half-open range ``[start, end)``."""
    if start is not None:
        df = df.where(F.col(column) >= time_literal(df, column, start))
    if end is not None:
        df = df.where(F.col(column) < time_literal(df, column, end))
    if PARTITION_DATE in df.columns and column == "prediction_timestamp":
        if start is not None:
            df = df.where(F.col(PARTITION_DATE) >= F.lit(start.date()))
        if end is not None:
            df = df.where(F.col(PARTITION_DATE) <= F.lit(end.date()))
    return df


def lookback_scan(
    df: DataFrame, days: int, as_of: datetime, column: str = "prediction_timestamp"
) -> DataFrame:
    """Rows of the ``days`` days before ``as_of`` and anything newer."""
    return time_range(df, column, as_of - timedelta(days=days))


def batch_date_scan(
    df: DataFrame,
    batch_date: date | None,
    as_of: datetime,
    column: str = "prediction_timestamp",
) -> DataFrame:
    """Rows of one day, or of the day of ``as_of`` onwards when no day is given."""
    if batch_date is None:
        return time_range(df, column, datetime.combine(as_of.date(), datetime.min.time()))
    start = datetime.combine(batch_date, datetime.min.time())
    return time_range(df, column, start, start + timedelta(days=1))


def retention_filter(
    df: DataFrame, days: int, as_of: datetime, column: str = "prediction_timestamp"
) -> DataFrame:
    """Rows young enough to keep (90 days for scores, 365 for metrics)."""
    return time_range(df, column, as_of - timedelta(days=days))


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def rows_of(spark: SparkSession, schema: str, rows: Sequence[tuple]) -> DataFrame:
    """A few driver-known rows (names, messages) as a DataFrame."""
    return spark.createDataFrame(list(rows), schema)


def table_probe(spark: SparkSession, tables: Mapping[str, DataFrame | str]) -> DataFrame:
    """Existence and row count per table.

    A name that cannot be resolved gives a FAILED row; resolving is a driver
    lookup, the counts are one job over all tables.
    """
    parts = []
    for name, table in tables.items():
        try:
            df = scan_table(spark, table) if isinstance(table, str) else table
            counted = df.agg(n_rows().alias("row_count"))
            message = F.concat(
                F.lit("Table exists with "),
                F.format_number("row_count", 0),
                F.lit(" rows"),
            )
            status = "SUCCESS"
        except AnalysisException as error:
            counted = spark.range(1).select(F.lit(0).cast("long").alias("row_count"))
            message, status = F.lit(f"not found: {error.getCondition()}"), "FAILED"
        parts.append(
            counted.select(
                F.lit(name).alias("table"),
                F.lit(status).alias("status"),
                "row_count",
                message.alias("message"),
            )
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# Second names used by some reports for the same prediction columns.
PREDICTION_ALIASES = {
    "smoking_status": "patient_smoking_status",
    "age_category": "patient_age_category",
    "region": "patient_region",
    "sex": "patient_gender",
    "confidence_interval_lower": "prediction_lower_bound",
    "confidence_interval_upper": "prediction_upper_bound",
}


def normalize_predictions(df: DataFrame) -> DataFrame:
    """Supply both sets of column names and the derived BMI class."""
    extra = {
        alias: F.col(source)
        for alias, source in PREDICTION_ALIASES.items()
        if alias not in df.columns and source in df.columns
    }
    if "bmi_category" not in df.columns and "bmi" in df.columns:
        extra["bmi_category"] = rules.bmi_category("bmi")
    return df.withColumns(extra) if extra else df
