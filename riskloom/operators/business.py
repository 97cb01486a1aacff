"""Operational figures of the prediction log."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.stats import merged_mean, merged_std, moments, n_rows, pct_of, ratio

SCORE = "adjusted_prediction"


def risk_distribution(df: DataFrame, category: str = "risk_category") -> DataFrame:
    everything = Window.partitionBy(F.lit(0))
    return (
        df.groupBy(category)
        .agg(n_rows().alias("count"))
        .withColumn("percentage", pct_of(F.col("count"), F.sum("count").over(everything)))
        .orderBy(category)
    )


def prediction_quality_stats(df: DataFrame) -> DataFrame:
    width = F.col("prediction_upper_bound") - F.col("prediction_lower_bound")
    return df.agg(
        F.avg(SCORE).alias("mean_prediction"),
        F.stddev_samp(SCORE).alias("std_prediction"),
        F.min(SCORE).alias("min_prediction"),
        F.max(SCORE).alias("max_prediction"),
        F.avg(width).alias("avg_confidence_width"),
    )


def _weekday_cells(df: DataFrame, by: Sequence[str], stamp: str) -> DataFrame:
    """Mergeable figures per weekday, from figures per day: a single scan."""
    score = F.col(SCORE)
    width = F.col("prediction_upper_bound") - F.col("prediction_lower_bound")
    return df.groupBy(*by, F.to_date(stamp).alias("_day")).agg(
        n_rows().alias("rows"),
        F.count_if("high_risk_patient").alias("high_n"),
        F.count_if("requires_review").alias("review_n"),
        F.sum(width).alias("width_sum"),
        F.count(width).alias("width_n"),
        *moments(score),
    )


def throughput(
    df: DataFrame, window_days: int = 7, stamp: str = "prediction_timestamp"
) -> DataFrame:
    """Volumes.  ``max/min_daily_predictions`` are totals per day of the week;
    the ``calendar`` columns are true daily extremes."""
    days = df.groupBy(F.to_date(stamp).alias("_day")).agg(n_rows().alias("rows"))
    weekdays = days.groupBy(F.dayofweek("_day").alias("_weekday")).agg(
        F.sum("rows").alias("rows"), F.max("rows").alias("_most"), F.min("rows").alias("_least")
    )
    total = F.coalesce(F.sum("rows"), F.lit(0))
    return weekdays.agg(
        total.cast("double").alias("total_predictions"),
        (total / F.lit(float(window_days))).alias("daily_avg_predictions"),
        F.coalesce(F.max("rows"), F.lit(0)).cast("double").alias("max_daily_predictions"),
        F.coalesce(F.min("rows"), F.lit(0)).cast("double").alias("min_daily_predictions"),
        F.coalesce(F.max("_most"), F.lit(0)).alias("max_calendar_day_predictions"),
        F.coalesce(F.min("_least"), F.lit(0)).alias("min_calendar_day_predictions"),
    )


def business_report(
    df: DataFrame,
    as_of: datetime | Column,
    window_days: int = 7,
    by: Sequence[str] = (),
    stamp: str = "prediction_timestamp",
) -> DataFrame:
    """Volumes, shares and score figures in one row (or one per ``by``)."""
    days = _weekday_cells(df, by, stamp)
    sums = ("rows", "high_n", "review_n", "width_sum", "width_n", "cnt", "sum")
    weekdays = days.groupBy(*by, F.dayofweek("_day").alias("_weekday")).agg(
        *[F.sum(c).alias(c) for c in sums],
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        # Spread within the merged group, still mergeable.
        (
            F.sum("m2")
            + F.sum(ratio(F.col("sum") * F.col("sum"), F.col("cnt")))
            - ratio(F.sum("sum") * F.sum("sum"), F.sum("cnt"))
        ).alias("m2"),
    )
    total = F.coalesce(F.sum("rows"), F.lit(0))
    now = as_of if isinstance(as_of, Column) else F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
    return (
        weekdays.groupBy(*by)
        .agg(
            total.alias("total_predictions"),
            F.coalesce(F.sum("high_n"), F.lit(0)).alias("high_risk_count"),
            F.coalesce(pct_of(F.sum("high_n"), total), F.lit(0.0)).alias("high_risk_percentage"),
            F.coalesce(F.sum("review_n"), F.lit(0)).alias("requires_review_count"),
            F.coalesce(pct_of(F.sum("review_n"), total), F.lit(0.0)).alias(
                "requires_review_percentage"
            ),
            merged_mean().alias("mean_prediction"),
            merged_std().alias("std_prediction"),
            F.min("min").alias("min_prediction"),
            F.max("max").alias("max_prediction"),
            ratio(F.sum("width_sum"), F.sum("width_n")).alias("avg_confidence_width"),
            (total / F.lit(float(window_days))).alias("daily_avg_predictions"),
            F.max("rows").cast("double").alias("max_daily_predictions"),
            F.min("rows").cast("double").alias("min_daily_predictions"),
        )
        .withColumn("metric_timestamp", now)
    )
