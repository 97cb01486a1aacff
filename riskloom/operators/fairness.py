"""Demographic parity and disparity between groups."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.rules import HIGH_RISK_SCORE, fairness_band
from riskloom.functions.stats import cv, n_rows, pct, pct_of, ratio

SCORE = "adjusted_prediction"
# Fixed values.
PROTECTED = (
    "patient_gender",
    "patient_region",
    "patient_age_category",
    "patient_smoking_status",
)
DISPARITY_LIMIT = 0.15


def demographic_parity(
    df: DataFrame,
    attributes: str | Sequence[str],
    score: str = SCORE,
    threshold: float = HIGH_RISK_SCORE,
) -> DataFrame:
    """Size, mean, spread and high-risk rate per group of one or more attributes."""
    keys = [attributes] if isinstance(attributes, str) else list(attributes)
    above = F.col(score) > threshold
    return df.groupBy(*keys).agg(
        n_rows().alias("total_count"),
        F.avg(score).alias("avg_prediction"),
        F.stddev_samp(score).alias("stddev_prediction"),
        F.count_if(above).alias("high_risk_count"),
        pct(above).alias("high_risk_rate"),
    )


def regional_fairness(
    df: DataFrame, region: str = "patient_region", score: str = SCORE
) -> DataFrame:
    return df.groupBy(region).agg(
        n_rows().alias("prediction_count"),
        F.avg(score).alias("avg_risk_score"),
        F.stddev_samp(score).alias("stddev_risk_score"),
        F.min(score).alias("min_risk_score"),
        F.max(score).alias("max_risk_score"),
    )


def _attribute_cells(
    df: DataFrame, attributes: Sequence[str], score: str, by: Sequence[str]
) -> DataFrame:
    """Group sums per attribute value.

    The log is grouped by all attributes at once; only those few cells are
    unpivoted, so the scan is not multiplied by the number of attributes.
    """
    x = F.col(score)
    cells = df.groupBy(*by, *attributes).agg(
        n_rows().alias("_rows"),
        F.count(x).alias("_n"),
        F.sum(x).alias("_s"),
        F.count_if(x > HIGH_RISK_SCORE).alias("_high"),
    )
    pairs = [
        F.struct(F.lit(a).alias("attribute"), F.col(a).cast("string").alias("group_value"))
        for a in attributes
    ]
    return (
        cells.select("*", F.inline(F.array(*pairs)))
        .groupBy(*by, "attribute", "group_value")
        .agg(
            F.sum("_rows").alias("group_rows"),
            ratio(F.sum("_s"), F.sum("_n")).alias("group_avg"),
            pct_of(F.sum("_high"), F.sum("_rows")).alias("group_high_pct"),
        )
    )


def fairness_groups(
    df: DataFrame, attributes: Sequence[str] = PROTECTED, score: str = SCORE
) -> DataFrame:
    """The per-group table behind the disparities."""
    return _attribute_cells(df, attributes, score, ())


def fairness_disparity(
    df: DataFrame,
    attributes: Sequence[str] = PROTECTED,
    score: str = SCORE,
    by: Sequence[str] = (),
) -> DataFrame:
    """Coefficient of variation of the group means, each group counting once.

    A single group has no spread: the disparity is null and never a violation.
    """
    groups = _attribute_cells(df, attributes, score, by)
    return groups.groupBy(*by, "attribute").agg(
        n_rows().alias("group_count"),
        cv(F.stddev_samp("group_avg"), F.avg("group_avg")).alias("disparity"),
        F.sum("group_rows").alias("_rows"),
    )


def fairness_report(
    df: DataFrame,
    as_of: datetime | Column,
    attributes: Sequence[str] = PROTECTED,
    score: str = SCORE,
    by: Sequence[str] = (),
    limit: float = DISPARITY_LIMIT,
) -> DataFrame:
    """One row per run (or per value of ``by``): total, disparities, violation flag."""
    long = fairness_disparity(df, attributes, score, by)

    def disparity(attribute: str) -> Column:
        return F.max(F.when(F.col("attribute") == attribute, F.col("disparity")))

    stamp = as_of if isinstance(as_of, Column) else F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
    return (
        long.groupBy(*by)
        .agg(
            F.max("_rows").alias("total_predictions"),
            *[disparity(a).alias(f"{a}_disparity") for a in attributes],
            F.coalesce(F.bool_or(F.col("disparity") > limit), F.lit(False)).alias(
                "fairness_threshold_violation"
            ),
        )
        .withColumn("metric_timestamp", stamp)
    )


def fairness_bands(
    df: DataFrame, attributes: Sequence[str] = PROTECTED, score: str = SCORE
) -> DataFrame:
    return fairness_disparity(df, attributes, score).select(
        "attribute", "disparity", fairness_band("disparity").alias("band")
    )


def intersectional_bias(
    df: DataFrame,
    pairs: Sequence[tuple[str, str]] = (
        ("patient_gender", "patient_region"),
        ("patient_age_category", "patient_smoking_status"),
    ),
    score: str = SCORE,
) -> DataFrame:
    """Parity of combined groups, and each group's gap to the overall rate.

    The log is grouped once by all attributes involved; the pairs are merged
    from those cells.
    """
    attributes = sorted({a for pair in pairs for a in pair})
    x = F.col(score)
    cells = df.groupBy(*attributes).agg(
        n_rows().alias("_rows"),
        F.count(x).alias("_n"),
        F.sum(x).alias("_s"),
        F.count_if(x > HIGH_RISK_SCORE).alias("_high"),
    )
    choices = [
        F.struct(
            F.lit(f"{a} x {b}").alias("intersection"),
            F.concat_ws(" / ", F.col(a), F.col(b)).alias("group_value"),
        )
        for a, b in pairs
    ]
    same = Window.partitionBy("intersection")
    grouped = (
        cells.select("*", F.inline(F.array(*choices)))
        .groupBy("intersection", "group_value")
        .agg(
            F.sum("_rows").alias("total_count"),
            ratio(F.sum("_s"), F.sum("_n")).alias("avg_prediction"),
            F.sum("_high").alias("high_risk_count"),
        )
    )
    rate = pct_of(F.col("high_risk_count"), F.col("total_count"))
    overall = pct_of(
        F.sum("high_risk_count").over(same), F.sum("total_count").over(same)
    )
    return grouped.withColumns({"high_risk_rate": rate, "gap_to_overall": rate - overall})


def equal_opportunity(
    df: DataFrame,
    attribute: str,
    label: str,
    score: str = SCORE,
    threshold: float = HIGH_RISK_SCORE,
) -> DataFrame:
    """True-positive rate per group: flagged share of truly high-risk rows."""
    truly = F.col(label) > threshold
    flagged = F.col(score) > threshold
    return df.groupBy(attribute).agg(
        F.count_if(truly).alias("positives"),
        F.count_if(truly & flagged).alias("true_positives"),
        ratio(F.count_if(truly & flagged), F.count_if(truly)).alias("true_positive_rate"),
    )
