"""Scoring rules over a table or a stream."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions import rules
from riskloom.functions.stats import n_rows, pct

# Multipliers are not given by the business rule; these are defaults to override.
RISK_MULTIPLIERS = {"low": 0.8, "medium": 1.0, "high": 1.4, "critical": 1.9}


def apply_score_rules(df: DataFrame, prediction: str = "prediction") -> DataFrame:
    """Floor, category, bounds and flags in one projection (batch or stream)."""
    score = rules.adjusted_prediction(prediction)
    category = rules.risk_category(score)
    return df.withColumns(
        {
            "adjusted_prediction": score,
            "risk_category": category,
            "prediction_lower_bound": rules.lower_bound(score),
            "prediction_upper_bound": rules.upper_bound(score),
            "high_risk_patient": rules.high_risk_flag(score, category),
            "requires_review": rules.review_flag(score),
        }
    )


def score_patients(
    df: DataFrame,
    model_name: str,
    model_version: str,
    scored_at: datetime | Column,
    prediction: str = "prediction",
) -> DataFrame:
    """Business rules plus the run's time and model identity."""
    stamp = scored_at if isinstance(scored_at, Column) else F.lit(scored_at)
    return apply_score_rules(df, prediction).withColumns(
        {
            "prediction_timestamp": stamp,
            "model_version": F.lit(model_version),
            "model_name": F.lit(model_name),
        }
    )


def batch_run_metrics(df: DataFrame) -> DataFrame:
    """All figures of a scoring run from one pass."""
    high = F.col("high_risk_patient")
    return df.agg(
        n_rows().alias("batch_inference_count"),
        F.avg("adjusted_prediction").alias("average_predicted_risk_score"),
        F.count_if(high).alias("high_risk_patient_count"),
        F.count_if(F.col("requires_review")).alias("requires_review_count"),
        pct(high).alias("high_risk_percentage"),
        *[
            F.count_if(F.col("risk_category") == c).alias(f"risk_{c}_count")
            for c in ("low", "medium", "high", "critical")
        ],
    )


def risk_category_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("risk_category").agg(n_rows().alias("count")).orderBy("risk_category")


def rule_adjusted_rows(df: DataFrame) -> DataFrame:
    """Rows whose score the floor changed, a null score included."""
    return df.where(~F.col("adjusted_prediction").eqNullSafe(F.col("prediction")))


def risk_interpretation(df: DataFrame) -> DataFrame:
    return df.withColumn("estimated_cost_band", rules.risk_interpretation("adjusted_prediction"))


def premium_estimate(
    df: DataFrame,
    base_premium: Column | str,
    multipliers: Mapping[str, float] = RISK_MULTIPLIERS,
) -> DataFrame:
    """Base premium times regional and risk multipliers."""
    base = F.col(base_premium) if isinstance(base_premium, str) else base_premium
    factor = rules.mapped("risk_category", multipliers, 1.0)
    region = rules.regional_multiplier("patient_region").cast("double")
    return df.withColumn("estimated_premium", base * region * factor)
