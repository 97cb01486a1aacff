"""Exploratory summaries of the patient table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.stats import n_rows, one_value, pct, quantiles

CORRELATED = ("age", "bmi", "children", "charges")


def eda_profile(patients: DataFrame, approx: bool = False) -> DataFrame:
    """Size, mean age, smoker share, 95th percentile of charges, null share per column."""
    p95 = quantiles(patients, "charges", [0.95], ["p95"], approx=approx)
    return patients.agg(
        n_rows().alias("total_patients"),
        F.avg("age").alias("avg_age"),
        pct(F.col("smoker")).alias("smoker_percentage"),
        *[pct(F.col(c).isNull()).alias(f"missing_{c}") for c in patients.columns],
    ).withColumn("high_cost_threshold", one_value(p95, "p95"))


def _with_quantiles(grouped: DataFrame, found: DataFrame, by: Sequence[str]) -> DataFrame:
    """Attach group quantiles to group aggregates; both sides are one row per group."""
    renamed = found.select(
        *[F.col(c).alias(f"_q_{c}") for c in by], *[c for c in found.columns if c not in by]
    )
    condition = F.lit(True)
    for c in by:
        condition = condition & grouped[c].eqNullSafe(renamed[f"_q_{c}"])
    return grouped.join(renamed, condition, "left").drop(*[f"_q_{c}" for c in by])


def risk_factor_analysis(patients: DataFrame, approx: bool = False) -> DataFrame:
    """Charges and BMI by smoking and age category, rounded to cents."""
    by = ["smoker", "patient_age_category"]
    grouped = patients.groupBy(*by).agg(
        F.round(F.avg("charges"), 2).alias("charges_mean"),
        F.round(F.stddev_samp("charges"), 2).alias("charges_std"),
        F.round(F.avg("bmi"), 2).alias("bmi_mean"),
    )
    median = quantiles(patients, "charges", [0.5], ["charges_median"], by=by, approx=approx)
    return _with_quantiles(grouped, median, by).withColumn(
        "charges_median", F.round("charges_median", 2)
    )


def box_stats(patients: DataFrame, approx: bool = False) -> DataFrame:
    """Five-number summary of charges per region and smoking status."""
    by = ["region", "smoker"]
    names = ["min_charges", "q1_charges", "median_charges", "q3_charges", "max_charges"]
    return quantiles(patients, "charges", [0, 0.25, 0.5, 0.75, 1], names, by=by, approx=approx)


def correlation_matrix(df: DataFrame, columns: Sequence[str] = CORRELATED) -> DataFrame:
    """Pearson correlation of every column pair over rows where both are present."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    wide = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    cells = []
    for a, b in pairs:
        for left, right in {(a, b), (b, a)}:
            cells.append(
                F.struct(
                    F.lit(left).alias("column_a"),
                    F.lit(right).alias("column_b"),
                    F.col(f"`{a}|{b}`").alias("correlation"),
                )
            )
    return wide.select(F.inline(F.array(*cells)))


def high_risk_cohort(patients: DataFrame) -> DataFrame:
    """Older obese smokers: how many, and their average cost."""
    cohort = F.col("smoker") & (F.col("bmi") > 30) & (F.col("age") > 50)
    return patients.where(cohort).agg(
        n_rows().alias("high_risk_patients_count"),
        F.avg("charges").alias("high_risk_avg_cost"),
    )


__all__ = [
    "box_stats",
    "correlation_matrix",
    "eda_profile",
    "high_risk_cohort",
    "risk_factor_analysis",
]
