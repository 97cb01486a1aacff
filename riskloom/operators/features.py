"""Feature engineering and the keyed feature table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions import rules
from riskloom.functions.ordered import top_rows
from riskloom.functions.stats import n_rows, pct_of
from riskloom.sources.tables import current_records, require_columns

FEATURE_KEY = "customer_id"
# What a model looks up, its label, and what never reaches training.
LOOKUP_FEATURES = (
    "age_risk_score",
    "smoking_impact",
    "family_size_factor",
    "regional_multiplier",
    "health_risk_composite",
    "data_quality_score",
    "sex",
    "region",
)
NUMERIC_FEATURES = (
    "age_risk_score",
    "smoking_impact",
    "family_size_factor",
    "health_risk_composite",
    "regional_multiplier",
    "data_quality_score",
)
CATEGORICAL_FEATURES = ("sex", "region")
LABEL = "health_risk_score"
NOT_FOR_TRAINING = (
    "timestamp",
    "ingestion_timestamp",
    "effective_from_date",
    "effective_to_date",
    "effective_date",
    "expiry_date",
    "patient_surrogate_key",
    "patient_id_hash",
    "patient_name_hash",
    "_pipeline_env",
    "dimension_last_updated",
)
FEATURE_RANGES = {"age_risk_score": (1.0, 5.0), "regional_multiplier": (0.95, 1.2)}
FEATURE_NULL_PCT_MAX = 5.0


def newest_first() -> list[Column]:
    return [F.col("dimension_last_updated").desc(), F.col("patient_surrogate_key").desc()]


def dedupe_keep_latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``order``."""
    return top_rows(df, keys, order, 1)


def enrich_patients(silver: DataFrame, dim: DataFrame) -> DataFrame:
    """Silver patients with score and lifestyle attributes of the current row.

    The dimension is cut to one row per patient first, so the join cannot
    multiply rows.
    """
    columns = ("patient_natural_key", "health_risk_score", "lifestyle_risk_factors")
    slim = dedupe_keep_latest(current_records(dim), ["patient_natural_key"], newest_first())
    slim = slim.select(*columns)
    kept = (
        "patient_id",
        "age",
        "sex",
        "bmi",
        "children",
        "smoker",
        "region",
        "charges",
        "patient_age_category",
        "health_risk_category",
        "demographic_segment",
        "patient_data_quality_score",
    )
    joined = silver.select(*kept).join(
        slim, silver["patient_id"] == slim["patient_natural_key"], "left"
    )
    return joined.select(*kept, *columns[1:])


def column_aliases(df: DataFrame) -> DataFrame:
    """Names the model expects for the dimension's columns."""
    return df.withColumns(
        {
            "children": F.col("number_of_dependents"),
            "region": F.col("patient_region"),
            "sex": F.col("patient_gender"),
            "data_quality_score": F.col("patient_data_quality_score"),
            "hipaa_compliant": F.col("hipaa_deidentification_applied"),
            FEATURE_KEY: F.col("patient_natural_key"),
        }
    )


def with_features(df: DataFrame, leak_safe: bool = False) -> DataFrame:
    """All feature columns, in two projections that Catalyst collapses into one."""
    age = rules.age_from_category("patient_age_category")
    smoker = rules.smoker_flag("patient_smoking_status")
    named = column_aliases(df).withColumns({"age": age, "smoker": smoker})
    risk = rules.age_risk_score("age")
    return named.withColumns(
        {
            "age_risk_score": risk,
            "smoking_impact": rules.smoking_impact("smoker", "age"),
            "family_size_factor": rules.family_size_factor("children"),
            "regional_multiplier": rules.regional_multiplier("region"),
            "health_risk_composite": rules.health_risk_composite(
                "health_risk_score", risk, "smoker", "bmi", leak_safe
            ),
        }
    )


def build_feature_table(dim: DataFrame, leak_safe: bool = False) -> DataFrame:
    """Current dimension rows to one feature row per patient: one shuffle, by key."""
    require_columns(dim, ["patient_natural_key", "is_current_record"])
    unique = dedupe_keep_latest(current_records(dim), ["patient_natural_key"], newest_first())
    return with_features(unique, leak_safe)


def feature_lookup(
    base: DataFrame,
    features: DataFrame,
    names: Sequence[str] = LOOKUP_FEATURES,
    key: str = FEATURE_KEY,
) -> DataFrame:
    """Left join of chosen feature columns by key; other feature columns are not read."""
    return base.join(features.select(key, *names), key, "left")


def training_set(
    dim: DataFrame,
    features: DataFrame,
    names: Sequence[str] = LOOKUP_FEATURES,
    label: str = LABEL,
) -> DataFrame:
    base = current_records(dim).withColumn(FEATURE_KEY, F.col("patient_natural_key"))
    require_columns(base, [label])
    return feature_lookup(base, features, names).drop(*NOT_FOR_TRAINING)


def feature_range_check(
    features: DataFrame,
    columns: Sequence[str] = NUMERIC_FEATURES,
    ranges: dict[str, tuple[float, float]] = FEATURE_RANGES,
    null_pct_max: float = FEATURE_NULL_PCT_MAX,
) -> DataFrame:
    """Null rate and range violations per feature from one aggregate."""
    aggs = [n_rows().alias("_n")]
    for c in columns:
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"_null_{c}"))
        if c in ranges:
            low, high = ranges[c]
            x = F.col(c).cast("double")
            aggs.append(F.count_if((x < low) | (x > high)).alias(f"_out_{c}"))
    wide = features.agg(*aggs)
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("feature_name"),
                F.col("_n").alias("total_count"),
                F.col(f"_null_{c}").alias("null_count"),
                (F.col(f"_out_{c}") if c in ranges else F.lit(0).cast("long")).alias(
                    "out_of_range_count"
                ),
            )
            for c in columns
        ]
    )
    long = wide.select(F.inline(rows))
    null_pct = pct_of(F.col("null_count"), F.col("total_count"))
    bad = (null_pct > null_pct_max) | (F.col("out_of_range_count") > 0)
    return long.withColumns(
        {"null_pct": null_pct, "status": F.when(bad, "FAIL").otherwise("PASS")}
    )


def feature_summary_by_risk(predictions: DataFrame, features: DataFrame) -> DataFrame:
    """Average features per risk category.

    Scores are counted per patient and category before the join, so a patient
    with very many scores joins as at most one row per category.
    """
    per_patient = predictions.groupBy(FEATURE_KEY, "risk_category").agg(n_rows().alias("_w"))
    joined = feature_lookup(per_patient, features, NUMERIC_FEATURES)
    w = F.col("_w")

    def weighted(c: str) -> Column:
        x = F.col(c).cast("double")
        return (F.sum(x * w) / F.sum(F.when(x.isNotNull(), w))).alias(f"avg_{c}")

    return joined.groupBy("risk_category").agg(
        F.sum(w).alias("prediction_count"), *[weighted(c) for c in NUMERIC_FEATURES]
    )
