"""Validation summaries over the prediction log.

Each operator filters on the raw timestamp, reads only its columns and
aggregates map-side before its one shuffle.  ``as_of`` replaces the clock.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.ordered import top_rows
from riskloom.functions.rules import SMOKER_LABEL
from riskloom.functions.stats import (
    disparity_pct,
    n_rows,
    one_value,
    pct,
    pct_change,
    pct_of,
    quantiles,

    zscore,
)
from riskloom.sources.tables import lookback_scan, normalize_predictions, time_literal

SCORE = "adjusted_prediction"
CATEGORY_ORDER = ("critical", "high", "medium", "low")
BMI_ORDER = ("underweight", "normal", "overweight", "obese")


def recent(df: DataFrame, days: int, as_of: datetime) -> DataFrame:
    return lookback_scan(normalize_predictions(df), days, as_of)


def high_risk_pct(digits: int = 2) -> Column:
    return pct(F.col("high_risk_patient"), digits)


def distinct_labels(column: str) -> Column:
    """Distinct count of a column with a fixed handful of labels.

    The set stays tiny, so no second shuffle for distinct rows is needed.
    """
    return F.size(F.collect_set(column)).cast("long")


def interval_width() -> Column:
    return F.col("prediction_upper_bound") - F.col("prediction_lower_bound")


def custom_order(column: str, labels: tuple[str, ...]) -> Column:
    order = F
    for i, label in enumerate(labels):
        order = order.when(F.col(column) == label, i)
    return order.otherwise(len(labels))


def daily_prediction_summary(df: DataFrame, as_of: datetime, days: int = 30) -> DataFrame:
    return (
        recent(df, days, as_of)
        .groupBy(F.to_date("prediction_timestamp").alias("prediction_date"))
        .agg(
            n_rows().alias("total_predictions"),
            F.avg(SCORE).alias("avg_risk_score"),
            F.stddev_samp(SCORE).alias("risk_score_std"),
            F.min(SCORE).alias("min_risk"),
            F.max(SCORE).alias("max_risk"),
            F.count_if("high_risk_patient").alias("high_risk_count"),
            high_risk_pct().alias("high_risk_pct"),
            F.count_distinct("customer_id").alias("unique_patients"),
        )
        .orderBy(F.col("prediction_date").desc())
    )


def risk_category_distribution(df: DataFrame, as_of: datetime, days: int = 7) -> DataFrame:
    """The share is a window over the grouped rows, one per category."""
    everything = Window.partitionBy(F.lit(0))
    return (
        recent(df, days, as_of)
        .groupBy("risk_category")
        .agg(
            n_rows().alias("patient_count"),
            F.avg(SCORE).alias("avg_risk_score"),
            F.min(SCORE).alias("min_risk_score"),
            F.max(SCORE).alias("max_risk_score"),
        )
        .withColumn(
            "percentage",
            pct_of(F.col("patient_count"), F.sum("patient_count").over(everything), 2),
        )
        .orderBy(custom_order("risk_category", CATEGORY_ORDER))
    )


def risk_by(
    df: DataFrame, column: str, as_of: datetime, days: int = 7, spread: bool = True
) -> DataFrame:
    """Size, mean, (spread) and high-risk share per value of a demographic column."""
    aggs = [n_rows().alias("patient_count"), F.avg(SCORE).alias("avg_risk_score")]
    if spread:
        aggs.append(F.stddev_samp(SCORE).alias("risk_std"))
    aggs.append(high_risk_pct().alias("high_risk_pct"))
    return recent(df, days, as_of).groupBy(column).agg(*aggs)


def risk_by_smoking(df: DataFrame, as_of: datetime) -> DataFrame:
    return risk_by(df, "smoking_status", as_of).orderBy(F.col("avg_risk_score").desc())


def risk_by_age(df: DataFrame, as_of: datetime) -> DataFrame:
    return risk_by(df, "age_category", as_of).orderBy("age_category")


def risk_by_bmi_category(df: DataFrame, as_of: datetime) -> DataFrame:
    return risk_by(df, "bmi_category", as_of, spread=False).orderBy(
        custom_order("bmi_category", BMI_ORDER)
    )


def risk_by_gender(df: DataFrame, as_of: datetime) -> DataFrame:
    return (
        risk_by(df, "sex", as_of, spread=False)
        .withColumnRenamed("sex", "gender")
        .orderBy(F.col("avg_risk_score").desc())
    )


def regional_equity(df: DataFrame, as_of: datetime, days: int = 7) -> DataFrame:
    return (
        recent(df, days, as_of)
        .groupBy("region")
        .agg(
            n_rows().alias("patient_count"),
            F.avg(SCORE).alias("avg_risk_score"),
            F.stddev_samp(SCORE).alias("risk_std"),
            F.min(SCORE).alias("min_risk"),
            F.max(SCORE).alias("max_risk"),
            high_risk_pct().alias("high_risk_pct"),
            F.avg(interval_width()).alias("avg_ci_width"),
        )
        .orderBy(F.col("avg_risk_score").desc())
    )


def regional_disparity(df: DataFrame, as_of: datetime, days: int = 7) -> DataFrame:
    by_region = recent(df, days, as_of).groupBy("region").agg(F.avg(SCORE).alias("avg_risk"))
    high, low = F.max("avg_risk"), F.min("avg_risk")
    return by_region.agg(
        high.alias("max_regional_risk"),
        low.alias("min_regional_risk"),
        (high - low).alias("risk_disparity"),
        F.round(disparity_pct(high, low), 2).alias("disparity_pct"),
    )


def _high_risk(df: DataFrame, days: int, as_of: datetime) -> DataFrame:
    return recent(df, days, as_of).where(F.col("high_risk_patient"))


def high_risk_summary(
    df: DataFrame, as_of: datetime, days: int = 7, smoker_label: str = SMOKER_LABEL
) -> DataFrame:
    return _high_risk(df, days, as_of).agg(
        n_rows().alias("total_high_risk_patients"),
        F.avg(SCORE).alias("avg_risk_score"),
        F.min(SCORE).alias("min_risk_score"),
        distinct_labels("region").alias("regions_represented"),
        pct(F.col("smoking_status") == smoker_label, 2).alias("smoker_pct"),
        pct(F.col("bmi_category") == "obese", 2).alias("obese_pct"),
    )


def high_risk_by_category(df: DataFrame, as_of: datetime, days: int = 7) -> DataFrame:
    return (
        _high_risk(df, days, as_of)
        .groupBy("risk_category")
        .agg(
            n_rows().alias("patient_count"),
            F.avg(SCORE).alias("avg_risk_score"),
            F.avg("number_of_dependents").alias("avg_dependents"),
        )
        .orderBy(F.col("avg_risk_score").desc())
    )


def weekly_performance(df: DataFrame, as_of: datetime, days: int = 90) -> DataFrame:
    """Weeks start on Monday."""
    stamp = F.col("prediction_timestamp")
    return (
        recent(df, days, as_of)
        .groupBy(F.to_date(F.date_trunc("week", stamp)).alias("week_start"))
        .agg(
            n_rows().alias("prediction_count"),
            F.avg(SCORE).alias("avg_risk_score"),
            F.stddev_samp(SCORE).alias("risk_std"),
            high_risk_pct().alias("high_risk_pct"),
            F.avg(interval_width()).alias("avg_ci_width"),
            F.min(stamp).alias("earliest_prediction"),
            F.max(stamp).alias("latest_prediction"),
        )
        .orderBy(F.col("week_start").desc())
    )


def prediction_quality(df: DataFrame, as_of: datetime, days: int = 7) -> DataFrame:
    """Also counts nulls of the raw score: the floor hides them in the adjusted one."""
    score = F.col(SCORE)
    return recent(df, days, as_of).agg(
        n_rows().alias("total_predictions"),
        F.count_if(score.isNull()).alias("null_predictions"),
        F.count_if(F.col("prediction").isNull()).alias("null_raw_predictions"),
        F.count_if(score < 0).alias("negative_predictions"),
        F.count_if(score > 100).alias("outlier_predictions"),
        F.avg(interval_width()).alias("avg_uncertainty"),
        pct(score.isNotNull(), 2).alias("prediction_success_rate"),
    )


def feature_completeness(df: DataFrame, as_of: datetime, days: int = 7) -> DataFrame:
    columns = ("customer_id", "smoking_status", "region", "age_category", "bmi_category", "sex")
    return recent(df, days, as_of).agg(
        n_rows().alias("total_records"),
        *[F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in columns],
    )


def duplicate_predictions(
    df: DataFrame, as_of: datetime, days: int = 7, limit: int = 100
) -> DataFrame:
    """Most repeated (patient, day) pairs; the key breaks ties."""
    return (
        recent(df, days, as_of)
        .groupBy("customer_id", F.to_date("prediction_timestamp").alias("prediction_date"))
        .agg(n_rows().alias("prediction_count"))
        .where(F.col("prediction_count") > 1)
        .orderBy(F.col("prediction_count").desc(), "customer_id", "prediction_date")
        .limit(limit)
    )


def high_risk_flag_accuracy(
    df: DataFrame, as_of: datetime, days: int = 7, approx: bool = False
) -> DataFrame:
    """Flagged rows at or above the 95th percentile of all recent scores."""
    rows = recent(df, days, as_of)
    p95 = one_value(quantiles(rows, SCORE, [0.95], ["p95"], approx=approx), "p95")
    marked = rows.where(F.col("high_risk_patient")).select(
        (F.col(SCORE) >= p95).alias("_above")
    )
    above = F.col("_above")
    return marked.agg(
        n_rows().alias("total_high_risk_flagged"),
        F.count_if(above).alias("correctly_flagged"),
        F.count_if(~above).alias("incorrectly_flagged"),
        pct(above, 2).alias("flag_accuracy_pct"),
    )


def category_boundaries(df: DataFrame, as_of: datetime, days: int = 7) -> DataFrame:
    return (
        recent(df, days, as_of)
        .groupBy("risk_category")
        .agg(
            F.min(SCORE).alias("min_risk"),
            F.max(SCORE).alias("max_risk"),
            n_rows().alias("patient_count"),
        )
        .orderBy("min_risk")
    )


def week_over_week(df: DataFrame, as_of: datetime, days: int = 7) -> DataFrame:
    """Current against previous period from one scan and one conditional aggregate."""
    rows = recent(df, 2 * days, as_of)
    border = time_literal(rows, "prediction_timestamp", as_of - timedelta(days=days))
    now = F.col("prediction_timestamp") >= border
    high = F.col("high_risk_patient")
    wide = rows.agg(
        F.avg(F.when(now, F.col(SCORE))).alias("current_avg_risk"),
        F.avg(F.when(~now, F.col(SCORE))).alias("last_week_avg_risk"),
        F.count_if(now).alias("current_volume"),
        F.count_if(~now).alias("last_week_volume"),
        F.count_if(now & high).alias("_now_high"),
        F.count_if(~now & high).alias("_then_high"),
    )
    a, b = F.col("current_avg_risk"), F.col("last_week_avg_risk")
    return wide.select(
        a,
        b,
        F.round(a - b, 2).alias("risk_change"),
        F.round(pct_change(a, b), 2).alias("risk_change_pct"),
        "current_volume",
        "last_week_volume",
        (F.col("current_volume") - F.col("last_week_volume")).alias("volume_change"),
        pct_of(F.col("_now_high"), F.col("current_volume"), 2).alias("current_high_risk_pct"),
        pct_of(F.col("_then_high"), F.col("last_week_volume"), 2).alias("last_week_high_risk_pct"),
    )


def top_high_risk_patients(
    df: DataFrame, as_of: datetime, days: int = 7, limit: int = 100
) -> DataFrame:
    return (
        _high_risk(df, days, as_of)
        .orderBy(F.col(SCORE).desc(), "customer_id", "prediction_timestamp")
        .limit(limit)
        .select(
            "customer_id",
            F.col(SCORE).alias("risk_score"),
            "risk_category",
            "smoking_status",
            "bmi_category",
            "age_category",
            "region",
            "number_of_dependents",
            "confidence_interval_lower",
            "confidence_interval_upper",
            "prediction_timestamp",
        )
    )


def rapidly_increasing_risk(
    df: DataFrame, as_of: datetime, days: int = 30, steps: int = 7, limit: int = 50
) -> DataFrame:
    """Patients whose latest daily mean exceeds that of their 7th latest active day.

    Scores are reduced to one row per patient and day before the ranking, so a
    patient contributes at most ``days`` rows to it.
    """
    daily = (
        recent(df, days, as_of)
        .groupBy("customer_id", F.to_date("prediction_timestamp").alias("prediction_date"))
        .agg(F.avg(SCORE).alias("daily_avg_risk"))
    )
    ranked = top_rows(
        daily, ["customer_id"], [F.col("prediction_date").desc()], steps, rank="recency_rank"
    )

    def at(rank: int) -> Column:
        return F.max(F.when(F.col("recency_rank") == rank, F.col("daily_avg_risk")))

    pair = ranked.groupBy("customer_id").agg(
        at(1).alias("latest_risk"), at(steps).alias("week_ago_risk")
    )
    latest, before = F.col("latest_risk"), F.col("week_ago_risk")
    return (
        pair.where(latest > before)
        .select(
            "customer_id",
            latest,
            before,
            F.round(latest - before, 2).alias("risk_increase"),
            F.round(pct_change(latest, before), 2).alias("risk_increase_pct"),
        )
        .orderBy(F.col("risk_increase").desc(), "customer_id")
        .limit(limit)
    )


def executive_dashboard(df: DataFrame, as_of: datetime, days: int = 7) -> DataFrame:
    category = F.col("risk_category")
    return recent(df, days, as_of).agg(
        F.lit(f"Last {days} Days").alias("time_period"),
        F.count_distinct("customer_id").alias("unique_patients_scored"),
        n_rows().alias("total_predictions"),
        F.round(F.avg(SCORE), 2).alias("avg_risk_score"),
        F.count_if("high_risk_patient").alias("high_risk_patients"),
        high_risk_pct().alias("high_risk_pct"),
        pct(category == "critical", 2).alias("critical_pct"),
        pct(category == "low", 2).alias("low_risk_pct"),
        distinct_labels("region").alias("regions_covered"),
        F.round(F.avg(interval_width()), 2).alias("avg_prediction_uncertainty"),
    )


def risk_anomaly_alert(
    df: DataFrame,
    as_of: datetime,
    days: int = 30,
    watch_days: int = 7,
    alert: float = 2.0,
    warning: float = 1.5,
) -> DataFrame:
    """Daily means of the last week against the mean and spread of earlier days.

    After grouping there is one row per day; the baseline is a window over
    those few rows, so the log is read once.
    """
    daily = (
        recent(df, days, as_of)
        .groupBy(F.to_date("prediction_timestamp").alias("prediction_date"))
        .agg(F.avg(SCORE).alias("avg_risk"))
    )
    border = F.lit((as_of - timedelta(days=watch_days)).date())
    older = F.when(F.col("prediction_date") < border, F.col("avg_risk"))
    everything = Window.partitionBy(F.lit(0))
    z = zscore(F.col("avg_risk"), F.col("baseline_avg"), F.col("_std"))
    status = F.when(F.abs(z) > alert, "ALERT").when(F.abs(z) > warning, "WARNING")
    return (
        daily.withColumns(
            {
                "baseline_avg": F.avg(older).over(everything),
                "_std": F.stddev_samp(older).over(everything),
            }
        )
        .where(F.col("prediction_date") >= border)
        .select(
            "prediction_date",
            "avg_risk",
            "baseline_avg",
            F.round(F.col("avg_risk") - F.col("baseline_avg"), 2).alias("deviation"),
            F.round(z, 2).alias("z_score"),
            status.otherwise("NORMAL").alias("alert_status"),
        )
        .orderBy(F.col("prediction_date").desc())
    )


# Ad-hoc questions ----------------------------------------------------------
def care_management_list(df: DataFrame, as_of: datetime, region: str | None = None) -> DataFrame:
    """High-risk rows scored since ``as_of``, highest first."""
    rows = _high_risk(df, 0, as_of)
    if region is not None:
        rows = rows.where(F.col("region") == region)
    return rows.select("customer_id", SCORE, "risk_category", "region").orderBy(
        F.col(SCORE).desc(), "customer_id"
    )


def region_category_matrix(df: DataFrame, as_of: datetime, days: int = 30) -> DataFrame:
    return (
        recent(df, days, as_of)
        .groupBy("patient_region", "risk_category")
        .agg(n_rows().alias("patient_count"), F.avg(SCORE).alias("avg_risk_score"))
        .orderBy("patient_region", F.col("avg_risk_score").desc())
    )


def patient_journey(dim: DataFrame, features: DataFrame, predictions: DataFrame) -> DataFrame:
    """Dimension, features and scores of every patient.

    Dimension and features share one key and are joined first, so the log is
    shuffled once.
    """
    d = dim.select(
        F.col("patient_natural_key").alias("customer_id"),
        "patient_age_category",
        "patient_smoking_status",
    )
    f = features.select("customer_id", "age_risk_score", "health_risk_composite")
    p = predictions.select(
        "customer_id", "prediction_timestamp", "prediction", SCORE, "risk_category"
    )
    return p.join(d.join(f, "customer_id"), "customer_id")


def missing_predictions(
    dim: DataFrame, features: DataFrame, predictions: DataFrame
) -> DataFrame:
    """Current patients without a score, and whether their features exist."""
    scored = predictions.select("customer_id").distinct()
    patients = dim.where("is_current_record").select(
        F.col("patient_natural_key").alias("customer_id")
    )
    known = features.select("customer_id", F.lit(True).alias("has_features"))
    return (
        patients.join(scored, "customer_id", "left_anti")
        .join(known, "customer_id", "left")
        .select("customer_id", F.coalesce("has_features", F.lit(False)).alias("has_features"))
    )


def _newest(df: DataFrame) -> list[Column]:
    order = [F.col("prediction_timestamp").desc()]
    return order + ([F.col("event_id").desc()] if "event_id" in df.columns else [])


def latest_prediction(df: DataFrame) -> DataFrame:
    return top_rows(df, ["customer_id"], _newest(df), 1)


def risk_transitions(df: DataFrame) -> DataFrame:
    """Patients whose latest category differs from the one before."""
    ranked = top_rows(df, ["customer_id"], _newest(df), 2, rank="_rank")

    def at(rank: int, column: str) -> Column:
        return F.max(F.when(F.col("_rank") == rank, F.col(column)))

    return (
        ranked.groupBy("customer_id")
        .agg(
            at(2, "risk_category").alias("previous_category"),
            at(1, "risk_category").alias("current_category"),
            at(2, SCORE).alias("previous_score"),
            at(1, SCORE).alias("current_score"),
            at(1, "prediction_timestamp").alias("changed_at"),
        )
        .where(F.col("previous_category") != F.col("current_category"))
    )


def prediction_volume_by_version(df: DataFrame) -> DataFrame:
    return df.groupBy(
        F.to_date("prediction_timestamp").alias("prediction_date"), "model_version"
    ).agg(n_rows().alias("prediction_count"))


def score_statistics(df: DataFrame, approx: bool = False) -> DataFrame:
    median = quantiles(df, SCORE, [0.5], ["median"], approx=approx)
    return df.agg(
        F.avg(SCORE).alias("avg_score"),
        F.min(SCORE).alias("min_score"),
        F.max(SCORE).alias("max_score"),
    ).withColumn("median_score", one_value(median, "median"))


def source_freshness(dim: DataFrame, as_of: datetime, stale_hours: int = 48) -> DataFrame:
    """Current rows per update day and whether that day is stale."""
    stamp = F.col("dimension_last_updated")
    moment = time_literal(dim, "dimension_last_updated", as_of)
    hours = F.timestamp_diff("SECOND", F.max(stamp), moment) / F.lit(3600.0)
    return (
        dim.where("is_current_record")
        .groupBy(F.to_date(stamp).alias("update_date"))
        .agg(n_rows().alias("record_count"), hours.alias("hours_since_update"))
        .withColumn("is_stale", F.col("hours_since_update") > stale_hours)
        .orderBy(F.col("update_date").desc())
    )


def source_null_check(dim: DataFrame) -> DataFrame:
    return dim.where("is_current_record").agg(
        n_rows().alias("total_records"),
        F.count_if(F.col("patient_age_category").isNull()).alias("null_age"),
        F.count_if(F.col("bmi").isNull()).alias("null_bmi"),
        F.count_if(F.col("patient_smoking_status").isNull()).alias("null_smoking"),
    )


def recent_volume_check(df: DataFrame, as_of: datetime) -> DataFrame:
    rows = lookback_scan(df, 1, as_of)
    hour = time_literal(rows, "prediction_timestamp", as_of - timedelta(hours=1))
    return rows.agg(
        F.count_if(F.col("prediction_timestamp") >= hour).alias("last_hour_predictions"),
        n_rows().alias("last_day_predictions"),
    )


def actual_vs_predicted_by_region(df: DataFrame, label: str = "health_risk_score") -> DataFrame:
    actual, predicted = F.avg(label), F.avg(SCORE)
    return df.groupBy("patient_region").agg(
        n_rows().alias("count"),
        actual.alias("avg_actual_risk"),
        predicted.alias("avg_predicted_risk"),
        (predicted - actual).alias("avg_gap"),
    )


def smokers_high_bmi_regional_top(
    df: DataFrame, k: int = 10, smoker_label: str = SMOKER_LABEL, bmi: float = 30
) -> DataFrame:
    """Highest scores per region among smokers with a high BMI."""
    rows = normalize_predictions(df).where(
        (F.col("smoking_status") == smoker_label) & (F.col("bmi") > bmi)
    )
    order = [F.col(SCORE).desc(), F.col("customer_id"), *_newest(df)]
    return top_rows(rows, ["region"], order, k, rank="regional_rank").select(
        "region", "regional_rank", "customer_id", "bmi", SCORE, "risk_category"
    )


