"""Profiles, summaries, alerts and retraining decisions.

These jobs stand in for a managed monitoring service: each produces a plain
metric table that can be appended to a history.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.stats import (
    cv,
    merged_mean,
    merged_std,
    moments,
    n_rows,
    one_row,
    one_row,
    one_value,
    pct_change,
    pct_of,
    quantiles,
    ratio,
)
from riskloom.operators.checks import check, check_rows, within
from riskloom.operators.segments import ALL, cells_of, facts, segments
from riskloom.sources.tables import lookback_scan, time_range

SCORE = "adjusted_prediction"
GRANULARITIES = {"1 day": "day", "1 week": "week"}
# Fixed values.
RETRAIN_PSI = 0.4
RETRAIN_PSI_WITH_ACCURACY = 0.25
RETRAIN_ACCURACY = 0.60
MAX_SILENT_HOURS = 2
MIN_DAILY_VOLUME = 50


def window_start(stamp: str, unit: str) -> Column:
    return F.to_date(F.date_trunc(unit, stamp))


def _granular(df: DataFrame, stamp: str) -> DataFrame:
    """Each row once per granularity."""
    pairs = [
        F.struct(
            F.lit(name).alias("granularity"), window_start(stamp, unit).alias("window_start")
        )
        for name, unit in GRANULARITIES.items()
    ]
    return df.select("*", F.inline(F.array(*pairs)))


def profile_inference(
    df: DataFrame, stamp: str = "prediction_timestamp", approx: bool = False
) -> DataFrame:
    """Score profile per day and per week of each model.

    Weekly figures are merged from the daily ones; only the quantiles need the
    rows themselves.
    """
    keys = ["granularity", "window_start", "model_name"]
    daily = df.groupBy("model_name", window_start(stamp, "day").alias("_day")).agg(
        n_rows().alias("rows"),
        F.count_if(F.col("prediction").isNull()).alias("nulls"),
        *moments(SCORE),
    )
    merged = (
        _granular(daily, "_day")
        .groupBy(*keys)
        .agg(
            F.sum("rows").alias("prediction_count"),
            merged_mean().alias("avg_prediction"),
            merged_std().alias("std_prediction"),
            F.min("min").alias("min_prediction"),
            F.max("max").alias("max_prediction"),
            F.sum("nulls").alias("null_count"),
        )
    )
    q = quantiles(
        _granular(df.select("model_name", stamp, SCORE), stamp),
        SCORE,
        [0.25, 0.5, 0.75],
        ["p25", "p50", "p75"],
        by=keys,
        approx=approx,
    )
    return merged.join(q, keys, "left")


def profile_snapshot(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: nulls, and numeric figures or the number of labels.

    One wide aggregate over the table.  Label columns are told apart by the
    approximate distinct count, whose state does not grow with the data.
    """
    columns = list(columns or df.columns)
    numeric = {
        c
        for c in columns
        if isinstance(df.schema[c].dataType, T.NumericType)
    }
    aggs = [n_rows().alias("_n")]
    for i, c in enumerate(columns):
        x = F.col(c)
        aggs.append(F.count_if(x.isNull()).alias(f"_nulls{i}"))
        if c in numeric:
            x = x.cast("double")
            aggs += [
                F.avg(x).alias(f"_avg{i}"),
                F.stddev_samp(x).alias(f"_std{i}"),
                F.min(x).alias(f"_min{i}"),
                F.max(x).alias(f"_max{i}"),
            ]
        else:
            aggs.append(F.approx_count_distinct(x).alias(f"_labels{i}"))
    none = F.lit(None)

    def figure(c: str, name: str, i: int, kind: str) -> Column:
        there = (c in numeric) == (kind == "double")
        return (F.col(f"_{name}{i}") if there else none).cast(kind)

    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col("_n").alias("total_count"),
            F.col(f"_nulls{i}").alias("null_count"),
            pct_of(F.col(f"_nulls{i}"), F.col("_n")).alias("null_pct"),
            figure(c, "avg", i, "double").alias("avg_value"),
            figure(c, "std", i, "double").alias("std_value"),
            figure(c, "min", i, "double").alias("min_value"),
            figure(c, "max", i, "double").alias("max_value"),
            figure(c, "labels", i, "long").alias("distinct_count"),
        )
        for i, c in enumerate(columns)
    ]
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def profile_time_series(dim: DataFrame, stamp: str = "dimension_last_updated") -> DataFrame:
    """Dimension health per day and week of last update."""
    current = F.col("is_current_record")
    return (
        _granular(dim, stamp)
        .groupBy("granularity", "window_start")
        .agg(
            n_rows().alias("record_count"),
            F.count_if(current).alias("current_records"),
            F.count_if(~current).alias("historical_records"),
            ratio(F.count_if(current), F.count_if(~current)).alias("current_to_historical"),
            F.avg("bmi").alias("avg_bmi"),
            pct_of(F.count_if(F.col("bmi").isNull()), n_rows()).alias("null_bmi_pct"),
        )
    )


SLICES = {
    "region": "patient_region",
    "gender": "patient_gender",
    "smoking": "patient_smoking_status",
    "age": "patient_age_category",
}


def profile_slices(df: DataFrame) -> DataFrame:
    """Profile of the whole log and of every protected group, from one scan."""
    dim = F.col("dimension")
    name = F.when(dim == ALL, F.lit(ALL))
    for short, column in SLICES.items():
        name = name.when(dim == short, column)
    return (
        segments(cells_of(df))
        .where(dim.isin(ALL, *SLICES))
        .select(
            name.alias("slice_key"),
            F.col("level").alias("slice_value"),
            F.col("rows").alias("prediction_count"),
            F.col("avg_risk").alias("avg_prediction"),
            F.col("std_risk").alias("std_prediction"),
            F.col("min_risk").alias("min_prediction"),
            F.col("max_risk").alias("max_prediction"),
            F.col("high_pct").alias("high_risk_pct"),
        )
    )


def latest_metrics(
    history: DataFrame, limit: int, stamp: str = "metric_timestamp", ties: Sequence[str] = ()
) -> DataFrame:
    return history.orderBy(F.col(stamp).desc(), *ties).limit(limit)


def metric_history(
    history: DataFrame, days: int, as_of: datetime, stamp: str = "metric_timestamp"
) -> DataFrame:
    """Dated rows of the last days, newest first."""
    return (
        lookback_scan(history, days, as_of, stamp)
        .withColumn("metric_date", F.to_date(stamp))
        .orderBy(F.col(stamp).desc())
    )


def monitoring_summary(
    business: DataFrame, fairness: DataFrame, drift: DataFrame, monitors_active: int
) -> DataFrame:
    """One history row from the run's three reports."""
    violations = fairness.agg(
        F.count_if("fairness_threshold_violation").alias("n")
    )
    drifted = drift.agg(F.count_if("requires_action").alias("n"))
    return business.select(
        "metric_timestamp",
        "total_predictions",
        "high_risk_percentage",
        "daily_avg_predictions",
        "mean_prediction",
        one_value(violations, "n").alias("fairness_violations"),
        one_value(drifted, "n").alias("significant_drift_count"),
        F.lit(monitors_active).alias("monitors_active"),
    )


def daily_monitoring_history(
    business: DataFrame, fairness: DataFrame, drift: DataFrame
) -> DataFrame:
    """Summary rows per day from reports computed per ``metric_date``."""
    drifted = drift.groupBy(F.col("window_start").alias("metric_date")).agg(
        F.count_if("requires_action").alias("significant_drift_count")
    )
    flags = fairness.select(
        "metric_date", F.col("fairness_threshold_violation").cast("int").alias("fairness_violations")
    )
    return (
        business.select(
            "metric_date",
            "total_predictions",
            "high_risk_percentage",
            "mean_prediction",
        )
        .join(flags, "metric_date", "left")
        .join(drifted, "metric_date", "left")
        .withColumns(
            {
                "fairness_violations": F.coalesce("fairness_violations", F.lit(0)),
                "significant_drift_count": F.coalesce("significant_drift_count", F.lit(0)),
            }
        )
    )


def alert_history(
    history: DataFrame, days: int, as_of: datetime, min_volume: int = MIN_DAILY_VOLUME
) -> DataFrame:
    """First matching alert per day: fairness, then drift, then volume."""
    kind = (
        F.when(F.col("fairness_violations") > 0, "FAIRNESS")
        .when(F.col("significant_drift_count") > 0, "DRIFT")
        .when(F.col("total_predictions") < min_volume, "VOLUME")
        .otherwise("OK")
    )
    return (
        lookback_scan(history, days, as_of, "metric_date")
        .select(
            "metric_date",
            kind.alias("alert_type"),
            F.col("total_predictions").alias("daily_predictions"),
            "fairness_violations",
            "significant_drift_count",
        )
        .orderBy(F.col("metric_date").desc())
    )


def volume_by_slot(
    predictions: DataFrame, first: datetime, last: datetime, unit: str = "HOUR"
) -> DataFrame:
    """Rows of every hour (or ``unit="DAY"``) from ``first`` to before ``last``; slots
    without rows are there with a zero."""
    stamp = "prediction_timestamp"
    counts = (
        time_range(predictions, stamp, first, last)
        .groupBy(F.date_trunc(unit, stamp).cast("timestamp_ntz").alias("slot"))
        .agg(n_rows().alias("row_count"))
    )
    ends = [F.lit(m.isoformat(sep=" ")).cast("timestamp_ntz") for m in (first, last)]
    slots = F.sequence(F.date_trunc(unit, ends[0]).cast("timestamp_ntz"), ends[1], F.expr(f"INTERVAL 1 {unit}"))
    calendar = predictions.sparkSession.range(1).select(F.explode(slots).alias("slot"))
    return (
        calendar.where(F.col("slot") < ends[1]).join(counts, "slot", "left")
        .select("slot", F.coalesce("row_count", F.lit(0)).alias("row_count"))
    )


def silence_alerts(
    predictions: DataFrame, first: datetime, last: datetime, hours: int = MAX_SILENT_HOURS
) -> DataFrame:
    """Spells of more than ``hours`` whole hours without any row."""
    # One row per hour of the period.
    order = Window.partitionBy(F.lit(0)).orderBy("slot")
    numbered = volume_by_slot(predictions, first, last).withColumn("n", F.row_number().over(order))
    spell = F.col("n") - F.row_number().over(order)
    return (
        numbered.where("row_count = 0").withColumn("spell", spell)
        .groupBy("spell").agg(F.min("slot").alias("silent_from"), n_rows().alias("silent_hours"))
        .where(F.col("silent_hours") > hours)
        .select("silent_from", "silent_hours")
    )


def low_volume_days(
    predictions: DataFrame, first: datetime, last: datetime, min_volume: int = MIN_DAILY_VOLUME
) -> DataFrame:
    """Days below the least daily volume, days without rows among them."""
    days = volume_by_slot(predictions, first, last, "DAY")
    return days.where(F.col("row_count") < min_volume).select(
        F.col("slot").cast("date").alias("metric_date"), "row_count"
    )


def custom_alerts(fairness: DataFrame, drift: DataFrame) -> DataFrame:
    """A row per fairness violation and per drifted column."""
    unfair = fairness.where("fairness_threshold_violation").select(
        F.lit("FAIRNESS").alias("alert_type"),
        F.lit("threshold_violation").alias("subject"),
        F.lit(None).cast("double").alias("value"),
    )
    drifted = drift.where("requires_action").select(
        F.lit("DRIFT").alias("alert_type"),
        F.col("column_name").alias("subject"),
        F.col("psi_score").alias("value"),
    )
    return unfair.unionByName(drifted)


@dataclass(frozen=True)
class Threshold:
    name: str
    metric: str
    above: bool
    limit: float
    severity: str


# The complete threshold reference.  Severities of the last three
# are this library's choice.
THRESHOLDS = (
    Threshold("min_daily_predictions", "min_daily_predictions", False, 50, "MEDIUM"),
    Threshold("max_null_rate", "null_rate", True, 0.05, "MEDIUM"),
    Threshold("psi_moderate", "psi", True, 0.1, "LOW"),
    Threshold("psi_significant", "psi", True, 0.25, "HIGH"),
    Threshold("psi_critical", "psi", True, 0.4, "CRITICAL"),
    Threshold("kl_divergence_max", "kl", True, 0.3, "MEDIUM"),
    Threshold("fairness_disparity_moderate", "disparity", True, 0.10, "LOW"),
    Threshold("fairness_disparity_significant", "disparity", True, 0.15, "HIGH"),
    Threshold("fairness_disparity_critical", "disparity", True, 0.25, "CRITICAL"),
    Threshold("high_risk_percentage_max", "high_risk_pct", True, 30.0, "MEDIUM"),
    Threshold("critical_risk_percentage_max", "critical_pct", True, 20.0, "HIGH"),
    Threshold("confidence_width_max", "confidence_width", True, 25.0, "MEDIUM"),
    Threshold("high_risk_accuracy_min", "high_risk_accuracy", False, 0.60, "HIGH"),
    Threshold("r2_score_min", "r2_score", False, 0.70, "HIGH"),
    Threshold("mae_max", "mae", True, 15.0, "HIGH"),
)


def monitored_metrics(
    df: DataFrame, fairness: DataFrame, drift: DataFrame, quality: DataFrame
) -> DataFrame:
    """The figures the thresholds refer to, as one row.

    ``fairness`` has one row per attribute, ``drift`` one per column and
    ``quality`` one for the serving version.
    """
    worst = fairness.agg(F.max("disparity").alias("d"))
    moved = drift.agg(F.max("psi_score").alias("psi"), F.max("kl_divergence").alias("kl"))
    frames = {"_moved": one_row(moved), "_quality": one_row(quality), "disparity": one_value(worst, "d")}
    return facts(cells_of(df)).withColumns(frames).select(
        F.col("day_min_rows").cast("double").alias("min_daily_predictions"),
        ratio(F.col("raw_null_n"), F.col("total")).alias("null_rate"),
        "_moved.psi",
        "_moved.kl",
        "disparity",
        F.col("high_pct").alias("high_risk_pct"),
        "critical_pct",
        F.col("avg_width").alias("confidence_width"),
        *[f"_quality.{c}" for c in ("high_risk_accuracy", "r2_score", "mae")],
    )


def alert_thresholds_eval(
    metrics: DataFrame, thresholds: Sequence[Threshold] = THRESHOLDS
) -> DataFrame:
    """One row per threshold; an unknown figure triggers nothing."""
    rows = []
    for t in thresholds:
        value, limit = F.col(t.metric), F.lit(float(t.limit))
        crossed = value > limit if t.above else value < limit
        rows.append(
            F.struct(
                F.lit(t.name).alias("threshold"),
                value.cast("double").alias("metric_value"),
                limit.alias("limit_value"),
                F.lit(t.severity).alias("severity"),
                F.coalesce(crossed, F.lit(False)).alias("triggered"),
            )
        )
    return metrics.select(F.inline(F.array(*rows)))


def should_retrain(drift: DataFrame, quality: DataFrame, fairness: DataFrame) -> DataFrame:
    """Decision and reason; the first rule that matches wins."""
    psi = one_value(drift.agg(F.max("psi_score").alias("p")), "p")
    accuracy = one_value(quality, "high_risk_accuracy")
    row = fairness.agg(
        F.coalesce(F.bool_or("fairness_threshold_violation"), F.lit(False)).alias("_unfair")
    ).select("_unfair", psi.alias("max_psi"), accuracy.alias("high_risk_accuracy"))
    critical = F.col("max_psi") > RETRAIN_PSI
    degraded = (F.col("max_psi") > RETRAIN_PSI_WITH_ACCURACY) & (
        F.col("high_risk_accuracy") < RETRAIN_ACCURACY
    )
    # Reasons.
    reason = (
        F.when(critical, "Critical drift detected (PSI > 0.4)")
        .when(degraded, "Drift + performance degradation")
        .when(F.col("_unfair"), "Fairness threshold violated")
        .otherwise("All metrics within acceptable range")
    )
    return row.select(
        F.coalesce(critical | degraded | F.col("_unfair"), F.col("_unfair")).alias("retrain"),
        reason.alias("reason"),
        "max_psi",
        "high_risk_accuracy",
    )


# Limits of the figures to track.
DAILY_COUNT = (35_000, 45_000)
NULL_PCT_MAX = 5.0
HIGH_RISK_SHIFT = 10.0
AVG_SHIFT = 5.0


def kpi_track_thresholds(
    baseline: DataFrame,
    current: DataFrame,
    daily_count: tuple[int, int] = DAILY_COUNT,
) -> DataFrame:
    """Tracked figures of a day against a baseline period."""

    def one(df: DataFrame) -> DataFrame:
        return df.agg(
            n_rows().alias("n"),
            pct_of(F.count_if(F.col("prediction").isNull()), n_rows()).alias("null_pct"),
            pct_of(F.count_if("high_risk_patient"), n_rows()).alias("high_pct"),
            F.avg(SCORE).alias("avg_score"),
        )

    base = one(baseline)
    row = one(current).withColumns(
        {
            "_high": one_value(base, "high_pct"),
            "_avg": one_value(base, "avg_score"),
        }
    )
    shift = pct_change(F.col("high_pct"), F.col("_high"))
    drift = F.col("avg_score") - F.col("_avg")
    name = "Tracked KPIs"
    return check_rows(
        row,
        [
            check(
                name,
                "daily_prediction_count",
                within(F.col("n"), daily_count),
                F.col("n"),
                float(daily_count[0]),
                float(daily_count[1]),
            ),
            check(
                name,
                "null_rate_pct",
                F.when(F.col("null_pct") < NULL_PCT_MAX, "PASS").otherwise("FAIL"),
                F.col("null_pct"),
                None,
                NULL_PCT_MAX,
            ),
            check(
                name,
                "high_risk_rate_shift_pct",
                within(shift, (-HIGH_RISK_SHIFT, HIGH_RISK_SHIFT)),
                shift,
                -HIGH_RISK_SHIFT,
                HIGH_RISK_SHIFT,
            ),
            check(
                name,
                "average_score_shift",
                within(drift, (-AVG_SHIFT, AVG_SHIFT)),
                drift,
                -AVG_SHIFT,
                AVG_SHIFT,
            ),
        ],
    )


# Fixed values.
REGION_SHARE_MIN = 5.0
REGION_VARIANCE_MAX = 15.0
REGION_RATE_GAP_MAX = 10.0


def new_provider_coverage(df: DataFrame) -> DataFrame:
    """Per region: share of the log, and the regional variance and rate gap alerts."""
    by_region = segments(cells_of(df)).where(F.col("dimension") == "region")
    everything = Window.partitionBy("dimension")
    variance = (
        cv(F.stddev_samp("avg_risk").over(everything), F.avg("avg_risk").over(everything)) * 100
    )
    gap = F.max("high_pct").over(everything) - F.min("high_pct").over(everything)
    share = pct_of(F.col("rows"), F.sum("rows").over(everything))
    return by_region.select(
        F.col("level").alias("region"),
        F.col("rows").alias("prediction_count"),
        share.alias("share_pct"),
        F.coalesce(share < REGION_SHARE_MIN, F.lit(False)).alias("low_coverage"),
        variance.alias("regional_variance_pct"),
        F.coalesce(variance > REGION_VARIANCE_MAX, F.lit(False)).alias("variance_alert"),
        gap.alias("high_risk_rate_gap"),
        F.coalesce(gap > REGION_RATE_GAP_MAX, F.lit(False)).alias("rate_gap_alert"),
    )
