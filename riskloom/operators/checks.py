"""Validation checks.

Every check compares figures of one facts row (see ``segments.facts``) with
thresholds, so any number of checks costs one scan of the log.  Check rows
share one schema: category, check_name, status, value, target_lo, target_hi.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions import rules
from riskloom.functions.stats import n_rows, one_value, pct, pct_of
from riskloom.operators.segments import age_position, cells_of, facts, segments
from riskloom.sources.tables import current_records

SCORE = "adjusted_prediction"


# Each report has its own bands for the same figure.
@dataclass(frozen=True)
class BusinessBands:
    high_risk: tuple[float, float] = (5.0, 25.0)
    avg_risk: tuple[float, float] = (20.0, 60.0)
    min_volume: int = 100
    low_medium_min: float = 60.0
    disparity_max: float = 20.0
    gender_gap_max: float = 10.0
    cv_good: float = 10.0
    cv_fair: float = 20.0


@dataclass(frozen=True)
class InferenceBands:
    high_risk: tuple[float, float] = (5.0, 30.0)
    critical_max: float = 10.0
    low_min: float = 30.0
    smoker_high_min: float = 30.0
    score_range: tuple[float, float] = (0.0, 200.0)


@dataclass(frozen=True)
class ReportBands:
    high_risk: tuple[float, float] = (5.0, 25.0)
    low_min: float = 30.0
    critical_max: float = 10.0
    disparity: tuple[float, float] = (15.0, 25.0)
    gender_gap: tuple[float, float] = (8.0, 15.0)


@dataclass(frozen=True)
class Roi:
    cost_per_patient: float = 500.0
    success_rate: float = 0.30
    value_per_claim: float = 5000.0
    monthly_cost: float = 2000.0
    days_per_month: float = 30.0


REQUIRED_COLUMNS = (
    "patient_natural_key",
    "patient_gender",
    "patient_region",
    "patient_age_category",
    "bmi",
    "patient_smoking_status",
    "is_current_record",
    "number_of_dependents",
)
CRITICAL_COLUMNS = ("patient_natural_key", "patient_gender", "bmi", "patient_smoking_status")
BMI_RANGE = (10.0, 80.0)
PASSING = ("PASS", "EXCELLENT", "GOOD")
WARNING = ("WARN", "MARGINAL")
FAILING = ("FAIL", "NEGATIVE")
# --------------------------------------------------------------------------


def facts_of(df: DataFrame, age_order: str = "clinical") -> DataFrame:
    return facts(cells_of(df), age_order)


def check(
    category: str,
    name: str,
    status: Column,
    value: Column,
    low: float | None = None,
    high: float | None = None,
) -> Column:
    def bound(x: float | None) -> Column:
        return F.lit(x).cast("double")

    return F.struct(
        F.lit(category).alias("category"),
        F.lit(name).alias("check_name"),
        status.alias("status"),
        value.cast("double").alias("value"),
        bound(low).alias("target_lo"),
        bound(high).alias("target_hi"),
    )


def check_rows(one_row: DataFrame, checks: Sequence[Column]) -> DataFrame:
    """Check rows of a facts row; a check without a status did not apply."""
    return one_row.select(F.inline(F.array(*checks))).where(F.col("status").isNotNull())


def within(value: Column, bounds: tuple[float, float], bad: str = "FAIL") -> Column:
    ok = (value >= bounds[0]) & (value <= bounds[1])
    return F.when(ok, "PASS").otherwise(bad)


# Status rules over the columns of a facts row ------------------------------
def smoking_status() -> Column:
    smoker, other = F.col("smoker_avg"), F.col("non_smoker_avg")
    return F.when(smoker > other, "PASS").when(smoker <= other, "FAIL")


def bmi_status() -> Column:
    obese, normal = F.col("obese_avg"), F.col("normal_avg")
    return F.when(obese > normal, "PASS").when(obese <= normal, "FAIL")


def age_status() -> Column:
    return F.when(F.col("age_monotonic"), "PASS").otherwise("WARN")


def low_medium_pct() -> Column:
    return F.col("low_pct") + F.col("medium_pct")


def regional_status(limit: float) -> Column:
    value = F.col("region_disparity")
    return F.when(F.col("region_levels") > 1, F.when(value <= limit, "PASS").otherwise("WARN"))


def gender_status(limit: float) -> Column:
    return F.when(
        F.col("gender_levels") == 2,
        F.when(F.col("gender_gap") <= limit, "PASS").otherwise("WARN"),
    )


def stability_status(bands: BusinessBands) -> Column:
    value = F.col("day_cv")
    return (
        F.when(F.col("days") <= 1, "INSUFFICIENT_DATA")
        .when(value < bands.cv_good, "PASS")
        .when(value < bands.cv_fair, "WARN")
        .otherwise("FAIL")
    )


def graded(value: Column, bands: tuple[float, float], labels: tuple[str, str, str]) -> Column:
    return (
        F.when(value <= bands[0], labels[0]).when(value <= bands[1], labels[1]).otherwise(labels[2])
    )


def roi_columns(high_risk: Column, roi: Roi, operating_days: int | None = None) -> dict[str, Column]:
    """Cost, value, net and return; operating cost only when days are given."""
    intervention = high_risk * F.lit(roi.cost_per_patient)
    operating = (
        0.0 if operating_days is None else roi.monthly_cost * operating_days / roi.days_per_month
    )
    cost = intervention + F.lit(operating)
    value = high_risk * F.lit(roi.success_rate) * F.lit(roi.value_per_claim)
    net = value - cost
    return {
        "intervention_costs": intervention,
        "total_costs": cost,
        "prevented_claims_value": value,
        "net_benefit": net,
        "roi_pct": F.when(cost > 0, net / cost * 100).otherwise(0.0),
    }


def roi_status(value: Column) -> Column:
    return (
        F.when(value > 100, "EXCELLENT")
        .when(value > 50, "GOOD")
        .when(value > 0, "MARGINAL")
        .otherwise("NEGATIVE")
    )


# Source checks -------------------------------------------------------------
def required_columns_check(
    dim: DataFrame, columns: Sequence[str] = REQUIRED_COLUMNS
) -> DataFrame:
    """Presence of each required column, and how many values it holds."""
    present = [c for c in columns if c in dim.columns]
    counted = dim.agg(n_rows().alias("_n"), *[F.count(c).alias(c) for c in present])
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(c in present).alias("present"),
            (F.col(c) if c in present else F.lit(0).cast("long")).alias("value_count"),
            F.lit("SUCCESS" if c in present else "FAILED").alias("status"),
        )
        for c in columns
    ]
    return counted.select(F.inline(F.array(*rows)))


def schema_change_check(df: DataFrame, expected: Mapping[str, str]) -> DataFrame:
    """Columns that were added, removed or changed in type against a stored schema
    (name to type), with the number of values that a column holds now."""
    now = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    kinds = {c: "ADDED" for c in now if c not in expected}
    kinds |= {c: "REMOVED" for c in expected if c not in now}
    kinds |= {c: "RETYPED" for c in now if c in expected and now[c] != expected[c]}
    counted = df.agg(n_rows().alias("_n"), *[F.count(c).alias(c) for c in kinds if c in now])
    none = F.lit(None).cast("string")
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(kind).alias("change"),
            (F.lit(expected[c]) if c in expected else none).alias("expected_type"),
            (F.lit(now[c]) if c in now else none).alias("current_type"),
            (F.col(c) if c in now else F.lit(0).cast("long")).alias("value_count"),
        )
        for c, kind in sorted(kinds.items())
    ]
    schema = "array<struct<column_name:string,change:string,expected_type:string,current_type:string,value_count:bigint>>"
    return counted.select(F.inline(F.array(*rows).cast(schema)))


def null_checks(dim: DataFrame, columns: Sequence[str] = CRITICAL_COLUMNS) -> DataFrame:
    counted = current_records(dim).agg(
        *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    )
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(c).alias("null_count"),
            F.when(F.col(c) > 0, "WARN").otherwise("PASS").alias("status"),
        )
        for c in columns
    ]
    return counted.select(F.inline(F.array(*rows)))


def bmi_range_check(dim: DataFrame, bounds: tuple[float, float] = BMI_RANGE) -> DataFrame:
    low, high = F.min("bmi"), F.max("bmi")
    return current_records(dim).agg(
        low.alias("min_bmi"),
        high.alias("max_bmi"),
        F.avg("bmi").alias("avg_bmi"),
        F.when((low < bounds[0]) | (high > bounds[1]), "WARN").otherwise("PASS").alias("status"),
    )


def data_validation_summary(probe: DataFrame) -> DataFrame:
    """SUCCESS if no probed table failed."""
    failed = F.count_if(F.col("status") == "FAILED")
    return probe.agg(
        F.when(failed > 0, "FAILED").otherwise("SUCCESS").alias("status"),
        (n_rows() - failed).alias("validated_tables"),
        failed.alias("failed_tables"),
        F.sum("row_count").alias("total_rows"),
    )


# Inference checks ----------------------------------------------------------
def inference_quality(batch: DataFrame, bands: InferenceBands = InferenceBands()) -> DataFrame:
    """Nulls must not occur; raw nulls are shown because the floor hides them."""
    score = F.col(SCORE)
    low, high = F.min(score), F.max(score)
    nulls = F.count_if(score.isNull())
    return batch.agg(
        n_rows().alias("prediction_count"),
        nulls.alias("null_count"),
        F.count_if(F.col("prediction").isNull()).alias("raw_null_count"),
        low.alias("min_pred"),
        high.alias("max_pred"),
        F.avg(score).alias("avg_pred"),
        F.stddev_samp(score).alias("std_pred"),
        F.when((nulls > 0) | (n_rows() == 0), "FAILED").otherwise("PASS").alias("null_status"),
        F.when((low < bands.score_range[0]) | (high > bands.score_range[1]), "WARN")
        .otherwise("PASS")
        .alias("range_status"),
    )


def inference_kpis(batch: DataFrame, bands: InferenceBands = InferenceBands()) -> DataFrame:
    high = F.col("high_pct")
    lo, hi = bands.high_risk
    low_pct, critical = F.col("low_pct"), F.col("critical_pct")
    status = F.when(high < lo, "LOW").when(high > hi, "HIGH").otherwise("PASS")
    return check_rows(
        facts_of(batch),
        [
            check("Inference KPIs", "high_risk_pct", status, high, lo, hi),
            check(
                "Inference KPIs",
                "critical_pct",
                F.when(critical > bands.critical_max, "HIGH").otherwise("PASS"),
                critical,
                None,
                bands.critical_max,
            ),
            check(
                "Inference KPIs",
                "low_pct",
                F.when(low_pct < bands.low_min, "LOW").otherwise("PASS"),
                low_pct,
                bands.low_min,
                None,
            ),
        ],
    )


def smoker_high_risk_rate(
    batch: DataFrame,
    smoker_label: str = rules.SMOKER_LABEL,
    bands: InferenceBands = InferenceBands(),
) -> DataFrame:
    high = F.col("high_risk_patient")
    rate = pct(high)
    return (
        batch.where(F.col("patient_smoking_status") == smoker_label)
        .agg(
            n_rows().alias("smoker_count"),
            F.count_if(high).alias("smoker_high_risk_count"),
            rate.alias("smoker_high_risk_pct"),
        )
        .withColumn(
            "status",
            F.when(F.col("smoker_high_risk_pct") < bands.smoker_high_min, "WARN").when(
                F.col("smoker_count") > 0, "PASS"
            ),
        )
    )


def age_monotonic_check(df: DataFrame, order: str = "clinical") -> DataFrame:
    """Mean risk per age category against the one before, by age or by label."""
    by_age = segments(cells_of(df)).where(F.col("dimension") == "age")
    window = Window.partitionBy("dimension").orderBy(age_position(order), "level")
    everything = Window.partitionBy("dimension")
    falls = F.coalesce(F.col("avg_risk") < F.col("previous_avg_risk"), F.lit(False))
    return (
        by_age.withColumn("previous_avg_risk", F.lag("avg_risk").over(window))
        .withColumn("age_monotonic", ~F.bool_or(falls).over(everything))
        .select(
            F.col("level").alias("patient_age_category"),
            "avg_risk",
            F.col("rows").alias("patient_count"),
            "previous_avg_risk",
            "age_monotonic",
        )
    )


# Business validation -------------------------------------------------------
def business_kpis(df: DataFrame, bands: BusinessBands = BusinessBands()) -> DataFrame:
    f = facts_of(df)
    return f.select(
        F.col("total").alias("total_predictions"),
        F.col("avg_risk").alias("avg_risk_score"),
        F.col("std_risk").alias("risk_score_std"),
        "min_risk",
        "max_risk",
        F.col("high_pct").alias("high_risk_pct"),
        F.col("avg_lower").alias("avg_ci_lower"),
        F.col("avg_upper").alias("avg_ci_upper"),
        within(F.col("high_pct"), bands.high_risk).alias("high_risk_status"),
        within(F.col("avg_risk"), bands.avg_risk).alias("avg_risk_status"),
        F.when(F.col("total") >= bands.min_volume, "PASS").otherwise("FAIL").alias("volume_status"),
    )


def smoking_validity(df: DataFrame) -> DataFrame:
    return facts_of(df).select("smoker_avg", "non_smoker_avg", smoking_status().alias("status"))


def bmi_validity(df: DataFrame) -> DataFrame:
    return facts_of(df).select("obese_avg", "normal_avg", bmi_status().alias("status"))


def risk_distribution_validity(
    df: DataFrame, bands: BusinessBands = BusinessBands()
) -> DataFrame:
    share = low_medium_pct()
    return facts_of(df).select(
        share.alias("low_medium_pct"),
        F.when(share >= bands.low_medium_min, "PASS").otherwise("WARN").alias("status"),
    )


def regional_equity_check(
    df: DataFrame,
    bands: BusinessBands = BusinessBands(),
    report: ReportBands = ReportBands(),
) -> DataFrame:
    value = F.col("region_disparity")
    return facts_of(df).select(
        F.col("region_max").alias("max_regional_risk"),
        F.col("region_min").alias("min_regional_risk"),
        value.alias("regional_disparity"),
        regional_status(bands.disparity_max).alias("status"),
        F.when(
            F.col("region_levels") > 1,
            graded(value, report.disparity, ("EXCELLENT", "ACCEPTABLE", "HIGH")),
        ).alias("report_band"),
    )


def gender_equity_check(
    df: DataFrame,
    bands: BusinessBands = BusinessBands(),
    report: ReportBands = ReportBands(),
) -> DataFrame:
    value = F.when(F.col("gender_levels") == 2, F.col("gender_gap"))
    return facts_of(df).select(
        F.col("gender_levels").alias("gender_groups"),
        value.alias("gender_disparity"),
        gender_status(bands.gender_gap_max).alias("status"),
        F.when(
            value.isNotNull(),
            graded(value, report.gender_gap, ("EXCELLENT", "ACCEPTABLE", "REVIEW")),
        ).alias("report_band"),
    )


def temporal_stability(df: DataFrame, bands: BusinessBands = BusinessBands()) -> DataFrame:
    """Spread of the daily means around their mean, population form."""
    return facts_of(df).select(
        F.col("days").alias("active_days"),
        F.col("day_mean").alias("avg_daily_risk"),
        F.col("day_cv").alias("coefficient_of_variation"),
        stability_status(bands).alias("status"),
    )


def roi_with_operating_cost(df: DataFrame, days: int, roi: Roi = Roi()) -> DataFrame:
    counted = df.agg(F.count_if("high_risk_patient").alias("high_risk_patients"))
    figures = counted.withColumns(roi_columns(F.col("high_risk_patients"), roi, days))
    return figures.withColumn("roi_status", roi_status(F.col("roi_pct")))


def business_checks(
    df: DataFrame, days: int, bands: BusinessBands = BusinessBands(), roi: Roi = Roi()
) -> DataFrame:
    """All business validation checks of a period, from one facts row."""
    f = facts_of(df)
    money = roi_columns(F.col("high_n"), roi, days)["roi_pct"]
    lm = low_medium_pct()
    kpi, clinical, equity = "Business KPIs", "Clinical Relevance", "Regional Equity"
    return check_rows(
        f,
        [
            check(
                kpi,
                "high_risk_pct",
                within(F.col("high_pct"), bands.high_risk),
                F.col("high_pct"),
                *bands.high_risk,
            ),
            check(
                kpi,
                "avg_risk",
                within(F.col("avg_risk"), bands.avg_risk),
                F.col("avg_risk"),
                *bands.avg_risk,
            ),
            check(
                kpi,
                "volume",
                F.when(F.col("total") >= bands.min_volume, "PASS").otherwise("FAIL"),
                F.col("total"),
                float(bands.min_volume),
            ),
            check(
                clinical,
                "smoking_correlation",
                smoking_status(),
                F.col("smoker_avg") - F.col("non_smoker_avg"),
                0.0,
            ),
            check(
                clinical, "age_correlation", age_status(), F.col("age_monotonic").cast("int"), 1.0
            ),
            check(
                clinical,
                "bmi_correlation",
                bmi_status(),
                F.col("obese_avg") - F.col("normal_avg"),
                0.0,
            ),
            check(
                clinical,
                "risk_distribution",
                F.when(lm >= bands.low_medium_min, "PASS").otherwise("WARN"),
                lm,
                bands.low_medium_min,
            ),
            check(
                equity,
                "regional_equity",
                regional_status(bands.disparity_max),
                F.col("region_disparity"),
                None,
                bands.disparity_max,
            ),
            check(
                equity,
                "gender_equity",
                gender_status(bands.gender_gap_max),
                F.col("gender_gap"),
                None,
                bands.gender_gap_max,
            ),
            check(
                "Temporal Stability",
                "temporal_stability",
                stability_status(bands),
                F.col("day_cv"),
                None,
                bands.cv_good,
            ),
            check("ROI", "roi_status", roi_status(money), money, 0.0),
        ],
    )


def champion_checks(versions: DataFrame, champion: str) -> DataFrame:
    """Whether the champion exists, and (informational) which version it is."""
    named = versions.agg(
        F.coalesce(F.bool_or(F.col("model_version") == champion), F.lit(False)).alias("_there")
    )
    there = F.col("_there")
    return check_rows(
        named,
        [
            check(
                "Governance",
                "champion_exists",
                F.when(there, "PASS").otherwise("FAIL"),
                there.cast("int"),
                1.0,
            ),
            check(
                "Governance",
                "champion_version",
                F.when(there, "INFO"),
                F.lit(champion).try_cast("double"),
            ),
        ],
    )


def validation_scorecard(checks: DataFrame) -> DataFrame:
    """Counts over check rows.  Informational rows count in the total only."""
    status = F.col("status")
    passed = F.count_if(status.isin(*PASSING))
    warned = F.count_if(status.isin(*WARNING))
    failed = F.count_if(status.isin(*FAILING))
    return checks.agg(
        n_rows().alias("total_checks"),
        passed.alias("passed"),
        warned.alias("warnings"),
        failed.alias("failures"),
        F.when((failed == 0) & (warned == 0), "EXCELLENT")
        .when(failed == 0, "GOOD")
        .when(failed <= 2, "ACCEPTABLE")
        .otherwise("NEEDS_IMPROVEMENT")
        .alias("overall_status"),
    )


def union_checks(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# Executive report ----------------------------------------------------------
def executive_summary(df: DataFrame, roi: Roi = Roi()) -> DataFrame:
    high = F.count_if("high_risk_patient")
    base = df.agg(
        F.count_distinct("patient_natural_key").alias("unique_patients"),
        n_rows().alias("total_predictions"),
        F.avg(SCORE).alias("avg_risk_score"),
        high.alias("high_risk_count"),
        pct_of(high, n_rows()).alias("high_risk_pct"),
    )
    money = roi_columns(F.col("high_risk_count"), roi)
    share, back = F.col("high_risk_pct"), F.col("roi_pct")
    lo, hi = ReportBands().high_risk
    return base.withColumns(
        {k: money[k] for k in ("intervention_costs", "prevented_claims_value", "net_benefit", "roi_pct")}
    ).withColumn(
        "overall_status",
        F.when((back > 100) & (share >= lo) & (share <= hi), "EXCELLENT")
        .when(back > 50, "GOOD")
        .when(back > 0, "ACCEPTABLE")
        .otherwise("NEEDS_IMPROVEMENT"),
    )


def report_quality_metrics(df: DataFrame) -> DataFrame:
    """Interval width only where the columns exist, as the report does."""
    score = F.col(SCORE)
    aggs = {
        "null_pct": pct(score.isNull()),
        "negative_pct": pct(score < 0),
        "outlier_pct": pct(score > 100),
    }
    if "confidence_interval_upper" in df.columns:
        aggs["avg_ci"] = F.avg(
            F.col("confidence_interval_upper") - F.col("confidence_interval_lower")
        )
    out = df.agg(*[c.alias(k) for k, c in aggs.items()])
    null, outlier = F.col("null_pct"), F.col("outlier_pct")
    band = (
        F.when((null < 1) & (outlier < 1), "EXCELLENT")
        .when(null < 5, "ACCEPTABLE")
        .otherwise("ATTENTION")
    )
    return out.withColumns({"completeness_pct": F.lit(100.0) - null, "quality_band": band})


def daily_volume_last7(df: DataFrame, days: int = 7) -> DataFrame:
    """The newest active dates and their average volume."""
    newest = (
        df.groupBy(F.date_format("prediction_timestamp", "yyyy-MM-dd").alias("date"))
        .agg(n_rows().alias("prediction_count"))
        .orderBy(F.col("date").desc())
        .limit(days)
    )
    return newest.withColumn(
        "avg_daily_volume", F.avg("prediction_count").over(Window.partitionBy(F.lit(0)))
    )


def business_performance(df: DataFrame, bands: ReportBands = ReportBands()) -> DataFrame:
    low, high, critical = F.col("low_pct"), F.col("high_pct"), F.col("critical_pct")
    lo, hi = bands.high_risk
    name = "Business Performance"
    return check_rows(
        facts_of(df),
        [
            check(
                name,
                "low_risk_pct",
                F.when(low >= bands.low_min, "PASS").otherwise("LOW"),
                low,
                bands.low_min,
            ),
            check(
                name,
                "high_risk_pct",
                F.when(high < lo, "LOW").when(high > hi, "HIGH").otherwise("PASS"),
                high,
                lo,
                hi,
            ),
            check(
                name,
                "critical_pct",
                F.when(critical < bands.critical_max, "PASS").otherwise("HIGH"),
                critical,
                None,
                bands.critical_max,
            ),
        ],
    )


def intervention_breakdown(df: DataFrame) -> DataFrame:
    return (
        df.where(F.col("high_risk_patient"))
        .groupBy("risk_category")
        .agg(n_rows().alias("count"), F.avg(SCORE).alias("avg_risk"))
        .orderBy(F.col("avg_risk").desc())
    )


def clinical_passes(with_bmi: bool = True) -> list[Column]:
    """A check whose groups are missing counts as not passed."""
    smoking = F.coalesce(smoking_status() == "PASS", F.lit(False))
    bmi = F.coalesce(bmi_status() == "PASS", F.lit(False))
    return [smoking, F.col("age_monotonic")] + ([bmi] if with_bmi else [])


def clinical_scorecard(df: DataFrame, with_bmi: bool = True) -> DataFrame:
    passes = clinical_passes(with_bmi)
    return facts_of(df).select(
        passes[0].alias("smoking_impact"),
        passes[1].alias("age_correlation"),
        *([passes[2].alias("bmi_impact")] if with_bmi else []),
        reduce(lambda a, b: a + b, [p.cast("int") for p in passes]).alias("passed_checks"),
        F.lit(len(passes)).alias("total_checks"),
    )


# Recommendation texts.
ADVICE_RAISE = (
    "Increase high-risk identification threshold to ensure adequate intervention candidates"
)
ADVICE_LOWER = (
    "Review high-risk threshold to prevent alert fatigue and optimize intervention resources"
)
ADVICE_ROI = "Optimize intervention strategy to improve ROI and business value"
ADVICE_AGE = "Review age feature engineering - correlation with risk should be monotonic"
ADVICE_SMOKING = "Smoking feature not properly weighted - recalibrate model"
ADVICE_REGION = "High regional disparity detected - investigate for potential geographic bias"
ADVICE_NULLS = "Address data quality issues - null prediction rate above threshold"
ADVICE_OUTLIERS = "Review outlier predictions to ensure model calibration"
ADVICE_NONE = "No critical issues identified - continue monitoring and optimization"
PRIORITIES = ("HIGH", "MEDIUM", "LOW", "INFO")


def recommendations(
    df: DataFrame, bands: ReportBands = ReportBands(), roi: Roi = Roi()
) -> DataFrame:
    """Action items in order of priority; one INFO row when nothing is wrong."""
    lo, hi = bands.high_risk
    high = F.col("high_pct")
    money = roi_columns(F.col("high_n"), roi)["roi_pct"]
    found = [
        (high < lo, "HIGH", "Business", ADVICE_RAISE),
        (high > hi, "HIGH", "Business", ADVICE_LOWER),
        (money < 50, "HIGH", "Business", ADVICE_ROI),
        (~F.col("age_monotonic"), "MEDIUM", "Clinical", ADVICE_AGE),
        (smoking_status() == "FAIL", "HIGH", "Clinical", ADVICE_SMOKING),
        (
            (F.col("region_levels") > 1) & (F.col("region_disparity") > bands.disparity[1]),
            "MEDIUM",
            "Equity",
            ADVICE_REGION,
        ),
        (F.col("null_pct") > 1, "MEDIUM", "Technical", ADVICE_NULLS),
        (F.col("outlier_pct") > 2, "LOW", "Technical", ADVICE_OUTLIERS),
    ]
    anything = reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c, *_ in found])
    found.append((~anything, "INFO", "Success", ADVICE_NONE))
    rows = [
        F.struct(
            F.coalesce(condition, F.lit(False)).alias("_hit"),
            F.lit(PRIORITIES.index(priority) * 100 + i).alias("_order"),
            F.lit(priority).alias("priority"),
            F.lit(area).alias("area"),
            F.lit(text).alias("recommendation"),
        )
        for i, (condition, priority, area, text) in enumerate(found)
    ]
    return (
        facts_of(df)
        .select(F.inline(F.array(*rows)))
        .where("_hit")
        .orderBy("_order")
        .drop("_hit", "_order")
    )


def final_scorecard(
    df: DataFrame,
    governance: DataFrame,
    bands: ReportBands = ReportBands(),
    roi: Roi = Roi(),
) -> DataFrame:
    """Five category verdicts, their share, and the final grade."""
    status = one_value(governance, "governance_status")
    lo, hi = bands.high_risk
    money = roi_columns(F.col("high_n"), roi)["roi_pct"]
    clinical = reduce(lambda a, b: a + b, [p.cast("int") for p in clinical_passes()])
    verdicts = {
        "technical_validation": (F.col("null_pct") < 1) & (F.col("outlier_pct") < 2),
        "business_performance": F.col("high_pct").between(lo, hi) & (money > 50),
        "clinical_relevance": clinical >= 2,
        "regional_equity": F.when(
            F.col("region_levels") > 1, F.col("region_disparity") <= bands.disparity[1]
        ).otherwise(True),
        "model_governance": F.coalesce(status == "COMPLIANT", F.lit(False)),
    }
    scored = facts_of(df).select(
        *[F.coalesce(v, F.lit(False)).alias(k) for k, v in verdicts.items()]
    )
    passed = reduce(lambda a, b: a + b, [F.col(k).cast("int") for k in verdicts])
    score = passed * F.lit(100.0) / len(verdicts)
    return scored.withColumns(
        {
            "passed_categories": passed,
            "overall_score": score,
            "final_status": F.when(score >= 90, "EXCELLENT")
            .when(score >= 70, "GOOD")
            .when(score >= 50, "ACCEPTABLE")
            .otherwise("NEEDS_IMPROVEMENT"),
        }
    )


def bmi_categories(dim: DataFrame) -> DataFrame:
    return dim.withColumn("bmi_category", rules.bmi_category("bmi"))

