"""SCD type 2 dimension, facts and summaries (own design over documented schemas)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.ordered import as_of_merge, split_window
from riskloom.functions.stats import n_rows, ratio
from riskloom.operators.features import dedupe_keep_latest, newest_first
from riskloom.sources.tables import current_records, lookback_scan, time_literal

HIGH_COST = 400_000
SUMMARY_HIGH = 80
SUMMARY_LOW = 50
KEY = "patient_natural_key"


# SCD type 2 ----------------------------------------------------------------
def scd2_dim_patients(
    observations: DataFrame,
    value: str = "primary_insurance_plan",
    observed: str = "observed_at",
    sequence: str = "sequence",
    key: str = KEY,
    by_rank: bool = False,
) -> DataFrame:
    """Versions of a tracked attribute from dated observations.

    A version opens where the value differs from the one before and ends where
    the next opens.  The opening observation's number is the surrogate key.
    Histories are chunked by the month; ``by_rank`` cuts crowded months further.
    """
    month = F.date_trunc("month", observed)
    order = [observed, sequence]
    marked = split_window(
        observations, [key], order, month, lag={"_previous": value}, running_count="_n", by_rank=by_rank
    )
    first = F.col("_n") == 1
    changes = marked.where(first | ~F.col(value).eqNullSafe(F.col("_previous"))).select(
        key, value, observed, sequence
    )
    versions = split_window(
        changes, [key], order, month, lead={"expiry_date": observed}, running_count="_version", by_rank=by_rank
    )
    return versions.select(
        F.col(sequence).alias("patient_surrogate_key"),
        key,
        value,
        F.col(observed).alias("effective_date"),
        "expiry_date",
        F.col("expiry_date").isNull().alias("is_current_record"),
        F.col("_version").cast("int").alias("record_version"),
    )


def scd2_apply_changes(
    dim: DataFrame,
    incoming: DataFrame,
    value: str = "primary_insurance_plan",
    key: str = KEY,
) -> DataFrame:
    """Dimension after a batch of new values (one row per key, with ``changed_at``
    and ``sequence``).

    Closed history passes through untouched.  The open rows meet the batch in
    one outer join on the key and leave as one row (unchanged or new) or two
    (closed and reopened).
    """
    columns = dim.columns
    open_rows = dim.where("is_current_record")
    batch = incoming.select(
        F.col(key).alias("_key"), F.col(value).alias("_value"), "changed_at", "sequence"
    )
    joined = open_rows.join(batch, open_rows[key] == F.col("_key"), "full")
    is_new = F.col(key).isNull()
    changed = F.col("_key").isNotNull() & ~is_new & ~F.col(value).eqNullSafe(F.col("_value"))

    def row(overrides: Mapping[str, Column]) -> Column:
        return F.struct(
            *[
                overrides.get(c, F.col(c)).cast(dim.schema[c].dataType).alias(c) for c in columns
            ]
        )

    opened = {
        "patient_surrogate_key": F.col("sequence"),
        key: F.col("_key"),
        value: F.col("_value"),
        "effective_date": F.col("changed_at"),
        "expiry_date": F.lit(None),
        "is_current_record": F.lit(True),
        "record_version": F.coalesce(F.col("record_version"), F.lit(0)) + 1,
    }
    closed = {"expiry_date": F.col("changed_at"), "is_current_record": F.lit(False)}
    rows = (
        F.when(is_new, F.array(row(opened)))
        .when(changed, F.array(row(closed), row(opened)))
        .otherwise(F.array(row({})))
    )
    return dim.where(~F.col("is_current_record")).unionByName(
        joined.select(F.inline(rows)).select(*columns)
    )


def scd2_as_of(dim: DataFrame, moment: datetime) -> DataFrame:
    """Versions valid at a moment."""
    t = time_literal(dim, "effective_date", moment)
    return dim.where(
        (F.col("effective_date") <= t)
        & (F.col("expiry_date").isNull() | (F.col("expiry_date") > t))
    )


def point_in_time_join(
    facts: DataFrame,
    dim: DataFrame,
    fact_key: str,
    fact_time: str,
    attributes: Sequence[str],
    key: str = KEY,
    by_rank: bool = False,
) -> DataFrame:
    """Facts with the dimension attributes valid at the fact's own time.

    An as-of merge: facts and versions are united and each fact takes the last version that
    began before it, if that version has not ended.  Of versions that overlap the later one counts.
    A fact without a version at its time keeps its row, with null attributes.  ``by_rank``
    cuts months in which one key has very many rows.
    """
    return as_of_merge(
        facts, dim, fact_key, key, fact_time, "effective_date", attributes, until="expiry_date",
        ties=[c for c in ("record_version",) if c in dim.columns], by_rank=by_rank,
    )


# Facts ---------------------------------------------------------------------
def current_patients(dim: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One current row per patient, so that a fact join cannot multiply rows."""
    return dedupe_keep_latest(current_records(dim), [KEY], newest_first()).select(*columns)


PATIENT_ATTRIBUTES = (
    "patient_surrogate_key",
    KEY,
    "patient_age_category",
    "patient_gender",
    "patient_region",
    "patient_smoking_status",
    "health_risk_score",
    "patient_data_quality_score",
)


def fact_claims(claims: DataFrame, dim: DataFrame, high_cost: float = HIGH_COST) -> DataFrame:
    """Claims with patient attributes and calendar columns.

    The risk-adjusted amount adds the patient's score as a percentage; the
    combined quality is the mean of both scores.  A claim without a current
    patient row keeps its row, with null attributes (``unmatched`` counts them).
    """
    patients = current_patients(dim, PATIENT_ATTRIBUTES)
    joined = claims.join(patients, claims["patient_id"] == patients[KEY], "left")
    amount = F.col("claim_amount_validated")
    uplift = 1 + F.coalesce("health_risk_score", F.lit(0.0)) / 100
    day = F.col("claim_date")
    return joined.select(
        "claim_id",
        "patient_surrogate_key",
        day,
        F.year(day).alias("claim_year"),
        F.month(day).alias("claim_month"),
        F.quarter(day).alias("claim_quarter"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        amount.alias("claim_amount"),
        (amount * uplift).alias("risk_adjusted_amount"),
        F.coalesce(amount > high_cost, F.lit(False)).alias("high_cost_claim_indicator"),
        "claim_approved",
        "claim_denied",
        "claim_paid",
        *[c for c in ("total_processing_days",) if c in claims.columns],
        "patient_age_category",
        "patient_gender",
        "patient_region",
        "patient_smoking_status",
        "claim_data_quality_score",
        (
            (F.col("claim_data_quality_score") + F.col("patient_data_quality_score")) / 2
        ).alias("combined_data_quality_score"),
    )


def unmatched(facts: DataFrame, column: str = "patient_surrogate_key") -> DataFrame:
    """How many facts have no dimension row."""
    return facts.agg(
        F.count(F.lit(1)).alias("fact_rows"), F.count_if(F.col(column).isNull()).alias("unmatched_rows")
    )


def fact_medical_events(events: DataFrame, dim: DataFrame) -> DataFrame:
    """Events with patient attributes; an event without a current patient row is kept."""
    patients = current_patients(dim, PATIENT_ATTRIBUTES)
    joined = events.join(patients, events["patient_id"] == patients[KEY], "left")
    day = F.col("event_date")
    return joined.select(
        "event_id",
        "patient_surrogate_key",
        F.year(day).alias("event_year"),
        F.month(day).alias("event_month"),
        F.quarter(day).alias("event_quarter"),
        "event_type_standardized",
        "medical_provider",
        *[
            c
            for c in (
                "emergency_visit",
                "hospital_admission",
                "days_since_previous_event",
                "days_to_next_event",
                "is_new_provider",
            )
            if c in events.columns
        ],
        "patient_age_category",
        "patient_gender",
        "patient_region",
    )


def claims_monthly_summary(facts: DataFrame) -> DataFrame:
    """Fifteen measures per month and region; money is summed as decimals."""
    amount = F.col("claim_amount").cast("decimal(18,2)")
    high = F.col("high_cost_claim_indicator")
    grouped = facts.groupBy("year_month", "claim_quarter", "patient_region").agg(
        n_rows().alias("total_claims"),
        F.count_distinct("patient_surrogate_key").alias("unique_patients"),
        F.sum(amount).cast("double").alias("total_claim_amount"),
        F.max("claim_amount").alias("max_claim_amount"),
        F.min("claim_amount").alias("min_claim_amount"),
        F.count("claim_amount").alias("_amounts"),
        F.count_if("claim_approved").alias("approved_claims"),
        F.count_if("claim_denied").alias("denied_claims"),
        F.count_if("claim_paid").alias("paid_claims"),
        F.avg("total_processing_days").alias("avg_processing_days"),
        F.avg("claim_data_quality_score").alias("avg_data_quality_score"),
        F.count_if(high).alias("high_cost_claims"),
        F.coalesce(F.sum(F.when(high, amount)).cast("double"), F.lit(0.0)).alias(
            "high_cost_amount"
        ),
    )
    return grouped.withColumns(
        {
            "avg_claim_amount": ratio(F.col("total_claim_amount"), F.col("_amounts")),
            "avg_claims_per_patient": ratio(F.col("total_claims"), F.col("unique_patients")),
            "avg_cost_per_patient": ratio(F.col("total_claim_amount"), F.col("unique_patients")),
        }
    ).drop("_amounts")


# Summaries -----------------------------------------------------------------
def monitoring_summary_view(df: DataFrame, as_of: datetime, days: int = 7) -> DataFrame:
    """Seven-day row with its own bands: above 80, 50 to 80, below 50."""
    score = F.col("adjusted_prediction")
    return lookback_scan(df, days, as_of).agg(
        F.lit(f"Last {days} Days").alias("period"),
        n_rows().alias("total_predictions"),
        # A handful of days, so a set needs no extra shuffle.
        F.size(F.collect_set(F.to_date("prediction_timestamp"))).cast("long").alias("active_days"),
        F.avg(score).alias("avg_risk_score"),
        F.min(score).alias("min_risk_score"),
        F.max(score).alias("max_risk_score"),
        F.count_if(score > SUMMARY_HIGH).alias("high_risk_count"),
        F.count_if(score.between(SUMMARY_LOW, SUMMARY_HIGH)).alias("medium_risk_count"),
        F.count_if(score < SUMMARY_LOW).alias("low_risk_count"),
        F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz").alias("generated_at"),
    )


def quality_monitoring_summary(
    tables: Mapping[str, tuple[DataFrame, str]], as_of: datetime, stale_hours: int = 48
) -> DataFrame:
    """Freshness and completeness structs per table (``{name: (df, time column)}``)."""
    parts = []
    for name, (df, stamp) in tables.items():
        moment = time_literal(df, stamp, as_of)
        day = time_literal(df, stamp, as_of - timedelta(days=1))
        facts = df.agg(
            F.max(stamp).alias("latest"),
            n_rows().alias("total"),
            F.count_if(F.col(stamp) >= day).alias("daily"),
        )
        hours = F.timestamp_diff("HOUR", F.col("latest"), moment)
        fresh = F.when(hours <= stale_hours, "FRESH").otherwise("STALE")
        complete = F.when(F.col("daily") > 0, "COMPLETE").otherwise("NO_RECENT_ROWS")
        parts.append(
            facts.select(
                F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz").alias("event_time"),
                F.lit(name).alias("table_name"),
                F.when((fresh == "FRESH") & (complete == "COMPLETE"), "HEALTHY")
                .otherwise("UNHEALTHY")
                .alias("status"),
                F.struct(
                    fresh.alias("status"), F.col("latest").cast("string").alias("commit_freshness")
                ).alias("freshness"),
                F.struct(
                    complete.alias("status"),
                    F.col("total").alias("total_row_count"),
                    F.col("daily").alias("daily_row_count"),
                ).alias("completeness"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def pk_check(df: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    """Keys occurring more than once."""
    repeated = df.groupBy(*keys).agg(n_rows().alias("_n")).where(F.col("_n") > 1)
    return repeated.agg(n_rows().alias("violations")).select(
        F.lit(name).alias("check_name"), "violations"
    )


def fk_check(
    child: DataFrame, name: str, child_key: str, parent: DataFrame, parent_key: str
) -> DataFrame:
    """Child keys without a parent; keys are made distinct before the join."""
    keys = child.select(F.col(child_key).alias("_k")).where(F.col("_k").isNotNull()).distinct()
    known = parent.select(F.col(parent_key).alias("_k"))
    return keys.join(known, "_k", "left_anti").agg(n_rows().alias("violations")).select(
        F.lit(name).alias("check_name"), "violations"
    )


def pk_fk_check(*parts: DataFrame) -> DataFrame:
    status = F.when(F.col("violations") > 0, "FAIL").otherwise("PASS")
    return reduce(DataFrame.unionByName, parts).withColumn("status", status)
