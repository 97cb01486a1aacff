"""Bronze to silver cleansing.

The source documents schemas and validity ranges only; the rules below are
this library's own design and are stated per function.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions import rules
from riskloom.functions.ordered import split_window
from riskloom.functions.stats import ratio

# Documented validity ranges.
AGE_RANGE = (18, 85)
BMI_RANGE = (15.0, 50.0)
# Own design.
REGIONS = ("NORTHEAST", "NORTHWEST", "SOUTHEAST", "SOUTHWEST")
SEXES = ("F", "M")
AGE_CATEGORY_BANDS = ((30, "YOUNG"), (40, "ADULT"), (55, "MIDDLE_AGED"), (68, "SENIOR"))
AGE_CATEGORY_TOP = "ELDERLY"
CLAIM_STATUSES = ("APPROVED", "DENIED", "PAID")
CLAIM_BANDS = ((50_000, "LOW"), (200_000, "MEDIUM"), (400_000, "HIGH"))
CLAIM_TOP = "VERY_HIGH"
AGE_BAND_YEARS = 10
AGE_BAND_TOP = 80


def quality_score(passed: Sequence[Column]) -> Column:
    """Share of rules met; an unknown outcome is not met."""
    met = reduce(lambda a, b: a + b, [F.coalesce(p, F.lit(False)).cast("int") for p in passed])
    return met / F.lit(float(len(passed)))


def record_quality(score: Column) -> Column:
    return F.when(score == 1.0, "VALID").when(score >= 0.75, "PARTIAL").otherwise("INVALID")


def silver_patients(bronze: DataFrame) -> DataFrame:
    """Standardised patients within the valid age and BMI ranges.

    Rows with a missing or invalid age or BMI are left out.  The quality score
    is the share of rules met: age, BMI, sex, region, charges, identifier.
    """
    clean = bronze.withColumns(
        {"sex": F.upper(F.trim("sex")), "region": F.upper(F.trim("region"))}
    )
    age_ok = F.col("age").between(*AGE_RANGE)
    bmi_ok = F.col("bmi").between(*BMI_RANGE)
    score = quality_score(
        [
            age_ok,
            bmi_ok,
            F.col("sex").isin(*SEXES),
            F.col("region").isin(*REGIONS),
            F.col("charges") >= 0,
            F.col("patient_id").isNotNull(),
        ]
    )
    category = rules.banded("age", AGE_CATEGORY_BANDS, AGE_CATEGORY_TOP)
    points = (
        F.when(F.col("smoker"), 2).otherwise(0)
        + (F.col("bmi") >= 30).cast("int")
        + (F.col("age") >= 60).cast("int")
    )
    return clean.where(age_ok & bmi_ok).withColumns(
        {
            "patient_age_category": category,
            "health_risk_category": rules.banded(
                points, ((1, "LOW_RISK"), (2, "MODERATE_RISK")), "HIGH_RISK"
            ),
            "demographic_segment": F.concat_ws("_", category, F.col("region")),
            "patient_data_quality_score": score,
            "patient_record_quality": record_quality(score),
        }
    )


def hash_identifiers(
    df: DataFrame,
    id_column: str = "patient_id",
    name_columns: Sequence[str] = ("first_name", "last_name"),
) -> DataFrame:
    """Replace direct identifiers by SHA-256 digests and drop them."""
    return df.withColumns(
        {
            "patient_id_hash": F.sha2(F.col(id_column), 256),
            "patient_name_hash": F.sha2(F.concat_ws("|", *name_columns), 256),
            "hipaa_deidentification_applied": F.lit(True),
        }
    ).drop(id_column, *name_columns)


def privacy_protection(df: DataFrame) -> DataFrame:
    """Ten-year age bands with an open top, and north/south instead of the region."""
    start = (F.floor(F.col("age") / AGE_BAND_YEARS) * AGE_BAND_YEARS).cast("int")
    closed = F.concat_ws("-", start.cast("string"), (start + AGE_BAND_YEARS - 1).cast("string"))
    band = F.when(start >= AGE_BAND_TOP, f"{AGE_BAND_TOP}+").when(F.col("age").isNotNull(), closed)
    area = F.when(F.upper(F.trim("region")).startswith("NORTH"), "NORTH").otherwise("SOUTH")
    return df.withColumns(
        {
            "age_band": band,
            "area": area,
            "age_privacy_protection": F.lit(True),
            "geographic_privacy_protection": F.lit(True),
        }
    ).drop("age", "region")


def silver_claims(claims: DataFrame, completion: DataFrame | None = None) -> DataFrame:
    """Typed claims with standard status, flags, amount class and handling time.

    Handling time is the distance in days between the claim and its completion,
    whichever comes first.
    """
    status = F.upper(F.trim("claim_status"))
    known = status.isin(*CLAIM_STATUSES)
    day = F.to_date("claim_date")
    amount = F.when(F.col("claim_amount") > 0, F.col("claim_amount"))
    out = claims.withColumns(
        {
            "claim_date": day,
            "claim_amount_validated": amount,
            "claim_status_standardized": F.when(known, status).otherwise("UNKNOWN"),
            "claim_amount_category": F.when(
                amount.isNotNull(), rules.banded(amount, CLAIM_BANDS, CLAIM_TOP)
            ),
            **{f"claim_{s.lower()}": F.coalesce(status == s, F.lit(False)) for s in CLAIM_STATUSES},
            "claim_data_quality_score": quality_score(
                [amount.isNotNull(), day.isNotNull(), known, F.col("patient_id").isNotNull()]
            ),
        }
    ).drop("claim_status", "claim_amount")
    if completion is not None:
        out = out.join(completion, "claim_id", "left").withColumn(
            "total_processing_days", F.abs(F.datediff("completed_at", "claim_date"))
        )
        out = out.drop("completed_at")
    return out


def silver_medical_events(events: DataFrame, as_of: datetime, by_rank: bool = False) -> DataFrame:
    """Standard event types, care flags and the place of each event in its history.

    Sequencing is chunked by the hour (see ``split_window``), so a patient or a
    provider with a very large history does not end up in one task; ``by_rank`` cuts
    crowded hours further.
    Familiarity is the share of the patient's events so far at this provider.
    """
    kind = F.upper(F.trim("event_type"))
    base = events.withColumns(
        {
            "event_type_standardized": kind,
            "emergency_visit": kind == "EMERGENCY",
            "hospital_admission": kind == "ADMISSION",
            "preventive_care_indicator": kind == "PREVENTIVE",
            "acute_care_indicator": kind.isin("EMERGENCY", "ADMISSION"),
        }
    ).drop("event_type")
    hour = F.date_trunc("hour", "event_date")
    order = ["event_date", "event_id"]
    seen = split_window(
        base,
        ["patient_id"],
        order,
        hour,
        lag={"_previous": "event_date"},
        lead={"_following": "event_date"},
        running_count="_visit",
        source=events,
        by_rank=by_rank,
    )
    both = split_window(
        seen,
        ["patient_id", "medical_provider"],
        order,
        hour,
        running_count="_provider_visit",
        source=events,
        by_rank=by_rank,
    )
    today = F.lit(as_of.date())
    return both.withColumns(
        {
            "days_since_previous_event": F.datediff("event_date", "_previous"),
            "days_to_next_event": F.datediff("_following", "event_date"),
            "days_since_event": F.datediff(today, "event_date"),
            "is_new_provider": F.col("_provider_visit") == 1,
            "provider_patient_familiarity": ratio(F.col("_provider_visit"), F.col("_visit")),
        }
    ).drop("_previous", "_following", "_visit", "_provider_visit")
