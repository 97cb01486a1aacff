"""Healthcare tables derived from the driver's Parquet files.

Every table is a lazy view: customers become patients, orders become claims
and events become both medical events and the prediction log.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions import rules

AS_OF = datetime(2024, 1, 31)
DRIFT_SPLIT = datetime(2024, 1, 16)
MODEL_NAME = "insurance_model"
MODEL_VERSION = "1"
CHAMPION = "1"
HIGH_COST_CLAIM = 400_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _patient_key(column: str):
    return F.concat(F.lit("P"), F.lpad(F.col(column).cast("string"), 8, "0"))


_AGE_LABELS = " ".join(
    f"WHEN {i} THEN '{label}'" for i, label in enumerate(rules.AGE_CATEGORIES_BY_AGE[:-1])
)
PATIENT_COLUMNS = {
    "patient_surrogate_key": "c_custkey",
    "patient_natural_key": "concat('P', lpad(string(c_custkey), 8, '0'))",
    "patient_gender": "CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END",
    "patient_region": "CASE n_regionkey WHEN 0 THEN 'NORTHEAST' WHEN 1 THEN 'NORTHWEST' "
    "WHEN 2 THEN 'SOUTHEAST' ELSE 'SOUTHWEST' END",
    "patient_age_category": f"CASE (c_custkey * 7) % 5 {_AGE_LABELS} "
    f"ELSE '{rules.AGE_CATEGORIES_BY_AGE[-1]}' END",
    "patient_smoking_status": f"CASE WHEN (c_custkey * 13) % 6 = 0 THEN '{rules.SMOKER_LABEL}' "
    f"ELSE '{rules.NON_SMOKER_LABEL}' END",
    "bmi": "double(160 + (c_custkey * 37) % 341) / 10D",
    "number_of_dependents": "int(c_custkey % 4)",
    "health_risk_score": "CASE WHEN c_custkey % 10 <> 0 THEN double(25 + (c_custkey * 17) % 61) END",
    "lifestyle_risk_factors": "CASE WHEN (c_custkey * 13) % 6 = 0 THEN 'SMOKING' ELSE 'NONE' END",
}


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    customer = table(spark, sf_dir, "customer")
    return customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"])


def dim_patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One current row per patient."""
    return _customers(spark, sf_dir).selectExpr(
        *[f"{sql} AS {name}" for name, sql in PATIENT_COLUMNS.items()],
        "1D AS patient_data_quality_score",
        "true AS hipaa_deidentification_applied",
        "true AS is_current_record",
        "TIMESTAMP_NTZ '2024-01-30 00:00:00' AS dimension_last_updated",
    )


def dim_patient_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dimension with closed rows and refreshed duplicates.

    Every third patient also has an older current row and every fourth a
    closed one, which is what de-duplication and current-row filters are for.
    """
    dim = dim_patients(spark, sf_dir)
    k = F.col("patient_surrogate_key")
    older = F.lit("2024-01-02 00:00:00").cast("timestamp_ntz")
    stale = dim.where(k % 3 == 0).withColumn("dimension_last_updated", older)
    closed = dim.where(k % 4 == 0).withColumns(
        {"dimension_last_updated": older, "is_current_record": F.lit(False)}
    )
    return dim.unionByName(stale).unionByName(closed)


def bronze_patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw patients: stray case and blanks; some ages and BMIs invalid or missing."""
    c = PATIENT_COLUMNS
    return _customers(spark, sf_dir).selectExpr(
        f"{c['patient_natural_key']} AS patient_id",
        "concat('First', string(c_custkey)) AS first_name",
        "c_name AS last_name",
        "CASE WHEN c_custkey % 53 <> 0 THEN int(14 + (c_custkey * 7) % 76) END AS age",
        f"concat(' ', lower({c['patient_gender']})) AS sex",
        f"lower({c['patient_region']}) AS region",
        "CASE WHEN c_custkey % 59 <> 0 THEN double(140 + (c_custkey * 37) % 381) / 10D END AS bmi",
        "(c_custkey * 13) % 6 = 0 AS smoker",
        "int(c_custkey % 4) AS children",
        "c_acctbal + 1000D AS charges",
    )


def silver_patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = PATIENT_COLUMNS
    age_category = c["patient_age_category"]
    return _customers(spark, sf_dir).selectExpr(
        f"{c['patient_natural_key']} AS patient_id",
        "int(18 + (c_custkey * 7) % 68) AS age",
        f"{c['patient_gender']} AS sex",
        f"{c['bmi']} AS bmi",
        f"{c['number_of_dependents']} AS children",
        "(c_custkey * 13) % 6 = 0 AS smoker",
        f"{c['patient_region']} AS region",
        "c_acctbal + 1000D AS charges",
        f"{age_category} AS patient_age_category",
        "CASE c_custkey % 3 WHEN 0 THEN 'LOW_RISK' WHEN 1 THEN 'MODERATE_RISK' "
        "ELSE 'HIGH_RISK' END AS health_risk_category",
        f"concat_ws('_', {age_category}, {c['patient_region']}) AS demographic_segment",
        "1D AS patient_data_quality_score",
    )


def predictions(spark: SparkSession, sf_dir: str, with_nulls: bool = False) -> DataFrame:
    """Prediction log: scored events joined to the patient row."""
    from riskloom.operators.scoring import apply_score_rules

    score = "100D * value / (value + 40D)"
    if with_nulls:
        score = f"CASE WHEN event_id % 97 <> 0 THEN {score} END"
    log = table(spark, sf_dir, "events").selectExpr(
        "event_id", "user_id AS _user", f"{score} AS prediction", "ts AS prediction_timestamp"
    )
    dim = dim_patients(spark, sf_dir).drop(
        "is_current_record", "dimension_last_updated", "lifestyle_risk_factors"
    )
    joined = log.join(dim, log["_user"] == dim["patient_surrogate_key"]).selectExpr(
        "* EXCEPT (_user)",
        "patient_natural_key AS customer_id",
        "patient_region AS region",
        "patient_gender AS sex",
        f"'{MODEL_NAME}' AS model_name",
        f"'{MODEL_VERSION}' AS model_version",
    )
    return apply_score_rules(joined)


VERSION_SPREAD = {"1": 1.0, "2": 0.5, "3": 4.0}


def scored_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows scored by three model versions, with the true label."""
    base = predictions(spark, sf_dir).select(
        "event_id",
        "customer_id",
        "patient_region",
        "prediction_timestamp",
        F.col("prediction").alias("label"),
    )
    spread = F.array(
        *[
            F.struct(F.lit(v).alias("model_version"), F.lit(k).alias("k"))
            for v, k in VERSION_SPREAD.items()
        ]
    )
    noise = ((F.col("event_id") * 31) % 21 - 10).cast("double")
    exploded = base.withColumn("_v", F.explode(spread))
    return exploded.select(
        "event_id",
        "customer_id",
        "patient_region",
        "prediction_timestamp",
        F.col("_v.model_version").alias("model_version"),
        (F.col("label") + noise * F.col("_v.k")).alias("prediction"),
        "label",
    )


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw claims: status letters with stray case and blanks, dates as text."""
    status = (
        F.when(F.col("o_orderstatus") == "F", " approved")
        .when(F.col("o_orderstatus") == "O", "Denied ")
        .otherwise("PAID")
    )
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("claim_id"),
        _patient_key("o_custkey").alias("patient_id"),
        F.col("o_totalprice").alias("claim_amount"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("claim_date"),
        status.alias("claim_status"),
    )


def claim_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last handling date of each claim."""
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.max("l_shipdate").alias("completed_at"))
        .select(F.col("l_orderkey").cast("string").alias("claim_id"), "completed_at")
    )


EVENT_KINDS = {
    "error": "emergency",
    "purchase": "Admission",
    "signup": "PREVENTIVE",
    "view": "routine ",
    "click": "lab",
}


def medical_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = rules.mapped("event_type", EVENT_KINDS, "other")
    return table(spark, sf_dir, "events").select(
        "event_id",
        _patient_key("user_id").alias("patient_id"),
        F.col("ts").alias("event_date"),
        kind.alias("event_type"),
        F.concat(F.lit("PROV"), F.lpad((F.col("event_id") % 20).cast("string"), 3, "0")).alias(
            "medical_provider"
        ),
    )


def plan_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dated observations of a patient's insurance plan, repeats included."""
    return table(spark, sf_dir, "orders").select(
        _patient_key("o_custkey").alias("patient_natural_key"),
        F.col("o_orderpriority").alias("primary_insurance_plan"),
        F.col("o_orderdate").alias("observed_at"),
        F.col("o_orderkey").alias("sequence"),
    )
