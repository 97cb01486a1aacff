"""Queries over the medallion layers and the star schema."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from riskloom.operators import features, medallion, star
from riskloom.plans.registry import register
from riskloom.plans.sql_tables import KEY, oracle, r, since
from riskloom.session import work_dir
from riskloom.sources import sinks
from riskloom.sources import testdata as td

AS_OF = td.AS_OF

BRONZE = (
    "bz AS (SELECT patient_natural_key AS patient_id, concat('First', c_custkey) AS first_name, "
    "c_name AS last_name, CASE WHEN c_custkey % 53 = 0 THEN NULL "
    "ELSE cast(14 + (c_custkey * 7) % 76 as int) END AS age, patient_gender AS sex, "
    "patient_region AS region, CASE WHEN c_custkey % 59 = 0 THEN NULL "
    "ELSE cast(140 + (c_custkey * 37) % 381 as double) / cast(10 as double) END AS bmi, "
    "(c_custkey * 13) % 6 = 0 AS smoker, number_of_dependents AS children, "
    "c_acctbal + cast(1000 as double) AS charges FROM dim JOIN customer "
    "ON c_custkey = patient_surrogate_key)"
)
register(
    "silver_patients",
    lambda s, d: medallion.silver_patients(td.bronze_patients(s, d)).drop(
        "first_name", "last_name"
    ),
    oracle(
        f"WITH {BRONZE}, k AS (SELECT *, CASE WHEN age < 30 THEN 'YOUNG' WHEN age < 40 THEN 'ADULT' "
        "WHEN age < 55 THEN 'MIDDLE_AGED' WHEN age < 68 THEN 'SENIOR' ELSE 'ELDERLY' END AS cat, "
        "CASE WHEN smoker THEN 2 ELSE 0 END + (bmi >= 30)::int + (age >= 60)::int AS pts, "
        "(5 + (charges >= 0)::int) / cast(6 as double) AS q FROM bz "
        "WHERE age BETWEEN 18 AND 85 AND bmi BETWEEN 15 AND 50) "
        "SELECT patient_id, age, sex, region, round(bmi, 6) AS bmi, smoker, children, "
        "round(charges, 6) AS charges, cat AS patient_age_category, CASE WHEN pts < 1 THEN 'LOW_RISK' "
        "WHEN pts < 2 THEN 'MODERATE_RISK' ELSE 'HIGH_RISK' END AS health_risk_category, "
        "concat(cat, '_', region) AS demographic_segment, round(q, 6) AS patient_data_quality_score, "
        "CASE WHEN q = 1 THEN 'VALID' WHEN q >= 0.75 THEN 'PARTIAL' ELSE 'INVALID' END "
        "AS patient_record_quality FROM k"
    ),
)
register(
    "hash_identifiers",
    lambda s, d: medallion.hash_identifiers(td.bronze_patients(s, d)).select(
        "patient_id_hash", "patient_name_hash", "hipaa_deidentification_applied", "smoker"
    ),
    oracle(
        f"WITH {BRONZE} SELECT sha256(patient_id) AS patient_id_hash, "
        "sha256(concat_ws('|', first_name, last_name)) AS patient_name_hash, "
        "true AS hipaa_deidentification_applied, smoker FROM bz"
    ),
)
register(
    "privacy_protection",
    lambda s, d: medallion.privacy_protection(td.bronze_patients(s, d)).select(
        "patient_id", "age_band", "area", "age_privacy_protection", "geographic_privacy_protection"
    ),
    oracle(
        f"WITH {BRONZE} SELECT patient_id, CASE WHEN age >= 80 THEN '80+' WHEN age IS NOT NULL THEN "
        "concat((age // 10) * 10, '-', (age // 10) * 10 + 9) END AS age_band, "
        "CASE WHEN region LIKE 'NORTH%' THEN 'NORTH' ELSE 'SOUTH' END AS area, "
        "true AS age_privacy_protection, true AS geographic_privacy_protection FROM bz"
    ),
)
SILVER_CLAIMS = (
    "done AS (SELECT cast(l_orderkey as varchar) AS claim_id, max(l_shipdate) AS completed_at "
    "FROM lineitem GROUP BY 1), sc AS (SELECT c.claim_id, patient_id, "
    "cast(claim_date as date) AS claim_date, claim_amount AS claim_amount_validated, "
    "status AS claim_status_standardized, CASE WHEN claim_amount < 50000 THEN 'LOW' "
    "WHEN claim_amount < 200000 THEN 'MEDIUM' WHEN claim_amount < 400000 THEN 'HIGH' "
    "ELSE 'VERY_HIGH' END AS claim_amount_category, status = 'APPROVED' AS claim_approved, "
    "status = 'DENIED' AS claim_denied, status = 'PAID' AS claim_paid, "
    "cast(1 as double) AS claim_data_quality_score, "
    "cast(abs(date_diff('day', cast(claim_date as date), cast(completed_at as date))) as int) "
    "AS total_processing_days FROM claims c LEFT JOIN done USING (claim_id))"
)


def _silver_claims(spark, sf_dir):
    return medallion.silver_claims(td.claims(spark, sf_dir), td.claim_completion(spark, sf_dir))


register("silver_claims", _silver_claims, oracle(
    f"WITH {SILVER_CLAIMS} SELECT * REPLACE (round(claim_amount_validated, 6) AS claim_amount_validated) FROM sc"
))
SILVER_EVENTS = (
    f"me AS (SELECT event_id, {KEY.format('user_id')} AS patient_id, ts AS event_date, "
    "CASE event_type WHEN 'error' THEN 'EMERGENCY' WHEN 'purchase' THEN 'ADMISSION' "
    "WHEN 'signup' THEN 'PREVENTIVE' WHEN 'view' THEN 'ROUTINE' ELSE 'LAB' END AS kind, "
    "concat('PROV', lpad(cast(event_id % 20 as varchar), 3, '0')) AS medical_provider FROM events), "
    "se AS (SELECT *, cast(date_diff('day', cast(lag(event_date) OVER w as date), "
    "cast(event_date as date)) as int) AS days_since_previous_event, "
    "cast(date_diff('day', cast(event_date as date), cast(lead(event_date) OVER w as date)) as int) "
    "AS days_to_next_event, row_number() OVER w AS visit, row_number() OVER (PARTITION BY patient_id, "
    "medical_provider ORDER BY event_date, event_id) AS pv FROM me "
    "WINDOW w AS (PARTITION BY patient_id ORDER BY event_date, event_id))"
)


def _silver_events(spark, sf_dir):
    return medallion.silver_medical_events(td.medical_events(spark, sf_dir), AS_OF)


register(
    "silver_medical_events",
    _silver_events,
    oracle(
        f"WITH {SILVER_EVENTS} SELECT event_id, patient_id, event_date, medical_provider, "
        "kind AS event_type_standardized, kind = 'EMERGENCY' AS emergency_visit, "
        "kind = 'ADMISSION' AS hospital_admission, kind = 'PREVENTIVE' AS preventive_care_indicator, "
        "kind IN ('EMERGENCY', 'ADMISSION') AS acute_care_indicator, days_since_previous_event, "
        "days_to_next_event, cast(date_diff('day', cast(event_date as date), DATE '2024-01-31') as int) "
        "AS days_since_event, pv = 1 AS is_new_provider, "
        "round(pv * cast(1 as double) / visit, 6) AS provider_patient_familiarity FROM se"
    ),
)

# SCD type 2 ----------------------------------------------------------------
SCD2 = (
    f"ob AS (SELECT {KEY.format('o_custkey')} AS k, o_orderpriority AS plan, o_orderdate AS t, "
    "o_orderkey AS q FROM orders), ch AS (SELECT *, lag(plan) OVER (PARTITION BY k ORDER BY t, q) AS p, "
    "row_number() OVER (PARTITION BY k ORDER BY t, q) AS n FROM ob), "
    "vs AS (SELECT q AS patient_surrogate_key, k AS patient_natural_key, "
    "plan AS primary_insurance_plan, t AS effective_date, lead(t) OVER w AS expiry_date, "
    "lead(t) OVER w IS NULL AS is_current_record, "
    "cast(row_number() OVER w as int) AS record_version FROM ch "
    "WHERE n = 1 OR plan IS DISTINCT FROM p WINDOW w AS (PARTITION BY k ORDER BY t, q))"
)


def _versions(spark, sf_dir):
    return star.scd2_dim_patients(td.plan_changes(spark, sf_dir))


register("scd2_dim_patients", _versions, oracle(f"WITH {SCD2} SELECT * FROM vs"))


def _apply(spark, sf_dir):
    k = F.col("c_custkey")
    incoming = td.table(spark, sf_dir, "customer").where(k % 2 == 0).select(
        F.concat(F.lit("P"), F.lpad(k.cast("string"), 8, "0")).alias("patient_natural_key"),
        F.lit("2-HIGH").alias("primary_insurance_plan"),
        F.lit("2002-01-01 00:00:00").cast("timestamp_ntz").alias("changed_at"),
        (k + 100_000_000).alias("sequence"),
    )
    old = _versions(spark, sf_dir).where(F.substring("patient_natural_key", 2, 8).cast("int") % 7 != 0)
    return star.scd2_apply_changes(old, incoming)


register(
    "scd2_apply_changes",
    _apply,
    oracle(
        f"WITH {SCD2}, od AS (SELECT * FROM vs WHERE cast(substr(patient_natural_key, 2) as int) % 7 <> 0), "
        f"inc AS (SELECT {KEY.format('c_custkey')} AS k, c_custkey + 100000000 AS q FROM customer "
        "WHERE c_custkey % 2 = 0), j AS (SELECT od.*, inc.k IS NOT NULL AND is_current_record "
        "AND primary_insurance_plan <> '2-HIGH' AS closes FROM od LEFT JOIN inc "
        "ON k = patient_natural_key) SELECT patient_surrogate_key, patient_natural_key, "
        "primary_insurance_plan, effective_date, CASE WHEN closes THEN TIMESTAMP '2002-01-01 00:00:00' "
        "ELSE expiry_date END AS expiry_date, is_current_record AND NOT closes AS is_current_record, "
        "record_version FROM j UNION ALL SELECT q, k, '2-HIGH', TIMESTAMP '2002-01-01 00:00:00', NULL, "
        "true, cast(coalesce(record_version, 0) + 1 as int) FROM inc LEFT JOIN od "
        "ON k = patient_natural_key AND is_current_record "
        "WHERE primary_insurance_plan IS DISTINCT FROM '2-HIGH'"
    ),
)
register(
    "scd2_as_of",
    lambda s, d: star.scd2_as_of(_versions(s, d), datetime(1998, 6, 15)),
    oracle(
        f"WITH {SCD2} SELECT * FROM vs WHERE effective_date <= TIMESTAMP '1998-06-15 00:00:00' "
        "AND (expiry_date IS NULL OR expiry_date > TIMESTAMP '1998-06-15 00:00:00')"
    ),
)


def _point_in_time(spark, sf_dir):
    facts = td.claims(spark, sf_dir).select(
        "claim_id",
        "patient_id",
        # Claims are read some weeks after they were made.
        (F.to_timestamp_ntz("claim_date") + F.expr("INTERVAL 40 DAYS")).alias("claim_time"),
    )
    # The dimension is a stored table, as it is for the facts of a real run.
    versions = sinks.write_overwrite(_versions(spark, sf_dir), work_dir(spark, "dim"))
    return star.point_in_time_join(
        facts,
        versions,
        "patient_id",
        "claim_time",
        ["primary_insurance_plan", "record_version"],
    )


register(
    "scd2_point_in_time",
    _point_in_time,
    oracle(
        f"WITH {SCD2}, fc AS (SELECT claim_id, patient_id, "
        "cast(claim_date as timestamp) + INTERVAL 40 DAY AS claim_time FROM claims) "
        "SELECT claim_id, patient_id, claim_time, primary_insurance_plan, record_version FROM fc "
        "LEFT JOIN vs ON patient_id = patient_natural_key AND effective_date <= claim_time "
        "AND (expiry_date IS NULL OR claim_time < expiry_date)"
    ),
)

# Facts ---------------------------------------------------------------------
FACT_CLAIMS = (
    f"{SILVER_CLAIMS}, fact AS (SELECT claim_id, patient_surrogate_key, claim_date, "
    "cast(year(claim_date) as int) AS claim_year, cast(month(claim_date) as int) AS claim_month, "
    "cast(quarter(claim_date) as int) AS claim_quarter, strftime(claim_date, '%Y-%m') AS year_month, "
    "claim_amount_validated AS claim_amount, "
    "claim_amount_validated * (1 + coalesce(health_risk_score, 0) / cast(100 as double)) "
    "AS risk_adjusted_amount, claim_amount_validated > 400000 AS high_cost_claim_indicator, "
    "claim_approved, claim_denied, claim_paid, total_processing_days, patient_age_category, "
    "patient_gender, patient_region, patient_smoking_status, claim_data_quality_score, "
    "CASE WHEN patient_natural_key IS NOT NULL THEN cast(1 as double) END AS combined_data_quality_score FROM sc LEFT JOIN dim "
    "ON patient_id = patient_natural_key)"
)


def _fact_claims(spark, sf_dir):
    return star.fact_claims(_silver_claims(spark, sf_dir), td.dim_patient_rows(spark, sf_dir))


register(
    "fact_claims",
    _fact_claims,
    oracle(
        f"WITH {FACT_CLAIMS} SELECT * REPLACE (round(claim_amount, 6) AS claim_amount, "
        "round(risk_adjusted_amount, 6) AS risk_adjusted_amount) FROM fact"
    ),
)
register(
    "fact_medical_events",
    lambda s, d: star.fact_medical_events(_silver_events(s, d), td.dim_patient_rows(s, d)),
    oracle(
        f"WITH {SILVER_EVENTS} SELECT event_id, patient_surrogate_key, "
        "cast(year(event_date) as int) AS event_year, cast(month(event_date) as int) AS event_month, "
        "cast(quarter(event_date) as int) AS event_quarter, kind AS event_type_standardized, "
        "medical_provider, kind = 'EMERGENCY' AS emergency_visit, "
        "kind = 'ADMISSION' AS hospital_admission, days_since_previous_event, days_to_next_event, "
        "pv = 1 AS is_new_provider, patient_age_category, patient_gender, patient_region "
        "FROM se LEFT JOIN dim ON patient_id = patient_natural_key"
    ),
)
register(
    "claims_monthly_summary",
    lambda s, d: star.claims_monthly_summary(_fact_claims(s, d)),
    oracle(
        f"WITH {FACT_CLAIMS}, g AS (SELECT year_month, claim_quarter, patient_region, "
        "count(*) AS total_claims, count(DISTINCT patient_surrogate_key) AS unique_patients, "
        "cast(sum(cast(claim_amount as decimal(18, 2))) as double) AS total_claim_amount, "
        "max(claim_amount) AS max_claim_amount, min(claim_amount) AS min_claim_amount, "
        "count(*) FILTER (WHERE claim_approved) AS approved_claims, "
        "count(*) FILTER (WHERE claim_denied) AS denied_claims, "
        "count(*) FILTER (WHERE claim_paid) AS paid_claims, "
        f"{r('avg(total_processing_days)', 'avg_processing_days')}, "
        f"{r('avg(claim_data_quality_score)', 'avg_data_quality_score')}, "
        "count(*) FILTER (WHERE high_cost_claim_indicator) AS high_cost_claims, "
        "coalesce(cast(sum(cast(claim_amount as decimal(18, 2))) FILTER "
        "(WHERE high_cost_claim_indicator) as double), 0) AS high_cost_amount "
        "FROM fact GROUP BY 1, 2, 3) SELECT *, "
        "round(total_claim_amount / total_claims, 6) AS avg_claim_amount, "
        "round(total_claims / cast(unique_patients as double), 6) AS avg_claims_per_patient, "
        "round(total_claim_amount / unique_patients, 6) AS avg_cost_per_patient FROM g"
    ),
)
register(
    "monitoring_summary_view",
    lambda s, d: star.monitoring_summary_view(td.predictions(s, d), AS_OF),
    oracle(
        "SELECT 'Last 7 Days' AS period, count(*) AS total_predictions, "
        "count(DISTINCT cast(prediction_timestamp as date)) AS active_days, "
        f"{r('avg(adjusted_prediction)', 'avg_risk_score')}, "
        f"{r('min(adjusted_prediction)', 'min_risk_score')}, "
        f"{r('max(adjusted_prediction)', 'max_risk_score')}, "
        "count(*) FILTER (WHERE adjusted_prediction > 80) AS high_risk_count, "
        "count(*) FILTER (WHERE adjusted_prediction BETWEEN 50 AND 80) AS medium_risk_count, "
        "count(*) FILTER (WHERE adjusted_prediction < 50) AS low_risk_count, "
        f"TIMESTAMP '2024-01-31 00:00:00' AS generated_at FROM pred WHERE {since(7)}"
    ),
)
def _quality_summary(spark, sf_dir):
    dated = td.claims(spark, sf_dir).withColumn("claim_time", F.to_timestamp_ntz("claim_date"))
    summary = star.quality_monitoring_summary(
        {
            "dim_patients": (td.dim_patient_rows(spark, sf_dir), "dimension_last_updated"),
            "ml_patient_predictions": (td.predictions(spark, sf_dir), "prediction_timestamp"),
            "bronze_claims": (dated, "claim_time"),
        },
        AS_OF,
    )
    return summary.select(
        "event_time",
        "table_name",
        "status",
        F.col("freshness.status").alias("freshness_status"),
        "freshness.commit_freshness",
        F.col("completeness.status").alias("completeness_status"),
        "completeness.total_row_count",
        "completeness.daily_row_count",
    )


register(
    "quality_monitoring_summary",
    _quality_summary,
    oracle(
        "WITH q AS ("
        + " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, max({stamp}) AS t, count(*) AS n, "
            f"count(*) FILTER (WHERE {stamp} >= TIMESTAMP '2024-01-30 00:00:00') AS k FROM {source}"
            for name, stamp, source in (
                ("dim_patients", "dimension_last_updated", "dim_rows"),
                ("ml_patient_predictions", "prediction_timestamp", "pred"),
                ("bronze_claims", "cast(claim_date as timestamp)", "claims"),
            )
        )
        + "), s AS (SELECT *, CASE WHEN date_diff('hour', t, TIMESTAMP '2024-01-31') <= 48 THEN 'FRESH' "
        "ELSE 'STALE' END AS f, CASE WHEN k > 0 THEN 'COMPLETE' ELSE 'NO_RECENT_ROWS' END AS c FROM q) "
        "SELECT TIMESTAMP '2024-01-31 00:00:00' AS event_time, table_name, CASE WHEN f = 'FRESH' AND "
        "c = 'COMPLETE' THEN 'HEALTHY' ELSE 'UNHEALTHY' END AS status, f AS freshness_status, "
        "cast(t as varchar) AS commit_freshness, c AS completeness_status, n AS total_row_count, "
        "k AS daily_row_count FROM s"
    ),
)


def _keys(spark, sf_dir):
    table = features.build_feature_table(td.dim_patients(spark, sf_dir))
    rows = td.dim_patient_rows(spark, sf_dir)
    known = td.dim_patients(spark, sf_dir).where(F.col("patient_surrogate_key") % 10 != 3)
    return star.pk_fk_check(
        star.pk_check(table, "ml_insurance_features.customer_id", ["customer_id"]),
        star.pk_check(rows, "dim_patients.patient_surrogate_key", ["patient_surrogate_key"]),
        star.fk_check(
            td.claims(spark, sf_dir),
            "claims.patient_id",
            "patient_id",
            known,
            "patient_natural_key",
        ),
    )


register(
    "pk_fk_check",
    _keys,
    oracle(
        "WITH v AS (SELECT 'ml_insurance_features.customer_id' AS check_name, "
        "(SELECT count(*) FROM (SELECT customer_id FROM features GROUP BY 1 HAVING count(*) > 1)) "
        "AS violations UNION ALL SELECT 'dim_patients.patient_surrogate_key', (SELECT count(*) FROM "
        "(SELECT patient_surrogate_key FROM dim_rows GROUP BY 1 HAVING count(*) > 1)) "
        "UNION ALL SELECT 'claims.patient_id', (SELECT count(DISTINCT patient_id) FROM claims "
        "WHERE patient_id NOT IN (SELECT patient_natural_key FROM dim "
        "WHERE patient_surrogate_key % 10 <> 3))) "
        "SELECT *, CASE WHEN violations > 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM v"
    ),
)
