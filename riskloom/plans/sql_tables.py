"""The derived tables of ``sources.testdata`` as SQL, for the check statements."""

from __future__ import annotations

KEY = "concat('P', lpad(cast({0} as varchar), 8, '0'))"
PATIENT_COLUMNS = f"""
  c_custkey AS patient_surrogate_key,
  {KEY.format('c_custkey')} AS patient_natural_key,
  CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS patient_gender,
  CASE n_regionkey WHEN 0 THEN 'NORTHEAST' WHEN 1 THEN 'NORTHWEST'
                   WHEN 2 THEN 'SOUTHEAST' ELSE 'SOUTHWEST' END AS patient_region,
  CASE (c_custkey * 7) % 5 WHEN 0 THEN 'YOUNG' WHEN 1 THEN 'ADULT' WHEN 2 THEN 'MIDDLE_AGED'
                           WHEN 3 THEN 'SENIOR' ELSE 'ELDERLY' END AS patient_age_category,
  CASE WHEN (c_custkey * 13) % 6 = 0 THEN 'SMOKER' ELSE 'NON_SMOKER' END AS patient_smoking_status,
  cast(160 + (c_custkey * 37) % 341 as double) / cast(10 as double) AS bmi,
  cast(c_custkey % 4 as int) AS number_of_dependents,
  CASE WHEN c_custkey % 10 = 0 THEN NULL
       ELSE cast(25 + (c_custkey * 17) % 61 as double) END AS health_risk_score,
  CASE WHEN (c_custkey * 13) % 6 = 0 THEN 'SMOKING' ELSE 'NONE' END AS lifestyle_risk_factors"""

SCORE_COLUMNS = """
  CASE WHEN adjusted_prediction < 30 THEN 'low' WHEN adjusted_prediction < 60 THEN 'medium'
       WHEN adjusted_prediction < 85 THEN 'high' ELSE 'critical' END AS risk_category,
  adjusted_prediction * cast(0.9 as double) AS prediction_lower_bound,
  adjusted_prediction * cast(1.1 as double) AS prediction_upper_bound,
  adjusted_prediction > 75 AS high_risk_patient,
  adjusted_prediction > 90 AS requires_review,
  CASE WHEN bmi IS NULL THEN 'unknown' WHEN bmi < 18.5 THEN 'underweight' WHEN bmi < 25 THEN 'normal'
       WHEN bmi < 30 THEN 'overweight' ELSE 'obese' END AS bmi_category"""


def _pred(score: str) -> str:
    return f"""
  SELECT *, {SCORE_COLUMNS} FROM (
    SELECT *, greatest(prediction, cast(10 as double)) AS adjusted_prediction FROM (
      SELECT e.event_id, {score} AS prediction, e.ts AS prediction_timestamp,
        d.patient_surrogate_key, d.patient_natural_key, d.patient_natural_key AS customer_id,
        d.patient_gender, d.patient_region, d.patient_age_category, d.patient_smoking_status,
        d.bmi, d.number_of_dependents, d.health_risk_score, d.patient_data_quality_score,
        d.hipaa_deidentification_applied, d.patient_region AS region, d.patient_gender AS sex,
        'insurance_model' AS model_name, '1' AS model_version
      FROM events e JOIN dim d ON e.user_id = d.patient_surrogate_key))"""


_SCORE = "cast(100 as double) * value / (value + cast(40 as double))"

CTES = {
    "cust": """
  SELECT * FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "dim": f"""
  SELECT {PATIENT_COLUMNS}, cast(1 as double) AS patient_data_quality_score,
    true AS hipaa_deidentification_applied, true AS is_current_record,
    TIMESTAMP '2024-01-30 00:00:00' AS dimension_last_updated
  FROM cust""",
    "dim_rows": """
  SELECT * FROM dim
  UNION ALL SELECT * REPLACE (TIMESTAMP '2024-01-02 00:00:00' AS dimension_last_updated)
    FROM dim WHERE patient_surrogate_key % 3 = 0
  UNION ALL SELECT * REPLACE (TIMESTAMP '2024-01-02 00:00:00' AS dimension_last_updated,
    false AS is_current_record) FROM dim WHERE patient_surrogate_key % 4 = 0""",
    "silver": """
  SELECT patient_natural_key AS patient_id,
    cast(18 + (patient_surrogate_key * 7) % 68 as int) AS age, patient_gender AS sex, bmi,
    number_of_dependents AS children, (patient_surrogate_key * 13) % 6 = 0 AS smoker,
    patient_region AS region, c_acctbal + cast(1000 as double) AS charges, patient_age_category,
    CASE patient_surrogate_key % 3 WHEN 0 THEN 'LOW_RISK' WHEN 1 THEN 'MODERATE_RISK'
         ELSE 'HIGH_RISK' END AS health_risk_category,
    concat(patient_age_category, '_', patient_region) AS demographic_segment,
    cast(1 as double) AS patient_data_quality_score
  FROM dim JOIN customer ON c_custkey = patient_surrogate_key""",
    "features": """
  SELECT *, CASE WHEN age < 25 THEN 1 WHEN age < 35 THEN 2 WHEN age < 50 THEN 3
                 WHEN age < 65 THEN 4 ELSE 5 END AS age_risk_score,
    cast(CASE WHEN smoker THEN age * 2.5 ELSE age END as double) AS smoking_impact,
    cast(1 + children * 0.15 as double) AS family_size_factor,
    cast(CASE region WHEN 'NORTHEAST' THEN 1.2 WHEN 'NORTHWEST' THEN 1.1 WHEN 'SOUTHEAST' THEN 1.0
         ELSE 0.95 END as double) AS regional_multiplier,
    coalesce(health_risk_score, cast(
      CASE WHEN age < 25 THEN 1 WHEN age < 35 THEN 2 WHEN age < 50 THEN 3 WHEN age < 65 THEN 4
           ELSE 5 END * 20
      + CASE WHEN smoker THEN 50 ELSE 0 END + CASE WHEN bmi > 30 THEN 30 ELSE 0 END as double))
      AS health_risk_composite
  FROM (SELECT *, number_of_dependents AS children, patient_region AS region,
      patient_gender AS sex, patient_data_quality_score AS data_quality_score,
      hipaa_deidentification_applied AS hipaa_compliant, patient_natural_key AS customer_id,
      CASE patient_age_category WHEN 'YOUNG' THEN 25 WHEN 'ADULT' THEN 35
        WHEN 'MIDDLE_AGED' THEN 45 WHEN 'SENIOR' THEN 60 ELSE 70 END AS age,
      patient_smoking_status = 'SMOKER' AS smoker FROM dim)""",
    "pred": _pred(_SCORE),
    "pred_nulls": _pred(f"CASE WHEN e.event_id % 97 = 0 THEN NULL ELSE {_SCORE} END"),
    "versions": """
  SELECT event_id, customer_id, patient_region, prediction_timestamp, v AS model_version,
    p.prediction + cast((event_id * 31) % 21 - 10 as double) * k AS prediction,
    p.prediction AS label
  FROM pred p, (VALUES ('1', cast(1 as double)), ('2', cast(0.5 as double)),
                       ('3', cast(4 as double))) m(v, k)""",
    "claims": f"""
  SELECT cast(o_orderkey as varchar) AS claim_id, {KEY.format('o_custkey')} AS patient_id,
    o_totalprice AS claim_amount, strftime(o_orderdate, '%Y-%m-%d') AS claim_date,
    CASE o_orderstatus WHEN 'F' THEN 'APPROVED' WHEN 'O' THEN 'DENIED' ELSE 'PAID' END AS status
  FROM orders""",
}


def oracle(body: str) -> str:
    """Prefix ``body`` with the derived tables it may read."""
    text = body.strip()
    ctes = ",\n".join(f"{name} AS ({sql})" for name, sql in CTES.items())
    if text.upper().startswith("WITH "):
        return f"WITH {ctes},\n{text[5:]}"
    return f"WITH {ctes}\n{text}"


def r(expression: str, name: str | None = None, digits: int = 6) -> str:
    """Rounded output column."""
    return f"round({expression}, {digits}) AS {name}" if name else f"round({expression}, {digits})"


def share(condition: str, digits: int | None = None) -> str:
    """Percentage of rows that meet a condition."""
    text = f"(count(*) FILTER (WHERE {condition}) * cast(100 as double) / nullif(count(*), 0))"
    return f"round({text}, {digits})" if digits is not None else text


def since(days: int, column: str = "prediction_timestamp") -> str:
    return f"{column} >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL {days} DAY"
