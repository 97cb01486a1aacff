"""Queries over features and exploratory summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.functions import rules
from riskloom.operators import explore, features
from riskloom.plans.registry import register
from riskloom.plans.sql_tables import oracle, r, share
from riskloom.sources import testdata as td

PATIENT_FIELDS = (
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


def _feature_table(spark, sf_dir):
    return features.build_feature_table(td.dim_patients(spark, sf_dir))


register(
    "enrich_patients",
    lambda s, d: features.enrich_patients(td.silver_patients(s, d), td.dim_patient_rows(s, d)),
    oracle(
        "SELECT s.* REPLACE (round(s.bmi, 6) AS bmi, round(s.charges, 6) AS charges), "
        "d.health_risk_score, d.lifestyle_risk_factors FROM silver s LEFT JOIN dim d "
        "ON s.patient_id = d.patient_natural_key"
    ),
)
register(
    "eda_profile",
    lambda s, d: explore.eda_profile(td.silver_patients(s, d)),
    oracle(
        f"SELECT count(*) AS total_patients, {r('avg(age)', 'avg_age')}, "
        f"{r(share('smoker'), 'smoker_percentage')}, "
        + ", ".join(r(share(f"{c} IS NULL"), f"missing_{c}") for c in PATIENT_FIELDS)
        + f", {r('quantile_cont(charges, 0.95)', 'high_cost_threshold')} FROM silver"
    ),
)
register(
    "risk_factor_analysis",
    lambda s, d: explore.risk_factor_analysis(td.silver_patients(s, d)),
    oracle(
        "SELECT smoker, patient_age_category, round(avg(charges), 2) AS charges_mean, "
        "round(stddev_samp(charges), 2) AS charges_std, round(avg(bmi), 2) AS bmi_mean, "
        "round(quantile_cont(charges, 0.5), 2) AS charges_median FROM silver GROUP BY 1, 2"
    ),
)
register(
    "correlation_matrix",
    lambda s, d: explore.correlation_matrix(td.silver_patients(s, d)),
    oracle(
        " UNION ALL ".join(
            f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) AS correlation "
            "FROM silver"
            for a in explore.CORRELATED
            for b in explore.CORRELATED
        )
    ),
)
register(
    "box_stats",
    lambda s, d: explore.box_stats(td.silver_patients(s, d)),
    oracle(
        "SELECT region, smoker, round(min(charges), 6) AS min_charges, "
        "round(quantile_cont(charges, 0.25), 6) AS q1_charges, "
        "round(quantile_cont(charges, 0.5), 6) AS median_charges, "
        "round(quantile_cont(charges, 0.75), 6) AS q3_charges, "
        "round(max(charges), 6) AS max_charges FROM silver GROUP BY 1, 2"
    ),
)
register(
    "high_risk_cohort",
    lambda s, d: explore.high_risk_cohort(td.silver_patients(s, d)),
    oracle(
        "SELECT count(*) AS high_risk_patients_count, round(avg(charges), 6) AS high_risk_avg_cost "
        "FROM silver WHERE smoker AND bmi > 30 AND age > 50"
    ),
)


def _feature_query(name, expression, sql):
    """A feature rule over the whole dimension."""
    register(
        name,
        lambda s, d: td.dim_patients(s, d).select(
            F.col("patient_natural_key").alias("customer_id"), expression().alias(name)
        ),
        oracle(f"SELECT customer_id, {sql} AS {name} FROM features"),
    )


def _age():
    return rules.age_from_category("patient_age_category")


def _smoker():
    return rules.smoker_flag("patient_smoking_status")


def _composite():
    return rules.health_risk_composite(
        "health_risk_score", rules.age_risk_score(_age()), _smoker(), "bmi"
    )


_feature_query("age_from_category", _age, "age")
_feature_query("smoker_flag", _smoker, "smoker")
_feature_query("age_risk_score", lambda: rules.age_risk_score(_age()), "age_risk_score")
_feature_query("smoking_impact", lambda: rules.smoking_impact(_smoker(), _age()), "smoking_impact")
_feature_query(
    "family_size_factor",
    lambda: rules.family_size_factor("number_of_dependents"),
    "family_size_factor",
)
_feature_query(
    "regional_multiplier",
    lambda: rules.regional_multiplier("patient_region"),
    "regional_multiplier",
)
_feature_query("health_risk_composite", _composite, "health_risk_composite")
register(
    "column_aliases",
    lambda s, d: features.column_aliases(td.dim_patients(s, d)).select(
        "customer_id", "children", "region", "sex", "data_quality_score", "hipaa_compliant"
    ),
    oracle(
        "SELECT customer_id, children, region, sex, data_quality_score, hipaa_compliant "
        "FROM features"
    ),
)
register(
    "build_feature_table",
    lambda s, d: features.build_feature_table(td.dim_patient_rows(s, d)),
    oracle("SELECT * REPLACE (round(bmi, 6) AS bmi) FROM features"),
)
register(
    "dedupe_keep_latest",
    lambda s, d: features.dedupe_keep_latest(
        td.dim_patient_rows(s, d), ["patient_natural_key"], features.newest_first()
    ).select("patient_natural_key", "dimension_last_updated", "is_current_record"),
    oracle(
        "SELECT patient_natural_key, dimension_last_updated, is_current_record FROM ("
        "SELECT *, row_number() OVER (PARTITION BY patient_natural_key "
        "ORDER BY dimension_last_updated DESC, patient_surrogate_key DESC) AS rn FROM dim_rows) "
        "WHERE rn = 1"
    ),
)
register(
    "feature_lookup",
    lambda s, d: features.feature_lookup(
        td.predictions(s, d).select("event_id", "customer_id", "prediction"),
        _feature_table(s, d),
        ["age_risk_score", "smoking_impact", "health_risk_composite"],
    ),
    oracle(
        "SELECT p.event_id, customer_id, round(p.prediction, 6) AS prediction, f.age_risk_score, "
        "f.smoking_impact, f.health_risk_composite FROM pred p LEFT JOIN features f "
        "USING (customer_id)"
    ),
)
register(
    "training_set",
    lambda s, d: features.training_set(td.dim_patients(s, d), _feature_table(s, d)),
    oracle(
        "SELECT customer_id, patient_natural_key, patient_gender, patient_region, "
        "patient_age_category, patient_smoking_status, round(bmi, 6) AS bmi, "
        "number_of_dependents, health_risk_score, lifestyle_risk_factors, "
        "patient_data_quality_score, hipaa_deidentification_applied, is_current_record, "
        "age_risk_score, smoking_impact, family_size_factor, regional_multiplier, "
        "health_risk_composite, data_quality_score, sex, region FROM features"
    ),
)
_NUMERIC = features.NUMERIC_FEATURES
_RANGE_SQL = {"age_risk_score": (1, 5), "regional_multiplier": (0.95, 1.2)}
register(
    "feature_range_check",
    lambda s, d: features.feature_range_check(
        _feature_table(s, d).withColumn("health_risk_score", F.col("health_risk_score")),
        (*_NUMERIC, "health_risk_score"),
    ),
    oracle(
        "SELECT *, CASE WHEN null_pct > 5 OR out_of_range_count > 0 THEN 'FAIL' ELSE 'PASS' END "
        "AS status FROM ("
        + " UNION ALL ".join(
            f"SELECT '{c}' AS feature_name, count(*) AS total_count, "
            f"count(*) FILTER (WHERE {c} IS NULL) AS null_count, "
            + (
                f"count(*) FILTER (WHERE {c} < cast({_RANGE_SQL[c][0]} as double) "
                f"OR {c} > cast({_RANGE_SQL[c][1]} as double)) "
                if c in _RANGE_SQL
                else "cast(0 as bigint) "
            )
            + f"AS out_of_range_count, {r(share(f'{c} IS NULL'), 'null_pct')} FROM features"
            for c in (*_NUMERIC, "health_risk_score")
        )
        + ")"
    ),
)
register(
    "feature_summary_by_risk",
    lambda s, d: features.feature_summary_by_risk(td.predictions(s, d), _feature_table(s, d)),
    oracle(
        "SELECT risk_category, count(*) AS prediction_count, "
        + ", ".join(r(f"avg(f.{c})", f"avg_{c}") for c in _NUMERIC)
        + " FROM pred p LEFT JOIN features f USING (customer_id) GROUP BY 1"
    ),
)
