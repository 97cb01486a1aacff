"""Validation and ad-hoc queries over the prediction log."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from riskloom.operators import checks, features
from riskloom.operators import validation as v
from riskloom.plans.registry import register
from riskloom.plans.sql_tables import oracle, r, share, since
from riskloom.sources import testdata as td

AS_OF = td.AS_OF
AVG = r("avg(adjusted_prediction)", "avg_risk_score")
STD = r("stddev_samp(adjusted_prediction)", "risk_std")
HIGH_PCT = f"{share('high_risk_patient', 2)} AS high_risk_pct"
SMOKER_SHARE = share("patient_smoking_status = 'SMOKER'", 2)
OBESE_SHARE = share("bmi_category = 'obese'", 2)
CRITICAL_SHARE = share("risk_category = 'critical'", 2)
LOW_SHARE = share("risk_category = 'low'", 2)
WIDTH = "avg(prediction_upper_bound - prediction_lower_bound)"
MIN_MAX = (
    "round(min(adjusted_prediction), 6) AS min_risk, round(max(adjusted_prediction), 6) AS max_risk"
)


def _over_log(name, operator, sql, with_nulls=False):
    register(
        name, lambda s, d: operator(td.predictions(s, d, with_nulls=with_nulls), AS_OF), oracle(sql)
    )


_over_log(
    "daily_prediction_summary",
    v.daily_prediction_summary,
    f"SELECT cast(prediction_timestamp as date) AS prediction_date, count(*) AS total_predictions, "
    f"{AVG}, round(stddev_samp(adjusted_prediction), 6) AS risk_score_std, {MIN_MAX}, "
    f"count(*) FILTER (WHERE high_risk_patient) AS high_risk_count, {HIGH_PCT}, "
    f"count(DISTINCT customer_id) AS unique_patients FROM pred WHERE {since(30)} GROUP BY 1",
)
_over_log(
    "risk_category_distribution",
    v.risk_category_distribution,
    f"SELECT risk_category, count(*) AS patient_count, {AVG}, "
    "round(min(adjusted_prediction), 6) AS min_risk_score, "
    "round(max(adjusted_prediction), 6) AS max_risk_score, "
    "round(count(*) * cast(100 as double) / sum(count(*)) OVER (), 2) AS percentage "
    f"FROM pred WHERE {since(7)} GROUP BY 1",
)
for _name, _operator, _column, _alias, _std in (
    ("risk_by_smoking", v.risk_by_smoking, "patient_smoking_status", "smoking_status", True),
    ("risk_by_age", v.risk_by_age, "patient_age_category", "age_category", True),
    ("risk_by_bmi_category", v.risk_by_bmi_category, "bmi_category", "bmi_category", False),
    ("risk_by_gender", v.risk_by_gender, "sex", "gender", False),
):
    _over_log(
        _name,
        _operator,
        f"SELECT {_column} AS {_alias}, count(*) AS patient_count, {AVG}, "
        f"{STD + ', ' if _std else ''}{HIGH_PCT} FROM pred WHERE {since(7)} GROUP BY 1",
    )
_over_log(
    "regional_equity",
    v.regional_equity,
    f"SELECT region, count(*) AS patient_count, {AVG}, {STD}, {MIN_MAX}, {HIGH_PCT}, "
    f"{r(WIDTH, 'avg_ci_width')} FROM pred WHERE {since(7)} GROUP BY 1",
)
_over_log(
    "regional_disparity",
    v.regional_disparity,
    "WITH m AS (SELECT avg(adjusted_prediction) AS a FROM pred "
    f"WHERE {since(7)} GROUP BY region) SELECT round(max(a), 6) AS max_regional_risk, "
    "round(min(a), 6) AS min_regional_risk, round(max(a) - min(a), 6) AS risk_disparity, "
    "round((max(a) - min(a)) / nullif(min(a), 0) * 100, 2) AS disparity_pct FROM m",
)
_over_log(
    "high_risk_summary",
    v.high_risk_summary,
    f"SELECT count(*) AS total_high_risk_patients, {AVG}, "
    "round(min(adjusted_prediction), 6) AS min_risk_score, "
    "count(DISTINCT region) AS regions_represented, "
    f"{SMOKER_SHARE} AS smoker_pct, "
    f"{OBESE_SHARE} AS obese_pct "
    f"FROM pred WHERE high_risk_patient AND {since(7)}",
)
_over_log(
    "high_risk_by_category",
    v.high_risk_by_category,
    f"SELECT risk_category, count(*) AS patient_count, {AVG}, "
    "round(avg(number_of_dependents), 6) AS avg_dependents FROM pred "
    f"WHERE high_risk_patient AND {since(7)} GROUP BY 1",
)
_over_log(
    "weekly_performance",
    v.weekly_performance,
    "SELECT cast(date_trunc('week', prediction_timestamp) as date) AS week_start, "
    f"count(*) AS prediction_count, {AVG}, {STD}, {HIGH_PCT}, {r(WIDTH, 'avg_ci_width')}, "
    "min(prediction_timestamp) AS earliest_prediction, "
    f"max(prediction_timestamp) AS latest_prediction FROM pred WHERE {since(90)} GROUP BY 1",
)
_over_log(
    "prediction_quality",
    v.prediction_quality,
    "SELECT count(*) AS total_predictions, "
    "count(*) FILTER (WHERE adjusted_prediction IS NULL) AS null_predictions, "
    "count(*) FILTER (WHERE prediction IS NULL) AS null_raw_predictions, "
    "count(*) FILTER (WHERE adjusted_prediction < 0) AS negative_predictions, "
    "count(*) FILTER (WHERE adjusted_prediction > 100) AS outlier_predictions, "
    f"{r(WIDTH, 'avg_uncertainty')}, "
    f"{share('adjusted_prediction IS NOT NULL', 2)} AS prediction_success_rate "
    f"FROM pred_nulls WHERE {since(7)}",
    with_nulls=True,
)
_over_log(
    "feature_completeness",
    v.feature_completeness,
    "SELECT count(*) AS total_records, "
    + ", ".join(
        f"count(*) FILTER (WHERE {source} IS NULL) AS missing_{name}"
        for source, name in (
            ("customer_id", "customer_id"),
            ("patient_smoking_status", "smoking_status"),
            ("region", "region"),
            ("patient_age_category", "age_category"),
            ("bmi_category", "bmi_category"),
            ("sex", "sex"),
        )
    )
    + f" FROM pred WHERE {since(7)}",
)
_over_log(
    "duplicate_predictions",
    v.duplicate_predictions,
    "SELECT customer_id, cast(prediction_timestamp as date) AS prediction_date, "
    f"count(*) AS prediction_count FROM pred WHERE {since(7)} GROUP BY 1, 2 "
    "HAVING count(*) > 1 ORDER BY 3 DESC, 1, 2 LIMIT 100",
)
_over_log(
    "high_risk_flag_accuracy",
    v.high_risk_flag_accuracy,
    "WITH recent AS (SELECT adjusted_prediction AS x, high_risk_patient AS flagged FROM pred "
    f"WHERE {since(7)}), q AS (SELECT quantile_cont(x, 0.95) AS p95 FROM recent) "
    "SELECT count(*) AS total_high_risk_flagged, "
    "count(*) FILTER (WHERE x >= p95) AS correctly_flagged, "
    "count(*) FILTER (WHERE x < p95) AS incorrectly_flagged, "
    f"{share('x >= p95', 2)} AS flag_accuracy_pct FROM recent, q WHERE flagged",
)
_over_log(
    "category_boundaries",
    v.category_boundaries,
    f"SELECT risk_category, {MIN_MAX}, count(*) AS patient_count FROM pred "
    f"WHERE {since(7)} GROUP BY 1",
)
_NOW = f"({since(7)})"
_over_log(
    "week_over_week",
    v.week_over_week,
    "WITH w AS (SELECT avg(adjusted_prediction) FILTER (WHERE cur) AS a, "
    "avg(adjusted_prediction) FILTER (WHERE NOT cur) AS b, count(*) FILTER (WHERE cur) AS n, "
    "count(*) FILTER (WHERE NOT cur) AS m, count(*) FILTER (WHERE cur AND high_risk_patient) AS nh, "
    "count(*) FILTER (WHERE NOT cur AND high_risk_patient) AS mh "
    f"FROM (SELECT *, {_NOW} AS cur FROM pred WHERE {since(14)})) "
    "SELECT round(a, 6) AS current_avg_risk, round(b, 6) AS last_week_avg_risk, "
    "round(a - b, 2) AS risk_change, round((a - b) / nullif(b, 0) * 100, 2) AS risk_change_pct, "
    "n AS current_volume, m AS last_week_volume, n - m AS volume_change, "
    "round(nh * cast(100 as double) / nullif(n, 0), 2) AS current_high_risk_pct, "
    "round(mh * cast(100 as double) / nullif(m, 0), 2) AS last_week_high_risk_pct FROM w",
)
_over_log(
    "top_high_risk_patients",
    v.top_high_risk_patients,
    "SELECT customer_id, round(adjusted_prediction, 6) AS risk_score, risk_category, "
    "patient_smoking_status AS smoking_status, bmi_category, patient_age_category AS age_category, "
    "region, number_of_dependents, round(prediction_lower_bound, 6) AS confidence_interval_lower, "
    "round(prediction_upper_bound, 6) AS confidence_interval_upper, prediction_timestamp "
    f"FROM pred WHERE high_risk_patient AND {since(7)} "
    "ORDER BY adjusted_prediction DESC, customer_id, prediction_timestamp LIMIT 100",
)
_over_log(
    "rapidly_increasing_risk",
    v.rapidly_increasing_risk,
    "WITH daily AS (SELECT customer_id, cast(prediction_timestamp as date) AS day, "
    f"avg(adjusted_prediction) AS risk FROM pred WHERE {since(30)} GROUP BY 1, 2), "
    "ranked AS (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY day DESC) AS k "
    "FROM daily), pairs AS (SELECT customer_id, max(risk) FILTER (WHERE k = 1) AS a, "
    "max(risk) FILTER (WHERE k = 7) AS b FROM ranked GROUP BY 1) "
    "SELECT customer_id, round(a, 6) AS latest_risk, round(b, 6) AS week_ago_risk, "
    "round(a - b, 2) AS risk_increase, round((a - b) / nullif(b, 0) * 100, 2) AS risk_increase_pct "
    "FROM pairs WHERE a > b ORDER BY 4 DESC, 1 LIMIT 50",
)
_over_log(
    "executive_dashboard",
    v.executive_dashboard,
    "SELECT 'Last 7 Days' AS time_period, count(DISTINCT customer_id) AS unique_patients_scored, "
    "count(*) AS total_predictions, round(avg(adjusted_prediction), 2) AS avg_risk_score, "
    f"count(*) FILTER (WHERE high_risk_patient) AS high_risk_patients, {HIGH_PCT}, "
    f"{CRITICAL_SHARE} AS critical_pct, "
    f"{LOW_SHARE} AS low_risk_pct, "
    "count(DISTINCT region) AS regions_covered, "
    f"round({WIDTH}, 2) AS avg_prediction_uncertainty FROM pred WHERE {since(7)}",
)
_over_log(
    "risk_anomaly_alert",
    v.risk_anomaly_alert,
    "WITH daily AS (SELECT cast(prediction_timestamp as date) AS day, "
    f"avg(adjusted_prediction) AS risk FROM pred WHERE {since(30)} GROUP BY 1), "
    "base AS (SELECT avg(risk) AS m, stddev_samp(risk) AS s FROM daily "
    "WHERE day < DATE '2024-01-24') SELECT day AS prediction_date, round(risk, 6) AS avg_risk, "
    "round(m, 6) AS baseline_avg, round(risk - m, 2) AS deviation, "
    "round((risk - m) / nullif(s, 0), 2) AS z_score, CASE "
    "WHEN abs((risk - m) / nullif(s, 0)) > 2 THEN 'ALERT' "
    "WHEN abs((risk - m) / nullif(s, 0)) > 1.5 THEN 'WARNING' ELSE 'NORMAL' END AS alert_status "
    "FROM daily, base WHERE day >= DATE '2024-01-24'",
)

# Ad-hoc questions ----------------------------------------------------------
register(
    "care_management_list",
    lambda s, d: v.care_management_list(td.predictions(s, d), datetime(2024, 1, 30)),
    oracle(
        "SELECT customer_id, round(adjusted_prediction, 6) AS adjusted_prediction, risk_category, "
        "region FROM pred WHERE high_risk_patient "
        "AND prediction_timestamp >= TIMESTAMP '2024-01-30 00:00:00'"
    ),
)
_over_log(
    "region_category_matrix",
    v.region_category_matrix,
    f"SELECT patient_region, risk_category, count(*) AS patient_count, {AVG} FROM pred "
    f"WHERE {since(30)} GROUP BY 1, 2",
)


def _features(spark, sf_dir):
    return features.build_feature_table(td.dim_patients(spark, sf_dir))


register(
    "patient_journey",
    lambda s, d: v.patient_journey(
        td.dim_patients(s, d), _features(s, d), td.predictions(s, d)
    ),
    oracle(
        "SELECT p.customer_id, p.prediction_timestamp, round(p.prediction, 6) AS prediction, "
        "round(p.adjusted_prediction, 6) AS adjusted_prediction, p.risk_category, "
        "d.patient_age_category, d.patient_smoking_status, f.age_risk_score, "
        "f.health_risk_composite FROM pred p JOIN dim d ON d.patient_natural_key = p.customer_id "
        "JOIN features f ON f.customer_id = p.customer_id"
    ),
)
register(
    "missing_predictions",
    lambda s, d: v.missing_predictions(
        td.dim_patient_rows(s, d),
        _features(s, d).where(F.substring("customer_id", 2, 8).cast("int") % 4 != 1),
        td.predictions(s, d),
    ),
    oracle(
        "SELECT patient_natural_key AS customer_id, patient_surrogate_key % 4 <> 1 AS has_features "
        "FROM dim_rows WHERE is_current_record AND patient_natural_key NOT IN "
        "(SELECT customer_id FROM pred)"
    ),
)
register(
    "risk_transitions",
    lambda s, d: v.risk_transitions(td.predictions(s, d)),
    oracle(
        "SELECT customer_id, previous_category, current_category, "
        "round(previous_score, 6) AS previous_score, round(current_score, 6) AS current_score, "
        "changed_at FROM (SELECT customer_id, risk_category AS current_category, "
        "adjusted_prediction AS current_score, prediction_timestamp AS changed_at, "
        "lag(risk_category) OVER w AS previous_category, "
        "lag(adjusted_prediction) OVER w AS previous_score, "
        "lead(event_id) OVER w AS later FROM pred WINDOW w AS (PARTITION BY customer_id "
        "ORDER BY prediction_timestamp, event_id)) "
        "WHERE later IS NULL AND previous_category <> current_category"
    ),
)
register(
    "latest_prediction",
    lambda s, d: v.latest_prediction(td.predictions(s, d)).select(
        "customer_id", "event_id", "prediction_timestamp", "adjusted_prediction", "risk_category"
    ),
    oracle(
        "SELECT customer_id, event_id, prediction_timestamp, "
        "round(adjusted_prediction, 6) AS adjusted_prediction, risk_category FROM pred "
        "QUALIFY row_number() OVER (PARTITION BY customer_id "
        "ORDER BY prediction_timestamp DESC, event_id DESC) = 1"
    ),
)
register(
    "prediction_volume_by_version",
    lambda s, d: v.prediction_volume_by_version(td.scored_versions(s, d)),
    oracle(
        "SELECT cast(prediction_timestamp as date) AS prediction_date, model_version, "
        "count(*) AS prediction_count FROM versions GROUP BY 1, 2"
    ),
)
register(
    "score_statistics",
    lambda s, d: v.score_statistics(td.predictions(s, d)),
    oracle(
        f"SELECT {r('avg(adjusted_prediction)', 'avg_score')}, "
        f"{r('min(adjusted_prediction)', 'min_score')}, "
        f"{r('max(adjusted_prediction)', 'max_score')}, "
        f"{r('quantile_cont(adjusted_prediction, 0.5)', 'median_score')} FROM pred"
    ),
)
register(
    "source_freshness",
    lambda s, d: v.source_freshness(td.dim_patient_rows(s, d), AS_OF),
    oracle(
        "SELECT cast(dimension_last_updated as date) AS update_date, count(*) AS record_count, "
        "cast(date_diff('hour', max(dimension_last_updated), TIMESTAMP '2024-01-31 00:00:00') "
        "as double) AS hours_since_update, date_diff('hour', max(dimension_last_updated), "
        "TIMESTAMP '2024-01-31 00:00:00') > 48 AS is_stale FROM dim_rows "
        "WHERE is_current_record GROUP BY 1"
    ),
)
register(
    "source_null_check",
    lambda s, d: v.source_null_check(td.dim_patient_rows(s, d)),
    oracle(
        "SELECT count(*) AS total_records, "
        "count(*) FILTER (WHERE patient_age_category IS NULL) AS null_age, "
        "count(*) FILTER (WHERE bmi IS NULL) AS null_bmi, "
        "count(*) FILTER (WHERE patient_smoking_status IS NULL) AS null_smoking "
        "FROM dim_rows WHERE is_current_record"
    ),
)
_over_log(
    "recent_volume_check",
    v.recent_volume_check,
    "SELECT count(*) FILTER (WHERE prediction_timestamp >= TIMESTAMP '2024-01-30 23:00:00') "
    "AS last_hour_predictions, count(*) FILTER (WHERE prediction_timestamp >= "
    "TIMESTAMP '2024-01-30 00:00:00') AS last_day_predictions FROM pred",
)
register(
    "actual_vs_predicted_by_region",
    lambda s, d: v.actual_vs_predicted_by_region(td.predictions(s, d)),
    oracle(
        'SELECT patient_region, count(*) AS "count", '
        f"{r('avg(health_risk_score)', 'avg_actual_risk')}, "
        f"{r('avg(adjusted_prediction)', 'avg_predicted_risk')}, "
        f"{r('avg(adjusted_prediction) - avg(health_risk_score)', 'avg_gap')} FROM pred GROUP BY 1"
    ),
)
register(
    "smokers_high_bmi_regional_top",
    lambda s, d: v.smokers_high_bmi_regional_top(td.predictions(s, d)),
    oracle(
        "SELECT region, cast(k as int) AS regional_rank, customer_id, round(bmi, 6) AS bmi, "
        "round(adjusted_prediction, 6) AS adjusted_prediction, risk_category FROM ("
        "SELECT *, row_number() OVER (PARTITION BY region ORDER BY adjusted_prediction DESC, "
        "customer_id, prediction_timestamp DESC, event_id DESC) AS k FROM pred "
        "WHERE patient_smoking_status = 'SMOKER' AND bmi > 30) WHERE k <= 10"
    ),
)


def _schema_changes(spark, sf_dir):
    """The event log against the schema that an earlier copy of it was stored with."""
    events = td.table(spark, sf_dir, "events")
    earlier = {f.name: f.dataType.simpleString() for f in events.schema.fields if f.name != "event_type"}
    return checks.schema_change_check(events, {**earlier, "event_id": "int", "channel": "string"})


register(
    "schema_change_check",
    _schema_changes,
    "SELECT 'channel' AS column_name, 'REMOVED' AS change, 'string' AS expected_type, "
    "cast(NULL as varchar) AS current_type, cast(0 as bigint) AS value_count UNION ALL "
    "SELECT 'event_id', 'RETYPED', 'int', 'bigint', count(event_id) FROM events UNION ALL "
    "SELECT 'event_type', 'ADDED', NULL, 'string', count(event_type) FROM events",
)
