"""Queries over dashboards, checks and reports."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from riskloom.operators import checks, dashboard, governance, rollup
from riskloom.plans.catalog_models import GATE, VERSION_CTE
from riskloom.plans.registry import register
from riskloom.plans.sql_tables import oracle, r, share, since
from riskloom.session import work_dir
from riskloom.sources import testdata as td
from riskloom.sources.tables import batch_date_scan, lookback_scan, table_probe

AS_OF = td.AS_OF
A = "adjusted_prediction"


def recent(spark, sf_dir, days, with_nulls=False):
    return lookback_scan(td.predictions(spark, sf_dir, with_nulls=with_nulls), days, AS_OF)


def batch(spark, sf_dir):
    return batch_date_scan(td.predictions(spark, sf_dir), date(2024, 1, 30), AS_OF)


WEEK = f"(SELECT * FROM pred WHERE {since(7)})"
MONTH = f"(SELECT * FROM pred WHERE {since(30)})"
BATCH = "(SELECT * FROM pred WHERE cast(prediction_timestamp as date) = DATE '2024-01-30')"


def filtered(condition: str) -> str:
    return f"avg({A}) FILTER (WHERE {condition})"


def facts_sql(source: str) -> str:
    """CTEs ending in ``f``: the figures checks are made of."""
    return (
        f"rec AS (SELECT * FROM {source}), "
        "f0 AS (SELECT count(*) AS total, count(*) FILTER (WHERE high_risk_patient) AS high_n, "
        f"avg({A}) AS a, stddev_samp({A}) AS s, min({A}) AS mn, max({A}) AS mx, "
        f"{share('high_risk_patient')} AS hp, avg(prediction_lower_bound) AS al, "
        "avg(prediction_upper_bound) AS au, "
        + ", ".join(
            f"{share(chr(39).join(['risk_category = ', c, '']))} AS {c}_pct"
            for c in ("low", "medium", "high", "critical")
        )
        + f", {share(f'{A} IS NULL')} AS null_pct, {share(f'{A} < 0')} AS neg_pct, "
        f"{share(f'{A} > 100')} AS out_pct, "
        + filtered("patient_smoking_status = 'SMOKER'")
        + " AS sa, "
        + filtered("patient_smoking_status = 'NON_SMOKER'")
        + " AS na, "
        + filtered("bmi_category = 'obese'")
        + " AS oa, "
        + filtered("bmi_category = 'normal'")
        + " AS nb FROM rec), "
        f"f1 AS (SELECT count(*) AS rn, max(m) AS rmax, min(m) AS rmin FROM "
        f"(SELECT avg({A}) AS m FROM rec GROUP BY region)), "
        f"f2 AS (SELECT count(*) AS gn, max(m) - min(m) AS gap FROM "
        f"(SELECT avg({A}) AS m FROM rec GROUP BY sex)), "
        "f3 AS (SELECT count(*) AS days, avg(m) AS dm, "
        "stddev_pop(m) / nullif(avg(m), 0) * 100 AS cv FROM "
        f"(SELECT avg({A}) AS m FROM rec GROUP BY cast(prediction_timestamp as date))), "
        "ages AS (SELECT patient_age_category AS c, count(*) AS n, "
        f"avg({A}) AS m FROM rec GROUP BY 1), "
        "agel AS (SELECT *, lag(m) OVER (ORDER BY CASE c WHEN 'YOUNG' THEN 0 WHEN 'ADULT' THEN 1 "
        "WHEN 'MIDDLE_AGED' THEN 2 WHEN 'SENIOR' THEN 3 ELSE 4 END) AS p FROM ages), "
        "f4 AS (SELECT NOT coalesce(bool_or(m < p), false) AS mono FROM agel), "
        "f AS (SELECT *, (rmax - rmin) / rmin * 100 AS disp, "
        "(round(rmax, 2) - round(rmin, 2)) / round(rmin, 2) * 100 AS rdisp, "
        "CASE WHEN high_n > 0 THEN (high_n * 0.3 * 5000 - high_n * 500) / (high_n * 500) * 100 "
        "ELSE 0 END AS roi FROM f0, f1, f2, f3, f4)"
    )


def d(text: object) -> str:
    return f"cast({text} as double)"


# Dashboard -----------------------------------------------------------------
register(
    "volume_metrics",
    lambda s, p: dashboard.volume_metrics(recent(s, p, 7), 7),
    oracle(
        "SELECT count(*) AS total_predictions, count(DISTINCT customer_id) AS unique_patients, "
        "min(prediction_timestamp) AS earliest_prediction, "
        "max(prediction_timestamp) AS latest_prediction, "
        f"round(count(*) / {d(7)}, 2) AS avg_predictions_per_day FROM {WEEK}"
    ),
)
register(
    "risk_metrics",
    lambda s, p: dashboard.risk_metrics(recent(s, p, 7)),
    oracle(
        f"SELECT round(avg({A}), 2) AS avg_risk_score, round(stddev_samp({A}), 2) AS risk_std_dev, "
        f"round(min({A}), 2) AS min_risk, round(max({A}), 2) AS max_risk, "
        f"round(quantile_cont({A}, 0.5), 2) AS median_risk, "
        f"round(quantile_cont({A}, 0.95), 2) AS p95_risk, "
        f"{share('high_risk_patient', 2)} AS high_risk_percentage"
        + "".join(
            f", count(*) FILTER (WHERE risk_category = '{c}') AS {c}_count, "
            + share(f"risk_category = '{c}'", 2)
            + f" AS {c}_percentage"
            for c in dashboard.CATEGORIES
        )
        + f" FROM {WEEK}"
    ),
)
register(
    "demographic_metrics",
    lambda s, p: dashboard.demographic_metrics(recent(s, p, 7)),
    oracle(
        " UNION ALL ".join(
            f"SELECT '{block}' AS block, {column} AS group_value, count(*) AS \"count\", "
            f"round(avg({A}), 2) AS avg_risk, {high} AS high_risk_pct FROM {WEEK} GROUP BY 2"
            for block, column, high in (
                ("smoking_status", "patient_smoking_status", share("high_risk_patient", 2)),
                ("age_category", "patient_age_category", "cast(NULL as double)"),
                ("gender", "sex", share("high_risk_patient", 2)),
            )
        )
    ),
)
register(
    "regional_metrics",
    lambda s, p: dashboard.regional_metrics(recent(s, p, 7)),
    oracle(
        f"WITH g AS (SELECT region, count(*) AS n, round(avg({A}), 2) AS m, "
        f"round(coalesce(stddev_samp({A}), 0), 2) AS sd, {share('high_risk_patient', 2)} AS hp "
        f"FROM {WEEK} GROUP BY 1) SELECT region, n AS \"count\", m AS avg_risk, sd AS risk_std, "
        "hp AS high_risk_pct, round((max(m) OVER () - min(m) OVER ()) / min(m) OVER () * 100, 2) "
        "AS regional_disparity_pct FROM g"
    ),
)
register(
    "quality_metrics",
    lambda s, p: dashboard.quality_metrics(recent(s, p, 7)),
    oracle(
        f"SELECT {share(f'{A} IS NULL', 2)} AS null_prediction_pct, "
        f"{share(f'{A} < 0', 2)} AS negative_prediction_pct, "
        f"{share(f'{A} > 100', 2)} AS outlier_prediction_pct, "
        "round(avg(prediction_upper_bound - prediction_lower_bound), 2) "
        f"AS avg_confidence_interval_width, round(100 - {share(f'{A} IS NULL')}, 2) "
        f"AS data_completeness_pct FROM {WEEK}"
    ),
)
register(
    "trend_metrics",
    lambda s, p: dashboard.trend_metrics(td.predictions(s, p), 7, AS_OF),
    oracle(
        f"WITH t AS (SELECT *, {since(7)} AS cur FROM pred WHERE {since(14)}), "
        "x AS (SELECT count(*) FILTER (WHERE cur) AS n1, count(*) FILTER (WHERE NOT cur) AS n0, "
        f"avg({A}) FILTER (WHERE cur) AS a1, avg({A}) FILTER (WHERE NOT cur) AS a0, "
        "count(*) FILTER (WHERE cur AND high_risk_patient) AS h1, "
        "count(*) FILTER (WHERE NOT cur AND high_risk_patient) AS h0 FROM t) "
        "SELECT n1 AS current_volume, round(a1, 2) AS current_avg_risk, "
        f"round(h1 * {d(100)} / n1, 2) AS current_high_risk_pct, n0 AS previous_volume, "
        f"round(a0, 2) AS previous_avg_risk, round(h0 * {d(100)} / n0, 2) AS previous_high_risk_pct, "
        f"round((n1 - n0) / {d('n0')} * 100, 2) AS volume_change_pct, "
        "round((a1 - a0) / a0 * 100, 2) AS risk_change_pct FROM x"
    ),
)
register(
    "roi_metrics",
    lambda s, p: dashboard.roi_metrics(recent(s, p, 7)),
    oracle(
        f"WITH {facts_sql(WEEK)} SELECT high_n AS high_risk_patients_identified, "
        f"{d('high_n * 500')} AS estimated_intervention_costs, "
        f"round({d('high_n * 1500')}, 2) AS estimated_prevented_claims_value, "
        f"round({d('high_n * 1000')}, 2) AS estimated_net_benefit, "
        f"round({d('roi')}, 2) AS estimated_roi_pct FROM f"
    ),
)
ALERTS_SQL = (
    "al AS (SELECT 'LOW_VOLUME' AS type, 'WARNING' AS severity, "
    "concat('Low prediction volume: ', total, ' < 100') AS message FROM f WHERE total < 100 "
    "UNION ALL SELECT 'LOW_AVG_RISK', 'WARNING', "
    "concat('Average risk unusually low: ', round(a, 2)) FROM f WHERE round(a, 2) < 20 "
    "UNION ALL SELECT 'HIGH_AVG_RISK', 'WARNING', "
    "concat('Average risk unusually high: ', round(a, 2)) FROM f WHERE round(a, 2) > 70 "
    "UNION ALL SELECT 'LOW_HIGH_RISK_PCT', 'INFO', "
    "concat('Low high-risk percentage: ', round(hp, 2), '%') FROM f WHERE round(hp, 2) < 5 "
    "UNION ALL SELECT 'HIGH_HIGH_RISK_PCT', 'WARNING', "
    "concat('High high-risk percentage: ', round(hp, 2), '%') FROM f WHERE round(hp, 2) > 30 "
    "UNION ALL SELECT 'HIGH_REGIONAL_DISPARITY', 'WARNING', "
    "concat('High regional disparity: ', printf('%.1f', rdisp), '%') FROM f "
    "WHERE rn > 1 AND rdisp > {disparity} "
    "UNION ALL SELECT 'HIGH_NULL_RATE', 'ERROR', "
    "concat('High null prediction rate: ', round(null_pct, 2), '%') FROM f "
    "WHERE round(null_pct, 2) > 1)"
)
register(
    "dashboard_alerts",
    lambda s, p: dashboard.dashboard_alerts(
        recent(s, p, 7), dashboard.AlertLimits(regional_disparity_max=1.0)
    ),
    oracle(
        f"WITH {facts_sql(WEEK)}, {ALERTS_SQL.format(disparity=1)} SELECT * FROM al"
    ),
)


def _document(spark, sf_dir):
    model = governance.model_metrics(td.scored_versions(spark, sf_dir), td.CHAMPION)
    log = td.predictions(spark, sf_dir)
    stored = rollup.refresh(log, work_dir(spark, "rollup"))
    return dashboard.dashboard_document(log, AS_OF, 7, model, rollup=stored)


# The nested fields shown here, by block.
DOCUMENT_FIELDS = (
    "volume_metrics.total_predictions",
    "volume_metrics.unique_patients",
    "risk_metrics.avg_risk_score",
    "risk_metrics.median_risk",
    "risk_metrics.low_count",
    "regional_metrics.regional_disparity_pct",
    "quality_metrics.data_completeness_pct",
    "model_metrics.champion_version",
    "model_metrics.r2_score",
    "trend_metrics.volume_change_pct",
    "business_metrics.estimated_roi_pct",
)
register(
    "dashboard_document",
    lambda s, p: _document(s, p).select(
        *DOCUMENT_FIELDS,
        F.col("demographic_metrics.gender")["F"]["count"].alias("female_count"),
        F.col("demographic_metrics.smoking_status")["SMOKER"]["avg_risk"].alias("smoker_avg_risk"),
        F.col("regional_metrics.by_region")["NORTHEAST"]["count"].alias("northeast_count"),
        F.size("alerts").alias("alert_count"),
    ),
    oracle(
        f"WITH {VERSION_CTE}, {facts_sql(WEEK)}, {ALERTS_SQL.format(disparity=25)}, "
        f"pv AS (SELECT count(*) AS n FROM pred WHERE {since(14)} AND NOT ({since(7)})) "
        "SELECT total AS total_predictions, (SELECT count(DISTINCT customer_id) FROM rec) "
        "AS unique_patients, round(a, 2) AS avg_risk_score, "
        f"(SELECT round(quantile_cont({A}, 0.5), 2) FROM rec) AS median_risk, "
        "(SELECT count(*) FILTER (WHERE risk_category = 'low') FROM rec) AS low_count, "
        "round(rdisp, 2) AS regional_disparity_pct, round(100 - null_pct, 2) AS data_completeness_pct, "
        "1 AS champion_version, (SELECT round(vm.r2_score, 4) FROM vm WHERE model_version = '1') "
        "AS r2_score, (SELECT round((total - n) / cast(n as double) * 100, 2) FROM pv) "
        f"AS volume_change_pct, round({d('roi')}, 2) AS estimated_roi_pct, "
        "(SELECT count(*) FILTER (WHERE sex = 'F') FROM rec) AS female_count, "
        "round(sa, 2) AS smoker_avg_risk, "
        "(SELECT count(*) FILTER (WHERE region = 'NORTHEAST') FROM rec) AS northeast_count, "
        "cast((SELECT count(*) FROM al) as int) AS alert_count FROM f"
    ),
)
register("metrics_to_json", lambda s, p: dashboard.metrics_to_json(_document(s, p)))
register(
    "flatten_dashboard_row",
    lambda s, p: dashboard.flatten_dashboard_row(td.predictions(s, p), AS_OF),
    oracle(
        f"WITH {facts_sql(WEEK)}, {ALERTS_SQL.format(disparity=25)} "
        "SELECT TIMESTAMP '2024-01-31 00:00:00' AS metric_timestamp, 7 AS lookback_days, "
        "total AS total_predictions, (SELECT count(DISTINCT customer_id) FROM rec) "
        "AS unique_patients, round(a, 2) AS avg_risk_score, round(hp, 2) AS high_risk_percentage, "
        "round(rdisp, 2) AS regional_disparity_pct, round(100 - null_pct, 2) "
        f"AS data_completeness_pct, round({d('roi')}, 2) AS estimated_roi_pct, "
        "cast((SELECT count(*) FROM al) as int) AS alert_count FROM f"
    ),
)

# Source checks -------------------------------------------------------------
register(
    "required_columns_check",
    lambda s, p: checks.required_columns_check(
        td.dim_patient_rows(s, p).drop("number_of_dependents")
    ),
    oracle(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, {'false' if c == 'number_of_dependents' else 'true'} "
            f"AS present, {'count(NULL)' if c == 'number_of_dependents' else f'count({c})'} "
            f"AS value_count, '{'FAILED' if c == 'number_of_dependents' else 'SUCCESS'}' AS status "
            "FROM dim_rows"
            for c in checks.REQUIRED_COLUMNS
        )
    ),
)
register(
    "null_checks",
    lambda s, p: checks.null_checks(
        td.dim_patient_rows(s, p), (*checks.CRITICAL_COLUMNS, "health_risk_score")
    ),
    oracle(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count, "
            f"CASE WHEN count(*) FILTER (WHERE {c} IS NULL) > 0 THEN 'WARN' ELSE 'PASS' END AS status "
            "FROM dim_rows WHERE is_current_record"
            for c in (*checks.CRITICAL_COLUMNS, "health_risk_score")
        )
    ),
)
register(
    "bmi_range_check",
    lambda s, p: checks.bmi_range_check(td.dim_patient_rows(s, p)),
    oracle(
        "SELECT round(min(bmi), 6) AS min_bmi, round(max(bmi), 6) AS max_bmi, "
        "round(avg(bmi), 6) AS avg_bmi, CASE WHEN min(bmi) < 10 OR max(bmi) > 80 THEN 'WARN' "
        "ELSE 'PASS' END AS status FROM dim_rows WHERE is_current_record"
    ),
)
register(
    "data_validation_summary",
    lambda s, p: checks.data_validation_summary(
        table_probe(
            s, {"silver_patients": td.silver_patients(s, p), "dim_patients": td.dim_patients(s, p)}
        )
    ),
    oracle(
        "SELECT 'SUCCESS' AS status, cast(2 as bigint) AS validated_tables, "
        "cast(0 as bigint) AS failed_tables, (SELECT count(*) FROM silver) + "
        "(SELECT count(*) FROM dim) AS total_rows"
    ),
)

# Inference checks ----------------------------------------------------------
register(
    "inference_quality",
    lambda s, p: checks.inference_quality(
        batch_date_scan(td.predictions(s, p, with_nulls=True), date(2024, 1, 30), AS_OF)
    ),
    oracle(
        "SELECT count(*) AS prediction_count, "
        f"count(*) FILTER (WHERE {A} IS NULL) AS null_count, "
        "count(*) FILTER (WHERE prediction IS NULL) AS raw_null_count, "
        f"{r(f'min({A})', 'min_pred')}, {r(f'max({A})', 'max_pred')}, {r(f'avg({A})', 'avg_pred')}, "
        f"{r(f'stddev_samp({A})', 'std_pred')}, 'PASS' AS null_status, 'PASS' AS range_status "
        "FROM pred_nulls WHERE cast(prediction_timestamp as date) = DATE '2024-01-30'"
    ),
)


def check_sql(category: str, rows) -> str:
    """Check rows over ``f``: (name, status, value, low, high)."""
    return " UNION ALL ".join(
        f"SELECT '{category}' AS category, '{name}' AS check_name, {status} AS status, "
        f"round({d(value)}, 6) AS value, {d(low)} AS target_lo, {d(high)} AS target_hi FROM f"
        for name, status, value, low, high in rows
    )


register(
    "inference_kpis",
    lambda s, p: checks.inference_kpis(batch(s, p)),
    oracle(
        f"WITH {facts_sql(BATCH)} "
        + check_sql(
            "Inference KPIs",
            [
                (
                    "high_risk_pct",
                    "CASE WHEN hp < 5 THEN 'LOW' WHEN hp > 30 THEN 'HIGH' ELSE 'PASS' END",
                    "hp",
                    5,
                    30,
                ),
                (
                    "critical_pct",
                    "CASE WHEN critical_pct > 10 THEN 'HIGH' ELSE 'PASS' END",
                    "critical_pct",
                    "NULL",
                    10,
                ),
                (
                    "low_pct",
                    "CASE WHEN low_pct < 30 THEN 'LOW' ELSE 'PASS' END",
                    "low_pct",
                    30,
                    "NULL",
                ),
            ],
        )
    ),
)
register(
    "smoker_high_risk_rate",
    lambda s, p: checks.smoker_high_risk_rate(batch(s, p)),
    oracle(
        "SELECT count(*) AS smoker_count, "
        "count(*) FILTER (WHERE high_risk_patient) AS smoker_high_risk_count, "
        f"{r(share('high_risk_patient'), 'smoker_high_risk_pct')}, "
        f"CASE WHEN {share('high_risk_patient')} < 30 THEN 'WARN' WHEN count(*) > 0 THEN 'PASS' END "
        f"AS status FROM {BATCH} WHERE patient_smoking_status = 'SMOKER'"
    ),
)
register(
    "age_monotonic_check",
    lambda s, p: checks.age_monotonic_check(recent(s, p, 30)),
    oracle(
        f"WITH {facts_sql(MONTH)} SELECT c AS patient_age_category, round(m, 6) AS avg_risk, "
        "n AS patient_count, round(p, 6) AS previous_avg_risk, mono AS age_monotonic FROM agel, f4"
    ),
)

# Business validation -------------------------------------------------------
register(
    "business_kpis",
    lambda s, p: checks.business_kpis(recent(s, p, 30)),
    oracle(
        f"WITH {facts_sql(MONTH)} SELECT total AS total_predictions, {r('a', 'avg_risk_score')}, "
        f"{r('s', 'risk_score_std')}, {r('mn', 'min_risk')}, {r('mx', 'max_risk')}, "
        f"{r('hp', 'high_risk_pct')}, {r('al', 'avg_ci_lower')}, {r('au', 'avg_ci_upper')}, "
        "CASE WHEN hp BETWEEN 5 AND 25 THEN 'PASS' ELSE 'FAIL' END AS high_risk_status, "
        "CASE WHEN a BETWEEN 20 AND 60 THEN 'PASS' ELSE 'FAIL' END AS avg_risk_status, "
        "CASE WHEN total >= 100 THEN 'PASS' ELSE 'FAIL' END AS volume_status FROM f"
    ),
)
SMOKING_STATUS = "CASE WHEN sa > na THEN 'PASS' WHEN sa <= na THEN 'FAIL' END"
BMI_STATUS = "CASE WHEN oa > nb THEN 'PASS' WHEN oa <= nb THEN 'FAIL' END"
LM_STATUS = "CASE WHEN low_pct + medium_pct >= 60 THEN 'PASS' ELSE 'WARN' END"
REGION_STATUS = "CASE WHEN disp <= 20 THEN 'PASS' ELSE 'WARN' END"
GENDER_STATUS = "CASE WHEN gn = 2 THEN CASE WHEN gap <= 10 THEN 'PASS' ELSE 'WARN' END END"
CV_STATUS = (
    "CASE WHEN days <= 1 THEN 'INSUFFICIENT_DATA' WHEN cv < 10 THEN 'PASS' "
    "WHEN cv < 20 THEN 'WARN' ELSE 'FAIL' END"
)
register(
    "smoking_validity",
    lambda s, p: checks.smoking_validity(recent(s, p, 30)),
    oracle(
        f"WITH {facts_sql(MONTH)} SELECT {r('sa', 'smoker_avg')}, {r('na', 'non_smoker_avg')}, "
        f"{SMOKING_STATUS} AS status FROM f"
    ),
)
register(
    "bmi_category",
    lambda s, p: checks.bmi_categories(td.dim_patients(s, p)).select(
        "patient_natural_key", "bmi", "bmi_category"
    ),
    oracle(
        "SELECT patient_natural_key, round(bmi, 6) AS bmi, CASE WHEN bmi < 18.5 THEN 'underweight' "
        "WHEN bmi < 25 THEN 'normal' WHEN bmi < 30 THEN 'overweight' WHEN bmi >= 30 THEN 'obese' "
        "ELSE 'unknown' END AS bmi_category FROM dim"
    ),
)
register(
    "bmi_validity",
    lambda s, p: checks.bmi_validity(recent(s, p, 30)),
    oracle(
        f"WITH {facts_sql(MONTH)} SELECT {r('oa', 'obese_avg')}, {r('nb', 'normal_avg')}, "
        f"{BMI_STATUS} AS status FROM f"
    ),
)
register(
    "risk_distribution_validity",
    lambda s, p: checks.risk_distribution_validity(recent(s, p, 30)),
    oracle(
        f"WITH {facts_sql(MONTH)} SELECT {r('low_pct + medium_pct', 'low_medium_pct')}, "
        f"{LM_STATUS} AS status FROM f"
    ),
)
register(
    "regional_equity_check",
    lambda s, p: checks.regional_equity_check(recent(s, p, 30)),
    oracle(
        f"WITH {facts_sql(MONTH)} SELECT {r('rmax', 'max_regional_risk')}, "
        f"{r('rmin', 'min_regional_risk')}, {r('disp', 'regional_disparity')}, "
        f"{REGION_STATUS} AS status, CASE WHEN disp <= 15 THEN 'EXCELLENT' WHEN disp <= 25 "
        "THEN 'ACCEPTABLE' ELSE 'HIGH' END AS report_band FROM f"
    ),
)
register(
    "gender_equity_check",
    lambda s, p: checks.gender_equity_check(recent(s, p, 30)),
    oracle(
        f"WITH {facts_sql(MONTH)} SELECT gn AS gender_groups, {r('gap', 'gender_disparity')}, "
        f"{GENDER_STATUS} AS status, CASE WHEN gap <= 8 THEN 'EXCELLENT' WHEN gap <= 15 "
        "THEN 'ACCEPTABLE' ELSE 'REVIEW' END AS report_band FROM f"
    ),
)
register(
    "temporal_stability",
    lambda s, p: checks.temporal_stability(recent(s, p, 30)),
    oracle(
        f"WITH {facts_sql(MONTH)} SELECT days AS active_days, {r('dm', 'avg_daily_risk')}, "
        f"{r('cv', 'coefficient_of_variation')}, {CV_STATUS} AS status FROM f"
    ),
)
OPERATING_ROI = (
    f"(({d('high_n * 1500')} - ({d('high_n * 500')} + 2000)) / ({d('high_n * 500')} + 2000) * 100)"
)
ROI_STATUS = (
    f"CASE WHEN {OPERATING_ROI} > 100 THEN 'EXCELLENT' WHEN {OPERATING_ROI} > 50 THEN 'GOOD' "
    f"WHEN {OPERATING_ROI} > 0 THEN 'MARGINAL' ELSE 'NEGATIVE' END"
)
register(
    "roi_with_operating_cost",
    lambda s, p: checks.roi_with_operating_cost(recent(s, p, 30), 30),
    oracle(
        f"WITH {facts_sql(MONTH)} SELECT high_n AS high_risk_patients, "
        f"{d('high_n * 500')} AS intervention_costs, {d('high_n * 500 + 2000')} AS total_costs, "
        f"{d('high_n * 1500')} AS prevented_claims_value, {d('high_n * 1000 - 2000')} AS net_benefit, "
        f"{r(OPERATING_ROI, 'roi_pct')}, {ROI_STATUS} AS roi_status FROM f"
    ),
)
BUSINESS_CHECKS_SQL = (
    "ck AS (SELECT * FROM ("
    + check_sql(
        "Business KPIs",
        [
            (
                "high_risk_pct",
                "CASE WHEN hp BETWEEN 5 AND 25 THEN 'PASS' ELSE 'FAIL' END",
                "hp",
                5,
                25,
            ),
            ("avg_risk", "CASE WHEN a BETWEEN 20 AND 60 THEN 'PASS' ELSE 'FAIL' END", "a", 20, 60),
            (
                "volume",
                "CASE WHEN total >= 100 THEN 'PASS' ELSE 'FAIL' END",
                "total",
                100,
                "NULL",
            ),
        ],
    )
    + " UNION ALL "
    + check_sql(
        "Clinical Relevance",
        [
            ("smoking_correlation", SMOKING_STATUS, "sa - na", 0, "NULL"),
            (
                "age_correlation",
                "CASE WHEN mono THEN 'PASS' ELSE 'WARN' END",
                "cast(mono as int)",
                1,
                "NULL",
            ),
            ("bmi_correlation", BMI_STATUS, "oa - nb", 0, "NULL"),
            ("risk_distribution", LM_STATUS, "low_pct + medium_pct", 60, "NULL"),
        ],
    )
    + " UNION ALL "
    + check_sql(
        "Regional Equity",
        [
            ("regional_equity", REGION_STATUS, "disp", "NULL", 20),
            ("gender_equity", GENDER_STATUS, "gap", "NULL", 10),
        ],
    )
    + " UNION ALL "
    + check_sql("Temporal Stability", [("temporal_stability", CV_STATUS, "cv", "NULL", 10)])
    + " UNION ALL "
    + check_sql("ROI", [("roi_status", ROI_STATUS, OPERATING_ROI, 0, "NULL")])
    + ") WHERE status IS NOT NULL)"
)


def _business_checks(spark, sf_dir):
    return checks.business_checks(recent(spark, sf_dir, 30), 30)


register(
    "business_checks",
    _business_checks,
    oracle(f"WITH {facts_sql(MONTH)}, {BUSINESS_CHECKS_SQL} SELECT * FROM ck"),
)
register(
    "validation_scorecard",
    lambda s, p: checks.validation_scorecard(
        checks.union_checks(
            _business_checks(s, p),
            checks.champion_checks(td.scored_versions(s, p), td.CHAMPION),
        )
    ),
    oracle(
        f"WITH {facts_sql(MONTH)}, {BUSINESS_CHECKS_SQL}, al AS (SELECT status FROM ck "
        "UNION ALL SELECT 'PASS' UNION ALL SELECT 'INFO'), n AS (SELECT count(*) AS t, "
        "count(*) FILTER (WHERE status IN ('PASS', 'EXCELLENT', 'GOOD')) AS p, "
        "count(*) FILTER (WHERE status IN ('WARN', 'MARGINAL')) AS w, "
        "count(*) FILTER (WHERE status IN ('FAIL', 'NEGATIVE')) AS x FROM al) "
        "SELECT t AS total_checks, p AS passed, w AS warnings, x AS failures, "
        "CASE WHEN x = 0 AND w = 0 THEN 'EXCELLENT' WHEN x = 0 THEN 'GOOD' WHEN x <= 2 "
        "THEN 'ACCEPTABLE' ELSE 'NEEDS_IMPROVEMENT' END AS overall_status FROM n"
    ),
)

# Executive report ----------------------------------------------------------
register(
    "executive_summary",
    lambda s, p: checks.executive_summary(recent(s, p, 30)),
    oracle(
        f"WITH {facts_sql(MONTH)} SELECT (SELECT count(DISTINCT patient_natural_key) FROM rec) "
        f"AS unique_patients, total AS total_predictions, {r('a', 'avg_risk_score')}, "
        f"high_n AS high_risk_count, {r('hp', 'high_risk_pct')}, "
        f"{d('high_n * 500')} AS intervention_costs, {d('high_n * 1500')} AS prevented_claims_value, "
        f"{d('high_n * 1000')} AS net_benefit, {r(d('roi'), 'roi_pct')}, "
        "CASE WHEN roi > 100 AND hp BETWEEN 5 AND 25 THEN 'EXCELLENT' WHEN roi > 50 THEN 'GOOD' "
        "WHEN roi > 0 THEN 'ACCEPTABLE' ELSE 'NEEDS_IMPROVEMENT' END AS overall_status FROM f"
    ),
)
register(
    "report_quality_metrics",
    lambda s, p: checks.report_quality_metrics(
        recent(s, p, 30).withColumns(
            {
                "confidence_interval_upper": F.col("prediction_upper_bound"),
                "confidence_interval_lower": F.col("prediction_lower_bound"),
            }
        )
    ),
    oracle(
        f"WITH {facts_sql(MONTH)} SELECT {r('null_pct', 'null_pct')}, {r('neg_pct', 'negative_pct')}, "
        f"{r('out_pct', 'outlier_pct')}, {r('au - al', 'avg_ci')}, "
        f"{r('100 - null_pct', 'completeness_pct')}, CASE WHEN null_pct < 1 AND out_pct < 1 "
        "THEN 'EXCELLENT' WHEN null_pct < 5 THEN 'ACCEPTABLE' ELSE 'ATTENTION' END AS quality_band "
        "FROM f"
    ),
)
register(
    "daily_volume_last7",
    lambda s, p: checks.daily_volume_last7(recent(s, p, 30)),
    oracle(
        "WITH v AS (SELECT strftime(prediction_timestamp, '%Y-%m-%d') AS date, "
        f"count(*) AS prediction_count FROM {MONTH} GROUP BY 1 ORDER BY 1 DESC LIMIT 7) "
        "SELECT *, round(avg(prediction_count) OVER (), 6) AS avg_daily_volume FROM v"
    ),
)
register(
    "business_performance",
    lambda s, p: checks.business_performance(recent(s, p, 30)),
    oracle(
        f"WITH {facts_sql(MONTH)} "
        + check_sql(
            "Business Performance",
            [
                (
                    "low_risk_pct",
                    "CASE WHEN low_pct >= 30 THEN 'PASS' ELSE 'LOW' END",
                    "low_pct",
                    30,
                    "NULL",
                ),
                (
                    "high_risk_pct",
                    "CASE WHEN hp < 5 THEN 'LOW' WHEN hp > 25 THEN 'HIGH' ELSE 'PASS' END",
                    "hp",
                    5,
                    25,
                ),
                (
                    "critical_pct",
                    "CASE WHEN critical_pct < 10 THEN 'PASS' ELSE 'HIGH' END",
                    "critical_pct",
                    "NULL",
                    10,
                ),
            ],
        )
    ),
)
register(
    "intervention_breakdown",
    lambda s, p: checks.intervention_breakdown(recent(s, p, 30)),
    oracle(
        f"SELECT risk_category, count(*) AS \"count\", {r(f'avg({A})', 'avg_risk')} "
        f"FROM {MONTH} WHERE high_risk_patient GROUP BY 1"
    ),
)
CLINICAL = (
    "coalesce(sa > na, false) AS c1, mono AS c2, coalesce(oa > nb, false) AS c3"
)
register(
    "clinical_scorecard",
    lambda s, p: checks.clinical_scorecard(recent(s, p, 30)),
    oracle(
        f"WITH {facts_sql(MONTH)}, c AS (SELECT {CLINICAL} FROM f) SELECT c1 AS smoking_impact, "
        "c2 AS age_correlation, c3 AS bmi_impact, "
        "c1::int + c2::int + c3::int AS passed_checks, 3 AS total_checks FROM c"
    ),
)
ADVICE = [
    ("hp < 5", "HIGH", "Business", checks.ADVICE_RAISE),
    ("hp > 25", "HIGH", "Business", checks.ADVICE_LOWER),
    ("roi < 50", "HIGH", "Business", checks.ADVICE_ROI),
    ("NOT mono", "MEDIUM", "Clinical", checks.ADVICE_AGE),
    ("sa <= na", "HIGH", "Clinical", checks.ADVICE_SMOKING),
    ("rn > 1 AND disp > 25", "MEDIUM", "Equity", checks.ADVICE_REGION),
    ("null_pct > 1", "MEDIUM", "Technical", checks.ADVICE_NULLS),
    ("out_pct > 2", "LOW", "Technical", checks.ADVICE_OUTLIERS),
]
register(
    "recommendations",
    lambda s, p: checks.recommendations(recent(s, p, 30)),
    oracle(
        f"WITH {facts_sql(MONTH)}, rc AS ("
        + " UNION ALL ".join(
            f"SELECT '{priority}' AS priority, '{area}' AS area, '{text}' AS recommendation "
            f"FROM f WHERE {condition}"
            for condition, priority, area, text in ADVICE
        )
        + ") SELECT * FROM rc UNION ALL "
        f"SELECT 'INFO', 'Success', '{checks.ADVICE_NONE}' WHERE (SELECT count(*) FROM rc) = 0"
    ),
)
register(
    "final_scorecard",
    lambda s, p: checks.final_scorecard(
        recent(s, p, 30),
        governance.governance_status(td.scored_versions(s, p), td.CHAMPION),
    ),
    oracle(
        f"WITH {VERSION_CTE}, {facts_sql(MONTH)}, c AS (SELECT {CLINICAL} FROM f), "
        "v AS (SELECT null_pct < 1 AND out_pct < 2 AS v1, hp BETWEEN 5 AND 25 AND roi > 50 AS v2, "
        "c1::int + c2::int + c3::int >= 2 AS v3, rn <= 1 OR disp <= 25 AS v4, "
        f"(SELECT {GATE} FROM vm WHERE model_version = '1') AS v5 FROM f, c), "
        "n AS (SELECT *, v1::int + v2::int + v3::int + v4::int + v5::int AS k FROM v) "
        "SELECT v1 AS technical_validation, v2 AS business_performance, v3 AS clinical_relevance, "
        "v4 AS regional_equity, v5 AS model_governance, k AS passed_categories, "
        f"{d('k * 20')} AS overall_score, CASE WHEN k * 20 >= 90 THEN 'EXCELLENT' "
        "WHEN k * 20 >= 70 THEN 'GOOD' WHEN k * 20 >= 50 THEN 'ACCEPTABLE' "
        "ELSE 'NEEDS_IMPROVEMENT' END AS final_status FROM n"
    ),
)
