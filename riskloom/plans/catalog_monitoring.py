"""Queries over profiles, drift windows, alerts and decisions."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from riskloom.operators import business, drift, fairness, features, governance, monitoring
from riskloom.plans.catalog_metrics import (
    BUSINESS_COLUMNS,
    DISPARITY_CTE,
    EDGES,
    GRADES,
    WEEKDAYS_CTE,
    drift_ctes,
    halves,
)
from riskloom.plans.catalog_models import VERSION_CTE
from riskloom.plans.registry import register
from riskloom.plans.sql_tables import oracle, r, share
from riskloom.sources import testdata as td
from riskloom.sources.tables import batch_date_scan, time_range

AS_OF = td.AS_OF
A = "adjusted_prediction"
NOW = "TIMESTAMP '2024-01-31 00:00:00'"
UNITS = (("1 day", "day"), ("1 week", "week"))

register(
    "profile_inference",
    lambda s, d: monitoring.profile_inference(td.predictions(s, d, with_nulls=True)),
    oracle(
        " UNION ALL ".join(
            f"SELECT '{name}' AS granularity, cast(date_trunc('{unit}', prediction_timestamp) as date) "
            f"AS window_start, model_name, count(*) AS prediction_count, "
            f"{r(f'avg({A})', 'avg_prediction')}, {r(f'stddev_samp({A})', 'std_prediction')}, "
            f"{r(f'min({A})', 'min_prediction')}, {r(f'max({A})', 'max_prediction')}, "
            "count(*) FILTER (WHERE prediction IS NULL) AS null_count, "
            f"{r(f'quantile_cont({A}, 0.25)', 'p25')}, {r(f'quantile_cont({A}, 0.5)', 'p50')}, "
            f"{r(f'quantile_cont({A}, 0.75)', 'p75')} FROM pred_nulls GROUP BY 1, 2, 3"
            for name, unit in UNITS
        )
    ),
)
# All columns of the feature table.
NUMERIC = (
    "patient_surrogate_key", "bmi", "number_of_dependents", "health_risk_score", "patient_data_quality_score",
    "children", "data_quality_score", "age", "age_risk_score", "smoking_impact", "family_size_factor",
    "regional_multiplier", "health_risk_composite",
)
LABELS = (
    "patient_natural_key", "patient_gender", "patient_region", "patient_age_category", "patient_smoking_status",
    "lifestyle_risk_factors", "hipaa_deidentification_applied", "is_current_record", "dimension_last_updated",
    "region", "sex", "hipaa_compliant", "customer_id", "smoker",
)
# Distinct counts are approximate; those above 100 are compared in tens.
DISTINCT = "CASE WHEN {0} > 100 THEN cast(round({0}, -1) as bigint) ELSE {0} END"


def _snapshot(spark, sf_dir):
    profile = monitoring.profile_snapshot(features.build_feature_table(td.dim_patients(spark, sf_dir)))
    return profile.withColumn("distinct_count", F.expr(DISTINCT.format("distinct_count")))


register(
    "profile_snapshot",
    _snapshot,
    oracle(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) AS total_count, "
            f"count(*) FILTER (WHERE {c} IS NULL) AS null_count, {r(share(f'{c} IS NULL'), 'null_pct')}, "
            + (
                f"cast(NULL as double) AS avg_value, cast(NULL as double) AS std_value, "
                "cast(NULL as double) AS min_value, cast(NULL as double) AS max_value, "
                f"{DISTINCT.format(f'count(DISTINCT {c})')} AS distinct_count "
                if c in LABELS
                else f"{r(f'avg({c})', 'avg_value')}, {r(f'stddev_samp({c})', 'std_value')}, "
                f"round(cast(min({c}) as double), 6) AS min_value, "
                f"round(cast(max({c}) as double), 6) AS max_value, "
                "cast(NULL as bigint) AS distinct_count "
            )
            + "FROM features"
            for c in (*NUMERIC, *LABELS)
        )
    ),
)
register(
    "profile_time_series",
    lambda s, d: monitoring.profile_time_series(td.dim_patient_rows(s, d)),
    oracle(
        " UNION ALL ".join(
            f"SELECT '{name}' AS granularity, cast(date_trunc('{unit}', dimension_last_updated) as date) "
            "AS window_start, count(*) AS record_count, "
            "count(*) FILTER (WHERE is_current_record) AS current_records, "
            "count(*) FILTER (WHERE NOT is_current_record) AS historical_records, "
            "round(count(*) FILTER (WHERE is_current_record) * cast(1 as double) / "
            "nullif(count(*) FILTER (WHERE NOT is_current_record), 0), 6) AS current_to_historical, "
            f"{r('avg(bmi)', 'avg_bmi')}, {r(share('bmi IS NULL'), 'null_bmi_pct')} "
            "FROM dim_rows GROUP BY 1, 2"
            for name, unit in UNITS
        )
    ),
)
SLICES = (
    ("all", "'all'"),
    *[(c, c) for c in monitoring.SLICES.values()],
)
register(
    "profile_slices",
    lambda s, d: monitoring.profile_slices(td.predictions(s, d)),
    oracle(
        " UNION ALL ".join(
            f"SELECT '{name}' AS slice_key, {column} AS slice_value, count(*) AS prediction_count, "
            f"{r(f'avg({A})', 'avg_prediction')}, {r(f'stddev_samp({A})', 'std_prediction')}, "
            f"{r(f'min({A})', 'min_prediction')}, {r(f'max({A})', 'max_prediction')}, "
            f"{r(share('high_risk_patient'), 'high_risk_pct')} FROM pred GROUP BY 2"
            for name, column in SLICES
        )
    ),
)


def day():
    return monitoring.window_start("prediction_timestamp", "day")


PSI_TERM = (
    "(CASE WHEN c = 0 THEN 0.0001 ELSE c / cn END - CASE WHEN b = 0 THEN 0.0001 ELSE b / bn END)"
    " * ln(CASE WHEN c = 0 THEN 0.0001 ELSE c / cn END / CASE WHEN b = 0 THEN 0.0001 ELSE b / bn END)"
)
KL_TERM = (
    "CASE WHEN c = 0 THEN 1e-10 ELSE c / ci END"
    " * ln(CASE WHEN c = 0 THEN 1e-10 ELSE c / ci END / CASE WHEN b = 0 THEN 1e-10 ELSE b / bi END)"
)
# Scores per window from ``rw(w, b, x)`` and ``ed(w, q)``.
WINDOW_SCORES = (
    "ix AS (SELECT w, b, x, CASE WHEN x = q[11] THEN 10 ELSE len(list_filter(q, lambda e: e <= x)) "
    "END AS i FROM rw JOIN ed USING (w)), "
    "tt AS (SELECT w, cast(count(*) FILTER (WHERE b) as double) AS bn, "
    "cast(count(*) FILTER (WHERE NOT b) as double) AS cn, "
    "cast(count(*) FILTER (WHERE b AND i BETWEEN 1 AND 10) as double) AS bi, "
    "cast(count(*) FILTER (WHERE NOT b AND i BETWEEN 1 AND 10) as double) AS ci, "
    "avg(x) FILTER (WHERE NOT b) - avg(x) FILTER (WHERE b) AS shift FROM ix GROUP BY 1), "
    "cc AS (SELECT w, i, count(*) FILTER (WHERE b) AS b, count(*) FILTER (WHERE NOT b) AS c FROM ix "
    "WHERE i BETWEEN 1 AND 10 GROUP BY 1, 2), "
    f"ws AS (SELECT w, sum({PSI_TERM}) AS psi_score, sum({KL_TERM}) AS kl_divergence, "
    "any_value(cn) AS cn, any_value(shift) AS shift FROM cc JOIN tt USING (w) GROUP BY 1)"
)


def window_select(kind: str, column: str) -> str:
    return (
        f"SELECT w AS window_start, '{column}' AS column_name, '{kind}' AS drift_type, "
        f"cast(cn as bigint) AS window_count, {r('shift', 'mean_shift')}, "
        f"{r('psi_score', 'psi_score')}, {r('kl_divergence', 'kl_divergence')}, {GRADES} FROM ws"
    )


DAYS = f"dv AS (SELECT cast(prediction_timestamp as date) AS d, {A} AS x FROM pred)"
CONSECUTIVE = (
    f"{DAYS}, nx AS (SELECT d, lead(d) OVER (ORDER BY d) AS nd FROM (SELECT DISTINCT d FROM dv)), "
    "rw AS (SELECT d AS w, false AS b, x FROM dv UNION ALL "
    "SELECT nd, true, x FROM dv JOIN nx USING (d) WHERE nd IS NOT NULL), "
    f"eq AS (SELECT w, quantile_cont(x, {EDGES}) AS q FROM rw WHERE b GROUP BY 1), "
    "ed AS (SELECT w, list_append(q[1:10], q[11] + 0.001) AS q FROM eq), " + WINDOW_SCORES
)
VS_BASELINE = (
    f"{DAYS}, base AS (SELECT x FROM dv WHERE d < DATE '2024-01-16'), "
    "cd AS (SELECT DISTINCT d FROM dv WHERE d >= DATE '2024-01-16'), "
    "rw AS (SELECT d AS w, false AS b, x FROM dv WHERE d >= DATE '2024-01-16' UNION ALL "
    "SELECT d, true, x FROM base, cd), "
    f"eq AS (SELECT quantile_cont(x, {EDGES}) AS q FROM base), "
    "ed AS (SELECT d AS w, list_append(q[1:10], q[11] + 0.001) AS q FROM eq, cd), " + WINDOW_SCORES
)
register(
    "drift_consecutive",
    lambda s, d: drift.drift_consecutive(td.predictions(s, d), [A], day()),
    oracle(f"WITH {CONSECUTIVE} {window_select('CONSECUTIVE', A)}"),
)
register(
    "drift_vs_baseline",
    lambda s, d: drift.drift_vs_baseline(*halves(s, d), [A], day()),
    oracle(f"WITH {VS_BASELINE} {window_select('BASELINE', A)}"),
)

# Histories: one report row per day of the log -------------------------------


def _by_day(df):
    return df.withColumn("metric_date", F.to_date("prediction_timestamp"))


def fairness_by_day(spark, sf_dir):
    rows = _by_day(td.predictions(spark, sf_dir))
    return fairness.fairness_report(rows, F.col("metric_date").cast("timestamp_ntz"), by=["metric_date"])


def business_by_day(spark, sf_dir):
    rows = _by_day(td.predictions(spark, sf_dir))
    return business.business_report(
        rows, F.col("metric_date").cast("timestamp_ntz"), window_days=1, by=["metric_date"]
    )


def drift_by_day(spark, sf_dir):
    return drift.drift_vs_baseline(*halves(spark, sf_dir), [A], day())


DAILY_DISPARITY = "dd AS (" + " UNION ALL ".join(
    f"SELECT d, '{a}' AS attribute, stddev_samp(m) / avg(m) AS disparity FROM "
    f"(SELECT cast(prediction_timestamp as date) AS d, {a}, avg({A}) AS m FROM pred GROUP BY 1, 2) "
    "GROUP BY 1"
    for a in fairness.PROTECTED
) + (
    "), fd AS (SELECT d, coalesce(bool_or(disparity > 0.15), false) AS unfair, "
    + ", ".join(
        f"max(disparity) FILTER (WHERE attribute = '{a}') AS {a}_disparity"
        for a in fairness.PROTECTED
    )
    + " FROM dd GROUP BY 1)"
)
COUNTS = "dc AS (SELECT cast(prediction_timestamp as date) AS d, count(*) AS n FROM pred GROUP BY 1)"
FAIRNESS_ROW = (
    "d AS metric_date, cast(d as timestamp) AS metric_timestamp, n AS total_predictions, "
    + ", ".join(r(f"{a}_disparity", f"{a}_disparity") for a in fairness.PROTECTED)
    + ", unfair AS fairness_threshold_violation FROM fd JOIN dc USING (d)"
)
register(
    "metric_history_fairness",
    lambda s, d: monitoring.metric_history(fairness_by_day(s, d), 7, AS_OF),
    oracle(
        f"WITH {DAILY_DISPARITY}, {COUNTS} SELECT {FAIRNESS_ROW} WHERE d >= DATE '2024-01-24'"
    ),
)
register(
    "metric_history_drift",
    lambda s, d: monitoring.metric_history(
        drift_by_day(s, d).withColumn("metric_timestamp", F.col("window_start").cast("timestamp_ntz")),
        30,
        AS_OF,
    ).select("metric_date", "column_name", "psi_score", "drift_severity"),
    oracle(
        f"WITH {VS_BASELINE} SELECT metric_date, column_name, psi_score, drift_severity FROM ("
        f"SELECT window_start AS metric_date, * FROM ({window_select('BASELINE', A)}))"
    ),
)
register(
    "metric_history_business",
    lambda s, d: monitoring.metric_history(business_by_day(s, d), 7, AS_OF).select(
        "metric_date",
        "total_predictions",
        "high_risk_percentage",
        "mean_prediction",
        "daily_avg_predictions",
    ),
    oracle(
        "SELECT cast(prediction_timestamp as date) AS metric_date, count(*) AS total_predictions, "
        f"{r(share('high_risk_patient'), 'high_risk_percentage')}, "
        f"{r(f'avg({A})', 'mean_prediction')}, cast(count(*) as double) AS daily_avg_predictions "
        "FROM pred WHERE prediction_timestamp >= TIMESTAMP '2024-01-24 00:00:00' GROUP BY 1"
    ),
)
register(
    "latest_metrics",
    lambda s, d: monitoring.latest_metrics(fairness_by_day(s, d), 5),
    oracle(
        f"WITH {DAILY_DISPARITY}, {COUNTS} SELECT {FAIRNESS_ROW} ORDER BY d DESC LIMIT 5"
    ),
)


def _alert_history(spark, sf_dir):
    history = monitoring.daily_monitoring_history(
        business_by_day(spark, sf_dir),
        fairness_by_day(spark, sf_dir),
        drift_by_day(spark, sf_dir),
    )
    return monitoring.alert_history(history, 30, AS_OF)


register(
    "alert_history",
    _alert_history,
    oracle(
        f"WITH {DAILY_DISPARITY}, {COUNTS}, {VS_BASELINE}, h AS (SELECT d, n, "
        "cast(unfair as int) AS u, cast(coalesce(psi_score > 0.25, false) as bigint) AS k FROM dc "
        "JOIN fd USING (d) LEFT JOIN ws ON ws.w = d) SELECT d AS metric_date, CASE WHEN u > 0 "
        "THEN 'FAIRNESS' WHEN k > 0 THEN 'DRIFT' WHEN n < 50 THEN 'VOLUME' ELSE 'OK' END AS alert_type, "
        "n AS daily_predictions, u AS fairness_violations, k AS significant_drift_count FROM h"
    ),
)

PERIOD = (datetime(2023, 12, 25), datetime(2024, 1, 31))
GAP = "NOT (prediction_timestamp >= TIMESTAMP '2024-01-10 03:00:00' AND prediction_timestamp < TIMESTAMP '2024-01-12 00:30:00')"


def _gappy(spark, sf_dir):
    """The log with a spell without rows."""
    return td.predictions(spark, sf_dir).where(GAP.replace("TIMESTAMP ", "TIMESTAMP_NTZ "))


HOURS = (
    "slots AS (SELECT unnest(generate_series(TIMESTAMP '2023-12-25', TIMESTAMP '2024-01-30 23:00:00', "
    "INTERVAL 1 HOUR)) AS slot), seen AS (SELECT date_trunc('hour', prediction_timestamp) AS slot, "
    f"count(*) AS n FROM pred WHERE {GAP} GROUP BY 1), volume AS (SELECT s.slot, coalesce(n, 0) AS n "
    "FROM slots s LEFT JOIN seen ON s.slot = seen.slot)"
)
register(
    "silence_alerts",
    lambda s, d: monitoring.silence_alerts(_gappy(s, d), *PERIOD),
    oracle(
        f"WITH {HOURS}, numbered AS (SELECT *, row_number() OVER (ORDER BY slot) AS r FROM volume), "
        "spells AS (SELECT slot, r - row_number() OVER (ORDER BY slot) AS g FROM numbered WHERE n = 0) "
        "SELECT min(slot) AS silent_from, count(*) AS silent_hours FROM spells GROUP BY g HAVING count(*) > 2"
    ),
)
register(
    "low_volume_days",
    lambda s, d: monitoring.low_volume_days(_gappy(s, d), *PERIOD),
    oracle(
        f"WITH {HOURS} SELECT cast(slot as date) AS metric_date, cast(sum(n) as bigint) AS row_count "
        "FROM volume GROUP BY 1 HAVING sum(n) < 50"
    ),
)

# Summaries and alerts --------------------------------------------------------


def _reports(spark, sf_dir):
    log = td.predictions(spark, sf_dir)
    return (
        business.business_report(log, AS_OF),
        fairness.fairness_report(log, AS_OF),
        drift.population_drift(td.dim_patients(spark, sf_dir), log, AS_OF),
    )


POPULATION = (
    drift_ctes("d0", "bmi", "dim", "pred")
    + ", "
    + drift_ctes("d1", "health_risk_score", "dim", "pred")
    + ", pd AS (SELECT * FROM d0 UNION ALL SELECT * FROM d1)"
)
register(
    "monitoring_summary",
    lambda s, d: monitoring.monitoring_summary(*_reports(s, d), monitors_active=3),
    oracle(
        f"WITH {WEEKDAYS_CTE}, {DISPARITY_CTE}, {POPULATION}, br AS (SELECT {BUSINESS_COLUMNS} FROM pred) "
        f"SELECT {NOW} AS metric_timestamp, total_predictions, high_risk_percentage, "
        "daily_avg_predictions, mean_prediction, "
        "(SELECT cast(bool_or(disparity > 0.15) as bigint) FROM disp) AS fairness_violations, "
        "(SELECT count(*) FILTER (WHERE psi_score > 0.25) FROM pd) AS significant_drift_count, "
        "3 AS monitors_active FROM br"
    ),
)


def all_custom_metrics(spark, sf_dir):
    """The three reports of a run as (report, metric document) rows."""
    parts = []
    for name, report in zip(("business", "fairness", "drift"), _reports(spark, sf_dir), strict=True):
        parts.append(report.select(F.lit(name).alias("report"), F.to_json(F.struct("*")).alias("metrics")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


register("all_custom_metrics", all_custom_metrics)


def _custom_alerts(spark, sf_dir):
    log = td.predictions(spark, sf_dir)
    # A tight limit and shifted scores make both kinds of alert appear.
    report = fairness.fairness_report(log, AS_OF, limit=0.0001)
    before, after = halves(spark, sf_dir)
    shifted = after.withColumn(A, F.col(A) * 1.5)
    return monitoring.custom_alerts(
        report, drift.drift_multi_column(before, shifted, [A, "bmi"], AS_OF)
    )


SHIFTED = (
    f"(SELECT * REPLACE ({A} * cast(1.5 as double) AS {A}) FROM pred "
    "WHERE prediction_timestamp >= TIMESTAMP '2024-01-16 00:00:00')"
)
BEFORE = "(SELECT * FROM pred WHERE prediction_timestamp < TIMESTAMP '2024-01-16 00:00:00')"
register(
    "custom_alerts",
    _custom_alerts,
    oracle(
        f"WITH {DISPARITY_CTE}, {drift_ctes('d0', A, BEFORE, SHIFTED)}, "
        f"{drift_ctes('d1', 'bmi', BEFORE, SHIFTED)}, u AS (SELECT * FROM d0 UNION ALL SELECT * FROM d1) "
        "SELECT 'FAIRNESS' AS alert_type, 'threshold_violation' AS subject, cast(NULL as double) AS value "
        "FROM (SELECT bool_or(disparity > 0.0001) AS v FROM disp) WHERE v UNION ALL "
        f"SELECT 'DRIFT', column_name, {r('psi_score')} FROM u WHERE psi_score > 0.25"
    ),
)


def _quality(spark, sf_dir, version):
    rows = td.scored_versions(spark, sf_dir).where(F.col("model_version") == version)
    return governance.version_metrics(rows)


def _thresholds(spark, sf_dir):
    before, after = halves(spark, sf_dir)
    metrics = monitoring.monitored_metrics(
        td.predictions(spark, sf_dir),
        fairness.fairness_disparity(td.predictions(spark, sf_dir)),
        drift.drift_multi_column(before, after, [A, "bmi"], AS_OF),
        _quality(spark, sf_dir, "3"),
    )
    return monitoring.alert_thresholds_eval(metrics)


METRIC_SQL = {
    "min_daily_predictions": "(SELECT cast(min(n) as double) FROM cal)",
    "null_rate": "(SELECT avg(cast(prediction IS NULL as int)) FROM pred)",
    "psi": "(SELECT max(psi_score) FROM u)",
    "kl": "(SELECT max(kl_divergence) FROM u)",
    "disparity": "(SELECT max(disparity) FROM disp)",
    "high_risk_pct": f"(SELECT {share('high_risk_patient')} FROM pred)",
    "critical_pct": "(SELECT count(*) FILTER (WHERE risk_category = 'critical') * "
    "cast(100 as double) / count(*) FROM pred)",
    "confidence_width": "(SELECT avg(prediction_upper_bound - prediction_lower_bound) FROM pred)",
    "high_risk_accuracy": "(SELECT high_risk_accuracy FROM vm WHERE model_version = '3')",
    "r2_score": "(SELECT r2_score FROM vm WHERE model_version = '3')",
    "mae": "(SELECT mae FROM vm WHERE model_version = '3')",
}
AFTER = "(SELECT * FROM pred WHERE prediction_timestamp >= TIMESTAMP '2024-01-16 00:00:00')"
register(
    "alert_thresholds_eval",
    _thresholds,
    oracle(
        f"WITH {WEEKDAYS_CTE}, {DISPARITY_CTE}, {VERSION_CTE}, {drift_ctes('d0', A, BEFORE, AFTER)}, "
        f"{drift_ctes('d1', 'bmi', BEFORE, AFTER)}, u AS (SELECT * FROM d0 UNION ALL SELECT * FROM d1), "
        "ev AS ("
        + " UNION ALL ".join(
            f"SELECT '{t.name}' AS threshold, {METRIC_SQL[t.metric]} AS v, "
            f"cast({t.limit} as double) AS lim, '{t.severity}' AS severity, {str(t.above).lower()} AS up"
            for t in monitoring.THRESHOLDS
        )
        + ") SELECT threshold, round(v, 6) AS metric_value, lim AS limit_value, severity, "
        "CASE WHEN up THEN v > lim ELSE v < lim END AS triggered FROM ev"
    ),
)


def _retrain(spark, sf_dir):
    before, after = halves(spark, sf_dir)
    return monitoring.should_retrain(
        drift.drift_multi_column(before, after, [A], AS_OF),
        _quality(spark, sf_dir, "3"),
        fairness.fairness_report(td.predictions(spark, sf_dir), AS_OF),
    )


register(
    "should_retrain",
    _retrain,
    oracle(
        f"WITH {DISPARITY_CTE}, {VERSION_CTE}, {drift_ctes('d0', A, BEFORE, AFTER)}, "
        "x AS (SELECT (SELECT psi_score FROM d0) AS p, (SELECT bool_or(disparity > 0.15) FROM disp) AS u, "
        "(SELECT high_risk_accuracy FROM vm WHERE model_version = '3') AS a) "
        "SELECT p > 0.4 OR (p > 0.25 AND a < 0.6) OR u AS retrain, CASE WHEN p > 0.4 "
        "THEN 'Critical drift detected (PSI > 0.4)' WHEN p > 0.25 AND a < 0.6 "
        "THEN 'Drift + performance degradation' WHEN u THEN 'Fairness threshold violated' "
        "ELSE 'All metrics within acceptable range' END AS reason, round(p, 6) AS max_psi, "
        "round(a, 6) AS high_risk_accuracy FROM x"
    ),
)


def _kpis(spark, sf_dir):
    log = td.predictions(spark, sf_dir, with_nulls=True)
    baseline = time_range(log, "prediction_timestamp", None, td.DRIFT_SPLIT)
    return monitoring.kpi_track_thresholds(
        baseline, batch_date_scan(log, date(2024, 1, 30), AS_OF)
    )


def _period(condition: str) -> str:
    return (
        f"SELECT count(*) AS n, {share('prediction IS NULL')} AS np, {share('high_risk_patient')} AS hp, "
        f"avg({A}) AS a FROM pred_nulls WHERE {condition}"
    )


register(
    "kpi_track_thresholds",
    _kpis,
    oracle(
        f"WITH b AS ({_period('prediction_timestamp < TIMESTAMP ' + chr(39) + '2024-01-16' + chr(39))}), "
        f"c AS ({_period('cast(prediction_timestamp as date) = DATE ' + chr(39) + '2024-01-30' + chr(39))}), "
        "x AS (SELECT c.n, c.np, (c.hp - b.hp) / b.hp * 100 AS hs, c.a - b.a AS ds FROM b, c) "
        + " UNION ALL ".join(
            f"SELECT 'Tracked KPIs' AS category, '{name}' AS check_name, "
            f"CASE WHEN {ok} THEN 'PASS' ELSE 'FAIL' END AS status, round(cast({v} as double), 6) AS value, "
            f"cast({lo} as double) AS target_lo, cast({hi} as double) AS target_hi FROM x"
            for name, ok, v, lo, hi in (
                ("daily_prediction_count", "n BETWEEN 35000 AND 45000", "n", 35000, 45000),
                ("null_rate_pct", "np < 5", "np", "NULL", 5),
                ("high_risk_rate_shift_pct", "hs BETWEEN -10 AND 10", "hs", -10, 10),
                ("average_score_shift", "ds BETWEEN -5 AND 5", "ds", -5, 5),
            )
        )
    ),
)
register(
    "new_provider_coverage",
    lambda s, d: monitoring.new_provider_coverage(td.predictions(s, d)),
    oracle(
        f"WITH g AS (SELECT region, count(*) AS n, avg({A}) AS m, {share('high_risk_patient')} AS hp "
        "FROM pred GROUP BY 1), w AS (SELECT *, n * cast(100 as double) / sum(n) OVER () AS s, "
        "stddev_samp(m) OVER () / avg(m) OVER () * 100 AS v, max(hp) OVER () - min(hp) OVER () AS gap "
        "FROM g) SELECT region, n AS prediction_count, round(s, 6) AS share_pct, s < 5 AS low_coverage, "
        "round(v, 6) AS regional_variance_pct, v > 15 AS variance_alert, "
        "round(gap, 6) AS high_risk_rate_gap, gap > 10 AS rate_gap_alert FROM w"
    ),
)
