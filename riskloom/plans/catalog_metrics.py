"""Queries over fairness, business and drift figures."""

from __future__ import annotations



from riskloom.operators import business, drift, fairness
from riskloom.plans.registry import register
from riskloom.plans.sql_tables import oracle, r, share
from riskloom.sources import testdata as td
from riskloom.sources.tables import time_range

AS_OF = td.AS_OF
STAMP = "TIMESTAMP '2024-01-31 00:00:00' AS metric_timestamp"
A = "adjusted_prediction"


def halves(spark, sf_dir):
    """Scores before and after the split date."""
    log = td.predictions(spark, sf_dir)
    before = time_range(log, "prediction_timestamp", None, td.DRIFT_SPLIT)
    return before, time_range(log, "prediction_timestamp", td.DRIFT_SPLIT)


def parity_sql(keys: str) -> str:
    return (
        f"SELECT {keys}, count(*) AS total_count, {r(f'avg({A})', 'avg_prediction')}, "
        f"{r(f'stddev_samp({A})', 'stddev_prediction')}, "
        f"count(*) FILTER (WHERE {A} > 75) AS high_risk_count, "
        f"{r(share(f'{A} > 75'), 'high_risk_rate')} FROM pred GROUP BY {keys}"
    )


register(
    "demographic_parity",
    lambda s, d: fairness.demographic_parity(td.predictions(s, d), "patient_gender"),
    oracle(parity_sql("patient_gender")),
)
register(
    "regional_fairness",
    lambda s, d: fairness.regional_fairness(td.predictions(s, d)),
    oracle(
        "SELECT patient_region, count(*) AS prediction_count, "
        f"{r(f'avg({A})', 'avg_risk_score')}, {r(f'stddev_samp({A})', 'stddev_risk_score')}, "
        f"{r(f'min({A})', 'min_risk_score')}, {r(f'max({A})', 'max_risk_score')} "
        "FROM pred GROUP BY 1"
    ),
)
DISPARITY_CTE = "disp AS (" + " UNION ALL ".join(
    f"SELECT '{a}' AS attribute, count(*) AS group_count, stddev_samp(m) / avg(m) AS disparity "
    f"FROM (SELECT {a}, avg({A}) AS m FROM pred GROUP BY 1)"
    for a in fairness.PROTECTED
) + ")"
register(
    "fairness_disparity",
    lambda s, d: fairness.fairness_disparity(td.predictions(s, d)).drop("_rows"),
    oracle(
        f"WITH {DISPARITY_CTE} SELECT attribute, group_count, {r('disparity', 'disparity')} FROM disp"
    ),
)
register(
    "fairness_report",
    lambda s, d: fairness.fairness_report(td.predictions(s, d), AS_OF),
    oracle(
        f"WITH {DISPARITY_CTE} SELECT {STAMP}, (SELECT count(*) FROM pred) AS total_predictions, "
        + ", ".join(
            r(f"max(disparity) FILTER (WHERE attribute = '{a}')", f"{a}_disparity")
            for a in fairness.PROTECTED
        )
        + ", bool_or(disparity > 0.15) AS fairness_threshold_violation FROM disp"
    ),
)
register(
    "fairness_groups",
    lambda s, d: fairness.fairness_groups(td.predictions(s, d)),
    oracle(
        " UNION ALL ".join(
            f"SELECT '{a}' AS attribute, {a} AS group_value, count(*) AS group_rows, "
            f"{r(f'avg({A})', 'group_avg')}, {r(share(f'{A} > 75'), 'group_high_pct')} "
            "FROM pred GROUP BY 2"
            for a in fairness.PROTECTED
        )
    ),
)
register(
    "fairness_bands",
    lambda s, d: fairness.fairness_bands(td.predictions(s, d)),
    oracle(
        f"WITH {DISPARITY_CTE} SELECT attribute, {r('disparity', 'disparity')}, "
        "CASE WHEN disparity IS NULL OR disparity < 0.10 THEN 'acceptable' "
        "WHEN disparity <= 0.15 THEN 'monitor' WHEN disparity <= 0.25 THEN 'high' "
        "ELSE 'critical' END AS band FROM disp"
    ),
)
register(
    "intersectional_bias",
    lambda s, d: fairness.intersectional_bias(td.predictions(s, d)),
    oracle(
        " UNION ALL ".join(
            f"SELECT '{a} x {b}' AS intersection, concat({a}, ' / ', {b}) AS group_value, "
            f"count(*) AS total_count, {r(f'avg({A})', 'avg_prediction')}, "
            f"count(*) FILTER (WHERE {A} > 75) AS high_risk_count, "
            f"{r(share(f'{A} > 75'), 'high_risk_rate')}, "
            f"{r(share(f'{A} > 75') + f' - (SELECT {share(f'{A} > 75')} FROM pred)', 'gap_to_overall')} "
            "FROM pred GROUP BY 2"
            for a, b in (
                ("patient_gender", "patient_region"),
                ("patient_age_category", "patient_smoking_status"),
            )
        )
    ),
)
register(
    "equal_opportunity",
    lambda s, d: fairness.equal_opportunity(
        td.scored_versions(s, d), "patient_region", "label", score="prediction"
    ),
    oracle(
        "SELECT patient_region, count(*) FILTER (WHERE label > 75) AS positives, "
        "count(*) FILTER (WHERE label > 75 AND prediction > 75) AS true_positives, "
        + r(
            "count(*) FILTER (WHERE label > 75 AND prediction > 75) * cast(1 as double) / "
            "nullif(count(*) FILTER (WHERE label > 75), 0)",
            "true_positive_rate",
        )
        + " FROM versions GROUP BY 1"
    ),
)

# Business ------------------------------------------------------------------
register(
    "risk_distribution",
    lambda s, d: business.risk_distribution(td.predictions(s, d)),
    oracle(
        'SELECT risk_category, count(*) AS "count", '
        + r("count(*) * cast(100 as double) / sum(count(*)) OVER ()", "percentage")
        + " FROM pred GROUP BY 1"
    ),
)
QUALITY_SQL = (
    f"{r(f'avg({A})', 'mean_prediction')}, {r(f'stddev_samp({A})', 'std_prediction')}, "
    f"{r(f'min({A})', 'min_prediction')}, {r(f'max({A})', 'max_prediction')}, "
    f"{r('avg(prediction_upper_bound - prediction_lower_bound)', 'avg_confidence_width')}"
)
register(
    "prediction_quality_stats",
    lambda s, d: business.prediction_quality_stats(td.predictions(s, d)),
    oracle(f"SELECT {QUALITY_SQL} FROM pred"),
)
WEEKDAYS_CTE = (
    "dows AS (SELECT dayofweek(prediction_timestamp) AS w, count(*) AS n FROM pred GROUP BY 1), "
    "cal AS (SELECT cast(prediction_timestamp as date) AS day, count(*) AS n FROM pred GROUP BY 1)"
)
register(
    "throughput",
    lambda s, d: business.throughput(td.predictions(s, d)),
    oracle(
        f"WITH {WEEKDAYS_CTE} SELECT cast(sum(n) as double) AS total_predictions, "
        "round(cast(sum(n) as double) / 7, 6) AS daily_avg_predictions, "
        "cast(max(n) as double) AS max_daily_predictions, "
        "cast(min(n) as double) AS min_daily_predictions, "
        "(SELECT max(n) FROM cal) AS max_calendar_day_predictions, "
        "(SELECT min(n) FROM cal) AS min_calendar_day_predictions FROM dows"
    ),
)
BUSINESS_COLUMNS = (
    "count(*) AS total_predictions, count(*) FILTER (WHERE high_risk_patient) AS high_risk_count, "
    f"{r(share('high_risk_patient'), 'high_risk_percentage')}, "
    "count(*) FILTER (WHERE requires_review) AS requires_review_count, "
    f"{r(share('requires_review'), 'requires_review_percentage')}, {QUALITY_SQL}, "
    "round(count(*) / cast(7 as double), 6) AS daily_avg_predictions"
)
register(
    "business_report",
    lambda s, d: business.business_report(td.predictions(s, d), AS_OF),
    oracle(
        f"WITH {WEEKDAYS_CTE} SELECT {STAMP}, {BUSINESS_COLUMNS}, "
        "(SELECT cast(max(n) as double) FROM dows) AS max_daily_predictions, "
        "(SELECT cast(min(n) as double) FROM dows) AS min_daily_predictions FROM pred"
    ),
)

# Drift ---------------------------------------------------------------------
BEFORE = "(SELECT * FROM pred WHERE prediction_timestamp < TIMESTAMP '2024-01-16 00:00:00')"
AFTER = "(SELECT * FROM pred WHERE prediction_timestamp >= TIMESTAMP '2024-01-16 00:00:00')"
EDGES = "[" + ", ".join(f"{i / 10}" for i in range(11)) + "]"


def drift_ctes(tag: str, column: str, base: str, current: str) -> str:
    """Bin counts of one column, then its two scores as ``<tag>``."""
    return (
        f"{tag}_v AS (SELECT true AS b, cast({column} as double) AS x FROM {base} "
        f"WHERE {column} IS NOT NULL UNION ALL SELECT false, cast({column} as double) "
        f"FROM {current} WHERE {column} IS NOT NULL), "
        f"{tag}_q AS (SELECT quantile_cont(x, {EDGES}) AS q FROM {tag}_v WHERE b), "
        f"{tag}_e AS (SELECT list_append(q[1:10], q[11] + 0.001) AS q FROM {tag}_q), "
        f"{tag}_i AS (SELECT b, CASE WHEN x = q[11] THEN 10 "
        f"ELSE len(list_filter(q, lambda e: e <= x)) END AS i FROM {tag}_v, {tag}_e), "
        f"{tag}_t AS (SELECT cast(count(*) FILTER (WHERE b) as double) AS bn, "
        f"cast(count(*) FILTER (WHERE NOT b) as double) AS cn, "
        f"cast(count(*) FILTER (WHERE b AND i BETWEEN 1 AND 10) as double) AS bi, "
        f"cast(count(*) FILTER (WHERE NOT b AND i BETWEEN 1 AND 10) as double) AS ci FROM {tag}_i), "
        f"{tag}_c AS (SELECT i, count(*) FILTER (WHERE b) AS b, count(*) FILTER (WHERE NOT b) AS c "
        f"FROM {tag}_i WHERE i BETWEEN 1 AND 10 GROUP BY 1), "
        f"{tag} AS (SELECT '{column}' AS column_name, "
        "sum((CASE WHEN c = 0 THEN 0.0001 ELSE c / cn END - CASE WHEN b = 0 THEN 0.0001 ELSE b / bn END)"
        " * ln(CASE WHEN c = 0 THEN 0.0001 ELSE c / cn END / CASE WHEN b = 0 THEN 0.0001 ELSE b / bn END))"
        " AS psi_score, "
        "sum(CASE WHEN c = 0 THEN 1e-10 ELSE c / ci END"
        " * ln(CASE WHEN c = 0 THEN 1e-10 ELSE c / ci END / CASE WHEN b = 0 THEN 1e-10 ELSE b / bi END))"
        f" AS kl_divergence FROM {tag}_c, {tag}_t)"
    )


GRADES = (
    "CASE WHEN psi_score < 0.1 THEN 'no_drift' WHEN psi_score < 0.25 THEN 'moderate_drift' "
    "ELSE 'significant_drift' END AS drift_severity, psi_score > 0.25 AS requires_action"
)
GRADED = (
    f"SELECT column_name, {r('psi_score', 'psi_score')}, {r('kl_divergence', 'kl_divergence')}, "
    f"{GRADES}, {STAMP} FROM "
)
register(
    "psi",
    lambda s, d: drift.psi(*halves(s, d), ["adjusted_prediction"]),
    oracle(
        f"WITH {drift_ctes('d1', A, BEFORE, AFTER)} SELECT column_name, "
        f"{r('psi_score', 'psi_score')} FROM d1"
    ),
)
register(
    "kl_divergence",
    lambda s, d: drift.kl_divergence(*halves(s, d), ["prediction"]),
    oracle(
        f"WITH {drift_ctes('d1', 'prediction', BEFORE, AFTER)} SELECT column_name, "
        f"{r('kl_divergence', 'kl_divergence')} FROM d1"
    ),
)
DRIFT_COLUMNS = ("adjusted_prediction", "bmi", "number_of_dependents")
register(
    "drift_multi_column",
    lambda s, d: drift.drift_multi_column(*halves(s, d), [*DRIFT_COLUMNS, "patient_region"], AS_OF),
    oracle(
        "WITH "
        + ", ".join(
            drift_ctes(f"d{i}", c, BEFORE, AFTER) for i, c in enumerate(DRIFT_COLUMNS)
        )
        + ", u AS ("
        + " UNION ALL ".join(f"SELECT * FROM d{i}" for i in range(len(DRIFT_COLUMNS)))
        + f") {GRADED} u UNION ALL SELECT 'patient_region', NULL, NULL, 'error', false, "
        "TIMESTAMP '2024-01-31 00:00:00'"
    ),
)
register(
    "drift_severity",
    lambda s, d: drift.drift_multi_column(*halves(s, d), ["health_risk_score"], AS_OF).select(
        "column_name", "drift_severity", "requires_action"
    ),
    oracle(
        f"WITH {drift_ctes('d1', 'health_risk_score', BEFORE, AFTER)} SELECT column_name, {GRADES} "
        "FROM d1"
    ),
)
register(
    "population_drift",
    lambda s, d: drift.population_drift(td.dim_patients(s, d), td.predictions(s, d), AS_OF),
    oracle(
        "WITH "
        + drift_ctes("d0", "bmi", "dim", "pred")
        + ", "
        + drift_ctes("d1", "health_risk_score", "dim", "pred")
        + f", u AS (SELECT * FROM d0 UNION ALL SELECT * FROM d1) {GRADED} u"
    ),
)
register(
    "drift_sampled",
    lambda s, d: drift.drift_sampled(
        *halves(s, d), ["adjusted_prediction", "bmi"], ["event_id"], AS_OF, fraction=0.2
    ),
)
LABELS = ("patient_region", "patient_smoking_status", "risk_category")
register(
    "categorical_drift",
    lambda s, d: drift.categorical_drift(*halves(s, d), LABELS, AS_OF),
    oracle(
        "WITH u AS ("
        + " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, "
            "sum((CASE WHEN c = 0 THEN 0.0001 ELSE c / cn END - CASE WHEN b = 0 THEN 0.0001 ELSE b / bn END)"
            " * ln(CASE WHEN c = 0 THEN 0.0001 ELSE c / cn END / CASE WHEN b = 0 THEN 0.0001 ELSE b / bn END))"
            " AS psi_score, "
            "sum(CASE WHEN c = 0 THEN 1e-10 ELSE c / cn END"
            " * ln(CASE WHEN c = 0 THEN 1e-10 ELSE c / cn END / CASE WHEN b = 0 THEN 1e-10 ELSE b / bn END))"
            " AS kl_divergence FROM (SELECT cast(count(*) FILTER (WHERE o) as double) AS b, "
            "cast(count(*) FILTER (WHERE NOT o) as double) AS c, "
            "sum(count(*) FILTER (WHERE o)) OVER () AS bn, "
            "sum(count(*) FILTER (WHERE NOT o)) OVER () AS cn FROM (SELECT *, "
            "prediction_timestamp < TIMESTAMP '2024-01-16 00:00:00' AS o FROM pred) "
            f"GROUP BY {c})"
            for c in LABELS
        )
        + f") {GRADED} u"
    ),
)
