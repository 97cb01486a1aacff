"""Queries over the scoring rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.functions import rules
from riskloom.operators import scoring
from riskloom.plans.registry import register
from riskloom.plans.sql_tables import oracle, r, share
from riskloom.sources import testdata as td


def _rule(name, columns, sql):
    """A scoring rule over the whole log, null scores included."""
    register(
        name,
        lambda s, d: td.predictions(s, d, with_nulls=True).select("event_id", *columns()),
        oracle(f"SELECT event_id, {sql} FROM pred_nulls"),
    )


def _score():
    return rules.adjusted_prediction("prediction")


_rule(
    "adjusted_prediction",
    lambda: [_score().alias("adjusted_prediction")],
    "round(adjusted_prediction, 6) AS adjusted_prediction",
)
_rule(
    "risk_category", lambda: [rules.risk_category(_score()).alias("risk_category")], "risk_category"
)
_rule(
    "prediction_bounds",
    lambda: [
        rules.lower_bound(_score()).alias("prediction_lower_bound"),
        rules.upper_bound(_score()).alias("prediction_upper_bound"),
    ],
    "round(prediction_lower_bound, 6) AS prediction_lower_bound, "
    "round(prediction_upper_bound, 6) AS prediction_upper_bound",
)
_rule(
    "high_risk_flag",
    lambda: [
        rules.high_risk_flag(_score(), rules.risk_category(_score())).alias("high_risk_patient")
    ],
    "high_risk_patient",
)
_rule(
    "review_flag",
    lambda: [rules.review_flag(_score()).alias("requires_review")],
    "requires_review",
)
register(
    "score_patients",
    lambda s, d: scoring.score_patients(
        td.predictions(s, d).select("event_id", "customer_id", "prediction"),
        td.MODEL_NAME,
        td.MODEL_VERSION,
        F.lit("2024-01-31 00:00:00").cast("timestamp_ntz"),
    ),
    oracle(
        "SELECT event_id, customer_id, round(prediction, 6) AS prediction, "
        "round(adjusted_prediction, 6) AS adjusted_prediction, risk_category, "
        "round(prediction_lower_bound, 6) AS prediction_lower_bound, "
        "round(prediction_upper_bound, 6) AS prediction_upper_bound, high_risk_patient, "
        "requires_review, TIMESTAMP '2024-01-31 00:00:00' AS prediction_timestamp, "
        "model_version, model_name FROM pred"
    ),
)
register(
    "batch_run_metrics",
    lambda s, d: scoring.batch_run_metrics(td.predictions(s, d)),
    oracle(
        "SELECT count(*) AS batch_inference_count, "
        + r("avg(adjusted_prediction)", "average_predicted_risk_score")
        + ", count(*) FILTER (WHERE high_risk_patient) AS high_risk_patient_count, "
        "count(*) FILTER (WHERE requires_review) AS requires_review_count, "
        + r(share("high_risk_patient"), "high_risk_percentage")
        + "".join(
            f", count(*) FILTER (WHERE risk_category = '{c}') AS risk_{c}_count"
            for c in ("low", "medium", "high", "critical")
        )
        + " FROM pred"
    ),
)
register(
    "risk_category_counts",
    lambda s, d: scoring.risk_category_counts(td.predictions(s, d)),
    oracle('SELECT risk_category, count(*) AS "count" FROM pred GROUP BY 1'),
)
register(
    "rule_adjusted_rows",
    lambda s, d: scoring.rule_adjusted_rows(td.predictions(s, d, with_nulls=True)).select(
        "event_id", "prediction", "adjusted_prediction"
    ),
    oracle(
        "SELECT event_id, round(prediction, 6) AS prediction, "
        "round(adjusted_prediction, 6) AS adjusted_prediction FROM pred_nulls "
        "WHERE adjusted_prediction IS DISTINCT FROM prediction"
    ),
)
register(
    "risk_interpretation",
    lambda s, d: scoring.risk_interpretation(td.predictions(s, d)).select(
        "event_id", "adjusted_prediction", "estimated_cost_band"
    ),
    oracle(
        "SELECT event_id, round(adjusted_prediction, 6) AS adjusted_prediction, "
        "CASE risk_category WHEN 'low' THEN '< $5,000' WHEN 'medium' THEN '$5,000 - $15,000' "
        "WHEN 'high' THEN '$15,000 - $35,000' ELSE '> $35,000' END AS estimated_cost_band FROM pred"
    ),
)
register(
    "premium_estimate",
    lambda s, d: scoring.premium_estimate(
        td.predictions(s, d), F.lit(100.0) + F.col("bmi") * 10
    ).select("event_id", "estimated_premium"),
    oracle(
        "SELECT event_id, round((cast(100 as double) + bmi * 10) * cast(CASE region "
        "WHEN 'NORTHEAST' THEN 1.2 WHEN 'NORTHWEST' THEN 1.1 WHEN 'SOUTHEAST' THEN 1.0 "
        "ELSE 0.95 END as double) * cast(CASE risk_category WHEN 'low' THEN 0.8 "
        "WHEN 'medium' THEN 1.0 WHEN 'high' THEN 1.4 ELSE 1.9 END as double), 6) "
        "AS estimated_premium FROM pred"
    ),
)
