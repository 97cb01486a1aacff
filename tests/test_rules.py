"""Worked examples and boundary values of the row rules."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from riskloom.functions import rules
from riskloom.operators.features import build_feature_table
from riskloom.operators.scoring import apply_score_rules

# Documented example patients and scores.
PATIENTS = [
    ("P00001", 28, "SOUTHWEST", 22.3, 0, False, 2, 28.0, 1.00, 0.95, 40),
    ("P00782", 45, "NORTHEAST", 29.8, 2, False, 3, 45.0, 1.30, 1.20, 60),
    ("P03456", 58, "SOUTHEAST", 35.2, 3, True, 4, 145.0, 1.45, 1.00, 160),
    ("P07821", 67, "NORTHWEST", 31.5, 0, False, 5, 67.0, 1.00, 1.10, 130),
    ("P09234", 23, "NORTHWEST", 24.1, 0, False, 1, 23.0, 1.00, 1.10, 20),
]
SCORES = [
    (28.5, 28.5, "low", 25.65, 31.35, False, False),
    (56.8, 56.8, "medium", 51.12, 62.48, False, False),
    (78.3, 78.3, "high", 70.47, 86.13, True, False),
    (71.2, 71.2, "high", 64.08, 78.32, False, False),
    (22.7, 22.7, "low", 20.43, 24.97, False, False),
    (92.4, 92.4, "critical", 83.16, 101.64, True, True),
    (8.2, 10.0, "low", 9.0, 11.0, False, False),
    (None, 10.0, "low", 9.0, 11.0, False, False),
]


def test_feature_examples(spark):
    df = spark.createDataFrame(
        [p[:6] for p in PATIENTS],
        "id string, age int, region string, bmi double, children int, smoker boolean",
    )
    risk = rules.age_risk_score("age")
    out = df.select(
        "id",
        risk.alias("risk"),
        rules.smoking_impact("smoker", "age").alias("impact"),
        rules.family_size_factor("children").alias("family"),
        rules.regional_multiplier("region").alias("region"),
        rules.composite_formula(risk, "smoker", "bmi").alias("composite"),
    )
    types = {f.name: f.dataType.simpleString() for f in out.schema}
    assert types["impact"] == "decimal(13,1)"
    assert types["family"] == "decimal(14,2)"
    assert types["region"] == "decimal(3,2)"
    got = {r.id: r for r in out.collect()}
    for pid, *_, risk_, impact, family, region, composite in PATIENTS:
        r = got[pid]
        assert (r.risk, float(r.impact), r.composite) == (risk_, impact, composite)
        assert float(r.family) == pytest.approx(family)
        assert float(r.region) == pytest.approx(region)


def test_score_examples(spark):
    df = spark.createDataFrame([(s[0],) for s in SCORES], "prediction double")
    rows = apply_score_rules(df.coalesce(1)).collect()
    for row, (_, adjusted, category, low, high, flag, review) in zip(rows, SCORES, strict=True):
        assert row.adjusted_prediction == adjusted
        assert row.risk_category == category
        assert row.prediction_lower_bound == pytest.approx(low)
        assert row.prediction_upper_bound == pytest.approx(high)
        assert (row.high_risk_patient, row.requires_review) == (flag, review)


def values(spark, column, inputs, kind="double"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, x {kind}")
    return [r.v for r in df.select("i", column.alias("v")).orderBy("i").collect()]


def test_boundaries(spark):
    x = F.col("x")
    scores = [9.99, 10.0, 29.99, 30.0, 59.99, 60.0, 84.99, 85.0]
    assert values(spark, rules.risk_category(x), scores) == (
        ["low"] * 3 + ["medium"] * 2 + ["high"] * 2 + ["critical"]
    )
    flags = rules.high_risk_flag(x, rules.risk_category(x))
    assert values(spark, flags, [75.0, 75.01, 85.0]) == [False, True, True]
    assert values(spark, rules.review_flag(x), [90.0, 90.01]) == [False, True]
    ages = [24, 25, 34, 35, 49, 50, 64, 65, None]
    assert values(spark, rules.age_risk_score(x), ages, "int") == [1, 2, 2, 3, 3, 4, 4, 5, 5]
    bmi = [18.49, 18.5, 24.99, 25.0, 29.99, 30.0, None]
    assert values(spark, rules.bmi_category(x), bmi) == [
        "underweight",
        "normal",
        "normal",
        "overweight",
        "overweight",
        "obese",
        "unknown",
    ]
    points = rules.composite_formula(F.lit(1), F.lit(False), x)
    assert values(spark, points, [30.0, 30.01]) == [20, 50]


def test_bands(spark):
    x = F.col("x")
    psi = [0.0999, 0.1, 0.2499, 0.25, 0.2501, None]
    assert values(spark, rules.drift_severity(x), psi) == [
        "no_drift",
        "moderate_drift",
        "moderate_drift",
        "significant_drift",
        "significant_drift",
        "error",
    ]
    assert values(spark, rules.drift_requires_action(x), psi) == [False] * 4 + [True, False]
    assert values(spark, rules.fairness_band(x), [0.09, 0.1, 0.15, 0.151, 0.25, 0.26, None]) == [
        "acceptable",
        "monitor",
        "monitor",
        "high",
        "high",
        "critical",
        "acceptable",
    ]


def test_unknown_labels_fall_through(spark):
    x = F.col("x")
    labels = ["YOUNG", "YOUNG_ADULT", "SENIOR", None]
    assert values(spark, rules.age_from_category(x), labels, "string") == [25, 70, 60, 70]
    assert values(spark, rules.smoker_flag(x), ["SMOKER", "NON_SMOKER", None], "string") == [
        True,
        False,
        None,
    ]


def test_composite_prefers_recorded_score(spark, sf_dir):
    from riskloom.sources import testdata as td

    dim = td.dim_patients(spark, sf_dir)
    plain = build_feature_table(dim).where("health_risk_score IS NOT NULL")
    assert plain.where("health_risk_composite <> health_risk_score").count() == 0
    safe = build_feature_table(dim, leak_safe=True)
    formula = rules.composite_formula("age_risk_score", "smoker", "bmi").cast("double")
    assert safe.where(F.col("health_risk_composite") != formula).count() == 0
