"""Row-level business rules as Catalyst expressions.

All rules are built-in expressions, so they stay inside whole-stage code
generation and add no stage to the plan they are used in.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values -------------------------------------------------------------
AGE_BY_CATEGORY = {"YOUNG": 25, "ADULT": 35, "MIDDLE_AGED": 45, "SENIOR": 60}
AGE_OTHERWISE = 70
AGE_CATEGORIES_BY_AGE = ("YOUNG", "ADULT", "MIDDLE_AGED", "SENIOR", "ELDERLY")
AGE_RISK_BANDS = ((25, 1), (35, 2), (50, 3), (65, 4))
AGE_RISK_TOP = 5
SMOKER_LABEL = "SMOKER"
NON_SMOKER_LABEL = "NON_SMOKER"
SMOKER_AGE_WEIGHT = Decimal("2.5")
NON_SMOKER_AGE_WEIGHT = Decimal("1.0")
DEPENDENT_WEIGHT = Decimal("0.15")
REGION_MULTIPLIERS = {
    "NORTHEAST": Decimal("1.2"),
    "NORTHWEST": Decimal("1.1"),
    "SOUTHEAST": Decimal("1.0"),
}
REGION_MULTIPLIER_OTHERWISE = Decimal("0.95")
COMPOSITE_AGE_WEIGHT = 20
COMPOSITE_SMOKER_POINTS = 50
COMPOSITE_OBESE_POINTS = 30
COMPOSITE_OBESE_BMI = 30
SCORE_FLOOR = 10.0
RISK_BANDS = ((30, "low"), (60, "medium"), (85, "high"))
RISK_TOP = "critical"
LOWER_BOUND_FACTOR = 0.90
UPPER_BOUND_FACTOR = 1.10
HIGH_RISK_SCORE = 75
REVIEW_SCORE = 90
BMI_BANDS = ((18.5, "underweight"), (25, "normal"), (30, "overweight"))
BMI_TOP = "obese"
BMI_UNKNOWN = "unknown"
COST_BANDS = (
    (30, "< $5,000"),
    (60, "$5,000 - $15,000"),
    (85, "$15,000 - $35,000"),
)
COST_TOP = "> $35,000"
PSI_MODERATE = 0.1
PSI_SIGNIFICANT = 0.25
FAIRNESS_BANDS = (0.10, 0.15, 0.25)
# --------------------------------------------------------------------------


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def banded(value: Column | str, bands: Sequence[tuple], top: object) -> Column:
    """First label whose bound lies above the value; ``top`` otherwise (also for null)."""
    x = _col(value)
    out = F
    for bound, label in bands:
        out = out.when(x < F.lit(bound), F.lit(label))
    return out.otherwise(F.lit(top))


def mapped(value: Column | str, table: Mapping[str, object], otherwise: object) -> Column:
    """Exact-match lookup in a small constant table."""
    x = _col(value)
    out = F
    for key, label in table.items():
        out = out.when(x == F.lit(key), F.lit(label))
    return out.otherwise(F.lit(otherwise))


# Features ------------------------------------------------------------------
def age_from_category(category: Column | str) -> Column:
    return mapped(category, AGE_BY_CATEGORY, AGE_OTHERWISE)


def smoker_flag(status: Column | str, label: str = SMOKER_LABEL) -> Column:
    """True/false; null status stays null."""
    return _col(status) == F.lit(label)


def age_risk_score(age: Column | str) -> Column:
    return banded(age, AGE_RISK_BANDS, AGE_RISK_TOP)


def smoking_impact(smoker: Column | str, age: Column | str) -> Column:
    years = _col(age)
    return F.when(_col(smoker), years * F.lit(SMOKER_AGE_WEIGHT)).otherwise(
        years * F.lit(NON_SMOKER_AGE_WEIGHT)
    )


def family_size_factor(children: Column | str) -> Column:
    return F.lit(1) + _col(children) * F.lit(DEPENDENT_WEIGHT)


def regional_multiplier(region: Column | str) -> Column:
    return mapped(region, REGION_MULTIPLIERS, REGION_MULTIPLIER_OTHERWISE)


def composite_formula(age_risk: Column | str, smoker: Column | str, bmi: Column | str) -> Column:
    return (
        _col(age_risk) * COMPOSITE_AGE_WEIGHT
        + F.when(_col(smoker), COMPOSITE_SMOKER_POINTS).otherwise(0)
        + F.when(_col(bmi) > COMPOSITE_OBESE_BMI, COMPOSITE_OBESE_POINTS).otherwise(0)
    )


def health_risk_composite(
    score: Column | str,
    age_risk: Column | str,
    smoker: Column | str,
    bmi: Column | str,
    leak_safe: bool = False,
) -> Column:
    """Recorded score when present, else the formula.

    The recorded score is also the training label, so ``leak_safe=True`` uses
    the formula alone.
    """
    formula = composite_formula(age_risk, smoker, bmi).cast("double")
    return formula if leak_safe else F.coalesce(_col(score), formula)


# Scoring -------------------------------------------------------------------
def adjusted_prediction(prediction: Column | str) -> Column:
    """Score floor.  ``greatest`` skips nulls, so a null score becomes the floor."""
    return F.greatest(_col(prediction), F.lit(SCORE_FLOOR))


def risk_category(score: Column | str) -> Column:
    return banded(score, RISK_BANDS, RISK_TOP)


def lower_bound(score: Column | str) -> Column:
    return _col(score) * F.lit(LOWER_BOUND_FACTOR)


def upper_bound(score: Column | str) -> Column:
    return _col(score) * F.lit(UPPER_BOUND_FACTOR)


def high_risk_flag(score: Column | str, category: Column | str) -> Column:
    return (_col(score) > HIGH_RISK_SCORE) | (_col(category) == RISK_TOP)


def review_flag(score: Column | str) -> Column:
    return _col(score) > REVIEW_SCORE


def bmi_category(bmi: Column | str) -> Column:
    x = _col(bmi)
    return F.when(x.isNull(), BMI_UNKNOWN).otherwise(banded(x, BMI_BANDS, BMI_TOP))


def risk_interpretation(score: Column | str) -> Column:
    """Expected annual cost band of a score."""
    return banded(score, COST_BANDS, COST_TOP)


# Bands of monitoring scores ------------------------------------------------
def drift_severity(psi: Column | str) -> Column:
    x = _col(psi)
    return (
        F.when(x.isNull(), "error")
        .when(x < PSI_MODERATE, "no_drift")
        .when(x < PSI_SIGNIFICANT, "moderate_drift")
        .otherwise("significant_drift")
    )


def drift_requires_action(psi: Column | str) -> Column:
    """Strict: a score of exactly 0.25 is significant but needs no action."""
    return F.coalesce(_col(psi) > PSI_SIGNIFICANT, F.lit(False))


def fairness_band(disparity: Column | str) -> Column:
    x = _col(disparity)
    watch, high, critical = FAIRNESS_BANDS
    return (
        F.when(x.isNull() | (x < watch), "acceptable")
        .when(x <= high, "monitor")
        .when(x <= critical, "high")
        .otherwise("critical")
    )
