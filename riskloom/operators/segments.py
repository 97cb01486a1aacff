"""One-scan rollup of the prediction log.

``score_cells`` groups the log by all reporting attributes at once.  The
attributes are labels and days, so the result is small whatever the size of
the log, and every figure in it can be merged further.  Scorecards, KPIs and
dashboards are computed from the cells instead of scanning the log again for
each figure.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions import rules
from riskloom.functions.stats import (
    merged_mean,
    merged_std,
    moments,
    pct_of,
    ratio,
)
from riskloom.sources.tables import normalize_predictions

SCORE = "adjusted_prediction"
DIMENSIONS = {
    "region": "patient_region",
    "gender": "patient_gender",
    "smoking": "patient_smoking_status",
    "age": "patient_age_category",
    "bmi": "bmi_category",
    "category": "risk_category",
    "day": "prediction_day",
}
ALL = "all"
_SUMS = ("rows", "high_n", "review_n", "null_n", "raw_null_n", "negative_n", "outlier_n")


def score_cells(df: DataFrame, more: dict[str, str] | None = None) -> DataFrame:
    """Mergeable figures per combination of attributes: one scan, one shuffle.

    ``more`` names further aggregates, as SQL text."""
    rows = normalize_predictions(df).withColumn(
        "prediction_day", F.date_format("prediction_timestamp", "yyyy-MM-dd")
    )
    counts = {
        "rows": "count(1)",
        "high_n": "count_if(high_risk_patient)",
        "review_n": "count_if(requires_review)",
        "null_n": f"count_if({SCORE} IS NULL)",
        "raw_null_n": "count_if(prediction IS NULL)",
        "negative_n": f"count_if({SCORE} < 0)",
        "outlier_n": f"count_if({SCORE} > 100)",
        "lower_sum": "sum(prediction_lower_bound)",
        "upper_sum": "sum(prediction_upper_bound)",
        **(more or {}),
    }
    return rows.groupBy(*DIMENSIONS.values()).agg(
        *[F.expr(f"{sql} AS {name}") for name, sql in counts.items()], *moments(SCORE)
    )


def cells_of(df: DataFrame) -> DataFrame:
    """The rollup of a log; a table that already is a rollup is taken as it is.

    Every report below therefore runs on the log or on a stored rollup.
    """
    return df if {"rows", "high_n", "m2"}.issubset(df.columns) else score_cells(df)


def segments(cells: DataFrame) -> DataFrame:
    """Cells merged per (dimension, level), plus one row for the whole log."""
    levels = [
        F.struct(F.lit(name).alias("dimension"), F.col(column).alias("level"))
        for name, column in DIMENSIONS.items()
    ]
    whole = F.struct(F.lit(ALL).alias("dimension"), F.lit(ALL).alias("level"))
    long = cells.select("*", F.inline(F.array(whole, *levels)))
    total = F.sum("rows")
    return long.groupBy("dimension", "level").agg(
        *[F.sum(c).alias(c) for c in _SUMS],
        merged_mean().alias("avg_risk"),
        merged_std().alias("std_risk"),
        F.min("min").alias("min_risk"),
        F.max("max").alias("max_risk"),
        pct_of(F.sum("high_n"), total).alias("high_pct"),
        ratio(F.sum("lower_sum"), F.sum("cnt")).alias("avg_lower"),
        ratio(F.sum("upper_sum"), F.sum("cnt")).alias("avg_upper"),
    )


def age_position(order: str = "clinical") -> Column:
    """Sort key of an age category: by age, or by label."""
    if order == "label":
        return F.col("level")
    positions = {c: f"{i}" for i, c in enumerate(rules.AGE_CATEGORIES_BY_AGE)}
    return rules.mapped("level", positions, "9")


def facts(cells: DataFrame, age_order: str = "clinical") -> DataFrame:
    """All figures the checks compare with a threshold, as one row.

    Everything after the cells runs on at most one row per label and day.
    """
    by_age = Window.partitionBy("dimension").orderBy(age_position(age_order), "level")
    rows = segments(cells).withColumn("_before", F.lag("avg_risk").over(by_age))
    wide = rows.selectExpr(*[f"{sql} AS {name}" for name, sql in _FIGURES.items()])
    return wide.selectExpr("*", *[f"{sql} AS {name}" for name, sql in _DERIVED.items()])


# SQL text: one call to the JVM per figure.
def _whole(column: str) -> str:
    return f"max(CASE WHEN dimension = '{ALL}' THEN {column} END)"


def _at(dimension: str, label: str, column: str) -> str:
    return f"max(CASE WHEN dimension = '{dimension}' AND level = '{label}' THEN {column} END)"


def _over(function: str, dimension: str) -> str:
    return f"{function}(CASE WHEN dimension = '{dimension}' THEN avg_risk END)"


def _levels(dimension: str) -> str:
    return f"count_if(dimension = '{dimension}')"


def _share(column: str) -> str:
    """A label nobody has is 0 %, no rows at all is unknown."""
    return f"try_divide(coalesce({column}, 0) * 100D, double(total))"


_FIGURES = {
    "total": f"coalesce({_whole('rows')}, 0L)",
    **{c: _whole(c) for c in _SUMS[1:]},
    **{
        c: _whole(c)
        for c in (
            "avg_risk",
            "std_risk",
            "min_risk",
            "max_risk",
            "high_pct",
            "avg_lower",
            "avg_upper",
        )
    },
    **{f"{c}_rows": _at("category", c, "rows") for c in ("low", "medium", "high", "critical")},
    "smoker_avg": _at("smoking", rules.SMOKER_LABEL, "avg_risk"),
    "non_smoker_avg": _at("smoking", rules.NON_SMOKER_LABEL, "avg_risk"),
    "smoker_high_pct": _at("smoking", rules.SMOKER_LABEL, "high_pct"),
    "obese_avg": _at("bmi", "obese", "avg_risk"),
    "normal_avg": _at("bmi", "normal", "avg_risk"),
    "region_levels": _levels("region"),
    "region_max": _over("max", "region"),
    "region_min": _over("min", "region"),
    "gender_levels": _levels("gender"),
    "gender_gap": f"{_over('max', 'gender')} - {_over('min', 'gender')}",
    "days": _levels("day"),
    "day_min_rows": "min(CASE WHEN dimension = 'day' THEN rows END)",
    "day_mean": _over("avg", "day"),
    "day_std": _over("stddev_pop", "day"),
    "age_monotonic": "NOT coalesce(bool_or(dimension = 'age' AND avg_risk < _before), false)",
    "age_levels": _levels("age"),
}
_DERIVED = {
    **{f"{c}_pct": _share(f"{c}_rows") for c in ("low", "medium", "critical")},
    **{f"{c}_pct": _share(f"{c}_n") for c in ("null", "negative", "outlier", "review")},
    "region_disparity": "try_divide(region_max - region_min, region_min) * 100",
    "day_cv": "try_divide(day_std, day_mean) * 100",
    "avg_width": "avg_upper - avg_lower",
}
