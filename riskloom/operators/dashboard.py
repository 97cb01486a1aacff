"""Dashboard blocks, alerts and the metric document.

All score figures come from one rollup of the period (``segments``); only the
distinct-patient count and the exact quantiles read the log again.  With a stored
rollup (``rollup.Rollup``) the document reads the log once, for the exact
quantiles, or not at all with ``approx=True``.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.stats import (
    n_rows,
    one_row,
    one_value,
    pct_change,
    pct_of,
    quantiles,
    ratio,
)
from riskloom.operators import rollup as stored_rollup
from riskloom.operators.checks import Roi, facts_of, roi_columns
from riskloom.operators.rollup import Rollup
from riskloom.operators.segments import cells_of, segments
from riskloom.sources.tables import lookback_scan, time_literal

SCORE = "adjusted_prediction"


# Fixed values.
@dataclass(frozen=True)
class AlertLimits:
    high_risk_pct_min: float = 5.0
    high_risk_pct_max: float = 30.0
    avg_risk_min: float = 20.0
    avg_risk_max: float = 70.0
    prediction_volume_min: int = 100
    null_prediction_pct_max: float = 1.0
    regional_disparity_max: float = 25.0


CATEGORIES = ("low", "medium", "high", "critical")
# --------------------------------------------------------------------------


def r2(column: Column | str) -> Column:
    return F.round(column, 2)


def volume_metrics(df: DataFrame, days: int) -> DataFrame:
    return df.agg(
        n_rows().alias("total_predictions"),
        F.count_distinct("customer_id").alias("unique_patients"),
        F.min("prediction_timestamp").alias("earliest_prediction"),
        F.max("prediction_timestamp").alias("latest_prediction"),
        r2(n_rows() / F.lit(float(days))).alias("avg_predictions_per_day"),
    )


QUANTILES = ([0.5, 0.95], ["median_risk", "p95_risk"])


def risk_metrics(df: DataFrame, approx: bool = False, cells: DataFrame | None = None) -> DataFrame:
    """Score figures, exact median and 95th percentile, count and share per category.

    With the ``cells`` of a stored rollup of the same rows the quantiles come from its
    sketches: within their error with ``approx``, else exactly from one read of the log.
    """
    if cells is None:
        q = quantiles(df, SCORE, *QUANTILES, approx=approx)
    elif approx:
        q = cells.agg(*stored_rollup.merged_quantiles(*QUANTILES))
    else:
        q = stored_rollup.exact_quantiles(df, cells, *QUANTILES)
    f = facts_of(df if cells is None else cells).withColumn("_q", one_row(q))
    shares = {}
    for c in CATEGORIES:
        rows = F.coalesce(F.col(f"{c}_rows"), F.lit(0).cast("long"))
        shares[f"{c}_count"] = rows
        shares[f"{c}_percentage"] = pct_of(rows, F.col("total"), 2)
    return f.select(
        r2("avg_risk").alias("avg_risk_score"),
        r2("std_risk").alias("risk_std_dev"),
        r2("min_risk").alias("min_risk"),
        r2("max_risk").alias("max_risk"),
        r2("_q.median_risk").alias("median_risk"),
        r2("_q.p95_risk").alias("p95_risk"),
        r2("high_pct").alias("high_risk_percentage"),
        *[c.alias(k) for k, c in shares.items()],
    )


DEMOGRAPHIC_BLOCKS = {"smoking": "smoking_status", "age": "age_category", "gender": "gender"}


def demographic_metrics(df: DataFrame) -> DataFrame:
    """Three blocks from one scan.  The age block carries no high-risk share."""
    dim = F.col("dimension")
    block = F
    for name, label in DEMOGRAPHIC_BLOCKS.items():
        block = block.when(dim == name, label)
    return (
        segments(cells_of(df))
        .where(dim.isin(*DEMOGRAPHIC_BLOCKS))
        .select(
            block.otherwise(F.lit(None)).alias("block"),
            F.col("level").alias("group_value"),
            F.col("rows").alias("count"),
            r2("avg_risk").alias("avg_risk"),
            F.when(dim != "age", r2("high_pct")).alias("high_risk_pct"),
        )
    )


def rounded_disparity(high: Column, low: Column) -> Column:
    """Disparity of means already rounded to two places."""
    return ratio(r2(high) - r2(low), r2(low)) * 100


def regional_metrics(df: DataFrame) -> DataFrame:
    """Per region, with the disparity over all regions on every row."""
    by_region = segments(cells_of(df)).where(F.col("dimension") == "region")
    everything = Window.partitionBy("dimension")
    gap = rounded_disparity(
        F.max("avg_risk").over(everything), F.min("avg_risk").over(everything)
    )
    several = F.count(F.lit(1)).over(everything) > 1
    return by_region.select(
        F.col("level").alias("region"),
        F.col("rows").alias("count"),
        r2("avg_risk").alias("avg_risk"),
        F.coalesce(r2("std_risk"), F.lit(0.0)).alias("risk_std"),
        r2("high_pct").alias("high_risk_pct"),
        F.when(several, r2(gap)).otherwise(0.0).alias("regional_disparity_pct"),
    )


def _quality_columns() -> dict[str, Column]:
    return {
        "null_prediction_pct": r2("null_pct"),
        "negative_prediction_pct": r2("negative_pct"),
        "outlier_prediction_pct": r2("outlier_pct"),
        "avg_confidence_interval_width": r2("avg_width"),
        "data_completeness_pct": r2(F.lit(100.0) - F.col("null_pct")),
    }


def quality_metrics(df: DataFrame) -> DataFrame:
    return facts_of(df).select(*[c.alias(k) for k, c in _quality_columns().items()])


def trend_metrics(df: DataFrame, days: int, as_of: datetime) -> DataFrame:
    """This period against the one before, from one conditional aggregate."""
    rows = lookback_scan(df, 2 * days, as_of)
    border = time_literal(rows, "prediction_timestamp", as_of - timedelta(days=days))
    now = F.col("prediction_timestamp") >= border
    high = F.col("high_risk_patient")
    wide = rows.agg(
        F.count_if(now).alias("n1"),
        F.count_if(~now).alias("n0"),
        F.avg(F.when(now, F.col(SCORE))).alias("a1"),
        F.avg(F.when(~now, F.col(SCORE))).alias("a0"),
        F.count_if(now & high).alias("h1"),
        F.count_if(~now & high).alias("h0"),
    )
    return _trend(wide)


def trend_of_cells(rollup: Rollup, days: int, as_of: datetime) -> DataFrame:
    """The same from a stored rollup."""
    border = f"prediction_day >= '{as_of - timedelta(days=days):%Y-%m-%d}'"
    sums = {"1": border, "0": f"NOT ({border})"}
    wide = rollup.last(2 * days, as_of).cells.agg(
        *[F.expr(f"coalesce(sum(CASE WHEN {c} THEN rows END), 0) AS n{k}") for k, c in sums.items()],
        *[
            F.expr(f"try_divide(sum(CASE WHEN {c} THEN sum END), sum(CASE WHEN {c} THEN cnt END)) AS a{k}")
            for k, c in sums.items()
        ],
        *[F.expr(f"coalesce(sum(CASE WHEN {c} THEN high_n END), 0) AS h{k}") for k, c in sums.items()],
    )
    return _trend(wide)


def _trend(wide: DataFrame) -> DataFrame:
    zero = F.lit(0.0)
    had_rows = F.col("n0") > 0
    return wide.select(
        F.col("n1").alias("current_volume"),
        r2("a1").alias("current_avg_risk"),
        pct_of(F.col("h1"), F.col("n1"), 2).alias("current_high_risk_pct"),
        F.col("n0").alias("previous_volume"),
        F.when(had_rows, r2("a0")).otherwise(zero).alias("previous_avg_risk"),
        F.when(had_rows, pct_of(F.col("h0"), F.col("n0"), 2))
        .otherwise(zero)
        .alias("previous_high_risk_pct"),
        F.when(had_rows, r2(pct_change(F.col("n1"), F.col("n0"))))
        .otherwise(zero)
        .alias("volume_change_pct"),
        F.when(had_rows, r2(pct_change(F.col("a1"), F.col("a0"))))
        .otherwise(zero)
        .alias("risk_change_pct"),
    )


def _roi_block(high_risk: Column, roi: Roi) -> dict[str, Column]:
    money = roi_columns(high_risk, roi)
    return {
        "high_risk_patients_identified": high_risk,
        "estimated_intervention_costs": r2(money["intervention_costs"]),
        "estimated_prevented_claims_value": r2(money["prevented_claims_value"]),
        "estimated_net_benefit": r2(money["net_benefit"]),
        "estimated_roi_pct": r2(money["roi_pct"]),
    }


def roi_metrics(df: DataFrame, roi: Roi = Roi()) -> DataFrame:
    counted = df.agg(F.count_if("high_risk_patient").alias("_high"))
    return counted.select(*[c.alias(k) for k, c in _roi_block(F.col("_high"), roi).items()])


def _alert_array(limits: AlertLimits) -> Column:
    """Alert structs over a facts row; entries that do not apply are null."""
    avg, high, null = r2("avg_risk"), r2("high_pct"), r2("null_pct")
    gap = rounded_disparity(F.col("region_max"), F.col("region_min"))
    several = F.col("region_levels") > 1

    def alert(condition: Column, kind: str, severity: str, *text) -> Column:
        message = F.concat(*[t if isinstance(t, Column) else F.lit(t) for t in text])
        return F.when(
            condition,
            F.struct(
                F.lit(kind).alias("type"),
                F.lit(severity).alias("severity"),
                message.alias("message"),
            ),
        )

    def s(c: Column) -> Column:
        return c.cast("string")

    # Alert kinds, severities and message formats.
    return F.array_compact(
        F.array(
            alert(
                F.col("total") < limits.prediction_volume_min,
                "LOW_VOLUME",
                "WARNING",
                "Low prediction volume: ",
                s(F.col("total")),
                f" < {limits.prediction_volume_min}",
            ),
            alert(
                avg < limits.avg_risk_min,
                "LOW_AVG_RISK",
                "WARNING",
                "Average risk unusually low: ",
                s(avg),
            ),
            alert(
                avg > limits.avg_risk_max,
                "HIGH_AVG_RISK",
                "WARNING",
                "Average risk unusually high: ",
                s(avg),
            ),
            alert(
                high < limits.high_risk_pct_min,
                "LOW_HIGH_RISK_PCT",
                "INFO",
                "Low high-risk percentage: ",
                s(high),
                "%",
            ),
            alert(
                high > limits.high_risk_pct_max,
                "HIGH_HIGH_RISK_PCT",
                "WARNING",
                "High high-risk percentage: ",
                s(high),
                "%",
            ),
            alert(
                several & (gap > limits.regional_disparity_max),
                "HIGH_REGIONAL_DISPARITY",
                "WARNING",
                "High regional disparity: ",
                F.format_string("%.1f", gap),
                "%",
            ),
            alert(
                null > limits.null_prediction_pct_max,
                "HIGH_NULL_RATE",
                "ERROR",
                "High null prediction rate: ",
                s(null),
                "%",
            ),
        )
    )


def dashboard_alerts(df: DataFrame, limits: AlertLimits = AlertLimits()) -> DataFrame:
    return facts_of(df).select(F.inline(_alert_array(limits)))


def dashboard_document(
    df: DataFrame,
    as_of: datetime,
    days: int = 7,
    model: DataFrame | None = None,
    limits: AlertLimits = AlertLimits(),
    roi: Roi = Roi(),
    model_name: str = "insurance_model",
    approx: bool = False,
    rollup: Rollup | None = None,
) -> DataFrame:
    """All blocks as one nested row.

    With a stored ``rollup`` all blocks are built from its small tables; the log is
    read once, for the exact quantiles, and not at all with ``approx``.
    """
    recent = lookback_scan(df, days, as_of)
    if rollup is None:
        source, cells = recent, None
        volume, trend = volume_metrics(recent, days), trend_metrics(df, days, as_of)
    else:
        period = rollup.last(days, as_of)
        source = cells = period.cells
        volume = stored_rollup.period_figures(period, days).drop(*QUANTILES[1])
        trend = trend_of_cells(rollup, days, as_of)

    def entries(rows: DataFrame, key: str, value: list[str]) -> Column:
        """A few rows as a map from their label."""
        pairs = rows.agg(
            F.map_from_entries(
                F.collect_list(F.struct(F.col(key), F.struct(*value)))
            ).alias("m")
        )
        return one_value(pairs, "m")

    demographic = demographic_metrics(source)
    regional = regional_metrics(source)
    measures = ["count", "avg_risk", "high_risk_pct"]
    facts_row = facts_of(source)
    missing = F.lit(None).cast("string")
    return facts_row.select(
        F.struct(
            F.lit(as_of.isoformat()).alias("generated_at"),
            F.lit(days).alias("lookback_days"),
            F.lit(model_name).alias("model_name"),
        ).alias("metadata"),
        one_row(volume).alias("volume_metrics"),
        one_row(risk_metrics(recent, approx, cells)).alias("risk_metrics"),
        F.struct(
            *[
                entries(
                    demographic.where(F.col("block") == label), "group_value", measures
                ).alias(label)
                for label in DEMOGRAPHIC_BLOCKS.values()
            ]
        ).alias("demographic_metrics"),
        F.struct(
            entries(regional, "region", ["count", "avg_risk", "risk_std", "high_risk_pct"]).alias(
                "by_region"
            ),
            F.when(
                F.col("region_levels") > 1,
                r2(rounded_disparity(F.col("region_max"), F.col("region_min"))),
            )
            .otherwise(0.0)
            .alias("regional_disparity_pct"),
        ).alias("regional_metrics"),
        F.struct(*[c.alias(k) for k, c in _quality_columns().items()]).alias("quality_metrics"),
        (one_row(model) if model is not None else F.struct(missing.alias("champion_version"))).alias(
            "model_metrics"
        ),
        one_row(trend).alias("trend_metrics"),
        F.struct(*[c.alias(k) for k, c in _roi_block(F.col("high_n"), roi).items()]).alias(
            "business_metrics"
        ),
        _alert_array(limits).alias("alerts"),
    )


def metrics_to_json(document: DataFrame) -> DataFrame:
    return document.select(F.to_json(F.struct("*")).alias("metrics_json"))


def flatten_dashboard_row(
    df: DataFrame,
    as_of: datetime,
    days: int = 7,
    limits: AlertLimits = AlertLimits(),
    roi: Roi = Roi(),
    rollup: Rollup | None = None,
) -> DataFrame:
    """One history row without the document; from a stored rollup alone, if given."""
    if rollup is None:
        source = lookback_scan(df, days, as_of)
        patients = source.agg(F.count_distinct("customer_id").alias("n"))
    else:
        period = rollup.last(days, as_of)
        source = period.cells
        patients = stored_rollup.distinct_patients(period.patients).select(F.col("unique_patients").alias("n"))
    return facts_of(source).select(
        F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz").alias("metric_timestamp"),
        F.lit(days).alias("lookback_days"),
        F.col("total").alias("total_predictions"),
        one_value(patients, "n").alias("unique_patients"),
        r2("avg_risk").alias("avg_risk_score"),
        r2("high_pct").alias("high_risk_percentage"),
        F.when(
            F.col("region_levels") > 1,
            r2(rounded_disparity(F.col("region_max"), F.col("region_min"))),
        )
        .otherwise(0.0)
        .alias("regional_disparity_pct"),
        r2(F.lit(100.0) - F.col("null_pct")).alias("data_completeness_pct"),
        r2(roi_columns(F.col("high_n"), roi)["roi_pct"]).alias("estimated_roi_pct"),
        F.size(_alert_array(limits)).alias("alert_count"),
    )
