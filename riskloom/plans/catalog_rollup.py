"""Queries over the stored rollup: figures of any period without the log."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.operators import dashboard, rollup
from riskloom.plans import catalog_reports  # noqa: F401
from riskloom.plans.registry import ENTRIES, register
from riskloom.plans.sql_tables import oracle
from riskloom.session import work_dir
from riskloom.sources import testdata as td
from riskloom.sources.tables import lookback_scan

AS_OF = td.AS_OF
HALF = td.DRIFT_SPLIT


def _stored(spark, sf_dir):
    """The rollup of the whole log, made in two refreshes that overlap by a day."""
    path = work_dir(spark, "rollup")
    log = td.predictions(spark, sf_dir)
    rollup.refresh(log.where(F.col("prediction_timestamp") < F.lit(HALF)), path)
    return log, rollup.refresh(log, path, HALF)


def _patients(spark, sf_dir):
    """Distinct patients per day, and of the seven days up to it."""
    _, stored = _stored(spark, sf_dir)
    trailing = rollup.trailing_patients(stored, 7).withColumnRenamed("unique_patients", "patients_last7")
    return rollup.distinct_patients(stored.patients, [rollup.DAY]).join(trailing, rollup.DAY)


register(
    "rollup_patients",
    _patients,
    oracle(
        "WITH s AS (SELECT DISTINCT cast(prediction_timestamp as date) AS d, customer_id AS c FROM pred), "
        "days AS (SELECT DISTINCT d FROM s) SELECT strftime(days.d, '%Y-%m-%d') AS prediction_day, "
        "count(DISTINCT s.c) FILTER (WHERE s.d = days.d) AS unique_patients, "
        "count(DISTINCT s.c) AS patients_last7 FROM days JOIN s ON s.d <= days.d AND s.d > days.d - 7 GROUP BY days.d"
    ),
)
NAMES = ("median_risk", "p95_risk")


def _quantiles(spark, sf_dir):
    """Whether the rollup's quantiles of each day lie within the stated error of their ranks."""
    log, stored = _stored(spark, sf_dir)
    shares = rollup.rank_shares(log, rollup.daily_figures(stored), NAMES)
    return shares.select(
        rollup.DAY,
        "scored_rows",
        rollup.within("median_risk", 0.5).alias("median_within"),
        rollup.within("p95_risk", 0.95).alias("p95_within"),
    )


register(
    "rollup_quantiles",
    _quantiles,
    oracle(
        "SELECT strftime(prediction_timestamp, '%Y-%m-%d') AS prediction_day, count(*) AS scored_rows, "
        "true AS median_within, true AS p95_within FROM pred GROUP BY 1"
    ),
)


def _volume(spark, sf_dir):
    _, stored = _stored(spark, sf_dir)
    return rollup.period_figures(stored.last(7, AS_OF), 7).drop(*NAMES)


register("rollup_volume", _volume, ENTRIES["volume_metrics"].sql)


def _risk(spark, sf_dir):
    log, stored = _stored(spark, sf_dir)
    return dashboard.risk_metrics(lookback_scan(log, 7, AS_OF), cells=stored.last(7, AS_OF).cells)


register("rollup_risk_metrics", _risk, ENTRIES["risk_metrics"].sql)
register(
    "rollup_trend",
    lambda s, d: dashboard.trend_of_cells(_stored(s, d)[1], 7, AS_OF),
    ENTRIES["trend_metrics"].sql,
)


def _flat(spark, sf_dir):
    log, stored = _stored(spark, sf_dir)
    return dashboard.flatten_dashboard_row(log, AS_OF, rollup=stored)


register("rollup_dashboard_row", _flat, ENTRIES["flatten_dashboard_row"].sql)
