"""The four whole jobs: features, training, inference and monitoring.

Each job writes its result once and reads it back for everything that follows,
so no expensive plan is evaluated twice.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators import business, drift, fairness, features, monitoring, training
from riskloom.operators.scoring import batch_run_metrics
from riskloom.operators.segments import score_cells
from riskloom.sources import sinks
from riskloom.sources.tables import PARTITION_DATE, current_records, time_range

CELL_DAY = "prediction_day"


def feature_job(dim: DataFrame, path: str, leak_safe: bool = False) -> DataFrame:
    """Rebuild the feature table."""
    return sinks.write_overwrite(features.build_feature_table(dim, leak_safe), path)


@dataclass(frozen=True)
class Trained:
    fitted: training.Fitted
    metrics: DataFrame


def training_job(dim: DataFrame, feature_table: DataFrame, estimator=None) -> Trained:
    """Fit on the labelled current patients and evaluate on the held-out part."""
    rows = training.labelled(features.training_set(dim, feature_table))
    fitted, scored = training.fit(rows, estimator or training.random_forest())
    return Trained(fitted, training.evaluate(scored, rows))


@dataclass(frozen=True)
class Scored:
    predictions: DataFrame
    metrics: DataFrame


def inference_job(
    dim: DataFrame,
    feature_table: DataFrame,
    trained: Trained,
    path: str,
    scored_at: datetime,
    model_name: str,
    model_version: str,
) -> Scored:
    """Score all current patients once, write by date, measure the written table."""
    patients = features.dedupe_keep_latest(
        current_records(dim), ["patient_natural_key"], features.newest_first()
    )
    log = training.score_batch(patients, feature_table, trained.fitted)
    stamped = log.withColumns(
        {
            "prediction_timestamp": F.lit(scored_at.isoformat(sep=" ")).cast("timestamp_ntz"),
            "model_name": F.lit(model_name),
            "model_version": F.lit(model_version),
        }
    )
    saved = sinks.write_overwrite(sinks.with_partition_date(stamped), path, [PARTITION_DATE])
    return Scored(saved, batch_run_metrics(saved))


def monitoring_job(
    predictions: DataFrame,
    dim: DataFrame,
    history: str,
    as_of: datetime,
    monitors_active: int = 3,
    approx: bool = False,
) -> dict[str, DataFrame]:
    """Add the run's reports to their histories and a summary built from them.

    A repeated run replaces its own rows.
    """
    reports = {
        "custom_fairness_metrics": fairness.fairness_report(predictions, as_of),
        "custom_business_metrics": business.business_report(predictions, as_of),
        "drift_analysis_summary": drift.population_drift(dim, predictions, as_of, approx=approx),
    }
    tables = {
        name: sinks.replace_run(report, f"{history}/{name}", as_of)
        for name, report in reports.items()
    }
    now = F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
    run = {name: table.where(F.col("metric_timestamp") == now) for name, table in tables.items()}
    summary = monitoring.monitoring_summary(
        run["custom_business_metrics"],
        run["custom_fairness_metrics"],
        run["drift_analysis_summary"],
        monitors_active,
    )
    name = "monitoring_summary_history"
    tables[name] = sinks.replace_run(summary, f"{history}/{name}", as_of)
    return tables


def refresh_cells(
    predictions: DataFrame, path: str, since: datetime | None = None
) -> DataFrame:
    """Keep the rollup of the log up to date.

    Only whole days from that of ``since`` are read, and only their partitions of
    the rollup are replaced; a day that has no rows any more loses its partition.
    Reports over any period then read the rollup instead of the log.
    """
    if since is not None:
        since = datetime(since.year, since.month, since.day)
    rows = time_range(predictions, "prediction_timestamp", since)
    (
        score_cells(rows)
        .hint("rebalance", CELL_DAY)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", sinks.CODEC)
        .partitionBy(CELL_DAY)
        .parquet(path)
    )
    # One entry per day.
    filled = {
        str(r[0]) for r in rows.select(F.to_date("prediction_timestamp")).distinct().collect()
    }
    sinks.drop_partitions(
        predictions.sparkSession,
        path,
        CELL_DAY,
        lambda day: day not in filled and (since is None or day >= f"{since:%Y-%m-%d}"),
    )
    # The day stays text, as the rollup made it.
    return predictions.sparkSession.read.parquet(path).withColumn(
        CELL_DAY, F.date_format(F.col(CELL_DAY).cast("date"), "yyyy-MM-dd")
    )
