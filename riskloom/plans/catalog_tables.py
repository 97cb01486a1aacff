"""Queries over scans and table maintenance."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Window
from pyspark.sql import functions as F

from riskloom.plans.registry import register
from riskloom.plans.sql_tables import oracle, r, since
from riskloom.session import work_dir
from riskloom.sources import buckets, sinks, tables
from riskloom.sources import testdata as td

AS_OF = td.AS_OF
SCORES = ("event_id", "customer_id", "adjusted_prediction", "risk_category")
SCORES_SQL = "event_id, customer_id, round(adjusted_prediction, 6) AS adjusted_prediction, risk_category"


register(
    "scan_table",
    lambda s, d: tables.scan_table(s, f"{d}/events.parquet"),
    "SELECT event_id, ts, user_id, event_type, round(value, 6) AS value, props FROM events",
)
register(
    "current_records",
    lambda s, d: tables.current_records(td.dim_patient_rows(s, d)).select(
        "patient_natural_key", "bmi", "dimension_last_updated"
    ),
    oracle(
        "SELECT patient_natural_key, round(bmi, 6) AS bmi, dimension_last_updated "
        "FROM dim_rows WHERE is_current_record"
    ),
)
register(
    "lookback_scan",
    lambda s, d: tables.lookback_scan(td.predictions(s, d), 7, AS_OF).select(*SCORES),
    oracle(f"SELECT {SCORES_SQL} FROM pred WHERE {since(7)}"),
)
register(
    "batch_date_scan",
    lambda s, d: tables.batch_date_scan(td.predictions(s, d), date(2024, 1, 30), AS_OF).select(
        *SCORES
    ),
    oracle(
        f"SELECT {SCORES_SQL} FROM pred "
        "WHERE strftime(prediction_timestamp, '%Y-%m-%d') = '2024-01-30'"
    ),
)


def _write_overwrite(spark, sf_dir):
    path = work_dir(spark, "predictions")
    log = sinks.with_partition_date(td.predictions(spark, sf_dir))
    saved = sinks.write_overwrite(log, path, [tables.PARTITION_DATE])
    recent = tables.lookback_scan(saved, 7, AS_OF)
    return recent.groupBy(tables.PARTITION_DATE).agg(
        F.count("*").alias("prediction_count"),
        F.avg("adjusted_prediction").alias("avg_risk_score"),
    )


register(
    "write_overwrite",
    _write_overwrite,
    oracle(
        "SELECT cast(prediction_timestamp as date) AS prediction_date, "
        f"count(*) AS prediction_count, {r('avg(adjusted_prediction)', 'avg_risk_score')} "
        f"FROM pred WHERE {since(7)} GROUP BY 1"
    ),
)


def _append_history(spark, sf_dir):
    """A run per day of the log, in two appends; the days that both have are there once."""
    path = work_dir(spark, "history")
    runs = (
        td.predictions(spark, sf_dir)
        .groupBy(F.to_date("prediction_timestamp").alias("run_date"))
        .agg(F.count("*").alias("total_predictions"), F.avg("adjusted_prediction").alias("mean_prediction"))
    )
    half = F.lit(td.DRIFT_SPLIT.date())
    sinks.append_metric_history(runs.where(F.col("run_date") <= half), path, "run_date")
    return sinks.append_metric_history(runs.where(F.col("run_date") >= F.date_sub(half, 2)), path, "run_date")


register(
    "append_metric_history",
    _append_history,
    oracle(
        "SELECT cast(prediction_timestamp as date) AS run_date, count(*) AS total_predictions, "
        f"{r('avg(adjusted_prediction)', 'mean_prediction')} FROM pred GROUP BY 1"
    ),
)


def _upsert(spark, sf_dir):
    from riskloom.operators.features import build_feature_table

    fresh = build_feature_table(td.dim_patients(spark, sf_dir)).select(
        "customer_id", "age_risk_score", "health_risk_composite"
    )
    k = F.substring("customer_id", 2, 8).cast("int")
    before = fresh.where(k % 5 != 0).withColumn(
        "health_risk_composite", F.col("health_risk_composite") - 1.0
    )
    path = work_dir(spark, "features")
    buckets.write_table(before, path, ["customer_id"])
    return buckets.upsert(fresh.where(k % 3 == 0), path, ["customer_id"])


register(
    "feature_table_upsert",
    _upsert,
    oracle(
        "SELECT customer_id, age_risk_score, "
        "round(CASE WHEN patient_surrogate_key % 3 = 0 THEN health_risk_composite "
        "ELSE health_risk_composite - 1 END, 6) AS health_risk_composite FROM features "
        "WHERE patient_surrogate_key % 3 = 0 OR patient_surrogate_key % 5 <> 0"
    ),
)
register(
    "table_probe",
    lambda s, d: tables.table_probe(
        s,
        {
            "silver_patients": td.silver_patients(s, d),
            "dim_patients": td.dim_patient_rows(s, d),
            "missing_table": "no_such_table",
        },
    ),
    oracle(
        "SELECT 'silver_patients' AS \"table\", 'SUCCESS' AS status, count(*) AS row_count, "
        "concat('Table exists with ', format('{:,}', count(*)), ' rows') AS message FROM silver "
        "UNION ALL SELECT 'dim_patients', 'SUCCESS', count(*), "
        "concat('Table exists with ', format('{:,}', count(*)), ' rows') FROM dim_rows "
        "UNION ALL SELECT 'missing_table', 'FAILED', 0, 'not found: TABLE_OR_VIEW_NOT_FOUND'"
    ),
)
register(
    "retention_filter",
    lambda s, d: tables.retention_filter(td.predictions(s, d), 14, AS_OF).select(*SCORES),
    oracle(f"SELECT {SCORES_SQL} FROM pred WHERE {since(14)}"),
)


def _states(spark, sf_dir):
    """The log before and after some rows came, went and changed."""
    log = td.predictions(spark, sf_dir).select("event_id", "adjusted_prediction", "risk_category")
    e = F.col("event_id")
    before = log.where(e % 11 != 0)
    score = F.when(e % 7 == 0, F.col("adjusted_prediction") + 1.0).otherwise(
        F.col("adjusted_prediction")
    )
    after = log.where(e % 13 != 0).withColumn("adjusted_prediction", score)
    return before, after


def _stored_changes(spark, sf_dir):
    """The same from two stored tables, by their digests."""
    paths = [work_dir(spark, f"state-{k}") for k in range(2)]
    for state, path in zip(_states(spark, sf_dir), paths):
        schema = buckets.write_table(state, path, ["event_id"]).schema
    return buckets.state_changes(spark, *paths, ["event_id"], schema)


CHANGES_SQL = oracle(
    "SELECT event_id, CASE WHEN event_id % 11 = 0 THEN 'insert' WHEN event_id % 13 = 0 "
    "THEN 'delete' ELSE 'update' END AS change_type FROM pred "
    "WHERE (event_id % 11 = 0 AND event_id % 13 <> 0) OR (event_id % 11 <> 0 AND "
    "event_id % 13 = 0) OR (event_id % 11 <> 0 AND event_id % 13 <> 0 AND event_id % 7 = 0)"
)
register(
    "incremental_changes",
    lambda s, d: sinks.incremental_changes(*_states(s, d), ["event_id"]),
    CHANGES_SQL,
)
register("stored_state_changes", _stored_changes, CHANGES_SQL)


def _layout(spark, sf_dir):
    log = td.predictions(spark, sf_dir).select(
        "event_id", "customer_id", "prediction_timestamp", "adjusted_prediction"
    )
    path = work_dir(spark, "layout")
    laid = sinks.table_layout(log, path, "prediction_timestamp", file_bytes=1 << 16)
    # One row per file, then whether any two files overlap in time.
    files = laid.groupBy(F.input_file_name().alias("file")).agg(
        F.count("*").alias("rows"),
        F.min("prediction_timestamp").alias("first"),
        F.max("prediction_timestamp").alias("last"),
    )
    before = F.lag("last").over(Window.partitionBy(F.lit(0)).orderBy("first", "last"))
    return files.withColumn("_overlaps", F.col("first") < before).agg(
        F.sum("rows").alias("row_count"),
        F.min("first").alias("first_prediction"),
        F.max("last").alias("last_prediction"),
        F.count_if("_overlaps").alias("overlapping_files"),
    )


register(
    "table_layout",
    _layout,
    oracle(
        "SELECT count(*) AS row_count, min(prediction_timestamp) AS first_prediction, "
        "max(prediction_timestamp) AS last_prediction, cast(0 as bigint) AS overlapping_files FROM pred"
    ),
)
