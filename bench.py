"""Headline timings: prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the data, BENCH_CPUS the
number of local threads.  Every query is evaluated in full into a sink that
discards its rows.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from riskloom.operators import training  # noqa: E402
from riskloom.operators.segments import facts  # noqa: E402
from riskloom.plans import jobs  # noqa: E402
from riskloom.plans.catalog import ENTRIES  # noqa: E402
from riskloom.plans.registry import runnable  # noqa: E402
from riskloom.session import local_session, work_dir  # noqa: E402
from riskloom.sources import testdata as td  # noqa: E402
from riskloom.sources.tables import batch_date_scan  # noqa: E402

HEADLINE = (
    "build_feature_table",
    "eda_profile",
    "risk_factor_analysis",
    "feature_summary_by_risk",
    "score_patients",
    "batch_run_metrics",
    "daily_prediction_summary",
    "risk_category_distribution",
    "weekly_performance",
    "high_risk_flag_accuracy",
    "week_over_week",
    "rapidly_increasing_risk",
    "executive_dashboard",
    "risk_anomaly_alert",
    "patient_journey",
    "risk_transitions",
    "latest_prediction",
    "fairness_report",
    "business_report",
    "drift_multi_column",
    "population_drift",
    "dashboard_alerts",
    "validation_scorecard",
    "final_scorecard",
    "governance_gate",
    "shadow_compare",
    "silver_claims",
    "silver_medical_events",
    "scd2_dim_patients",
    "scd2_point_in_time",
    "fact_claims",
    "claims_monthly_summary",
    "profile_inference",
    "drift_consecutive",
    "incremental_changes",
    "stream_score",
    "stream_daily_profile",
    "alert_thresholds_eval",
    "dashboard_document",
    "should_retrain",
    "model_metrics",
)


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(work) -> float:
    started = time.perf_counter()
    work()
    return round(time.perf_counter() - started, 3)


def whole_jobs(spark, sf_dir: str) -> dict[str, float]:
    """The published figures: features, training, inference, monitor refresh."""
    dim, log = td.dim_patients(spark, sf_dir), td.predictions(spark, sf_dir)
    base, state = work_dir(spark, "bench"), {}

    def feature():
        state["features"] = jobs.feature_job(dim, f"{base}/features")

    def train():
        state["trained"] = jobs.training_job(dim, state["features"], training.random_forest())
        state["trained"].metrics.collect()

    def infer():
        scored = jobs.inference_job(
            dim, state["features"], state["trained"], f"{base}/predictions", td.AS_OF, "m", "1"
        )
        scored.metrics.collect()

    def refresh():
        facts(jobs.refresh_cells(log, f"{base}/cells")).collect()

    def increment():
        facts(jobs.refresh_cells(log, f"{base}/cells", td.DRIFT_SPLIT)).collect()

    def monitor():
        jobs.monitoring_job(log, dim, f"{base}/history", td.AS_OF)

    return {
        "job_feature_engineering": timed(feature),
        "job_model_training": timed(train),
        "job_batch_inference": timed(infer),
        "job_monitoring": timed(monitor),
        "job_monitor_refresh_full": timed(refresh),
        "job_monitor_refresh_incremental": timed(increment),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, shuffle_partitions=cpus)
    # Start-up of the JVM and its compiler is not a property of the queries.
    drain(batch_date_scan(td.predictions(spark, sf_dir), td.DRIFT_SPLIT.date(), td.AS_OF))
    times = {
        name: timed(lambda name=name: drain(runnable(ENTRIES[name])(spark, sf_dir)))
        for name in HEADLINE
    }
    times.update(whole_jobs(spark, sf_dir))
    print(
        json.dumps(
            {
                "metric": "headline queries and jobs, total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf_dir.rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
