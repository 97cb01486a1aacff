"""What the physical plans must and must not contain."""

from __future__ import annotations

from riskloom.operators import validation
from riskloom.plans.catalog import ENTRIES
from riskloom.sources import sinks, tables
from riskloom.sources import testdata as td

AS_OF = td.AS_OF
def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_time_filter_reaches_the_scan(spark, sf_dir):
    plan = plan_of(validation.weekly_performance(td.predictions(spark, sf_dir), AS_OF, 7))
    assert "GreaterThanOrEqual(ts,2024-01-24" in plan
    # Only the columns in use are read.
    assert "props" not in plan


def test_partition_pruning(spark, sf_dir, tmp_path):
    log = sinks.with_partition_date(td.predictions(spark, sf_dir))
    saved = sinks.write_overwrite(log, str(tmp_path / "p"), [tables.PARTITION_DATE])
    plan = plan_of(tables.lookback_scan(saved, 7, AS_OF))
    assert "PartitionFilters: [isnotnull(prediction_date" in plan


def test_week_over_week_reads_the_log_once(spark, sf_dir):
    plan = plan_of(validation.week_over_week(td.predictions(spark, sf_dir), AS_OF))
    assert plan.count("events.parquet") == 1


def test_checks_share_one_scan(spark, sf_dir):
    plan = plan_of(ENTRIES["business_checks"].build(spark, sf_dir))
    assert plan.count("events.parquet") == 1
