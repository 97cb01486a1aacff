"""Governance, checks, fairness and whole jobs."""

from __future__ import annotations

import threading
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from riskloom.operators import checks, fairness, features, governance, medallion, star, training, validation
from riskloom.operators.segments import facts, score_cells
from riskloom.plans import jobs
from riskloom.session import work_dir
from riskloom.sources import sinks, tables
from riskloom.sources import testdata as td

AS_OF = td.AS_OF


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_gate_bounds_are_included(spark):
    df = spark.createDataFrame(
        [(0.70, 15.0, 0.60), (0.6999, 15.0, 0.60), (0.70, 15.01, 0.60), (0.70, 15.0, 0.599), (None, 1.0, 1.0)],
        "r double, m double, a double",
    )
    gate = governance.passes_gate(F.col("r"), F.col("m"), F.col("a"))
    assert [r.g for r in df.select(gate.alias("g")).collect()] == [True, False, False, False, False]


def test_version_without_labels_fails(spark, sf_dir):
    rows = td.scored_versions(spark, sf_dir)
    bare = rows.withColumn(
        "label", F.when(F.col("model_version") != "2", F.col("label"))
    )
    got = {r.model_version: r for r in governance.governance_gate(bare).collect()}
    assert got["1"].gate_passed and not got["2"].gate_passed
    assert got["2"].r2_score is None and got["2"].labelled_rows == 0
    status = one(governance.governance_status(bare, "2"))
    assert status.governance_status == "UNKNOWN"


def test_challenger(spark, sf_dir):
    rows = td.scored_versions(spark, sf_dir)
    assert one(governance.challenger_vs_champion(rows, "1", "2")).promote
    assert not one(governance.challenger_vs_champion(rows, "1", "3")).promote
    assert not one(governance.challenger_vs_champion(rows, "2", "2")).challenger_better


def test_latest_version_rows(spark, sf_dir):
    rows = td.scored_versions(spark, sf_dir)
    for champion, expected in (("2", "2"), ("9", "3"), (None, "3")):
        got = governance.latest_version_rows(rows, champion)
        assert [r[0] for r in got.select("model_version").distinct().collect()] == [expected]


def test_roi_example(spark):
    row = one(spark.range(1).select(F.lit(1000).alias("n")).withColumns(checks.roi_columns(F.col("n"), checks.Roi())))
    assert (row.intervention_costs, row.prevented_claims_value) == (500_000, 1_500_000)
    assert (row.net_benefit, row.roi_pct) == (1_000_000, 200)
    nobody = one(spark.range(1).select(F.lit(0).alias("n")).withColumns(checks.roi_columns(F.col("n"), checks.Roi())))
    assert nobody.roi_pct == 0


def test_empty_period(spark, sf_dir):
    nothing = td.predictions(spark, sf_dir).where("event_id < 0")
    row = one(facts(score_cells(nothing)))
    assert row.total == 0 and row.avg_risk is None and row.low_pct is None
    card = one(checks.validation_scorecard(checks.business_checks(nothing, 30)))
    assert card.overall_status == "NEEDS_IMPROVEMENT"
    assert one(validation.week_over_week(nothing, AS_OF)).risk_change_pct is None


def test_single_group_has_no_disparity(spark, sf_dir):
    one_region = td.predictions(spark, sf_dir).where("patient_region = 'NORTHEAST'")
    report = one(fairness.fairness_report(one_region, AS_OF, ["patient_region"]))
    assert report.patient_region_disparity is None
    assert report.fairness_threshold_violation is False
    row = one(checks.regional_equity_check(one_region))
    assert row.status is None


def test_shares_sum_to_hundred(spark, sf_dir):
    shares = validation.risk_category_distribution(td.predictions(spark, sf_dir), AS_OF, 90)
    assert one(shares.agg(F.sum("percentage").alias("s"))).s == pytest.approx(100, abs=0.1)


def test_null_scores_hide_behind_the_floor(spark, sf_dir):
    log = td.predictions(spark, sf_dir, with_nulls=True)
    row = one(validation.prediction_quality(log, AS_OF, 90))
    assert row.null_predictions == 0 and row.null_raw_predictions > 0


def test_age_order_matters(spark, sf_dir):
    log = td.predictions(spark, sf_dir)
    for order in ("clinical", "label"):
        rows = checks.age_monotonic_check(log, order).collect()
        firsts = [r.patient_age_category for r in rows if r.previous_avg_risk is None]
        assert firsts == (["YOUNG"] if order == "clinical" else ["ADULT"])


def test_required_columns(spark):
    with pytest.raises(ValueError, match="missing columns"):
        tables.require_columns(spark.range(1), ["id", "nope"])


def test_label_encoding_and_constant_scaling(spark):
    seen = spark.createDataFrame([("b",), ("a",), ("b",)], "c string")
    codes = training.label_codes(seen, "c")
    new = spark.createDataFrame([("a",), ("b",), ("z",), (None,)], "c string")
    got = {r.c: r.c_code for r in training.label_encode(new, "c", codes).collect()}
    assert got == {"a": 0, "b": 1, "z": 0, None: 0}
    flat = spark.createDataFrame([(2.0, 1.0), (2.0, 3.0)], "k double, x double")
    rows = training.standard_scale(flat, ["k", "x"]).collect()
    assert sorted((r.k_scaled, r.x_scaled) for r in rows) == [(0.0, -1.0), (0.0, 1.0)]


def test_whole_jobs(spark, sf_dir):
    base = work_dir(spark, "test-jobs")
    dim = td.dim_patient_rows(spark, sf_dir)
    table = jobs.feature_job(dim, f"{base}/features")
    assert table.count() == table.select("customer_id").distinct().count()
    trained = jobs.training_job(td.dim_patients(spark, sf_dir), table, training.random_forest(numTrees=5))
    quality = one(trained.metrics)
    assert quality.r2_score > 0.5
    at = datetime(2024, 1, 31, 2)
    scored = jobs.inference_job(dim, table, trained, f"{base}/predictions", at, "m", "1")
    measured = one(scored.metrics)
    assert measured.batch_inference_count == table.count()
    assert scored.predictions.where("adjusted_prediction < 10").count() == 0
    log = td.predictions(spark, sf_dir)
    for moment in (AS_OF, at):
        histories = jobs.monitoring_job(log, dim, f"{base}/history", moment)
    assert histories["monitoring_summary_history"].count() == 2
    assert histories["drift_analysis_summary"].count() == 4


def same_facts(cells, log):
    a, b = one(facts(cells)), one(facts(score_cells(log)))
    assert a.total == b.total and a.days == b.days
    for name in ("avg_risk", "std_risk", "high_pct", "day_cv", "region_disparity"):
        assert a[name] == pytest.approx(b[name])


def test_rollup_refresh_equals_full_scan(spark, sf_dir):
    path = f"{work_dir(spark, 'test-cells')}/cells"
    log = td.predictions(spark, sf_dir)
    early = tables.time_range(log, "prediction_timestamp", None, datetime(2024, 1, 25))
    jobs.refresh_cells(early, path)
    # From the middle of a day, whose earlier rows stay in.
    same_facts(jobs.refresh_cells(log, path, datetime(2024, 1, 24, 12)), log)
    # A day whose rows are all gone.
    gone = log.where("to_date(prediction_timestamp) <> DATE '2024-01-26'")
    cells = jobs.refresh_cells(gone, path, datetime(2024, 1, 25))
    assert cells.where("prediction_day = '2024-01-26'").count() == 0
    same_facts(cells, gone)


def test_repeated_monitoring_run_replaces_itself(spark, sf_dir):
    base, log, dim = work_dir(spark, "test-runs"), td.predictions(spark, sf_dir), td.dim_patient_rows(spark, sf_dir)
    once = {k: v.count() for k, v in jobs.monitoring_job(log, dim, base, AS_OF).items()}
    assert {k: v.count() for k, v in jobs.monitoring_job(log, dim, base, AS_OF).items()} == once


def test_folds_and_split_take_any_key(spark):
    keys = spark.createDataFrame([(f"{i:08x}-abc",) for i in range(2000)], "customer_id string")
    folds = {r.fold: r["count"] for r in keys.groupBy(training.key_slot("customer_id", 5).alias("fold")).count().collect()}
    assert set(folds) == set(range(5)) and min(folds.values()) > 300
    assert 300 < training.train_test_split(keys, "customer_id").where("is_test").count() < 500


def test_every_fold_has_all_age_categories(spark, sf_dir):
    rows = td.dim_patients(spark, sf_dir).withColumn("fold", training.key_slot("patient_natural_key", 5))
    seen = {r.fold: r.n for r in rows.groupBy("fold").agg(F.count_distinct("patient_age_category").alias("n")).collect()}
    assert len(seen) == 5 and len(set(seen.values())) == 1 and min(seen.values()) > 1


def test_saved_model_scores_alike(spark, sf_dir):
    path = work_dir(spark, "test-model")
    dim = td.dim_patients(spark, sf_dir)
    table = jobs.feature_job(td.dim_patient_rows(spark, sf_dir), f"{path}/features")
    trained = jobs.training_job(dim, table, training.random_forest(numTrees=3))
    training.save_model(trained.fitted, f"{path}/saved")
    few = dim.where("patient_natural_key < 'P00000040'")
    # Only some patients are left in the feature table.
    small = table.join(few.select(F.col("patient_natural_key").alias("customer_id")), "customer_id", "left_semi")
    first = training.score_batch(few, table, trained.fitted)
    again = training.score_batch(few, small, training.load_model(spark, f"{path}/saved"))
    scores = [{r.patient_natural_key: r.prediction for r in f.collect()} for f in (first, again)]
    assert scores[0] and scores[0] == scores[1]


def test_versions_need_not_be_numbers(spark):
    rows = [("1", 1.0, 1.0), ("v2", 2.0, 2.5), ("3", 1.0, None), ("v2", None, 1.0)]
    df = spark.createDataFrame(rows, "model_version string, label double, prediction double")
    assert [r.model_version for r in governance.compare_versions(df).collect()] == ["3", "1", "v2"]
    assert one(governance.model_metrics(df, "v2")).champion_version is None
    mix = governance.version_distribution_shift(df, "1").where("model_version = '3'")
    assert mix.agg(F.sum("prediction_count").alias("n")).collect()[0].n in (0, None)


def test_upsert_on_disk_and_retention(spark):
    path = f"{work_dir(spark, 'test-upsert')}/table"
    old = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    assert sinks.upsert_table(spark, path, old, ["id"]).count() == 2
    new = spark.createDataFrame([(2, "B"), (3, "C")], "id int, v string")
    assert {tuple(r) for r in sinks.upsert_table(spark, path, new, ["id"]).collect()} == {(1, "a"), (2, "B"), (3, "C")}
    days = spark.createDataFrame([(d, d) for d in ("2024-01-01", "2024-01-20", "2024-01-30")], "v string, prediction_date string")
    kept = f"{path}-days"
    days.write.partitionBy("prediction_date").parquet(kept)
    assert sinks.drop_expired(spark, kept, datetime(2024, 1, 31), 15) == ["2024-01-01"]
    assert spark.read.parquet(kept).count() == 2


def test_facts_without_a_patient_are_kept(spark, sf_dir):
    claims, dim = td.claims(spark, sf_dir), td.dim_patient_rows(spark, sf_dir)
    silver = medallion.silver_claims(claims, td.claim_completion(spark, sf_dir))
    orphans = dim.where(F.substring("patient_natural_key", -1, 1) != "7")
    facts_of = star.fact_claims(silver, orphans)
    row = one(star.unmatched(facts_of))
    assert row.fact_rows == silver.count() and row.unmatched_rows > 0


def test_upsert_and_append(spark, tmp_path):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "C")], "id int, v string")
    merged = sinks.feature_table_upsert(old, new, ["id"])
    assert {tuple(r) for r in merged.collect()} == {(1, "a"), (2, "B"), (3, "C")}
    assert sinks.feature_table_upsert(old, new, ["id"], replace=True).count() == 2
    path = str(tmp_path / "h")
    sinks.append_metric_history(old, path)
    assert sinks.append_metric_history(new, path).count() == 4


def test_layout_of_joined_rows(spark, tmp_path):
    """The number of files follows the rows' size and not the planner's estimate of the
    join, the product of its inputs."""
    rows = spark.range(100_000)
    for other in ("b", "c"):
        rows = rows.join(spark.range(100_000).withColumnRenamed("id", other), F.col("id") == F.col(other))
    rows = rows.select("id", (F.col("id") * 7919 % 100_003).alias("at"))
    path = str(tmp_path / "laid")
    laid = sinks.table_layout(rows, path, "at", file_bytes=1 << 16)
    files = laid.groupBy(F.input_file_name()).agg(F.min("at").alias("low"), F.max("at").alias("high")).orderBy("low").collect()
    assert 2 <= len(files) <= 40 and all(a.high < b.low for a, b in zip(files, files[1:]))
    assert laid.count() == 100_000 and laid.agg(F.sum("id")).first()[0] == sum(range(100_000))
    assert [p.name for p in tmp_path.iterdir()] == ["laid"]


def test_folds_are_fitted_side_by_side(spark, sf_dir):
    """Two folds at a time, with the figures of fits without kept nodes, one by one."""
    class Meeting:
        def __init__(self, inner):
            self.inner, self.barrier = inner, threading.Barrier(2, timeout=60)

        def copy(self):
            return self

        def fit(self, rows):
            self.barrier.wait()
            return self.inner.copy().fit(rows)

    dim = td.dim_patients(spark, sf_dir)
    rows = features.training_set(dim, features.build_feature_table(dim))
    assert training.random_forest().getCacheNodeIds()
    got = training.cross_validation_r2(rows, Meeting(training.random_forest(numTrees=3)), folds=4).collect()
    plain = training.random_forest(numTrees=3, cacheNodeIds=False)
    assert sorted(got) == sorted(training.cross_validation_r2(rows, plain, folds=4).collect())
