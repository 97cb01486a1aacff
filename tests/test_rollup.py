"""The stored rollup and the exact quantiles of crowded columns."""

from __future__ import annotations

from datetime import datetime

import numpy as np
import pytest
from conftest import scans
from pyspark.sql import functions as F

from riskloom.functions import stats
from riskloom.operators import dashboard, rollup
from riskloom.session import work_dir
from riskloom.sources import testdata as td

AS_OF = td.AS_OF


def log_of(spark, rows):
    return spark.createDataFrame(rows, "customer_id string, prediction_timestamp timestamp_ntz")


def test_numbers_are_dense_and_stay(spark):
    path = f"{work_dir(spark, 'test-numbers')}/numbers"
    day = datetime(2024, 1, 1)
    first = rollup.refresh_numbers(log_of(spark, [(f"p{k}", day) for k in range(100)] * 2 + [(None, day)]), path)
    before = {r.customer_id: r.number for r in first.collect()}
    assert sorted(before.values()) == list(range(1, 101))
    for _ in range(2):
        later = rollup.refresh_numbers(log_of(spark, [(f"p{k}", day) for k in range(50, 180)]), path)
    after = {r.customer_id: r.number for r in later.collect()}
    assert sorted(after.values()) == list(range(1, 181)) and later.count() == 180
    assert all(after[k] == n for k, n in before.items())


def test_distinct_patients_of_a_period(spark):
    rows = [(f"p{k % 40_000}", datetime(2024, 1, 1 + k % 3)) for k in range(100_000)]
    log = log_of(spark, rows)
    numbers = rollup.refresh_numbers(log, f"{work_dir(spark, 'test-bitmaps')}/numbers")
    bitmaps = rollup.patient_bitmaps(log, numbers)
    assert bitmaps.count() == 6  # two buckets a day
    assert rollup.distinct_patients(bitmaps).first()[0] == 40_000
    two = bitmaps.where(F.col(rollup.DAY) < "2024-01-03")
    assert rollup.distinct_patients(two).first()[0] == len({p for p, d in rows if d.day < 3})
    assert rollup.distinct_patients(bitmaps.limit(0)).first()[0] == 0


def test_refresh_equals_a_new_rollup(spark, sf_dir):
    path = work_dir(spark, "test-rollup")
    log = td.predictions(spark, sf_dir)
    rollup.refresh(log.where("prediction_timestamp < TIMESTAMP_NTZ '2024-01-25 10:00:00'"), path)
    gone = log.where("to_date(prediction_timestamp) <> DATE '2024-01-26'")
    stored = rollup.refresh(gone, path, datetime(2024, 1, 24, 12))
    fresh = rollup.refresh(gone, work_dir(spark, "test-rollup"))
    for days in (3, 60):
        a, b = (rollup.period_figures(r.last(days, AS_OF), days).first() for r in (stored, fresh))
        assert a == b and a.total_predictions > 0
    with pytest.raises(ValueError):
        stored.between(datetime(2024, 1, 24, 12))


def test_sketch_error_over_many_rows(spark):
    n = 200_000
    value = F.col("id") * F.col("id") / 1e6
    rows = spark.range(n).select(value.alias("adjusted_prediction"), (F.col("id") % 60).alias("cell"))
    cells = rows.groupBy("cell").agg(F.expr(f"kll_sketch_agg_double(adjusted_prediction, {rollup.K}) AS scores"))
    probs = [0.01, 0.5, 0.95, 0.999]
    names = ["a", "b", "c", "d"]
    found = cells.agg(*rollup.merged_quantiles(probs, names)).first()
    ranks = [(np.sqrt(v * 1e6) + 1) / n for v in found]
    assert all(abs(r - p) <= rollup.RANK_ERROR for r, p in zip(ranks, probs))
    exact = rollup.exact_quantiles(rows, cells, probs, names).first()
    assert tuple(exact) == pytest.approx(np.quantile(np.arange(n, dtype=float) ** 2 / 1e6, probs))
    # Sketches of other rows bracket the wrong ranks: refused, not answered.
    other = rows.withColumn("adjusted_prediction", F.col("adjusted_prediction") + 5000)
    with pytest.raises(Exception, match="outside of its bracket"):
        rollup.exact_quantiles(other, cells, probs, names).collect()


def test_document_from_the_rollup_reads_the_log_once(spark, sf_dir):
    log = td.predictions(spark, sf_dir)
    stored = rollup.refresh(log, work_dir(spark, "test-document"))
    exact = dashboard.dashboard_document(log, AS_OF, rollup=stored)
    assert scans(exact) == 1
    near = dashboard.dashboard_document(log, AS_OF, rollup=stored, approx=True)
    assert scans(near) == 0
    plain = dashboard.dashboard_document(log, AS_OF).first()
    for name in ("volume_metrics", "risk_metrics", "trend_metrics", "alerts"):
        assert exact.first()[name] == plain[name]
    assert scans(dashboard.flatten_dashboard_row(log, AS_OF, rollup=stored)) == 0


PROBS, NAMES = [0, 0.1, 0.5, 0.95, 1], ["a", "b", "c", "d", "e"]


@pytest.mark.parametrize("crowded", [0, 10**6])
def test_crowded_quantiles(spark, monkeypatch, crowded):
    monkeypatch.setattr(stats, "CROWDED", crowded)
    k = F.col("id")
    columns = {
        "narrow": 1e9 + k * 0.5,
        "seconds": (1_704_067_200 + (k * 7919) % 100_000).cast("double"),
        "clustered": F.when(k % 1000 == 0, 1.0002).otherwise(1 + k * 1e-14),
        "ties": (k % 3).cast("double"),
    }
    df = spark.range(100_000).select(k, *[c.alias(n) for n, c in columns.items()])
    for name in columns:
        values = np.array([r[0] for r in df.select(name).collect()])
        assert tuple(stats.quantiles(df, name, PROBS, NAMES).first()) == pytest.approx(tuple(np.quantile(values, PROBS)), rel=1e-15)
    by = df.withColumn("g", F.when(k % 3 > 0, k % 3))
    got = {r.g: tuple(r)[1:] for r in stats.quantiles(by, "narrow", PROBS, NAMES, by=["g"]).collect()}
    values = 1e9 + np.arange(100_000) * 0.5
    assert got == {g or None: pytest.approx(tuple(np.quantile(values[g::3], PROBS)), rel=1e-15) for g in range(3)}


def test_largest_group_of_a_crowded_bucket(spark):
    k = F.col("id")
    values = {"narrow": 1e9 + k * 0.5, "clustered": F.when(k % 1000 == 0, 1.0002 + k * 1e-9).otherwise(1 + k * 1e-15)}
    for value in values.values():
        counted = spark.range(100_000).select(value.alias("_x")).distinct().withColumns({"_n": F.lit(1), "_b": F.lit(0)})
        n = counted.count()
        parts = stats.dealt_parts(counted, ["_b"]).groupBy("_part").count().agg(F.max("count")).first()[0]
        assert parts <= n / stats.SPLITS + 2 * n / stats.SPLIT_ACCURACY + 1
