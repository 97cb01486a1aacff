"""Quantiles, drift scores and merged moments against numpy and pandas."""

from __future__ import annotations

import math

from datetime import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.functions.stats import merged_mean, merged_std, moments, quantiles
from riskloom.operators import drift

PROBS = [0, 0.05, 0.25, 0.5, 0.75, 0.95, 1]
NAMES = [f"q{i}" for i in range(len(PROBS))]
AS_OF = datetime(2024, 1, 31)


def column(spark, values, name="x"):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], f"{name} double")


RNG = np.random.default_rng(5)
SAMPLES = {
    "uniform": RNG.uniform(0, 100, 997),
    "ties": RNG.integers(0, 7, 500).astype(float),
    "heavy_floor": np.concatenate([np.full(400, 10.0), RNG.uniform(10, 100, 200)]),
    "negative": RNG.normal(-3, 50, 333),
    "large": RNG.lognormal(12, 3, 250),
    "constant": np.full(40, 3.25),
    "one": np.array([7.5]),
    "two": np.array([1.0, 2.0]),
}


@pytest.mark.parametrize("name", SAMPLES)
def test_exact_quantiles(spark, name):
    data = SAMPLES[name]
    noisy = [*data, None, float("nan")]
    got = quantiles(column(spark, noisy).repartition(5), "x", PROBS, NAMES).collect()[0]
    want = np.percentile(data, [p * 100 for p in PROBS])
    np.testing.assert_allclose([got[n] for n in NAMES], want, rtol=1e-12)


def test_grouped_quantiles(spark):
    frame = pd.DataFrame(
        {
            "g": RNG.choice(["a", "b", "c"], 900, p=[0.8, 0.15, 0.05]),
            "x": RNG.gamma(2, 20, 900),
        }
    )
    df = spark.createDataFrame(frame).withColumn("g", F.when(F.col("g") != "c", F.col("g")))
    got = quantiles(df, "x", [0.25, 0.5], ["a1", "a2"], by=["g"]).collect()
    assert len(got) == 3
    for row in got:
        part = frame[frame.g == (row.g or "c")].x
        np.testing.assert_allclose([row.a1, row.a2], part.quantile([0.25, 0.5]), rtol=1e-12)


def test_quantiles_of_nothing(spark):
    empty = column(spark, [None]).withColumn("g", F.lit("a"))
    assert quantiles(empty, "x", [0.5], ["m"]).collect()[0].m is None
    assert quantiles(empty, "x", [0.5], ["m"], by=["g"]).count() == 0


def test_infinite_values_have_quantiles(spark):
    inf = float("inf")
    row = quantiles(column(spark, [1.0, inf]), "x", [0.0, 0.5, 1.0], ["a", "b", "c"]).collect()[0]
    assert tuple(row) == (1.0, inf, inf)
    row = quantiles(column(spark, [-inf, 1.0, 2.0]), "x", [0.25, 0.5], ["a", "b"]).collect()[0]
    assert tuple(row) == (-inf, 1.0)


# Baselines of eleven values have a decile at each value, so bins are counted by
# hand; the last bin holds its upper edge and 0.001 more.
TENS = [float(v) for v in range(0, 110, 10)]
ONES = [1] * 9 + [2]
CASES = {
    # name: baseline, current, rows per bin of both
    "same": (TENS, TENS, ONES, ONES),
    "shifted": (TENS, [5.0, 15.0, 15.0, 95.0], ONES, [1, 2, 0, 0, 0, 0, 0, 0, 0, 1]),
    "edges": (TENS, [0.0, 10.0, 99.9, 100.0, 100.0005], ONES, [1, 1, 0, 0, 0, 0, 0, 0, 0, 3]),
    "outside": (TENS, [-1.0, 50.0, 100.5, 200.0], ONES, [0, 0, 0, 0, 0, 1, 0, 0, 0, 0]),
    "nulls": ([*TENS, None, float("nan")], [None, 45.0, float("nan"), 45.0], ONES, [0, 0, 0, 0, 2, 0, 0, 0, 0, 0]),
    "ties": ([1.0] * 6 + [2.0] * 5, [1.0, 2.0, 2.0], [0, 0, 0, 0, 0, 6, 0, 0, 0, 5], [0, 0, 0, 0, 0, 1, 0, 0, 0, 2]),
}


@pytest.mark.parametrize("name", CASES)
def test_drift_scores(spark, name):
    base, cur, b, c = CASES[name]
    rows = [sum(v is not None and v == v for v in side) for side in (base, cur)]
    row = drift.drift_scores(column(spark, base), column(spark, cur), ["x"]).collect()[0]
    psi = kl = 0.0
    for x, y in zip(b, c):
        p, q = x / rows[0] or 1e-4, y / rows[1] or 1e-4
        psi += (q - p) * math.log(q / p)
        p, q = x / sum(b) or 1e-10, y / sum(c) or 1e-10
        kl += q * math.log(q / p)
    assert row.psi_score == pytest.approx(psi, abs=1e-9)
    assert row.kl_divergence == pytest.approx(kl, abs=1e-9)


def test_drift_without_rows(spark):
    some = column(spark, TENS)
    none = column(spark, [None])
    for base, cur in ((none, some), (some, none)):
        row = drift.drift_scores(base, cur, ["x"]).collect()[0]
        assert (row.psi_score, row.kl_divergence) == (0.0, 0.0)
    far = drift.drift_scores(some, column(spark, [500.0]), ["x"]).collect()[0]
    # No current value in any bin: the shares are the floor, the divergence is undefined.
    assert far.psi_score > 1 and far.kl_divergence is None


def test_same_distribution_has_no_drift(spark):
    df = column(spark, SAMPLES["uniform"])
    row = drift.drift_multi_column(df, df, ["x"], AS_OF).collect()[0]
    assert (row.psi_score, row.drift_severity, row.requires_action) == (0.0, "no_drift", False)


def test_unusable_column_gives_error_row(spark):
    df = column(spark, [1, 2, 3]).withColumn("label", F.lit("a"))
    rows = {r.column_name: r for r in drift.drift_multi_column(df, df, ["x", "label"], AS_OF).collect()}
    assert rows["label"].drift_severity == "error"
    assert rows["label"].requires_action is False
    assert rows["x"].drift_severity == "no_drift"


def test_population_drift_without_shared_columns(spark):
    row = drift.population_drift(
        column(spark, [1], "bmi"), column(spark, [1], "other"), AS_OF
    ).collect()[0]
    assert (row.column_name, row.psi_score) == ("no_common_columns", 0.0)


def test_key_sample_ignores_partitioning(spark):
    df = spark.range(5000)
    one = {r.id for r in drift.key_sample(df.coalesce(1), ["id"], 0.2).collect()}
    many = {r.id for r in drift.key_sample(df.repartition(9), ["id"], 0.2).collect()}
    assert one == many
    assert 800 < len(one) < 1200


def test_moments_merge(spark):
    x = RNG.normal(1000, 3, 700)
    df = spark.createDataFrame([(int(i % 13), float(v)) for i, v in enumerate(x)], "g int, x double")
    parts = df.groupBy("g").agg(*moments("x"))
    row = parts.agg(merged_mean().alias("m"), merged_std().alias("s")).collect()[0]
    assert row.m == pytest.approx(x.mean())
    assert row.s == pytest.approx(x.std(ddof=1), rel=1e-6)
