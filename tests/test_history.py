"""Ordered logic with hot keys, SCD type 2 invariants, streaming state."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from riskloom.functions import ordered
from riskloom.functions.ordered import as_of_merge, is_crowded, rank_parts, split_window, top_rows
from riskloom.operators import star
from riskloom.sources import sinks
from riskloom.sources import testdata as td
from riskloom.streaming import state


def hot_rows(n=600):
    """One key holds most rows; keys and values repeat and may be null."""
    rng = random.Random(3)
    rows = []
    for i in range(n):
        key = "hot" if rng.random() < 0.7 else rng.choice(["a", "b", None])
        rows.append((key, rng.randrange(0, 200), i, rng.choice(["x", "y", None])))
    return rows


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_split_window_equals_plain_window(spark, width):
    df = spark.createDataFrame(hot_rows(), "k string, t int, id int, v string")
    out = split_window(
        df,
        ["k"],
        ["t", "id"],
        F.floor(F.col("t") / width),
        lag={"p": "v"},
        lead={"n": "v"},
        running_count="c",
    )
    w = Window.partitionBy("k").orderBy("t", "id")
    plain = df.select(
        *df.columns,
        F.lag("v").over(w).alias("p"),
        F.lead("v").over(w).alias("n"),
        F.row_number().over(w).cast("long").alias("c"),
    )
    assert sorted(map(str, out.collect())) == sorted(map(str, plain.collect()))


def one_hour(spark, n=4000):
    """A key with all its rows in one hour, a third of them in one second."""
    rng = random.Random(8)
    rows = [("hot", 1000 + (500 if rng.random() < 0.3 else rng.randrange(3600)), i, i % 3) for i in range(n)]
    rows += [("calm", rng.randrange(100_000), n + i, i % 3) for i in range(300)] + [(None, 5, n + 999, 1)]
    return spark.createDataFrame(rows, "k string, t int, id int, v int")


def test_rank_parts_spread_a_crowded_hour(spark):
    df = one_hour(spark)
    hour = F.floor(F.col("t") / 3600)
    assert is_crowded(df, ["k"], hour, 200) and not is_crowded(df, ["k"], hour, 5000)
    cut = rank_parts(df, ["k"], ["t", "id"], hour, crowded=200)
    sizes = cut.groupBy("k", "_chunk").count()
    largest = sizes.agg(F.max("count")).first()[0]
    assert largest <= 200
    # Chunks follow the order of the rows.
    w = Window.partitionBy("k").orderBy("t", "id")
    assert cut.withColumn("b", F.lag("_chunk").over(w)).where("b > _chunk").count() == 0
    # Calm keys keep their hour.
    assert cut.where("k = 'calm'").select("_chunk").distinct().count() == df.where("k = 'calm'").select(hour).distinct().count()


def test_split_window_by_rank_equals_plain_window(spark, monkeypatch):
    monkeypatch.setattr(ordered, "CROWDED", 200)
    df = one_hour(spark, 1500)
    hour = F.floor(F.col("t") / 3600)
    out = split_window(df, ["k"], ["t", "id"], hour, lag={"p": "v"}, lead={"n": "v"}, running_count="c", by_rank=True)
    w = Window.partitionBy("k").orderBy("t", "id")
    plain = df.select(
        *df.columns, F.lag("v").over(w).alias("p"), F.lead("v").over(w).alias("n"),
        F.row_number().over(w).cast("long").alias("c"),
    )
    assert sorted(map(str, out.collect())) == sorted(map(str, plain.collect()))


@pytest.mark.parametrize("by_rank", [False, True])
def test_as_of_merge_equals_plain_join(spark, monkeypatch, by_rank):
    monkeypatch.setattr(ordered, "CROWDED", 50)
    rng = random.Random(12)

    def at(minutes):
        return datetime(2024, 1, 1) + timedelta(minutes=minutes)

    keys = ["hot"] * 6 + ["a", "b", "none"]
    facts = [(i, rng.choice([*keys, None]), at(rng.choice([rng.randrange(300_000), rng.randrange(50, 60)]))) for i in range(600)]
    facts += [(601, "hot", None), (602, None, None)]
    starts = {k: sorted(rng.sample(range(0, 300_000, 7), 40)) + [50, 55] for k in ("hot", "a", "b")}
    versions = []
    for k, places in starts.items():
        places = sorted(set(places))
        for n, (begin, end) in enumerate(zip(places, [*places[1:], None])):
            # Every fifth version ends early: a gap without a version.
            versions.append((k, at(begin), None if end is None else at(end - 3 if n % 5 == 0 else end), n))
    left = spark.createDataFrame(facts, "id int, k string, t timestamp_ntz")
    right = spark.createDataFrame(versions, "key string, begin timestamp_ntz, stop timestamp_ntz, n int")
    found = as_of_merge(left, right, "k", "key", "t", "begin", ["n"], until="stop", by_rank=by_rank)

    def of(k, t):
        if k is None or t is None:
            return None
        hits = [n for key, b, e, n in versions if key == k and b <= t and (e is None or t < e)]
        return hits[0] if hits else None

    got = {r.id: r.n for r in found.collect()}
    assert got == {i: of(k, t) for i, k, t in facts} and len(set(got.values())) > 20
    assert found.columns == ["id", "k", "t", "n"]


def test_as_of_merge_takes_the_last_of_equal_times(spark):
    left = spark.createDataFrame([(1, "a", 5), (2, "a", 4)], "id int, k string, t int").withColumn(
        "t", F.timestamp_seconds("t").cast("timestamp_ntz")
    )
    right = spark.createDataFrame([("a", 5, 1, "x"), ("a", 5, 2, "y")], "k string, b int, version int, v string").withColumn(
        "b", F.timestamp_seconds("b").cast("timestamp_ntz")
    )
    found = as_of_merge(left, right, "k", "k", "t", "b", ["v"], ties=["version"])
    assert {r.id: r.v for r in found.collect()} == {1: "y", 2: None}


def test_top_rows_cut_before_the_shuffle(spark):
    df = spark.createDataFrame(hot_rows(), "k string, t int, id int, v string")
    top = top_rows(df, ["k"], [F.col("t").desc(), F.col("id").desc()], 2)
    assert top.count() == 8
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_scd2_versions(spark, sf_dir):
    versions = star.scd2_dim_patients(td.plan_changes(spark, sf_dir)).cache()
    assert versions.groupBy("patient_natural_key").agg(
        F.count_if("is_current_record").alias("n")
    ).where("n <> 1").count() == 0
    w = Window.partitionBy("patient_natural_key").orderBy("record_version")
    gaps = versions.withColumn("next", F.lead("effective_date").over(w))
    assert gaps.where("NOT (expiry_date <=> next)").count() == 0
    assert versions.where("expiry_date < effective_date").count() == 0


def test_point_in_time_matches_every_covered_fact_once(spark, sf_dir):
    versions = star.scd2_dim_patients(td.plan_changes(spark, sf_dir))
    facts = td.claims(spark, sf_dir).select(
        "claim_id", "patient_id", F.to_timestamp_ntz("claim_date").alias("t")
    )
    joined = star.point_in_time_join(facts, versions, "patient_id", "t", ["record_version"])
    assert joined.count() == facts.count()
    assert joined.select("claim_id").distinct().count() == facts.count()


def test_scd2_apply_nothing_changes_nothing(spark, sf_dir):
    dim = star.scd2_dim_patients(td.plan_changes(spark, sf_dir)).cache()
    same = dim.where("is_current_record").select(
        "patient_natural_key",
        "primary_insurance_plan",
        F.lit("2030-01-01 00:00:00").cast("timestamp_ntz").alias("changed_at"),
        F.lit(1).cast("long").alias("sequence"),
    )
    after = star.scd2_apply_changes(dim, same)
    assert after.exceptAll(dim).count() == 0
    assert after.count() == dim.count()


def test_duplicate_current_rows_do_not_multiply_facts(spark, sf_dir):
    from riskloom.operators.medallion import silver_claims

    claims = silver_claims(td.claims(spark, sf_dir))
    facts = star.fact_claims(claims, td.dim_patient_rows(spark, sf_dir))
    assert facts.count() == claims.count()


def test_incremental_changes_see_nulls(spark):
    a = spark.createDataFrame([(1, None), (2, "x"), (3, "y")], "id int, v string")
    b = spark.createDataFrame([(1, None), (2, None), (4, "z")], "id int, v string")
    got = {(r.id, r.change_type) for r in sinks.incremental_changes(a, b, ["id"]).collect()}
    assert got == {(2, "update"), (3, "delete"), (4, "insert")}


def test_stream_state_survives_replay(spark, sf_dir, tmp_path):
    log = td.predictions(spark, sf_dir)
    columns = ["customer_id", "event_id", "prediction_timestamp", "adjusted_prediction", "risk_category"]
    path = str(tmp_path / "state")
    write = state.latest_increment(path, columns)
    for epoch, part in enumerate([log.where("event_id % 2 = 0"), log.where("event_id % 2 = 1")]):
        write(part, epoch)
    once = {tuple(r) for r in state.latest_state(spark, path).collect()}
    write(log.where("event_id % 2 = 1"), 1)
    assert {tuple(r) for r in state.latest_state(spark, path).collect()} == once


def test_stream_state_is_folded_while_it_runs(spark, tmp_path):
    columns = ["customer_id", "event_id", "prediction_timestamp", "adjusted_prediction", "risk_category"]
    path = str(tmp_path / "state")
    write = state.latest_increment(path, columns, fold_every=4)
    rng = random.Random(2)
    rows, batches, most = [], [], 0

    def wanted():
        by: dict = {}
        for r in rows:
            by.setdefault(r[0], []).append(r)
        return {r for own in by.values() for r in sorted(own, key=lambda r: (r[2], r[1]))[-2:]}

    for epoch in range(22):
        # Late rows too, and patients that come once only.
        new = [
            (f"p{rng.randrange(6)}" if k else f"only{epoch}", epoch * 10 + k, datetime(2024, 1, 1 + rng.randrange(20)), float(k), "low")
            for k in range(4)
        ]
        rows += new
        batches.append(spark.createDataFrame(new, "customer_id string, event_id long, prediction_timestamp timestamp_ntz, adjusted_prediction double, risk_category string"))
        write(batches[-1], epoch)
        most = max(most, len(state.epochs(spark, path)))
        if epoch % 7 == 5:
            assert {tuple(r) for r in state.latest_state(spark, path).collect()} == wanted()
            write(batches[-1], epoch)  # replayed
            write(batches[0], 0)  # long folded, or its own folder again
            assert {tuple(r) for r in state.latest_state(spark, path).collect()} == wanted()
    assert most <= 2 * 4 + 2 and state.folds(spark, path)
    assert max(map(len, state.buckets(spark, path).values())) <= 3
    # A fold that was not committed is no fold.
    (tmp_path / "state" / "base" / "upto=999" / "bucket=0").mkdir(parents=True)
    assert {tuple(r) for r in state.latest_state(spark, path).collect()} == wanted()
