from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from riskloom.session import work_dir
from riskloom.sources import buckets

SCHEMA = "id long, name string, score double"


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def files_of(path):
    return {p.parent.name: p.name for p in sorted(Path(path).glob(f"{buckets.BUCKET}=*/*.parquet"))}


def contents(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def first(spark, n=200):
    path = work_dir(spark, "buckets")
    rows = [(i, f"n{i}", i / 2) for i in range(n)] + [(None, "none", 0.0)]
    buckets.write_table(table(spark, rows), path, ["id"], 16)
    return path, rows


def test_upsert_rewrites_only_touched_buckets(spark):
    path, rows = first(spark)
    before = files_of(path)
    changes = [(3, "new", 9.0), (1000, "more", None), (None, None, 1.0)]
    after = buckets.upsert(table(spark, changes), path, ["id"])
    assert contents(after) == contents(table(spark, [r for r in rows if r[0] not in (3, None)] + changes))
    touched = {
        f"{buckets.BUCKET}={r[0]}"
        for r in buckets.with_bucket(table(spark, changes), ["id"], 16).select(buckets.BUCKET).collect()
    }
    now = files_of(path)
    assert len(before) == 16 and len(touched) <= 3
    assert {b for b in now if now[b] != before.get(b)} == touched
    # The digests are those of the table as it is.
    fresh = buckets.digests(buckets.with_bucket(after, ["id"], 16), 16)
    stored = buckets.sums_of(spark, path)
    assert contents(fresh) == contents(stored.select(*fresh.columns))


def test_repeated_and_empty_upserts_change_nothing(spark):
    path, _ = first(spark)
    changes = table(spark, [(3, "new", 9.0), (None, "none", 5.0)])
    once = contents(buckets.upsert(changes, path, ["id"]))
    assert contents(buckets.upsert(changes, path, ["id"])) == once
    assert contents(buckets.upsert(table(spark, []), path, ["id"])) == once
    made = work_dir(spark, "made")
    assert contents(buckets.upsert(table(spark, []), made, ["id"])) == []
    assert contents(buckets.upsert(changes, made, ["id"])) == contents(changes)


def test_a_broken_upsert_is_finished_by_the_next(spark, monkeypatch):
    path, rows = first(spark)
    changes = table(spark, [(3, "new", 9.0)])
    replace, calls = buckets._replace, []

    def breaks(frame, place, whole):
        calls.append(place)
        if place == f"{path}-sums":
            raise OSError("lost")
        replace(frame, place, whole)

    monkeypatch.setattr(buckets, "_replace", breaks)
    with pytest.raises(OSError):
        buckets.upsert(changes, path, ["id"])
    monkeypatch.setattr(buckets, "_replace", replace)
    later = buckets.upsert(table(spark, [(4, "later", 1.0)]), path, ["id"])
    expected = [r for r in rows if r[0] not in (3, 4)] + [(3, "new", 9.0), (4, "later", 1.0)]
    assert contents(later) == contents(table(spark, expected))
    fresh = buckets.digests(buckets.with_bucket(later, ["id"], 16), 16)
    assert contents(fresh) == contents(buckets.sums_of(spark, path).select(*fresh.columns))


def test_new_columns_reach_every_bucket(spark):
    path, rows = first(spark)
    wide = table(spark, [(3, "new", 9.0)]).withColumn("extra", F.lit(7))
    after = buckets.upsert(wide, path, ["id"])
    assert after.where("extra = 7").count() == 1 and after.count() == len(rows)
    assert "extra" in spark.read.parquet(path).columns


def test_changes_read_differing_buckets_only(spark):
    path, rows = first(spark)
    other = work_dir(spark, "buckets")
    now = [(i, n, -1.0 if i == 5 else s) for i, n, s in rows if i not in (7, None)] + [(None, "none", 0.0), (500, "x", 1.0)]
    schema = buckets.write_table(table(spark, now), other, ["id"], 16).schema
    differ = buckets.differing_buckets(spark, path, other)
    assert 0 < len(differ) <= 3
    # Files of equal buckets cannot be read any more.
    for place in (path, other):
        for file in Path(place).glob(f"{buckets.BUCKET}=*/*.parquet"):
            if int(file.parent.name.split("=")[1]) not in differ:
                file.write_bytes(b"not a table")
                file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    found = buckets.state_changes(spark, path, other, ["id"], schema).where("id IS NOT NULL")
    assert contents(found) == [(5, "update"), (500, "insert"), (7, "delete")]
    assert buckets.differing_buckets(spark, path, path) == []


def test_digests_see_moved_nulls_and_repeats(spark):
    def sums(rows):
        frame = spark.createDataFrame(rows, "a string, b string").withColumn(buckets.BUCKET, F.lit(0))
        return contents(buckets.digests(frame, 1))

    assert sums([("x", None)]) != sums([(None, "x")])
    assert sums([("x", "y")] * 2) != sums([("x", "z")] * 2)
    assert sums([("x", "y"), ("p", "q")]) == sums([("p", "q"), ("x", "y")])


def test_tables_of_other_bucket_numbers_are_refused(spark):
    path, _ = first(spark)
    other = work_dir(spark, "buckets")
    buckets.write_table(table(spark, [(1, "a", 1.0)]), other, ["id"], 8)
    with pytest.raises(ValueError):
        buckets.differing_buckets(spark, path, other)
