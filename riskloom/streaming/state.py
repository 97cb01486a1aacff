"""Latest score and transition per patient, kept as folded state and recent increments.

Every micro-batch writes the newest two rows per patient to a folder of its own epoch.
Every FOLD epochs the batch that comes next folds the increments since the last fold into the base: the
base is kept in BUCKETS partitions by the hash of the key, and only buckets that the
increments touch are written anew, below the folder of the fold:

    increments/epoch=17/...
    base/upto=16/bucket=3/...

A fold counts once Spark has committed it (``_SUCCESS``).  The state is the newest version
of each bucket and the increments after the last fold.  What a fold replaces is deleted one
fold later, so that readers of the state before can end; the number of folders is
bounded by 2 FOLD increments and two versions of a bucket.

Replaying an epoch writes the same rows over its own folder, or nothing if it is
folded already, so the result does not depend on retries.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.ordered import top_rows
from riskloom.operators.validation import risk_transitions
from riskloom.sources.sinks import folder

EPOCH, UPTO, BUCKET = "epoch", "upto", "bucket"
KEY = "customer_id"
KEPT = 2
FOLD = 16
BUCKETS = 32


def _newest_first():
    return [F.col("prediction_timestamp").desc(), F.col("event_id").desc()]


def _newest(rows: DataFrame) -> DataFrame:
    return top_rows(rows, [KEY], _newest_first(), KEPT)


# Folders ---------------------------------------------------------------------
def _listed(spark: SparkSession, path: str, column: str) -> list[int]:
    """Values of the partition folders right below a path, in order."""
    files, place, _ = folder(spark, path)
    if not files.exists(place):
        return []
    names = (entry.getPath().getName().partition("=") for entry in files.listStatus(place))
    return sorted(int(value) for name, _, value in names if name == column)


def _is_complete(spark: SparkSession, path: str) -> bool:
    files, place, _ = folder(spark, f"{path}/_SUCCESS")
    return files.exists(place)


def _delete(spark: SparkSession, path: str) -> None:
    files, place, _ = folder(spark, path)
    files.delete(place, True)


def epochs(spark: SparkSession, path: str) -> list[int]:
    return _listed(spark, f"{path}/increments", EPOCH)


def folds(spark: SparkSession, path: str) -> list[int]:
    """Last epochs of the committed folds."""
    return [n for n in _listed(spark, f"{path}/base", UPTO) if _is_complete(spark, f"{path}/base/{UPTO}={n}")]


def buckets(spark: SparkSession, path: str) -> dict[int, list[int]]:
    """The folds that hold a version of each bucket, in order."""
    found: dict[int, list[int]] = {}
    for fold in folds(spark, path):
        for bucket in _listed(spark, f"{path}/base/{UPTO}={fold}", BUCKET):
            found.setdefault(bucket, []).append(fold)
    return found


# Writing ---------------------------------------------------------------------
def latest_increment(
    path: str, columns: Sequence[str], fold_every: int = FOLD
) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` writer."""

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        done = folds(spark, path)
        if done and epoch <= done[-1]:
            return
        _newest(batch.select(*columns)).write.mode("overwrite").parquet(f"{path}/increments/{EPOCH}={epoch}")
        # Whatever is older than this epoch is committed and will not be replayed.
        waiting = [e for e in epochs(spark, path) if e < epoch and (not done or e > done[-1])]
        if len(waiting) >= fold_every:
            fold_state(spark, path, waiting[-1])

    return write


def fold_state(spark: SparkSession, path: str, upto: int) -> None:
    """Fold the increments up to an epoch into the buckets they touch, then tidy up."""
    done = folds(spark, path)
    last = done[-1] if done else -1
    wanted = [e for e in epochs(spark, path) if last < e <= upto]
    if not wanted:
        return
    fresh = spark.read.parquet(*[f"{path}/increments/{EPOCH}={e}" for e in wanted])
    number = F.pmod(F.xxhash64(KEY), F.lit(BUCKETS)).cast("int")
    fresh = fresh.withColumn(BUCKET, number)
    # At most BUCKETS values.
    touched = sorted(r[0] for r in fresh.select(BUCKET).distinct().collect())
    old = _base(spark, path, touched)
    both = fresh if old is None else fresh.unionByName(old.withColumn(BUCKET, number))
    _newest(both).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{path}/base/{UPTO}={upto}")
    _tidy(spark, path)


def _tidy(spark: SparkSession, path: str) -> None:
    """Delete increments that the fold before the last one took in, and versions of
    buckets that the last two folds have both replaced."""
    done = folds(spark, path)
    if len(done) < 2:
        return
    for epoch in epochs(spark, path):
        if epoch <= done[-2]:
            _delete(spark, f"{path}/increments/{EPOCH}={epoch}")
    for bucket, versions in buckets(spark, path).items():
        # The newest version that a reader of the state before the last fold may use.
        needed = [v for v in versions if v <= done[-2]][-1:] + [done[-1]]
        for version in versions:
            if version not in needed:
                _delete(spark, f"{path}/base/{UPTO}={version}/{BUCKET}={bucket}")
    for fold in done[:-1]:
        if not _listed(spark, f"{path}/base/{UPTO}={fold}", BUCKET):
            _delete(spark, f"{path}/base/{UPTO}={fold}")


# Reading ---------------------------------------------------------------------
def _base(spark: SparkSession, path: str, wanted: Sequence[int] | None = None) -> DataFrame | None:
    """Newest version of the buckets."""
    paths = [
        f"{path}/base/{UPTO}={versions[-1]}/{BUCKET}={bucket}"
        for bucket, versions in buckets(spark, path).items()
        if wanted is None or bucket in wanted
    ]
    return spark.read.parquet(*paths) if paths else None


def latest_state(spark: SparkSession, path: str) -> DataFrame:
    """Newest two rows per patient: the folded base and the increments after it."""
    done = folds(spark, path)
    parts = [] if (base := _base(spark, path)) is None else [base]
    after = [e for e in epochs(spark, path) if not done or e > done[-1]]
    if after:
        parts.append(spark.read.parquet(*[f"{path}/increments/{EPOCH}={e}" for e in after]))
    return _newest(reduce(DataFrame.unionByName, parts))


def latest_scores(spark: SparkSession, path: str) -> DataFrame:
    return top_rows(latest_state(spark, path), [KEY], _newest_first(), 1)


def latest_transitions(spark: SparkSession, path: str) -> DataFrame:
    return risk_transitions(latest_state(spark, path))
