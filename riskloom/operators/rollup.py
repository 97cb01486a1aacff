"""A stored rollup that answers every figure of a report, without the log.

Three tables stand below one folder, each partitioned by the day where it has one:

    cells      ``segments.score_cells`` with two more figures: the first and last
               time, and a quantile sketch (KLL) of the scores.  Sketches of any
               cells merge, so the quantiles of any period come from the cells.
    patients   the distinct patients of a day as bitmaps, one per bucket of
               32,768 patient numbers.  The bitwise OR of bitmaps is the bitmap of
               the union, so the distinct count of any period is exact.
    numbers    each patient's number.  Numbers are dense, are given once and stay,
               so bitmaps of different days fit each other.

A refresh reads whole days and replaces their partitions; reports read the tables.

A sketch of size K returns a value whose rank is within RANK_ERROR of the wanted
share, with 99 % confidence; below some thousand values it is exact.  It keeps
about 3 K values, whatever the number of rows.  For exact quantiles there is
``stats.quantiles`` over the log.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.functions.stats import at_ranks, n_rows, rank_list, running_counts
from riskloom.operators.segments import SCORE, score_cells
from riskloom.sources import sinks
from riskloom.sources.tables import time_range

DAY = "prediction_day"
STAMP = "prediction_timestamp"
PATIENT = "customer_id"
K = 1024
# 2.296 / K ** 0.9021, the bound of the sketch for one rank.
RANK_ERROR = 0.0045


@dataclass(frozen=True)
class Rollup:
    """The tables of a rollup; days are texts like 2024-01-31."""

    cells: DataFrame
    patients: DataFrame

    def between(self, start: datetime | None, end: datetime | None = None) -> Rollup:
        """The days from that of ``start`` to before that of ``end``.

        A rollup knows whole days only, so both must be midnights.
        """
        for moment in (start, end):
            if moment is not None and moment != _midnight(moment):
                raise ValueError(f"{moment} is within a day, a rollup has whole days")

        def cut(df: DataFrame) -> DataFrame:
            if start is not None:
                df = df.where(F.col(DAY) >= f"{start:%Y-%m-%d}")
            return df if end is None else df.where(F.col(DAY) < f"{end:%Y-%m-%d}")

        return Rollup(cut(self.cells), cut(self.patients))

    def last(self, days: int, as_of: datetime) -> Rollup:
        return self.between(as_of - timedelta(days=days))


def _midnight(moment: datetime) -> datetime:
    return datetime(moment.year, moment.month, moment.day)


# Building --------------------------------------------------------------------
def sketched_cells(log: DataFrame, k: int = K) -> DataFrame:
    """Cells of the log with the figures that only this rollup has, in one aggregate."""
    return score_cells(
        log,
        {
            "first_at": f"min({STAMP})",
            "last_at": f"max({STAMP})",
            # Without a value there is no sketch: merging skips nulls.
            "scores": f"CASE WHEN count({SCORE}) > 0 THEN kll_sketch_agg_double(double({SCORE}), {k}) END",
        },
    )


def refresh_numbers(log: DataFrame, path: str) -> DataFrame:
    """Number the log's patients that have no number yet, and return all numbers.

    Each task numbers its own new patients and writes them beside the table; one count per task
    says where each task's numbers begin, so they are dense.  Known patients keep theirs,
    so a repeated refresh adds nothing.
    """
    spark = log.sparkSession
    files, place, _ = sinks.folder(spark, path)
    known = spark.read.parquet(path) if files.exists(place) else None
    fresh = log.select(PATIENT).where(f"{PATIENT} IS NOT NULL").distinct()
    start = 1
    if known is not None:
        fresh = fresh.join(known.select(PATIENT), PATIENT, "left_anti")
        start = known.agg(F.coalesce(F.max("number") + 1, F.lit(1))).first()[0]
    dealt = fresh.withColumn("_part", F.spark_partition_id())
    order = Window.partitionBy("_part").orderBy(PATIENT)
    staged = f"{path}-staged"
    dealt.withColumn("_place", F.row_number().over(order) - 1).write.mode("overwrite").parquet(staged)
    rows = spark.read.parquet(staged)
    # One row per task of the numbering.
    sizes = sorted((r["_part"], r["count"]) for r in rows.groupBy("_part").count().collect())
    begins = [(part, start + sum(n for _, n in sizes[:k])) for k, (part, _) in enumerate(sizes)]
    if begins or known is None:
        bases = F.broadcast(spark.createDataFrame(begins, "_part int, _base long"))
        numbered = rows.join(bases, "_part").select(PATIENT, (F.col("_base") + F.col("_place")).alias("number"))
        numbered.write.mode("append").option("compression", sinks.CODEC).parquet(path)
    files.delete(sinks.folder(spark, staged)[1], True)
    return spark.read.parquet(path)


def patient_bitmaps(log: DataFrame, numbers: DataFrame) -> DataFrame:
    """(day, bucket, patients): a bitmap per day and 32,768 patient numbers."""
    seen = log.select(PATIENT, F.date_format(STAMP, "yyyy-MM-dd").alias(DAY)).distinct()
    return (
        seen.join(numbers, PATIENT)
        .groupBy(DAY, F.bitmap_bucket_number("number").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("patients"))
    )


def _replace_days(df: DataFrame, path: str, days: set[str], since: datetime | None) -> None:
    """Write days over the stored ones; days from ``since`` on that are empty now go."""
    (
        df.hint("rebalance", DAY).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .option("compression", sinks.CODEC).partitionBy(DAY).parquet(path)
    )
    sinks.drop_partitions(
        df.sparkSession, path, DAY, lambda day: day not in days and (since is None or day >= f"{since:%Y-%m-%d}")
    )


def refresh(log: DataFrame, path: str, since: datetime | None = None, k: int = K) -> Rollup:
    """Bring the rollup below ``path`` up to date, from the day of ``since`` on."""
    since = None if since is None else _midnight(since)
    rows = time_range(log, STAMP, since)
    numbers = refresh_numbers(rows, f"{path}/numbers")
    # One entry per day.
    days = {str(r[0]) for r in rows.select(F.to_date(STAMP)).distinct().collect()}
    _replace_days(sketched_cells(rows, k), f"{path}/cells", days, since)
    _replace_days(patient_bitmaps(rows, numbers), f"{path}/patients", days, since)
    return read(log.sparkSession, path)


def read(spark: SparkSession, path: str) -> Rollup:
    tables = (spark.read.parquet(f"{path}/{name}") for name in ("cells", "patients"))
    # The day stays text, as the cells made it.
    return Rollup(*[t.withColumn(DAY, F.date_format(F.col(DAY).cast("date"), "yyyy-MM-dd")) for t in tables])


# Figures ---------------------------------------------------------------------
def distinct_patients(patients: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Exact number of different patients per group of days."""
    buckets = patients.groupBy(*by, "bucket").agg(F.bitmap_count(F.bitmap_or_agg("patients")).alias("_n"))
    return buckets.groupBy(*by).agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("unique_patients"))


def merged_quantiles(probs: Sequence[float], names: Sequence[str]) -> list[Column]:
    """Aggregates: a sketch's quantiles per group of cells; null without values."""
    merged = F.kll_merge_agg_double("scores")
    found = F.when(
        F.count("scores") > 0, F.kll_sketch_get_quantile_double(merged, F.array(*[F.lit(float(p)) for p in probs]))
    )
    return [F.get(found, F.lit(i)).alias(name) for i, name in enumerate(names)]


def period_figures(rollup: Rollup, days: int) -> DataFrame:
    """Volume and score quantiles of a period as one row."""
    total = F.coalesce(F.sum("rows"), F.lit(0))
    cells = rollup.cells.agg(
        total.alias("total_predictions"),
        F.min("first_at").alias("earliest_prediction"),
        F.max("last_at").alias("latest_prediction"),
        F.round(total / F.lit(float(days)), 2).alias("avg_predictions_per_day"),
        *merged_quantiles([0.5, 0.95], ["median_risk", "p95_risk"]),
    )
    patients = distinct_patients(rollup.patients).select("unique_patients").scalar()
    first, *others = cells.columns
    return cells.select(first, patients.alias("unique_patients"), *others)


def daily_figures(rollup: Rollup) -> DataFrame:
    """Rows, distinct patients and score quantiles of each day."""
    cells = rollup.cells.groupBy(DAY).agg(
        F.sum("rows").alias("total_predictions"), *merged_quantiles([0.5, 0.95], ["median_risk", "p95_risk"])
    )
    return cells.join(distinct_patients(rollup.patients, [DAY]), DAY, "left")


def trailing_patients(rollup: Rollup, days: int) -> DataFrame:
    """Distinct patients of the ``days`` days up to each day, from the bitmaps alone.

    Each bitmap counts for the days that look back on it.
    """
    reach = F.explode(F.sequence(F.lit(0), F.lit(days - 1)))
    seen = rollup.patients.select("bucket", "patients", F.col(DAY).alias("_day"), reach.alias("_ahead"))
    ends = seen.withColumn(DAY, F.date_format(F.date_add(F.to_date("_day"), F.col("_ahead")), "yyyy-MM-dd"))
    present = rollup.patients.select(DAY).distinct()
    return distinct_patients(ends.join(present, DAY, "left_semi"), [DAY])


def rank_shares(log: DataFrame, estimates: DataFrame, names: Sequence[str], by: str = DAY) -> DataFrame:
    """Share of the log's scores below and up to each estimate: the estimate's true ranks.

    ``estimates`` has one row per group.
    """
    rows = log.select(F.date_format(STAMP, "yyyy-MM-dd").alias(by), F.col(SCORE).alias("_x")).where("_x IS NOT NULL")
    joined = rows.join(estimates.select(by, *names), by)
    shares = [
        F.avg(cond.cast("double")).alias(f"{name}_{end}")
        for name in names
        for end, cond in (("below", F.col("_x") < F.col(name)), ("upto", F.col("_x") <= F.col(name)))
    ]
    return joined.groupBy(by).agg(n_rows().alias("scored_rows"), *shares)


def within(name: str, share: float, error: float = RANK_ERROR) -> Column:
    """Whether an estimate's true ranks hold the wanted share, up to the error."""
    return F.col(f"{name}_below").between(0, share + error) & F.col(f"{name}_upto").between(share - error, 1)


def exact_quantiles(
    log: DataFrame, cells: DataFrame, probs: Sequence[float], names: Sequence[str], slack: float = 4 * RANK_ERROR
) -> DataFrame:
    """Exact quantiles of the log's scores, from one read of the log.

    The cells' sketches, which are of the same rows, bracket each wanted rank by two values.
    The read counts the rows between the brackets and collapses the values inside of them,
    a share of 2 ``slack`` of the rows for each rank.  A rank outside of its bracket, which
    the sketch makes all but impossible, raises an error instead of giving a near value.
    """
    shares = [[max(0.0, p - slack), min(1.0, p + slack)] for p in probs]
    ends = [e for pair in shares for e in pair]
    bracket = cells.agg(
        F.struct(*merged_quantiles(ends, [f"{end}{i}" for i in range(len(probs)) for end in ("lo", "hi")])).alias("b")
    )
    rows = log.select(F.col(SCORE).cast("double").alias("_x")).where("_x IS NOT NULL AND NOT isnan(_x)")
    rows = rows.withColumn("_b", bracket.scalar())
    ranges = range(len(probs))
    number = " + ".join(f"int(_x >= _b.lo{i}) + int(_x > _b.hi{i})" for i in ranges)
    inside = " OR ".join(f"(_x >= _b.lo{i} AND _x <= _b.hi{i})" for i in ranges)
    # All uses of these counts are alike, down to null-safe joins, so that they share one read.
    # The number of a stretch rises with the value; between the brackets it has one row.
    counted = rows.selectExpr(f"{number} AS _stretch", f"CASE WHEN {inside} THEN _x END AS _x").groupBy(
        "_stretch", "_x"
    ).agg(n_rows().alias("_n"))
    upto = Window.partitionBy(F.lit(0)).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(0))
    # At most two stretches per rank and one.
    stretches = counted.groupBy("_stretch").agg(F.sum("_n").alias("_size")).select(
        F.col("_stretch").alias("_s"),
        F.coalesce(F.sum("_size").over(upto), F.lit(0)).alias("_ahead"),
        F.sum("_size").over(whole).alias("_total"),
    )
    ordered = running_counts(counted, ["_stretch"], few_keys=True).join(
        F.broadcast(stretches), F.col("_stretch").eqNullSafe(F.col("_s"))
    )
    missed = F.raise_error(F.lit("a wanted rank lies outside of its bracket: use stats.quantiles"))
    start = F.col("_ahead") + F.col("_earlier")
    ranked = ordered.select("_x", "_total", start.alias("_start"), (start + F.col("_n")).alias("_end"))
    wanted = F.expr(f"exists({rank_list(probs)}, k -> k >= _start AND k < _end)")
    held = ranked.where(wanted).withColumn("_x", F.coalesce("_x", missed.cast("double")))
    return at_ranks(held, [], probs, names)
