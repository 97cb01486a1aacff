"""Streaming jobs over the events file, run to completion and read back."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.plans.catalog_monitoring import GAP, HOURS, PERIOD
from riskloom.plans.registry import ENTRIES, register
from riskloom.plans.sql_tables import oracle, r
from riskloom.session import work_dir
from riskloom.sources import testdata as td
from riskloom.streaming import ingest, profiles, scoring, state

A = "adjusted_prediction"
SPLIT = datetime(2024, 1, 20)
# Newest event time less the watermark delay.
WATERMARK = "(SELECT max(prediction_timestamp) - INTERVAL 1 DAY FROM pred)"


EVENT_FILES = "events.parquet"


def _schema(spark, sf_dir):
    return td.table(spark, sf_dir, "events").schema


def _scored(spark, sf_dir, path=None):
    """Scores of the arriving events; event time gets the type watermarks need."""
    arrivals = ingest.file_stream(
        spark, path or sf_dir, _schema(spark, sf_dir), names=None if path else EVENT_FILES
    )
    arrivals = arrivals.select(
        "event_id",
        "user_id",
        "value",
        F.col("ts").cast("timestamp").alias("prediction_timestamp"),
    )
    dim = td.dim_patients(spark, sf_dir).drop("is_current_record", "dimension_last_updated")
    value = F.col("value")
    return scoring.stream_score(
        arrivals,
        dim,
        "user_id",
        "patient_surrogate_key",
        F.lit(100.0) * value / (value + F.lit(40.0)),
        td.MODEL_NAME,
        td.MODEL_VERSION,
    )


def _naive(df, *columns):
    """Times without zone, as in the batch tables."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def _sink(spark, stream, name, mode="append"):
    path = work_dir(spark, name)
    ingest.run_available(stream, f"{path}-checkpoint", path, mode)
    return spark.read.parquet(path)


def _ingest(spark, sf_dir):
    rows = ingest.stream_ingest_files(spark, sf_dir, _schema(spark, sf_dir), EVENT_FILES)
    return _sink(spark, rows, "ingest").select(
        "event_id",
        "event_type",
        "_file_name",
        (F.col("_file_size") > 0).alias("has_size"),
        F.col("_ingested_at").isNotNull().alias("has_ingest_time"),
    )


register(
    "stream_ingest_files",
    _ingest,
    "SELECT event_id, event_type, 'events.parquet' AS _file_name, true AS has_size, "
    "true AS has_ingest_time FROM events",
)


def _bronze(spark, sf_dir):
    target = work_dir(spark, "bronze")
    for _ in range(2):
        # The second run finds no new file and adds nothing.
        ingest.stream_bronze(
            spark,
            sf_dir,
            _schema(spark, sf_dir),
            target,
            f"{target}-checkpoint",
            EVENT_FILES,
        )
    bronze = spark.read.parquet(target)
    return bronze.groupBy("_file_name", "event_type").agg(
        F.count("*").alias("row_count"),
        F.min("event_id").alias("first_event"),
        F.max("event_id").alias("last_event"),
    )


register(
    "stream_bronze",
    _bronze,
    "SELECT 'events.parquet' AS _file_name, event_type, count(*) AS row_count, "
    "min(event_id) AS first_event, max(event_id) AS last_event FROM events GROUP BY 2",
)
register(
    "stream_score",
    lambda s, d: _naive(
        _sink(
            s,
            _scored(s, d).select(
                "event_id",
                "customer_id",
                "prediction_timestamp",
                A,
                "risk_category",
                "high_risk_patient",
                "requires_review",
            ),
            "scores",
        ),
        "prediction_timestamp",
    ),
    oracle(
        f"SELECT event_id, customer_id, prediction_timestamp, {r(A, A)}, risk_category, "
        "high_risk_patient, requires_review FROM pred"
    ),
)
PROFILE_SQL = (
    "cast(date_trunc('day', prediction_timestamp) as timestamp) AS window_start, "
    "cast(date_trunc('day', prediction_timestamp) as timestamp) + INTERVAL 1 DAY AS window_end, "
    f"model_name, count(*) AS prediction_count, {r(f'avg({A})', 'avg_prediction')}, "
    f"{r(f'stddev_samp({A})', 'std_prediction')}, {r(f'min({A})', 'min_prediction')}, "
    f"{r(f'max({A})', 'max_prediction')}, "
    "count(*) FILTER (WHERE high_risk_patient) AS high_risk_count FROM pred"
)
register(
    "stream_daily_profile",
    lambda s, d: _naive(
        _sink(s, profiles.stream_daily_profile(_scored(s, d)), "profile"),
        "window_start",
        "window_end",
    ),
    oracle(
        f"WITH w AS (SELECT {PROFILE_SQL} GROUP BY 1, 2, 3) SELECT * FROM w "
        f"WHERE window_end <= {WATERMARK}"
    ),
)
register(
    "stream_sliding_volume",
    lambda s, d: _naive(
        _sink(s, profiles.stream_sliding_volume(_scored(s, d)), "sliding"),
        "window_start",
        "window_end",
    ),
    oracle(
        "WITH h AS (SELECT date_trunc('hour', prediction_timestamp) AS t, count(*) AS n FROM pred "
        "GROUP BY 1), w AS (SELECT cast(t - INTERVAL 1 HOUR * k as timestamp) AS window_start, "
        "sum(n) AS c FROM h, range(24) x(k) GROUP BY 1) SELECT window_start, "
        "window_start + INTERVAL 1 DAY AS window_end, cast(c as bigint) AS prediction_count, "
        f"c < 50 AS low_volume FROM w WHERE window_start + INTERVAL 1 DAY <= {WATERMARK}"
    ),
)

# Silence -------------------------------------------------------------------
BEATS_UNTIL = datetime(2024, 2, 4)


def _heartbeats(spark):
    """An hourly heartbeat over the period and some days on, as a file stream."""
    path = work_dir(spark, "heartbeats")
    first = F.lit(PERIOD[0].isoformat(sep=" ")).cast("timestamp")
    last = F.lit(BEATS_UNTIL.isoformat(sep=" ")).cast("timestamp")
    beats = F.explode(F.sequence(first, last, F.expr("INTERVAL 1 HOUR"))).alias("prediction_timestamp")
    spark.range(1).select(beats).write.parquet(path)
    return ingest.file_stream(spark, path, T.StructType([T.StructField("prediction_timestamp", T.TimestampType())]))


def _gappy_scores(spark, sf_dir):
    """The score stream with a spell without rows."""
    return _scored(spark, sf_dir).where(GAP)


def _zero_windows(spark, sf_dir):
    volume = profiles.stream_sliding_volume(_gappy_scores(spark, sf_dir), heartbeat=_heartbeats(spark))
    windows = _naive(_sink(spark, volume, "zero-windows"), "window_start", "window_end")
    # Windows that lie in the period as a whole.
    return windows.where(F.col("window_start") >= F.lit(PERIOD[0])).where(F.col("window_end") <= F.lit(PERIOD[1]))


register(
    "stream_zero_windows",
    _zero_windows,
    oracle(
        f"WITH {HOURS}, w AS (SELECT slot AS window_start, slot + INTERVAL 1 DAY AS window_end, "
        "sum(n) OVER (ORDER BY slot ROWS BETWEEN CURRENT ROW AND 23 FOLLOWING) AS c FROM volume) "
        "SELECT window_start, window_end, cast(c as bigint) AS prediction_count, c < 50 AS low_volume "
        "FROM w WHERE window_end <= TIMESTAMP '2024-01-31'"
    ),
)


def _silence(spark, sf_dir):
    spells = profiles.stream_silence(_gappy_scores(spark, sf_dir), _heartbeats(spark))
    found = _naive(_sink(spark, spells, "silence"), "silent_from")
    return found.where(F.col("silent_from") < F.lit(PERIOD[1]))


register("stream_silence", _silence, ENTRIES["silence_alerts"].sql)


def _dedupe(spark, sf_dir):
    columns = ("event_id", "customer_id", "prediction_timestamp", A)
    once, again = (_scored(spark, sf_dir).select(*columns) for _ in range(2))
    unique = scoring.stream_dedupe(once.unionByName(again))
    return _naive(_sink(spark, unique, "unique"), "prediction_timestamp")


register(
    "stream_dedupe",
    _dedupe,
    oracle(f"SELECT event_id, customer_id, prediction_timestamp, {r(A, A)} FROM pred"),
)


def _arrivals_in_two_steps(spark, sf_dir, name, first, second, run):
    """Write ``first``, run the stream, add ``second``, run it again."""
    inbox = work_dir(spark, name)
    events = td.table(spark, sf_dir, "events")
    split = F.lit(SPLIT.isoformat(sep=" ")).cast("timestamp_ntz")
    parts = {"old": F.col("ts") < split, "new": F.col("ts") >= split}
    queries = []
    for step in (first, second):
        events.where(parts[step]).write.mode("append").parquet(inbox)
        queries.append(run(inbox))
    return queries


def _latest(spark, sf_dir):
    path = work_dir(spark, "latest")
    columns = ("customer_id", "event_id", "prediction_timestamp", A, "risk_category")

    def run(inbox):
        return ingest.run_available(
            _scored(spark, sf_dir, inbox),
            f"{path}-checkpoint",
            mode="append",
            each_batch=state.latest_increment(path, columns),
        )

    _arrivals_in_two_steps(spark, sf_dir, "inbox", "old", "new", run)
    latest = state.latest_scores(spark, path)
    moved = state.latest_transitions(spark, path).select("customer_id", "previous_category")
    return _naive(latest.join(moved, "customer_id", "left"), "prediction_timestamp")


register(
    "stream_latest_state",
    _latest,
    oracle(
        f"SELECT customer_id, event_id, prediction_timestamp, {r(A, A)}, risk_category, "
        "CASE WHEN p <> risk_category THEN p END AS previous_category FROM (SELECT *, "
        "lag(risk_category) OVER w AS p, lead(event_id) OVER w AS later FROM pred WINDOW w AS "
        "(PARTITION BY customer_id ORDER BY prediction_timestamp, event_id)) WHERE later IS NULL"
    ),
)


def _late(spark, sf_dir):
    path = work_dir(spark, "late")

    def run(inbox):
        profile = profiles.stream_daily_profile(_scored(spark, sf_dir, inbox))
        return ingest.run_available(profile, f"{path}-checkpoint", path)

    late = profiles.LateRows()
    spark.streams.addListener(late)
    try:
        ran = _arrivals_in_two_steps(spark, sf_dir, "inbox", "new", "old", run)
        # Late rows are counted after the map-side aggregate, that is per group.
        dropped = late.wait(len(ran))
    finally:
        spark.streams.removeListener(late)
    return _naive(
        spark.read.parquet(path).withColumn("late_rows_dropped", F.lit(dropped > 0)),
        "window_start",
        "window_end",
    )


register(
    "stream_late_data",
    _late,
    oracle(
        f"WITH w AS (SELECT {PROFILE_SQL} WHERE prediction_timestamp >= TIMESTAMP '2024-01-20' "
        "GROUP BY 1, 2, 3) SELECT *, true AS late_rows_dropped FROM w "
        f"WHERE window_end <= {WATERMARK}"
    ),
)
