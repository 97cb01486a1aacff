"""Windowed profiles over the score stream.

All jobs run in append mode behind a watermark, so state is bounded by the
delay; a window is written once, after it can no longer change.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from riskloom.functions.stats import n_rows
from riskloom.operators.monitoring import MAX_SILENT_HOURS

SCORE = "adjusted_prediction"
LOW_VOLUME = 50


def stream_daily_profile(
    scores: DataFrame,
    window: str = "1 day",
    stamp: str = "prediction_timestamp",
    delay: str = "1 day",
) -> DataFrame:
    return (
        scores.withWatermark(stamp, delay)
        .groupBy(F.window(stamp, window).alias("w"), "model_name")
        .agg(
            n_rows().alias("prediction_count"),
            F.avg(SCORE).alias("avg_prediction"),
            F.stddev_samp(SCORE).alias("std_prediction"),
            F.min(SCORE).alias("min_prediction"),
            F.max(SCORE).alias("max_prediction"),
            F.count_if("high_risk_patient").alias("high_risk_count"),
        )
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            *[c for c in ("model_name", "prediction_count", "avg_prediction", "std_prediction")],
            *[c for c in ("min_prediction", "max_prediction", "high_risk_count")],
        )
    )


def clock(spark: SparkSession, stamp: str = "prediction_timestamp") -> DataFrame:
    """A heartbeat per second, for streams that must notice silence."""
    return spark.readStream.format("rate").option("rowsPerSecond", 1).load().select(F.col("timestamp").alias(stamp))


def _slots(scores: DataFrame, slide: str, stamp: str, delay: str, heartbeat: DataFrame | None) -> DataFrame:
    """Rows per slide.  Heartbeats are rows that count nothing: united with the scores before the
    watermark they open the slots that have no score, and move time on without any."""
    rows = scores.select(stamp, F.lit(1).alias("n"))
    if heartbeat is not None:
        rows = rows.unionByName(heartbeat.select(stamp, F.lit(0).alias("n")))
    return (
        rows.withWatermark(stamp, delay)
        .groupBy(F.window(stamp, slide).alias("slot"))
        .agg(F.sum("n").alias("rows"))
    )


def stream_sliding_volume(
    scores: DataFrame,
    length: str = "1 day",
    slide: str = "1 hour",
    stamp: str = "prediction_timestamp",
    delay: str = "1 day",
    low_volume: int = LOW_VOLUME,
    heartbeat: DataFrame | None = None,
) -> DataFrame:
    """Rolling volume with a low-volume flag.

    Rows are first counted per slide; only those counts are repeated for the
    windows they belong to, instead of every row.  With a ``heartbeat`` of at least
    one row per slide a window without scores is written as well, with a zero.
    """
    slots = _slots(scores, slide, stamp, delay, heartbeat)
    return (
        slots.groupBy(F.window(F.window_time("slot"), length, slide).alias("w"))
        .agg(F.sum("rows").alias("prediction_count"))
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "prediction_count",
            (F.col("prediction_count") < low_volume).alias("low_volume"),
        )
    )


def stream_silence(
    scores: DataFrame,
    heartbeat: DataFrame,
    hours: int = MAX_SILENT_HOURS,
    stamp: str = "prediction_timestamp",
    delay: str = "1 day",
) -> DataFrame:
    """Spells of more than ``hours`` whole hours without a score, as they end.

    Hours without scores are known by the heartbeat; those in a row are one session.
    """
    empty = _slots(scores, "1 hour", stamp, delay, heartbeat).where("rows = 0")
    # Slots in a row are an hour apart, others two at least.
    session = F.session_window(F.window_time("slot"), "90 minutes")
    return (
        # Sessions on a stream need a key beside them; all empty hours have the same one.
        empty.groupBy(session.alias("s"), "rows")
        .agg(F.min("slot.start").alias("silent_from"), n_rows().alias("silent_hours"))
        .where(F.col("silent_hours") > hours)
        .select("silent_from", "silent_hours")
    )


class LateRows(StreamingQueryListener):
    """Counts the rows that queries discard as too late, over all their batches.

    Add it to ``spark.streams`` before a query starts; ``wait`` returns when the
    ends of so many queries have been reported, each after all of its batches.
    """

    def __init__(self) -> None:
        self.rows = 0
        self._ended = threading.Semaphore(0)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.rows += sum(o.numRowsDroppedByWatermark for o in event.progress.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._ended.release()

    def wait(self, queries: int = 1, seconds: float = 60) -> int:
        for _ in range(queries):
            if not self._ended.acquire(timeout=seconds):
                raise TimeoutError("a query's end was not reported")
        return self.rows
