"""Scoring on arrival and de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.operators.scoring import apply_score_rules


def stream_score(
    arrivals: DataFrame,
    dim: DataFrame,
    key: str,
    dim_key: str,
    score: Column,
    model_name: str,
    model_version: str,
) -> DataFrame:
    """Stateless: join the static patient row, predict, apply the rules.

    An arrival without a patient row is kept under its own key; what the score
    needs of the patient is null then.
    """
    joined = arrivals.join(dim, arrivals[key] == dim[dim_key], "left")
    scored = joined.withColumns(
        {
            "prediction": score,
            "customer_id": F.coalesce("patient_natural_key", F.col(key).cast("string")),
            "model_name": F.lit(model_name),
            "model_version": F.lit(model_version),
        }
    )
    return apply_score_rules(scored)


def stream_dedupe(
    scores: DataFrame,
    keys: Sequence[str] = ("customer_id", "event_id"),
    stamp: str = "prediction_timestamp",
    delay: str = "1 day",
) -> DataFrame:
    """First copy of each key; state is dropped once the watermark passes."""
    return scores.withWatermark(stamp, delay).dropDuplicatesWithinWatermark(list(keys))
