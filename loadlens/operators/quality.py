"""Prediction accuracy: stored prediction lookup and error vs measured average."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def prediction_min(pred_set: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The first member of an ascending prediction set is its minimum."""
    return pred_set.groupBy("target_slice", *keys).agg(F.min("predicted_load").alias("predicted_load"))


def prediction_error(pred_min: DataFrame, averages: DataFrame, keys: Sequence[str],
                     align: str = "reference") -> DataFrame:
    """Absolute error of each stored prediction against a measured slice average.

    ``align='reference'``: the forecast stored for slice s+1 is compared with
    the average *of* slice s (what the reference does); ``'target'``: with the
    average of the slice it forecasts.  Both sides must be present (inner).
    """
    shift = {"reference": 1, "target": 0}.get(align)
    if shift is None:
        raise ValueError(f"align must be 'reference' or 'target', not {align!r}")
    a = averages.select(*keys, "slice", "avg_load", (F.col("slice") + shift).alias("target_slice"))
    j = a.join(pred_min, [*keys, "target_slice"])
    return j.select(*keys, "slice", "predicted_load", "avg_load",
                    F.abs(F.col("predicted_load") - F.col("avg_load")).alias("error"))
