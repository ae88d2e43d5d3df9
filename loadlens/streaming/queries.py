"""Streaming forms of the window and aggregate operators.

``output_mode='complete'`` is for bounded runs (every window is final when
the input ends, which the tests and oracles need); production streams use
``'append'`` with a watermark so state is dropped once windows close.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.functions.timeslice import DEFAULT_TF, ORIGIN_TS, epoch_seconds, event_time
from loadlens.operators.measures import as_double, prepared, valid_load
from loadlens.functions.text import words


def sliding_event_counts(events: DataFrame, window_seconds: int, slide_seconds: int,
                         watermark: str | None = None) -> DataFrame:
    """Count per event type in sliding event-time windows (``ts`` may be NTZ)."""
    ev = events.withColumn("_et", event_time("ts", events.schema["ts"].dataType))
    if watermark:
        ev = ev.withWatermark("_et", watermark)
    return ev.groupBy(F.window("_et", f"{window_seconds} seconds", f"{slide_seconds} seconds").alias("w"),
                      "event_type").agg(F.count(F.lit(1)).alias("n"))


def finish_sliding_event_counts(result: DataFrame, slide_seconds: int) -> DataFrame:
    """Window structs -> ``event_type, pane, window_start, window_end, n`` (epoch seconds)."""
    t = result.schema["w"].dataType["start"].dataType
    start = epoch_seconds(F.col("w.start"), t)
    end = epoch_seconds(F.col("w.end"), t)
    return result.select("event_type", (F.call_function("div", end, F.lit(slide_seconds)) - 1).alias("pane"),
                         start.alias("window_start"), end.alias("window_end"), "n")


def slice_avg_stream(measurements: DataFrame, keys: Sequence[str], tf: int = DEFAULT_TF,
                     origin: int = ORIGIN_TS) -> DataFrame:
    """Plain slice average per key on a measurement stream (complete mode)."""
    p = prepared(valid_load(measurements), keys, tf, origin=origin)
    return p.groupBy(*keys, F.col("s").alias("slice")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("v").alias("avg_load"))


def tumbling_sum_stream(measurements: DataFrame, keys: Sequence[str], size_seconds: int,
                        watermark: str | None = None) -> DataFrame:
    """Count and load sum per key per tumbling event-time window."""
    m = measurements.withColumn("_et", F.timestamp_seconds("timestamp"))
    if watermark:
        m = m.withWatermark("_et", watermark)
    g = m.groupBy(*keys, F.window("_et", f"{size_seconds} seconds").alias("w")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(as_double()).alias("sum_value"))
    return g


def finish_tumbling(result: DataFrame, keys: Sequence[str]) -> DataFrame:
    return result.select(*keys, F.unix_seconds(F.col("w.start")).alias("window_start"), "n", "sum_value")


def word_count_stream(texts: DataFrame, value_col: str = "value") -> DataFrame:
    """Running word count (lower, ``\\W+``, non-empty) on a text stream."""
    toks = texts.select(F.explode(words(F.col(value_col), keep_empty=False)).alias("word"))
    return toks.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
