"""Slice averages, set tables and the averages history.

The reference keeps per-key sorted sets in an external store, where score and
member are the same number, so repeated values are stored once.  Here each
set is a table unique on (key columns, value); "insert" is ``distinct``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadlens.functions.parsing import hhp_id
from loadlens.functions.timeslice import DEFAULT_TF, ORIGIN_TS
from loadlens.operators.measures import as_double, prepared

# Decimals an average is rounded to before it enters a set, so set membership
# does not depend on the summation order of an engine.
SET_DECIMALS = 6


def slice_avg(valid: DataFrame, keys: Sequence[str], tf: int = DEFAULT_TF,
              origin: int = ORIGIN_TS) -> DataFrame:
    """Plain average per (key, slice): every reading counts, duplicates too."""
    p = prepared(valid, keys, tf, origin=origin)
    return p.groupBy(*keys, F.col("s").alias("slice")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("v").alias("avg_load"))


def distinct_values(valid: DataFrame, keys: Sequence[str], tf: int = DEFAULT_TF,
                    origin: int = ORIGIN_TS) -> DataFrame:
    """The measure set: distinct (key, slice, value)."""
    p = prepared(valid, keys, tf, origin=origin)
    return p.select(*keys, "s", "v").distinct()


def measure_set(valid: DataFrame, keys: Sequence[str], tf: int = DEFAULT_TF,
                origin: int = ORIGIN_TS) -> DataFrame:
    """Set table ``(tf, slice, keys, value)`` of the distinct readings."""
    d = distinct_values(valid, keys, tf, origin)
    return d.select(F.lit(tf).alias("tf"), F.col("s").alias("slice"), *keys, F.col("v").alias("value"))


def measure_card(valid: DataFrame, keys: Sequence[str], tf: int = DEFAULT_TF,
                 origin: int = ORIGIN_TS) -> DataFrame:
    """Set size per (key, slice)."""
    d = distinct_values(valid, keys, tf, origin)
    return d.groupBy(*keys, F.col("s").alias("slice")).agg(F.count(F.lit(1)).alias("card"))


def distinct_slice_avg(valid: DataFrame, keys: Sequence[str], tf: int = DEFAULT_TF,
                       origin: int = ORIGIN_TS) -> DataFrame:
    """Average over the distinct readings of each (key, slice) at the end of the data."""
    d = distinct_values(valid, keys, tf, origin)
    return d.groupBy(*keys, F.col("s").alias("slice")).agg(
        F.count(F.lit(1)).alias("n_distinct"), F.avg("v").alias("avg_load"))


def averages_history(valid: DataFrame, keys: Sequence[str], tf: int = DEFAULT_TF,
                     pane_seconds: int = 10, origin: int = ORIGIN_TS,
                     decimals: int = SET_DECIMALS) -> DataFrame:
    """Snapshot of each set's distinct-value average at every pane it changed.

    A value enters its set in the first pane it arrives (``fp``); the snapshot
    at pane ``fp`` is the running sum / count of the set's values so far.
    Returns ``keys, s, fp, avg_load`` (one row per change).  The running window
    holds one row per change pane of a (key, slice), i.e. at most the panes
    that touch that slice: days of data x ceil(tf / pane_seconds), whatever
    the row volume.
    """
    p = prepared(valid, keys, tf, pane_seconds, origin)
    return history_of(p, keys, decimals)


def history_of(arrivals: DataFrame, keys: Sequence[str], decimals: int = SET_DECIMALS) -> DataFrame:
    """``averages_history`` from rows ``keys, s, v, p0``; repeated rows change nothing."""
    first = arrivals.groupBy(*keys, "s", "v").agg(F.min("p0").alias("fp"))
    per_pane = first.groupBy(*keys, "s", "fp").agg(F.sum("v").alias("_ds"), F.count(F.lit(1)).alias("_dc"))
    w = Window.partitionBy(*keys, "s").orderBy("fp").rowsBetween(Window.unboundedPreceding, 0)
    avg = F.sum("_ds").over(w) / F.sum("_dc").over(w)
    return per_pane.select(*keys, "s", "fp", F.round(avg, decimals).alias("avg_load"))


def averages_set(valid: DataFrame, keys: Sequence[str], tf: int = DEFAULT_TF,
                 pane_seconds: int = 10, origin: int = ORIGIN_TS,
                 decimals: int = SET_DECIMALS) -> DataFrame:
    """Set table ``(tf, slice, keys, avg_load)`` of all averages ever stored."""
    h = averages_history(valid, keys, tf, pane_seconds, origin, decimals)
    return h.select(F.lit(tf).alias("tf"), F.col("s").alias("slice"), *keys, "avg_load").distinct()


def overall_avg(valid: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Average and counter per key over all its readings (no slices)."""
    out = valid.groupBy(*keys).agg(F.avg(as_double()).alias("avg_load"), F.count(F.lit(1)).alias("n"))
    if len(keys) == 3:
        out = out.withColumn("hhp_id", hhp_id())
    return out


# Fixed value: the rolling median is 1% of the average.
MEDIAN_FACTOR = 0.01


def prediction_from_avg(avgs: DataFrame, median_factor: float = MEDIAN_FACTOR) -> DataFrame:
    """Adds ``median = 0.01 * avg_load`` and ``prediction = (avg_load + median) / 2``."""
    med = F.col("avg_load") * F.lit(median_factor)
    return avgs.withColumn("median", med).withColumn("prediction", (F.col("avg_load") + F.col("median")) / 2)


def overall_prediction(valid: DataFrame, keys: Sequence[str], median_factor: float = MEDIAN_FACTOR) -> DataFrame:
    """``(avg, n, median, prediction)`` per key over all its readings."""
    return prediction_from_avg(overall_avg(valid, keys), median_factor)
