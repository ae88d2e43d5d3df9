"""Load predictions with running state.

Batch form of the micro-batch job: a reading arriving in pane ``p0`` is in
the sliding windows ending at panes ``p0 .. p0 + K - 1``.  Readings are first
reduced per (key, pane) and only those partials are replicated K times, so
replication never touches raw rows.  The running state (total, counter) is
a cumulative window over panes per key: one row per pane, bounded by the
time span, not by the row volume.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadlens.functions.stats import copysign
from loadlens.functions.timeslice import DEFAULT_TF, ORIGIN_TS, idiv, time_slice
from loadlens.operators.asof import asof_attach
from loadlens.operators.measures import as_double, prepared
from loadlens.operators.medians import median_history
from loadlens.operators.salt import salted_lookup

# Micro-batch length (s) and window length in batches of the reference job.
DEFAULT_PANE_SECONDS = 10
DEFAULT_PANES_PER_WINDOW = 3


HEAD_UNIT = 2 * 10 ** 19  # over twice the largest id


def head_key(ts: str = "timestamp", rid: str = "id"):
    """(timestamp, id) packed in one decimal that orders like the pair (id any long)."""
    wide = F.col(ts).cast("decimal(11,0)") * F.lit(str(HEAD_UNIT)).cast("decimal(20,0)")
    return (wide + F.col(rid).cast("decimal(19,0)") + F.lit(str(HEAD_UNIT // 2)).cast("decimal(20,0)")).cast("decimal(33,0)")


def head_timestamp(key: str):
    return F.floor(F.col(key) / F.lit(str(HEAD_UNIT)).cast("decimal(20,0)")).cast("int")


def window_partials(valid: DataFrame, keys: Sequence[str], tf: int = DEFAULT_TF,
                    pane_seconds: int = DEFAULT_PANE_SECONDS,
                    panes_per_window: int = DEFAULT_PANES_PER_WINDOW,
                    origin: int = ORIGIN_TS) -> DataFrame:
    """Per (key, window-end pane): ``wsum, wcnt``, the first reading's ``head_key``
    and its value ``head_v``.

    The head is the earliest reading, ties broken by id; (timestamp, id) is
    packed into one decimal so ``min`` / ``min_by`` stay hash aggregates (a
    struct minimum would force a sort of the raw rows in every map task).
    Ids are unique per reading; for equal (timestamp, id) the value picked is
    unspecified.
    """
    p = prepared(valid, keys, tf, pane_seconds, origin).withColumn("_hk", head_key())
    # partials (one row per key and pane) are partitioned by key alone: the
    # replicated copies are summed in place and the running state window that
    # follows (partitioned by key) needs no further exchange
    part = p.groupBy(*keys, "p0").agg(
        F.sum("v").alias("_ps"), F.count(F.lit(1)).alias("_pc"),
        F.min("_hk").alias("_hk"), F.min_by("v", "_hk").alias("_hv")).repartition(*keys)
    k = panes_per_window - 1
    exp = part.select(*keys, F.explode(F.sequence("p0", F.col("p0") + k)).alias("pane"),
                      "_ps", "_pc", "_hk", "_hv")
    return exp.groupBy(*keys, "pane").agg(
        F.sum("_ps").alias("wsum"), F.sum("_pc").alias("wcnt"),
        F.min("_hk").alias("head_key"), F.min_by("_hv", "_hk").alias("head_v"))


def sliding_panes(valid: DataFrame, keys: Sequence[str], pane_seconds: int = DEFAULT_PANE_SECONDS,
                  panes_per_window: int = DEFAULT_PANES_PER_WINDOW) -> DataFrame:
    """Content of every sliding window: ``keys, pane, window_start, window_end, n, sum_load``."""
    w = window_partials(valid, keys, DEFAULT_TF, pane_seconds, panes_per_window)
    start = (F.col("pane") - (panes_per_window - 1)) * pane_seconds
    return w.select(*keys, "pane", start.alias("window_start"),
                    ((F.col("pane") + 1) * pane_seconds).alias("window_end"),
                    F.col("wcnt").alias("n"), F.col("wsum").alias("sum_load"))


def state_prediction(valid: DataFrame, keys: Sequence[str], tf: int = DEFAULT_TF,
                     pane_seconds: int = DEFAULT_PANE_SECONDS,
                     panes_per_window: int = DEFAULT_PANES_PER_WINDOW,
                     median_source: str = "as_run", rule: str = "reference",
                     origin: int = ORIGIN_TS) -> DataFrame:
    """One prediction per (key, pane) in which the key has readings in its window.

    ``predicted_load = (total / counter + median) / 2`` where total and counter
    run over all windows so far (a reading counts once per window it is in),
    and median is the head reading's own value (``as_run``) or its slice median
    as of the pane (``intended``).  Stored under ``target_slice = slice(head) + 1``.
    Returns ``keys, pane, head_timestamp, n, predicted_load, target_slice``.
    """
    win = window_partials(valid, keys, tf, pane_seconds, panes_per_window, origin)
    w = Window.partitionBy(*keys).orderBy("pane").rowsBetween(Window.unboundedPreceding, 0)
    ht = head_timestamp("head_key")
    st = win.select(*keys, "pane", F.sum("wsum").over(w).alias("_total"),
                    F.sum("wcnt").over(w).alias("n"), ht.alias("head_timestamp"),
                    F.col("head_v").alias("_hv"), time_slice(ht, tf, origin).alias("s"))
    if median_source == "as_run":
        st = st.withColumn("_median", F.col("_hv"))
    elif median_source == "intended":
        # one row per (key, pane) per side: the lookup runs per (key, slice), no join back
        hist = median_history(valid, keys, tf, pane_seconds, rule, origin)
        st = asof_attach(st, hist, [*keys, "s"], "pane", "fp", ["median"]).withColumn(
            "_median", F.coalesce(F.col("median"), F.col("_hv")))
    else:
        raise ValueError(f"median source must be 'intended' or 'as_run', not {median_source!r}")
    pred = (F.col("_total") / F.col("n") + F.col("_median")) / 2
    return st.select(*keys, "pane", "head_timestamp", "n", pred.alias("predicted_load"),
                     (F.col("s") + 1).alias("target_slice"))


def prediction_set(pred: DataFrame, keys: Sequence[str], tf: int = DEFAULT_TF) -> DataFrame:
    """Set table ``(tf, target_slice, keys, predicted_load)``."""
    return pred.select(F.lit(tf).alias("tf"), "target_slice", *keys, "predicted_load").distinct()


def rolling_prediction(loads: DataFrame, narrow: bool = True, target_rows: int = 2_000_000,
                       median_factor: float = 0.01) -> DataFrame:
    """Record-at-a-time running prediction per house (T3), one output row per reading.

    In order (timestamp, id): ``avg`` = running sum / count (narrowed to float
    when ``narrow``), ``median = copySign(avg * 0.01, sum before this row)``,
    ``predicted_load = (avg + median) / 2``.  The reference's state keeps its
    initial median (0) forever, which this reproduces.

    The running sum is a two-level prefix sum so a house holding a third of all
    rows is not ordered in one task.  Each (house, hour) is cut into chunks of
    equal length sized so a chunk holds about ``target_rows`` readings (down to
    one second); per-chunk totals get their offsets from a window over the
    house's chunks (one row per chunk), and the row-level window runs per
    (house, chunk).  Only the readings of a single house-second are never split.
    """
    base = loads.select("house_id", "household_id", "id", "timestamp", as_double().alias("v"),
                        idiv(F.col("timestamp"), 3600).alias("_hour"))
    per_hour = base.groupBy("house_id", "_hour").agg(F.count(F.lit(1)).alias("_rows"))
    pieces = F.ceil(F.col("_rows") / F.lit(target_rows))
    spec = per_hour.select("house_id", "_hour", F.greatest(F.lit(1), idiv(F.lit(3600), pieces)).alias("_len"))
    in_hour = F.col("timestamp").cast("long") - F.col("_hour") * 3600
    r = salted_lookup(base, spec, ["house_id", "_hour"], ["timestamp", "id"], per_hour).select(
        "house_id", "household_id", "id", "timestamp", "v",
        (F.col("_hour") * 3600 + idiv(in_hour, F.col("_len")) * F.col("_len")).alias("_chunk"))
    part = r.groupBy("house_id", "_chunk").agg(F.sum("v").alias("_cs"), F.count(F.lit(1)).alias("_cc"))
    w_off = Window.partitionBy("house_id").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    off = part.select("house_id", "_chunk", F.coalesce(F.sum("_cs").over(w_off), F.lit(0.0)).alias("_os"),
                      F.coalesce(F.sum("_cc").over(w_off), F.lit(0)).alias("_oc"))
    order = Window.partitionBy("house_id", "_chunk").orderBy("timestamp", "id", "v")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    j = r.join(off, ["house_id", "_chunk"])
    total = F.col("_os") + F.sum("v").over(upto)
    prior = F.col("_os") + F.coalesce(F.sum("v").over(before), F.lit(0.0))
    count = F.col("_oc") + F.count(F.lit(1)).over(upto)
    s = j.select("house_id", "household_id", "id", "timestamp", total.alias("_sum"),
                 prior.alias("_prior"), count.alias("_n"))
    avg = F.col("_sum") / F.col("_n")
    if narrow:
        avg = avg.cast("float").cast("double")
    median = copysign(avg * F.lit(median_factor), F.col("_prior"))
    return s.select("house_id", "household_id", "id", "timestamp",
                    ((avg + median) / 2).alias("predicted_load"))
