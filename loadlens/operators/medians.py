"""Order statistics of the averages history and their as-of attachment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadlens.functions.stats import exact_median, shifted_median, shifted_median_ranks
from loadlens.functions.timeslice import DEFAULT_TF, ORIGIN_TS
from loadlens.operators.averages import SET_DECIMALS, averages_history, distinct_values
from loadlens.operators.measures import prepared
from loadlens.operators.orderstat import replayed_medians
from loadlens.operators.ranks import ranked
from loadlens.operators.salt import salted_lookup


def _rule(arr, rule: str):
    if rule == "reference":
        return shifted_median(arr)
    if rule == "exact":
        return exact_median(arr)
    raise ValueError(f"median rule must be 'reference' or 'exact', not {rule!r}")


def median_history(valid: DataFrame, keys: Sequence[str], tf: int = DEFAULT_TF,
                   pane_seconds: int = 10, rule: str = "reference", origin: int = ORIGIN_TS,
                   decimals: int = SET_DECIMALS) -> DataFrame:
    """The median of each (key, slice) averages set, as of every pane in which it grew.

    Returns ``keys, s, fp, n, median``, one row per new average.  Each history is replayed
    in pane order (``orderstat``); it is bounded by the panes that touch the slice, not by
    the row volume.
    """
    if rule not in ("reference", "exact"):
        raise ValueError(f"median rule must be 'reference' or 'exact', not {rule!r}")
    return replayed_medians(averages_history(valid, keys, tf, pane_seconds, origin, decimals), keys, rule)


def final_median(valid: DataFrame, keys: Sequence[str], tf: int = DEFAULT_TF,
                 pane_seconds: int = 10, rule: str = "reference", over: str = "averages",
                 origin: int = ORIGIN_TS, decimals: int = SET_DECIMALS) -> DataFrame:
    """Median per (key, slice) at the end of the data: ``keys, slice, n, median``.

    ``over='averages'`` reads the averages set (bounded per slice);
    ``over='measures'`` reads the raw distinct readings, whose sets grow with
    the data, so the pick goes through distributed ranks, never an array.
    """
    if over == "averages":
        h = averages_history(valid, keys, tf, pane_seconds, origin, decimals)
        s = h.groupBy(*keys, "s").agg(F.array_sort(F.collect_set("avg_load")).alias("_arr"))
        return s.select(*keys, F.col("s").alias("slice"), F.size("_arr").cast("long").alias("n"),
                        _rule(F.col("_arr"), rule).alias("median"))
    if over != "measures":
        raise ValueError(f"over must be 'averages' or 'measures', not {over!r}")
    d = distinct_values(valid, keys, tf, origin)
    r = ranked(d, [*keys, "s"], "v")
    sizes = r.groupBy(*keys, "s").agg((F.max("rank") + 1).alias("n"))
    n = F.col("n")
    if rule == "reference":
        lo, hi = shifted_median_ranks(n)
    else:
        lo = F.call_function("div", n - 1, F.lit(2))
        hi = F.call_function("div", n, F.lit(2))
    # one or two positions per set are looked up in the sets' rows
    wanted = sizes.select(*keys, "s", "n", F.explode(F.array_distinct(F.array(lo, hi))).alias("rank"))
    picked = wanted.join(r, [*keys, "s", "rank"], "left").groupBy(*keys, "s").agg(
        F.first("n").alias("n"), F.count("v").alias("_found"), F.count(F.lit(1)).alias("_wanted"), F.avg("v").alias("_avg"))
    both = F.when(F.col("_found") == F.col("_wanted"), F.col("_avg"))
    med = both if rule == "exact" else F.coalesce(both, F.lit(0.0))
    return picked.select(*keys, F.col("s").alias("slice"), "n", med.cast("double").alias("median"))


def sorted_measures(valid: DataFrame, keys: Sequence[str], tf: int = DEFAULT_TF,
                    origin: int = ORIGIN_TS) -> DataFrame:
    """Each set member with its ascending position: ``keys, slice, rank, value``."""
    d = distinct_values(valid, keys, tf, origin)
    r = ranked(d, [*keys, "s"], "v")
    return r.select(*keys, F.col("s").alias("slice"), "rank", F.col("v").alias("value"))


def with_median(valid: DataFrame, keys: Sequence[str], tf: int = DEFAULT_TF,
                pane_seconds: int = 10, panes_per_window: int = 3, source: str = "intended",
                rule: str = "reference", origin: int = ORIGIN_TS) -> DataFrame:
    """Every reading in every pane of its sliding window, with a median attached.

    ``source='as_run'``: the reading's own value (what the reference's code
    produces, its median map is never filled); ``'intended'``: the slice median
    as of that pane, else the reading's value.
    Returns ``keys, id, timestamp, slice, pane, value, median``.
    """
    p = prepared(valid, keys, tf, pane_seconds, origin)
    panes = F.sequence("p0", F.col("p0") + (panes_per_window - 1))
    if source == "as_run":
        out = p.select(*keys, "id", "timestamp", "s", "v", F.explode(panes).alias("pane"),
                       F.col("v").alias("median"))
    elif source == "intended":
        # a set grows only in panes in which the slice has readings, so one row per (key, slice, arrival pane) has all
        # medians: those of its K panes, a K-element array, are its own and those of the rows up to K - 1 panes on.
        # Raw readings join it once and are expanded after the join
        hist = median_history(valid, keys, tf, pane_seconds, rule, origin)
        sizes = p.groupBy(*keys, "s", "p0").agg(F.count(F.lit(1)).alias("_rows"))
        both = sizes.select(*keys, "s", "p0", F.lit(True).alias("_here"), F.lit(None).cast("double").alias("median")).unionByName(
            hist.select(*keys, "s", F.col("fp").alias("p0"), F.lit(False).alias("_here"), "median"))
        along = Window.partitionBy(*keys, "s").orderBy("p0")
        # the history's row and the arrivals' row of a pane are peers
        asof = F.last("median", ignorenulls=True).over(along.rangeBetween(Window.unboundedPreceding, 0))
        ahead = F.collect_list(F.when(F.col("_here"), F.struct("p0", "_m"))).over(along.rangeBetween(0, panes_per_window - 1))
        held = both.withColumn("_m", asof).withColumn("_ahead", ahead).where("_here").select(*keys, "s", "p0", "_ahead")
        upto = F.transform(panes, lambda t: F.struct(
            t.alias("pane"), F.element_at(F.filter("_ahead", lambda x: x["p0"] <= t), -1)["_m"].alias("median")))
        out = salted_lookup(p, held, [*keys, "s", "p0"], ["timestamp", "id"], sizes).select(
            *keys, "id", "timestamp", "s", "v", F.inline(upto)).withColumn("median", F.coalesce(F.col("median"), F.col("v")))
    else:
        raise ValueError(f"median source must be 'intended' or 'as_run', not {source!r}")
    return out.select(*keys, "id", "timestamp", F.col("s").alias("slice"), "pane",
                      F.col("v").alias("value"), "median")
