"""As-of lookup: for each probe, the latest history row at or before it.

Spark has no batch as-of join; this is the union + running ``last`` pattern.
Both sides are stacked, ordered by time (history before probe at equal
times), and ``last(value, ignorenulls)`` carries the latest history value
forward.  No candidate pairs are generated: one sort per ``by`` group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def asof_lookup(probes: DataFrame, history: DataFrame, by: Sequence[str], probe_time: str,
                history_time: str, values: Sequence[str]) -> DataFrame:
    """Returns ``by, probe_time, values`` for every distinct probe."""
    by = list(by)
    hist_types = dict(history.dtypes)
    p = probes.select(*by, F.col(probe_time).cast("long").alias("_t")).distinct().select(
        *by, "_t", F.lit(1).alias("_kind"), *[F.lit(None).cast(hist_types[v]).alias(v) for v in values])
    h = history.select(*by, F.col(history_time).cast("long").alias("_t"), F.lit(0).alias("_kind"), *values)
    w = Window.partitionBy(*by).orderBy("_t", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    carried = p.unionByName(h).select(
        *by, "_t", "_kind", *[F.last(v, ignorenulls=True).over(w).alias(v) for v in values])
    return carried.filter(F.col("_kind") == 1).select(*by, F.col("_t").alias(probe_time), *values)


def asof_attach(probes: DataFrame, history: DataFrame, by: Sequence[str], probe_time: str,
                history_time: str, values: Sequence[str]) -> DataFrame:
    """Like ``asof_lookup`` but keeps every probe column (no join back).

    Use when probes are already bounded per ``by`` group (e.g. one row per
    key and pane); raw rows should go through ``asof_lookup`` on their
    distinct grid instead, then an equi-join.
    """
    by = list(by)
    hist_types = dict(history.dtypes)
    payload = [c for c in probes.columns if c not in by]
    p = probes.select("*", F.col(probe_time).cast("long").alias("_t"), F.lit(1).alias("_kind"),
                      *[F.lit(None).cast(hist_types[v]).alias(v) for v in values])
    h = history.select(*by, F.col(history_time).cast("long").alias("_t"), F.lit(0).alias("_kind"), *values)
    w = Window.partitionBy(*by).orderBy("_t", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    both = p.unionByName(h, allowMissingColumns=True)
    carried = both.select(*by, *payload, "_kind", *[F.last(v, ignorenulls=True).over(w).alias(v) for v in values])
    return carried.filter(F.col("_kind") == 1).drop("_kind")
