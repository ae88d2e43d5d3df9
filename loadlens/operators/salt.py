"""Lookup joins whose left side may have a large share of its rows under one key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_PER_TASK = 1_000_000


def salted_lookup(rows: DataFrame, table: DataFrame, on: Sequence[str], spread: Sequence[str], sizes: DataFrame,
                  rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``rows`` joined with ``table`` (one row per ``on``), a key with many rows spread over several tasks.

    ``sizes`` has the number of ``rows`` of each key, as ``on, _rows``.  Rows of a key with over ``rows_per_task`` go by (key,
    hash of their ``spread`` columns) and only such a key's table row is repeated.  What is broadcast
    has at most one row per ``rows_per_task`` rows.
    """
    on = list(on)
    hot = F.broadcast(sizes.where(F.col("_rows") > rows_per_task).select(
        *on, F.ceil(F.col("_rows") / F.lit(rows_per_task)).cast("int").alias("_salts")))
    salts = F.coalesce("_salts", F.lit(1))
    left = rows.join(hot, on, "left").withColumn("_salt", F.pmod(F.xxhash64(*spread), salts).cast("int")).drop("_salts")
    right = table.join(hot, on, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_salts")
    return left.join(right, [*on, "_salt"]).drop("_salt")
