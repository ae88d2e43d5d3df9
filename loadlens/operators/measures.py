"""Filters and projections over measurement rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlens.functions.timeslice import DEFAULT_TF, ORIGIN_TS, pane, time_slice

# The id range the accuracy report enumerates (inclusive).
MAX_ID = 40


def valid_load(df: DataFrame) -> DataFrame:
    """Load readings with a positive value.  ``NaN > 0`` is true in SQL, so NaN is excluded."""
    return df.filter((F.col("property") == 1) & (F.col("value") > 0) & ~F.isnan("value"))


def load_only(df: DataFrame) -> DataFrame:
    """Load readings of any value (zero and negative kept)."""
    return df.filter(F.col("property") == 1)


def household_filter(df: DataFrame, household_id: int = 0) -> DataFrame:
    return df.filter(F.col("household_id") == household_id)


def domain_bounds(df: DataFrame, max_id: int | None = MAX_ID,
                  slices: tuple[int, int] | None = None, slice_col: str = "slice",
                  id_cols: Sequence[str] = ("house_id", "household_id", "plug_id")) -> DataFrame:
    """Range predicates for the key domain; ``None`` means unbounded."""
    cond: Column = F.lit(True)
    if max_id is not None:
        for c in id_cols:
            if c in df.columns:
                cond = cond & F.col(c).between(0, max_id)
    if slices is not None:
        cond = cond & F.col(slice_col).between(slices[0], slices[1])
    return df.filter(cond)


def as_double(col: str = "value") -> Column:
    """Float reading widened to double, exactly as the reference widens it."""
    return F.col(col).cast("double")


def plug_measurements(valid: DataFrame) -> DataFrame:
    """Per-plug reading with a median placeholder of 0.0."""
    return valid.select("house_id", "household_id", "plug_id", "timestamp",
                        as_double().alias("value"), F.lit(0.0).alias("median"), "hhp_id")


def house_measurements(valid: DataFrame) -> DataFrame:
    """Per-house reading; one row per plug reading (loads are never summed)."""
    return valid.select("house_id", "timestamp", as_double().alias("value"),
                        F.lit(0.0).alias("median"), "hhp_id")


def house_value_pairs(df: DataFrame) -> DataFrame:
    return df.select("house_id", as_double().alias("value"))


def plug_value_pairs(df: DataFrame) -> DataFrame:
    return df.select("hhp_id", as_double().alias("value"))


def with_slices(df: DataFrame, tfs: Sequence[int], origin: int = ORIGIN_TS) -> DataFrame:
    return df.select("*", *[time_slice("timestamp", tf, origin).alias(f"slice_{tf}") for tf in tfs])


def prepared(valid: DataFrame, keys: Sequence[str], tf: int = DEFAULT_TF,
             pane_seconds: int | None = None, origin: int = ORIGIN_TS) -> DataFrame:
    """Keys, order columns, double value ``v``, slice ``s`` and arrival pane ``p0``."""
    cols = [*keys, "id", "timestamp", as_double().alias("v"),
            time_slice("timestamp", tf, origin).alias("s")]
    if pane_seconds:
        cols.append(pane("timestamp", pane_seconds).alias("p0"))
    return valid.select(*cols)
