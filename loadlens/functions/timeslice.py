"""Time arithmetic on epoch-second integers: panes and slice-of-day.

Everything here returns a native Catalyst expression, so it stays inside
whole-stage codegen and can be used in filters that reach the scan.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, TimestampNTZType, TimestampType

# Fixed values that must equal the reference's for right results:
# the origin of slice numbering (epoch seconds), the length of a day in
# seconds, and the default slice size (1 second).
ORIGIN_TS = 1377986401
FULL_DAY = 86400
DEFAULT_TF = 1


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(x)


def idiv(a, b) -> Column:
    """Integer division truncating toward zero (SQL ``a div b``), bigint result."""
    return F.call_function("div", _c(a), _c(b))


def time_slice(ts, tf: int = DEFAULT_TF, origin: int = ORIGIN_TS) -> Column:
    """Slice-of-day index of an epoch-second column.

    ``r = ts - origin``; ``days = r div 86400``; for ``days > 0`` the slice is
    ``r div tf - days * (86400 div tf)``, else ``r div tf``.  Same slice on
    different days folds into one key; rows before ``origin`` give negative,
    unfolded slices; when ``86400 % tf != 0`` slices drift by day (kept as is).
    """
    if tf <= 0:
        raise ValueError("tf must be a positive number of seconds")
    r = _c(ts).cast("long") - F.lit(origin)
    days = idiv(r, FULL_DAY)
    per_day = FULL_DAY // tf  # constant-folded on the driver
    folded = idiv(r, tf) - days * F.lit(per_day)
    return F.when(days > 0, folded).otherwise(idiv(r, tf)).cast("int")


def pane(ts, pane_seconds: int) -> Column:
    """Index of the micro-batch (pane) an epoch second falls in."""
    return idiv(_c(ts).cast("long"), pane_seconds)


def epoch_seconds(col, dtype: DataType) -> Column:
    """Whole epoch seconds of a timestamp column, independent of the session zone.

    A TIMESTAMP_NTZ is read as wall-clock UTC; a TIMESTAMP is an instant.
    """
    c = _c(col)
    if isinstance(dtype, TimestampNTZType):
        return F.timestamp_diff(
            "SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c
        )
    if isinstance(dtype, TimestampType):
        return F.unix_seconds(c)
    return c.cast("long")


def event_time(col, dtype: DataType) -> Column:
    """An instant (TIMESTAMP) for watermarks and windows, independent of the session zone.

    Watermarks need TIMESTAMP; a TIMESTAMP_NTZ wall clock is read as UTC, so
    window boundaries fall on the same epoch multiples as the pane arithmetic.
    """
    c = _c(col)
    if isinstance(dtype, TimestampNTZType):
        micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c)
        return F.timestamp_micros(micros)
    return c


def time_slice_sql_function(spark, name: str = "time_slice", origin: int = ORIGIN_TS) -> None:
    """Register ``name(ts INT, tf INT) RETURNS INT`` as a session SQL function."""
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION {name}(ts INT, tf INT) RETURNS INT
        RETURN CAST(CASE WHEN (ts - {origin}) div {FULL_DAY} > 0
                    THEN (ts - {origin}) div tf - ((ts - {origin}) div {FULL_DAY}) * ({FULL_DAY} div tf)
                    ELSE (ts - {origin}) div tf END AS INT)"""
    )
