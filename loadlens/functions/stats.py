"""Order statistics and sign helpers as array / scalar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def shifted_median(sorted_arr: Column) -> Column:
    """The reference's order statistic over an ascending, duplicate-free array.

    0-based: for even ``n`` the mean of elements ``n/2`` and ``n/2+1``; for odd
    ``n`` element ``(n+1)/2``; a missing element gives 0.0.  So n = 0, 1, 2 give
    0.0, n = 3 gives the maximum, n = 5 the fourth smallest.
    """
    n = F.size(sorted_arr)
    half = F.call_function("div", n, F.lit(2)).cast("int")
    left = F.get(sorted_arr, half)
    right = F.get(sorted_arr, half + 1)
    odd = F.get(sorted_arr, F.call_function("div", n + 1, F.lit(2)).cast("int"))
    even_val = F.when(left.isNotNull() & right.isNotNull(), (left + right) / 2)
    return F.coalesce(F.when(n % 2 == 0, even_val).otherwise(odd), F.lit(0.0)).cast("double")


def shifted_median_ranks(n: Column) -> tuple[Column, Column]:
    """0-based ranks the shifted rule reads for a set of size ``n`` (lo, hi).

    For odd ``n`` both are ``(n+1)/2``.  A rank ``>= n`` means "missing".
    """
    half = F.call_function("div", n, F.lit(2))
    odd = F.call_function("div", n + 1, F.lit(2))
    lo = F.when(n % 2 == 0, half).otherwise(odd)
    hi = F.when(n % 2 == 0, half + 1).otherwise(odd)
    return lo, hi


def copysign(magnitude: Column, sign: Column) -> Column:
    """``Math.copySign``: |magnitude| with the sign of ``sign`` (+0.0 is positive)."""
    return F.when(sign < 0, -F.abs(magnitude)).otherwise(F.abs(magnitude))


def exact_median(sorted_arr: Column) -> Column:
    """Textbook median of an ascending array (null when empty)."""
    n = F.size(sorted_arr)
    mid = F.call_function("div", n, F.lit(2)).cast("int")
    return F.when(n == 0, F.lit(None).cast("double")).when(
        n % 2 == 1, F.get(sorted_arr, mid)
    ).otherwise((F.get(sorted_arr, mid - 1) + F.get(sorted_arr, mid)) / 2).cast("double")
