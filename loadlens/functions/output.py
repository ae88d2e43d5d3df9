"""Output normalisation: floats widen to double and doubles are rounded once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

OUT_DECIMALS = 6


def finish(df: DataFrame, decimals: int = OUT_DECIMALS) -> DataFrame:
    """Floats widen to double; every double is rounded once (half-up)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, FloatType):
            c = c.cast("double")
        elif isinstance(f.dataType, DoubleType):
            c = F.round(c, decimals)
        cols.append(c.alias(f.name))
    return df.select(*cols)
