"""SQL access: register the measurement views and the slice function on a session.

After ``register(spark, sf_dir)`` a SQL user can write, for example::

    SELECT house_id, time_slice(timestamp, 3600) AS slice, count(*) AS n, avg(value) AS avg_load
    FROM valid_measurements GROUP BY 1, 2

The views are plain temporary views over the same DataFrames the library
builds, so Catalyst prunes columns and pushes filters exactly as it does there.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from loadlens.functions.timeslice import time_slice_sql_function
from loadlens.operators.measures import load_only, valid_load
from loadlens.sources.tables import load_candidate_measurements, load_measurements


def register(spark: SparkSession, sf_dir: str, prefix: str = "") -> list[str]:
    """Create ``measurements``, ``load_measurements`` and ``valid_measurements`` views
    and the ``time_slice(ts, tf)`` function; returns the view names."""
    m = load_measurements(spark, sf_dir)
    views = {
        f"{prefix}measurements": m,
        f"{prefix}load_measurements": load_only(m),
        f"{prefix}valid_measurements": valid_load(load_candidate_measurements(spark, sf_dir)),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    time_slice_sql_function(spark, f"{prefix}time_slice")
    return list(views)
