"""Set tables fed by a stream (K1-K4 in stream form).

Every micro-batch inserts its distinct ``ARRIVAL`` rows: which value reached which plug and
slice in which pane.  Inserting is idempotent and order-free, so there is no watermark, no
state in the engine and no reading is too late; a replayed batch changes nothing.  The house and
plug measure sets and averages sets are read from that one table.  ``compact`` merges the
folders of old batches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.functions.timeslice import DEFAULT_TF
from loadlens.operators.averages import history_of
from loadlens.operators.keys import PLUG
from loadlens.operators.measures import prepared, valid_load
from loadlens.operators.predict import DEFAULT_PANE_SECONDS
from loadlens.streaming.sinks import read_set_table, run_bounded, set_table_sink

ARRIVAL = [*PLUG, "s", "v", "p0"]


def arrivals(measurements: DataFrame, tf: int = DEFAULT_TF, pane_seconds: int = DEFAULT_PANE_SECONDS) -> DataFrame:
    """``ARRIVAL`` rows of the valid readings of a stream or table."""
    return prepared(valid_load(measurements), PLUG, tf, pane_seconds).select(*ARRIVAL)


def insert_available(rows: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Insert everything a stream of ``ARRIVAL`` rows has now; returns the set table."""
    spark = rows.sparkSession
    # a table without any batch yet is empty, not missing
    spark.createDataFrame([], rows.schema).write.mode("overwrite").parquet(f"{path}/batch_id=-1")
    run_bounded(rows, set_table_sink(path, ARRIVAL), "append", checkpoint)
    return read_set_table(spark, path, ARRIVAL)


def measure_set_of(rows: DataFrame, keys: Sequence[str], tf: int = DEFAULT_TF) -> DataFrame:
    """``operators.averages.measure_set`` from ``ARRIVAL`` rows."""
    d = rows.select(*keys, "s", "v").distinct()
    return d.select(F.lit(tf).alias("tf"), F.col("s").alias("slice"), *keys, F.col("v").alias("value"))


def averages_set_of(rows: DataFrame, keys: Sequence[str], tf: int = DEFAULT_TF) -> DataFrame:
    """``operators.averages.averages_set`` from ``ARRIVAL`` rows."""
    return history_of(rows, keys).select(F.lit(tf).alias("tf"), F.col("s").alias("slice"), *keys, "avg_load").distinct()


def compact(spark: SparkSession, path: str, upto: int, unique_on: Sequence[str] = tuple(ARRIVAL)) -> None:
    """Merge the batches ``0 .. upto`` (all committed) and what was merged before into one folder.

    The merged folder ``batch_id=-(upto + 2)`` is written first, the merged ones go after; rows
    present twice in between, also after a crash, are one row of a set.
    """
    old = spark.read.parquet(path).where(F.col("batch_id") <= upto)
    old.select(*unique_on).distinct().write.mode("overwrite").parquet(f"{path}/batch_id={-(upto + 2)}")
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for f in fs.listStatus(root):
        name = f.getPath().getName()
        if name.startswith("batch_id=") and -(upto + 2) < int(name.split("=")[1]) <= upto:
            fs.delete(f.getPath(), True)
