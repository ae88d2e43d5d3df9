"""Batch writers for set tables and for publishing encoded lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_set_table(df: DataFrame, path: str, unique_on: Sequence[str], partition_by: Sequence[str] = ("tf",)) -> None:
    """Store a set table (distinct on ``unique_on``) partitioned by slice size.

    Partitioned by ``tf`` so readers of one slice size prune the rest; never by
    slice (86,400 values at tf = 1).
    """
    cols = [c for c in partition_by if c in df.columns]
    # only the slice sizes written now are replaced, others stay
    w = df.select(*unique_on).distinct().write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    (w.partitionBy(*cols) if cols else w).parquet(path)


def kafka_write(lines: DataFrame, bootstrap: str, topic: str, value_col: str = "value") -> None:
    """Publish one message per row with a null key (needs the spark-sql-kafka package)."""
    (lines.select(F.lit(None).cast("string").alias("key"), F.col(value_col).cast("string").alias("value"))
     .write.format("kafka").option("kafka.bootstrap.servers", bootstrap).option("topic", topic).save())


def store_table(df: DataFrame, path: str) -> DataFrame:
    """Write a table to the shared folder and continue from the stored copy.

    Later stages read files instead of recomputing the plan, so a lost
    executor costs a re-read, not a replay of the whole upstream chain.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
