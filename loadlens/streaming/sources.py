"""Streaming sources: the driver's parquet tables as file streams, and line streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.session import scratch_path
from loadlens.sources.tables import measurements_from_events, table_path


def is_directory(spark: SparkSession, path: str) -> bool:
    """Whether a path of any file system Spark reads is a directory."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()


def stream_table(spark: SparkSession, sf_dir: str, name: str,
                 max_files_per_trigger: int | None = None, partitions: int | None = None) -> DataFrame:
    """One driver table as a file stream (schema taken from the batch reader).

    ``partitions`` round-robin rebalances each micro-batch, as a few receivers
    feeding many cores need; use it when a trigger brings few large files and
    the per-row work is heavy (text), not when a trigger already has many files.
    """
    path = table_path(sf_dir, name)
    r = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if is_directory(spark, path):
        df = r.parquet(path)
    else:  # a file stream watches directories: a table stored as one file is picked from its folder
        df = r.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)
    return df.repartition(partitions) if partitions else df


def stream_measurements(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    return measurements_from_events(stream_table(spark, sf_dir, "events", max_files_per_trigger))


#: A reading at this second, of a house and plug that do not exist, ends the input of a bounded stream.
END_SECOND = 2_147_000_000


def end_of_input(spark: SparkSession, measurements: DataFrame) -> tuple[DataFrame, Callable[[], None]]:
    """A stream to union with ``measurements`` and a function that ends the input.

    Called once all files are processed, it adds one reading so late that every window of
    real readings closes in the next run; its own windows stay open, so it never shows in an
    append-mode result.
    """
    folder = scratch_path(spark, "end-of-input")
    row = spark.createDataFrame([(-1, END_SECOND, 1.0, 1, -1, -1, -1, "-1:-1:-1")],
                                "id long, timestamp int, value float, property int, plug_id int, "
                                "household_id int, house_id int, hhp_id string")
    row = row.select(*measurements.columns)
    row.limit(0).write.parquet(folder)
    return (spark.readStream.schema(measurements.schema).parquet(folder),
            lambda: row.write.mode("append").parquet(folder))


def end_of_events(spark: SparkSession, events: DataFrame) -> tuple[DataFrame, Callable[[], None]]:
    """``end_of_input`` for a stream of ``(event_type, ts)``."""
    folder = scratch_path(spark, "end-of-events")
    at = F.timestamp_seconds(F.lit(END_SECOND)).cast(events.schema["ts"].dataType)
    row = spark.range(1).select(F.lit(None).cast("string").alias("event_type"), at.alias("ts"))
    row.limit(0).write.parquet(folder)
    return (spark.readStream.schema(events.schema).parquet(folder),
            lambda: row.write.mode("append").parquet(folder))


def arriving_in_files(spark: SparkSession, table: DataFrame, by: str, triggers: int = 4) -> DataFrame:
    """A table as a feed that arrives over several triggers, each with rows of all times.

    A stand-in for a feed: the rows are those of the table, dealt to files by a hash of the column ``by``.
    """
    folder = scratch_path(spark, "feed")
    files = triggers * -(-table.rdd.getNumPartitions() // triggers)
    table.repartition(files, F.xxhash64(by)).write.parquet(folder)
    return spark.readStream.schema(table.schema).option("maxFilesPerTrigger", str(files // triggers)).parquet(folder)


def stream_lines(spark: SparkSession, directory: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """New text files in a directory, one row per line (``value``)."""
    r = spark.readStream
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.text(directory)
