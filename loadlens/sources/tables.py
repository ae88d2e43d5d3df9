"""Driver tables and the measurement view derived from ``events``.

The measurement view maps each event to one smart-meter reading:
``id = event_id``, ``timestamp`` = epoch seconds of ``ts``, ``value`` as a
float, ``property = 1`` for load events (view, click, purchase), and the
sensor ids from ``user_id`` (15 users per house, 5 plugs per household).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.functions.parsing import hhp_id
from loadlens.functions.timeslice import epoch_seconds, idiv

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Fixed values of the measurement mapping (see FIXTURES.md section 2).
LOAD_EVENT_TYPES = ("view", "click", "purchase")
USERS_PER_HOUSE = 15
PLUGS_PER_HOUSEHOLD = 5

MEASUREMENT_COLUMNS = ("id", "timestamp", "value", "property", "plug_id", "household_id",
                       "house_id", "hhp_id")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def balanced(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin rebalance a scan that yields fewer partitions than the cluster has cores.

    For CPU-heavy per-row work (text splitting) on inputs stored as a few large
    row groups.  A scan of many files already has enough partitions and is
    returned unchanged, so at scale this adds no shuffle.
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(target) if df.rdd.getNumPartitions() < target else df


def measurements_from_events(events: DataFrame) -> DataFrame:
    """``events`` -> measurement rows (narrow projection; only 5 columns are read)."""
    ts_type = events.schema["ts"].dataType
    u = F.col("user_id")
    house = idiv(u, USERS_PER_HOUSE).cast("int")
    household = idiv(u % USERS_PER_HOUSE, PLUGS_PER_HOUSEHOLD).cast("int")
    plug = (u % PLUGS_PER_HOUSEHOLD).cast("int")
    return events.select(
        F.col("event_id").cast("long").alias("id"),
        epoch_seconds("ts", ts_type).cast("int").alias("timestamp"),
        F.col("value").cast("float").alias("value"),
        F.when(F.col("event_type").isin(*LOAD_EVENT_TYPES), 1).otherwise(0).alias("property"),
        plug.alias("plug_id"),
        household.alias("household_id"),
        house.alias("house_id"),
    ).withColumn("hhp_id", hhp_id())


def load_measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measurements_from_events(read_table(spark, sf_dir, "events"))


def load_candidate_measurements(spark: SparkSession, sf_dir: str, positive: bool = True) -> DataFrame:
    """Measurements that can be loads (valid loads when ``positive``), with the test on
    raw columns pushed to the scan.

    ``event_type IN (load types)`` (and ``value > 0`` on the stored double) are
    implied by the load / validity rules (the float cast keeps the sign), so
    they only let Parquet skip row groups and decode less; the exact rule
    still runs after the mapping.
    """
    cond = F.col("event_type").isin(*LOAD_EVENT_TYPES)
    if positive:
        cond = cond & (F.col("value") > 0)
    return measurements_from_events(read_table(spark, sf_dir, "events").filter(cond))
