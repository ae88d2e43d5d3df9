"""Averages history kept up to date by deltas (A3/A4 on stored tables).

Two tables are kept per level: ``firsts``, the first pane of each value of a (key, slice), and ``history``, the running sum,
count and average of the distinct values at each pane the set changed.  Both lie in buckets of (slice, key).  A
batch of arrivals opens only the buckets of the groups it touches; a group is replayed from the earliest pane that
changed, starting from the sum and count stored before it.  Arrivals may come in any order and any number of times.

Changed buckets are written to a folder of the batch and the manifest that maps buckets to folders is replaced by an
atomic rename, so readers see all of a batch or nothing, and a replayed batch changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loadlens.functions.timeslice import DEFAULT_TF
from loadlens.operators.averages import SET_DECIMALS
from loadlens.session import scratch_path
from loadlens.streaming.processor import CommittedTables


class AveragesHistory:
    """The averages history of ``keys`` under ``path``, in ``slice_buckets`` times ``key_buckets`` buckets."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], slice_buckets: int = 24, key_buckets: int = 8,
                 decimals: int = SET_DECIMALS):
        self.spark, self.path, self.keys, self.decimals = spark, path.rstrip("/"), list(keys), decimals
        self.slices, self.hashes = slice_buckets, key_buckets
        self.manifests = CommittedTables(spark, path)
        self.group = [*self.keys, "s"]
        ids = ", ".join(f"{k} int" for k in self.group)
        self._schema = {"firsts": f"{ids}, v double, fp long, bucket int",
                        "history": f"{ids}, fp long, total double, n long, bucket int"}

    def _bucket(self):
        key = F.pmod(F.xxhash64(*self.keys), F.lit(self.hashes))
        return (F.pmod(F.col("s"), F.lit(self.slices)) * self.hashes + key).cast("int")

    def folders(self, table: str, buckets: Sequence[int] | None = None) -> list[str]:
        """The current folders of a table's buckets (all, or those given)."""
        where = self.manifests.manifest()[1].get("where", {})
        wanted = where if buckets is None else [str(b) for b in buckets if str(b) in where]
        return [f"{self.path}/batch={where[b]}/table={table}/bucket={b}" for b in wanted]

    def _read(self, table: str, buckets: Sequence[int] | None = None) -> DataFrame:
        schema = self._schema[table].rsplit(", bucket int", 1)[0]
        paths = self.folders(table, buckets)
        rows = self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)
        return rows.withColumn("bucket", self._bucket())

    def apply(self, arrivals: DataFrame, batch_id: int) -> bool:
        """Take in rows with ``keys, s, v, p0``; False if the batch is in already (``foreachBatch`` form)."""
        number, manifest = self.manifests.manifest()
        if batch_id <= manifest["batch"]:
            return False
        new = arrivals.groupBy(*self.group, "v").agg(F.min("p0").alias("fp")).withColumn("bucket", self._bucket())
        stage = scratch_path(self.spark, "history-delta")
        new.write.parquet(stage)  # used several times below
        new = self.spark.read.schema(new.schema).parquet(stage)
        touched = sorted(r[0] for r in new.select("bucket").distinct().collect())  # at most one row per bucket
        where = dict(manifest.get("where", {}))
        if touched:
            firsts, history = self._read("firsts", touched), self._read("history", touched)
            self._write(new, firsts, history, batch_id)
            where |= {str(b): batch_id for b in touched}
        self.manifests.commit(number + 1, {"batch": batch_id, "folders": [], "schema": None, "seen": {}, "where": where})
        return True

    def _write(self, new: DataFrame, firsts: DataFrame, history: DataFrame, batch_id: int) -> None:
        group = self.group
        # no joins, so no side is broadcast by what its files are taken to hold: values meet by (group, value), panes by group
        both = firsts.select(*group, "v", "bucket", F.col("fp").alias("_old"), F.lit(None).cast("long").alias("_new")).unionByName(
            new.select(*group, "v", "bucket", F.lit(None).cast("long").alias("_old"), F.col("fp").alias("_new")))
        merged = both.groupBy(*group, "v", "bucket").agg(
            F.least(F.min("_old"), F.min("_new")).alias("fp"), F.min("_old").alias("_old"), F.min("_new").alias("_new"))
        # the panes at which a group's set differs now; the earliest is the group's cut
        change = F.when(F.col("_old").isNull() | (F.col("_new") < F.col("_old")), F.col("_new"))
        panes = merged.groupBy(*group, "bucket", "fp").agg(
            F.sum("v").alias("_s"), F.count(F.lit(1)).alias("_n"), F.min(change).alias("_change"))
        lines = panes.unionByName(history.select(*group, "bucket", "fp", "total", "n"), allowMissingColumns=True)
        whole, stored = Window.partitionBy(*group), F.col("n").isNotNull()
        lines = lines.dropna(subset=group)  # a group without a key has values, but no history
        lines = lines.withColumn("_cut", F.min("_change").over(whole)).where(
            F.when(stored, F.col("_cut").isNull() | (F.col("fp") < F.col("_cut"))).otherwise(F.col("fp") >= F.col("_cut")))
        # what is stored before the cut is kept, and its last sum and count are where the replay starts
        base = F.max_by(F.when(stored, F.struct("total", "n")), F.when(stored, F.col("fp"))).over(whole)
        upto = whole.orderBy("fp").rowsBetween(Window.unboundedPreceding, 0)
        lines = lines.withColumn("_base", base).withColumn("_sum", F.sum("_s").over(upto)).withColumn("_count", F.sum("_n").over(upto))
        rows = lines.select(
            *group, "fp", F.when(stored, F.col("total")).otherwise(F.coalesce(F.col("_base.total"), F.lit(0.0)) + F.col("_sum")).alias("total"),
            F.when(stored, F.col("n")).otherwise(F.coalesce(F.col("_base.n"), F.lit(0)) + F.col("_count")).alias("n"), "bucket")
        out = rows.withColumn("table", F.lit("history")).unionByName(
            merged.drop("_old", "_new").withColumn("table", F.lit("firsts")), allowMissingColumns=True)
        (out.repartition("table", "bucket").sortWithinPartitions("table", "bucket", *group, "fp")
         .write.mode("overwrite").partitionBy("table", "bucket").parquet(f"{self.path}/batch={batch_id}"))

    def history(self) -> DataFrame:
        """``operators.averages.averages_history``: ``keys, s, fp, avg_load``."""
        return self._read("history").select(*self.group, "fp", F.round(F.col("total") / F.col("n"), self.decimals).alias("avg_load"))

    def averages(self, tf: int = DEFAULT_TF) -> DataFrame:
        """``operators.averages.averages_set``."""
        return self.history().select(F.lit(tf).alias("tf"), F.col("s").alias("slice"), *self.keys, "avg_load").distinct()
