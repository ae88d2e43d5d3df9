"""The whole processor as one stream: six set tables committed together, and the readings that came too late.

Each micro-batch writes one folder with all its rows (house and plug measures, averages and
predictions, late readings) and then commits it: a numbered manifest names the folders
that make up the tables and is created by an atomic rename.  Readers take the newest manifest, so they see a batch in
all tables or in none; a batch that was cut off is written anew by the replay, a committed one is skipped.

The engine drops readings of panes behind the watermark.  The table ``late`` holds exactly those: the watermark of a
batch follows from the newest event times of the batches before it, which the manifests carry along.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loadlens.functions.timeslice import DEFAULT_TF, ORIGIN_TS, pane
from loadlens.operators.averages import averages_set, measure_set
from loadlens.operators.keys import PLUG, keys_of
from loadlens.operators.measures import valid_load
from loadlens.operators.predict import DEFAULT_PANE_SECONDS, DEFAULT_PANES_PER_WINDOW, state_prediction
from loadlens.streaming.panes import sets_and_predictions
from loadlens.streaming.sinks import run_bounded


class CommittedTables:
    """Folders of batches under ``path``, partitioned by ``table``, visible through numbered manifests.

    A manifest holds the last ``batch``, the ``folders``, the rows' ``schema`` and, for the last batches, the newest event
    time ``seen`` up to each.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._hadoop.Path(self.path).getFileSystem(self._conf)

    def _at(self, name: str):
        return self._hadoop.Path(f"{self.path}/{name}" if name else self.path)

    def _names(self, folder: str) -> list[str]:
        at = self._at(folder)
        return [f.getPath().getName() for f in self._fs.listStatus(at)] if self._fs.exists(at) else []

    def manifest(self) -> tuple[int, dict]:
        """Number and content of the newest manifest (-1 and an empty one before the first commit)."""
        numbers = [int(n) for n in self._names("_manifests") if n.isdigit()]
        if not numbers:
            return -1, {"batch": -1, "folders": [], "schema": None, "seen": {}}
        lines = self.spark.read.text(f"{self.path}/_manifests/{max(numbers)}", wholetext=True).collect()
        return max(numbers), json.loads(lines[0][0])

    def commit(self, number: int, content: dict) -> None:
        """Create manifest ``number``; fails if there is one already."""
        draft, final = self._at(f"_manifests/.{uuid.uuid4().hex}"), self._at(f"_manifests/{number}")
        out = self._fs.create(draft)
        out.write(bytearray(json.dumps(content).encode()))
        out.close()
        keep = self.spark.sparkContext._gateway.new_array(self._hadoop.Options.Rename, 0)  # nothing is overwritten
        self._hadoop.FileContext.getFileContext(draft.toUri(), self._conf).rename(draft, final, keep)

    def write(self, rows: DataFrame, batch_id: int, seen: Observation | None = None) -> bool:
        """Write a batch's folder and commit it; False if the batch is committed already.

        ``seen`` observes the newest event time of the batch, as ``newest``.
        """
        number, content = self.manifest()
        if batch_id <= content["batch"]:
            return False
        folder = f"batch={batch_id}"
        rows.write.mode("overwrite").partitionBy("table").parquet(f"{self.path}/{folder}")
        times = {int(k): v for k, v in content["seen"].items()}
        now = [v for v in (*times.values(), seen.get["newest"] if seen else None) if v is not None]
        times[batch_id] = max(now, default=None)
        self.commit(number + 1, {
            "batch": batch_id, "folders": [*content["folders"], folder], "schema": json.loads(rows.schema.json()),
            "seen": {k: v for k, v in times.items() if k > batch_id - 3}})
        return True

    def read(self, table: str) -> DataFrame | None:
        """The committed rows of a table, without ``table``; None before the first commit."""
        _, content = self.manifest()
        if content["schema"] is None:
            return None
        schema = StructType.fromJson(content["schema"])
        schema = StructType([f for f in schema.fields if f.name != "table"])
        paths = [f"{f}/table={table}" for f in content["folders"]]
        paths = [f"{self.path}/{p}" for p in paths if self._fs.exists(self._at(p))]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def compact(self) -> None:
        """Merge the committed folders into one; the old ones stay for readers that use them until ``vacuum``."""
        number, content = self.manifest()
        if len(content["folders"]) < 2:
            return
        schema = StructType.fromJson(content["schema"])
        rows = None
        for f in content["folders"]:
            part = self.spark.read.schema(schema).parquet(f"{self.path}/{f}")
            rows = part if rows is None else rows.unionByName(part)
        folder = f"merged={number + 1}"
        rows.write.mode("overwrite").partitionBy("table").parquet(f"{self.path}/{folder}")
        self.commit(number + 1, {**content, "folders": [folder]})

    def vacuum(self) -> None:
        """Delete folders that the newest manifest does not name, and older manifests; not while a batch is written."""
        number, content = self.manifest()
        for name in self._names(""):
            if name.startswith(("batch=", "merged=")) and name not in content["folders"]:
                self._fs.delete(self._at(name), True)
        for name in self._names("_manifests"):
            if name != str(number):
                self._fs.delete(self._at(f"_manifests/{name}"), False)


#: Milliseconds of the units of a watermark's delay.
UNITS = {"second": 1000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000}


def delay_ms(delay: str) -> int:
    """A delay such as ``2 hours`` in milliseconds."""
    number, unit = delay.split()
    return int(number) * UNITS[unit.rstrip("s")]


class ProcessorTables:
    """The six set tables and the late readings of a processor stream, under ``path``."""

    def __init__(self, spark: SparkSession, path: str, tf: int = DEFAULT_TF, pane_seconds: int = DEFAULT_PANE_SECONDS,
                 panes_per_window: int = DEFAULT_PANES_PER_WINDOW, watermark: str = "1 hour", rule: str = "reference",
                 origin: int = ORIGIN_TS):
        self.store = CommittedTables(spark, path)
        self.tf, self.pane, self.size, self.rule, self.origin = tf, pane_seconds, panes_per_window, rule, origin
        self.watermark = watermark

    def stream(self, measurements: DataFrame) -> DataFrame:
        """All rows of a micro-batch: both levels' sets and predictions, and the valid readings as they came."""
        out = valid_load(measurements).select(F.lit("reading").alias("table"), *PLUG, "id", "timestamp",
                                              F.col("value").alias("reading"))
        for level in ("house", "plug"):
            got = sets_and_predictions(measurements, keys_of(level), self.tf, self.pane, self.size, watermark=self.watermark,
                                       rule=self.rule, origin=self.origin)
            got = got.withColumn("table", F.concat(F.lit(f"{level}_"), "kind")).drop("kind")
            out = out.unionByName(got, allowMissingColumns=True)
        return out

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """``foreachBatch``: of the readings keep those the engine drops in this batch; commit all tables at once."""
        # in batch N the engine filters by the watermark of batch N - 1: the event times up to batch N - 2
        seen = self.store.manifest()[1]["seen"].get(str(batch_id - 2))
        reading = F.col("table") == "reading"
        late = F.lit(False)
        if seen is not None:
            late = (pane("timestamp", self.pane) + 1) * (self.pane * 1000) <= F.lit(seen - delay_ms(self.watermark))
        newest = Observation()
        rows = batch.observe(newest, F.max(F.when(reading, F.col("timestamp").cast("long") * 1000)).alias("newest"))
        rows = rows.withColumn("table", F.when(reading & late, "late").otherwise(F.col("table")))
        self.store.write(rows.where(F.col("table") != "reading"), batch_id, newest)

    def run_available(self, measurements: DataFrame, checkpoint: str):
        """Process what there is now, in one query."""
        return run_bounded(self.stream(measurements), self.write, "append", checkpoint)

    def measures(self, level: str) -> DataFrame:
        """``operators.averages.measure_set``."""
        return self.store.read(f"{level}_measure").select(F.lit(self.tf).alias("tf"), "slice", *keys_of(level), "value")

    def averages(self, level: str) -> DataFrame:
        """``operators.averages.averages_set``."""
        return self.store.read(f"{level}_average").select(F.lit(self.tf).alias("tf"), "slice", *keys_of(level),
                                                          F.col("value").alias("avg_load"))

    def predictions(self, level: str) -> DataFrame:
        """``operators.predict.state_prediction`` (``prediction_set`` of it is the set table)."""
        return self.store.read(f"{level}_prediction").select(
            *keys_of(level), "pane", "head_timestamp", "n", F.col("value").alias("predicted_load"),
            F.col("slice").alias("target_slice"))

    def late(self) -> DataFrame:
        """Valid readings that came behind the watermark: they are in no other table."""
        return self.store.read("late").select(*PLUG, "id", "timestamp", F.col("reading").alias("value"))

    def repaired(self, level: str, feed: DataFrame) -> dict[str, DataFrame]:
        """The level's tables with the late readings in: keys that have any are computed anew from the whole ``feed``."""
        keys = list(keys_of(level))
        hit = self.late().select(*keys).distinct()
        valid = valid_load(feed).join(hit, keys, "left_semi")
        anew = {"measures": measure_set(valid, keys, self.tf, self.origin),
                "averages": averages_set(valid, keys, self.tf, self.pane, self.origin),
                "predictions": state_prediction(valid, keys, self.tf, self.pane, self.size, "intended", self.rule, self.origin)}
        return {name: getattr(self, name)(level).join(hit, keys, "left_anti").unionByName(rows) for name, rows in anew.items()}
