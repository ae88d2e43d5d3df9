"""Record-at-a-time rolling prediction as a stream (T3): readings released in total order.

Readings wait in state, in buckets of event time, until the watermark has passed them; then they are released in
(timestamp, id, value) order and the running sum and count of their house move on.  A house that gets no new readings is
released by an event-time timer.  What waits is bounded by the watermark's delay.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from loadlens.operators.measures import as_double
from loadlens.streaming.state import require_rocksdb

# shipped by value: the driver-side worker that plans a stateful query does not see ``--py-files``
cloudpickle.register_pickle_by_value(sys.modules[__name__])

READING = [("timestamp", "<i8"), ("id", "<i8"), ("v", "<f8"), ("household_id", "<i4")]
ORDER = ["timestamp", "id", "v"]


class RollingPrediction(StatefulProcessor):
    """Per house: readings waiting for the watermark, and the running sum and count of the released ones."""

    def __init__(self, narrow: bool, median_factor: float, bucket_seconds: int):
        self.narrow, self.factor, self.bucket = narrow, median_factor, bucket_seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        #: running sum, count, and the numbers of the waiting buckets with their least timestamps
        self.state = handle.getValueState("running", StructType([StructField("state", StringType())]))
        self.waiting = handle.getMapState("waiting", StructType([StructField("bucket", LongType())]),
                                          StructType([StructField("readings", BinaryType())]))

    def _read(self, bucket: int):
        row = self.waiting.getValue((bucket,))
        return np.frombuffer(bytes(row[0]), READING) if row else np.zeros(0, READING)

    def _release(self, key, state: list, watermark_ms: int) -> Iterator[pd.DataFrame]:
        """Predictions of the readings up to the watermark, and a timer for the next one."""
        ready = []
        for bucket in sorted((b for b, least in state[2].items() if least * 1000 <= watermark_ms), key=int):
            rows = self._read(int(bucket))
            due = rows["timestamp"] * 1000 <= watermark_ms
            ready.append(np.sort(rows[due], order=ORDER))
            if due.all():
                self.waiting.removeKey((int(bucket),))
                del state[2][bucket]
            else:
                rest = rows[~due]
                self.waiting.updateValue((int(bucket),), (bytearray(rest.tobytes()),))
                state[2][bucket] = int(rest["timestamp"].min())
        got = np.concatenate(ready) if ready else np.zeros(0, READING)
        if len(got):
            upto = np.cumsum(np.r_[state[0], got["v"]])
            count = state[1] + np.arange(1, len(got) + 1)
            avg = upto[1:] / count
            if self.narrow:
                avg = avg.astype(np.float32).astype(np.float64)
            median = np.where(upto[:-1] < 0, -np.abs(avg * self.factor), np.abs(avg * self.factor))
            state[0], state[1] = float(upto[-1]), int(count[-1])
            yield pd.DataFrame({"house_id": np.full(len(got), key[0], np.int32), "household_id": got["household_id"],
                                "id": got["id"], "timestamp": got["timestamp"].astype(np.int32),
                                "predicted_load": (avg + median) / 2})
        if state[2]:
            self.handle.registerTimer(min(state[2].values()) * 1000 + 1)
        self.state.update((json.dumps(state),))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        held = self.state.get()
        state = json.loads(held[0]) if held else [0.0, 0, {}]
        pdf = pd.concat(list(rows), ignore_index=True)
        new = np.zeros(len(pdf), READING)
        for name, _ in READING:
            new[name] = pdf[name].to_numpy()
        number = new["timestamp"] // self.bucket
        for b in np.unique(number).tolist():
            part = np.concatenate([self._read(b), new[number == b]]) if str(b) in state[2] else new[number == b]
            self.waiting.updateValue((b,), (bytearray(part.tobytes()),))
            state[2][str(b)] = int(part["timestamp"].min())
        yield from self._release(key, state, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        yield from self._release(key, json.loads(self.state.get()[0]), timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


def rolling_prediction_stream(loads: DataFrame, *, watermark: str, narrow: bool = True, median_factor: float = 0.01,
                              bucket_seconds: int = 3600) -> DataFrame:
    """``operators.predict.rolling_prediction`` as an append-mode stream; readings behind the watermark are left out.

    One task orders a house's readings, as a running state per record does; a null value counts as a reading of 0.
    """
    require_rocksdb(loads.sparkSession)
    rows = loads.select("house_id", "household_id", "id", F.col("timestamp").cast("long").alias("timestamp"),
                        F.coalesce(as_double(), F.lit(0.0)).alias("v"), F.timestamp_seconds("timestamp").alias("_et"))
    return rows.withWatermark("_et", watermark).groupBy("house_id").transformWithStateInPandas(
        RollingPrediction(narrow, median_factor, bucket_seconds),
        "house_id int, household_id int, id long, timestamp int, predicted_load double", "Append", "EventTime")
