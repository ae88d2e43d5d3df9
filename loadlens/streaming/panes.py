"""Stateful streams over closed panes: predictions with the slice median, and incremental sliding counts.

Readings are first aggregated per (key, pane) by the engine (append mode: a pane comes out once, when the
watermark passes its end).  A stateful step then advances each key pane by pane, in order.  Windows
that hold no new reading close too: they are emitted when the key's next pane arrives or by an event-time timer, whichever
is first.  No reading is copied per window and the Python step sees pane rows only.

State of a key: the last panes of its window, the running totals, and for the slice median two sorted
sets per slice (the values seen, and the averages stored), cut in blocks that are read and written one by one.
While a key's sets are few and small they lie in its one state value: a call to the state store costs more than they do.
"""

from __future__ import annotations

import json
import sys
from array import array
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterable, Iterator, Sequence
from decimal import ROUND_HALF_UP, Decimal
from itertools import groupby
from operator import itemgetter

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import (ArrayType, BinaryType, DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType)

from loadlens.functions.timeslice import DEFAULT_TF, ORIGIN_TS, event_time, time_slice
from loadlens.operators.measures import prepared, valid_load
from loadlens.operators.predict import DEFAULT_PANE_SECONDS, DEFAULT_PANES_PER_WINDOW, HEAD_UNIT, head_key, head_timestamp
from loadlens.streaming.state import require_rocksdb

# shipped by value: the driver-side worker that plans a stateful query does not see ``--py-files``
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = 512  # values a block of a stored set is cut to; it holds up to twice as many
KEPT = 4 * BLOCK  # values of all sets up to which a key keeps them in its state
PACK = 10_000  # rows of a key that come out of the stateful step as one, in lists
DECIMALS = Decimal("0.000001")  # an average is rounded to this before it enters its set


class StoredSet:
    """A sorted set of floats in blocks, loaded on demand.

    ``directory`` has ``[number, size, least]`` per block in order; ``load(number)`` gives a block's floats.
    """

    def __init__(self, directory: list, load):
        self.directory, self.load = directory, load
        self.size = sum(d[1] for d in directory)
        self.blocks: dict[int, list[float]] = {}
        self.changed: set[int] = set()

    def _block(self, at: int) -> list[float]:
        number = self.directory[at][0]
        if number not in self.blocks:
            self.blocks[number] = self.load(number)
        return self.blocks[number]

    def add(self, v: float) -> bool:
        """Whether ``v`` is new."""
        if not self.directory:
            self.directory.append([0, 0, v])
            self.blocks[0] = []
        at = max(0, bisect_right(self.directory, v, key=lambda d: d[2]) - 1)
        block, entry = self._block(at), self.directory[at]
        i = bisect_left(block, v)
        if i < len(block) and block[i] == v:
            return False
        insort(block, v)
        self.size += 1
        self.changed.add(entry[0])
        entry[1], entry[2] = len(block), block[0]
        if len(block) > 2 * BLOCK:
            number = max(d[0] for d in self.directory) + 1
            self.blocks[number] = block[BLOCK:]
            del block[BLOCK:]
            entry[1] = BLOCK
            self.directory.insert(at + 1, [number, len(self.blocks[number]), self.blocks[number][0]])
            self.changed.add(number)
        return True

    def kth(self, k: int) -> float | None:
        """The value at 0-based position ``k``; None outside the set.  Loads one block."""
        if not 0 <= k < self.size:
            return None
        for at, (_, size, _) in enumerate(self.directory):
            if k < size:
                return self._block(at)[k]
            k -= size

    def median(self, rule: str) -> float:
        """``exact``, or ``reference``: one position too high, 0.0 where the set has no such position."""
        n = self.size
        if rule == "exact":
            lo, hi = self.kth((n - 1) // 2), self.kth(n // 2)
        elif n % 2 == 0:
            lo, hi = self.kth(n // 2), self.kth(n // 2 + 1)
        else:
            lo = hi = self.kth((n + 1) // 2)
        return 0.0 if lo is None or hi is None else (lo + hi) / 2


class SliceSets:
    """Both sets of one (key, slice) with the running sum of the distinct values, in two map states.

    While each set is one block, both lie in the slice's record: one read and one write.  ``held`` has the records of
    a key that keeps them itself; the record is not in the map state then.
    """

    def __init__(self, heads, blocks, s: int, held: dict | None = None):
        self.heads, self.stored, self.s = heads, blocks, s
        if held is None:
            row = heads.getValue((s,))
            record = json.loads(row[0]) if row else None
        else:
            record = held.get(str(s))
        self.total, directories, inline = record or [0.0, [[], []], [None, None]]
        self.values, self.averages = (StoredSet(directories[i], self._loader(i, inline[i])) for i in (0, 1))

    def _loader(self, which: int, inline):
        def load(number: int) -> list[float]:
            if inline is not None:
                return inline
            return array("d", self.stored.getValue((self.s, which, number))[0]).tolist()
        return load

    def add(self, values: list[float]) -> tuple[list[float], float | None]:
        """The values that are new, and the new average they make (None: none, or one already stored)."""
        new = [v for v in values if self.values.add(v)]
        if not new:
            return [], None
        self.total += sum(new)
        avg = float(Decimal(repr(self.total / self.values.size)).quantize(DECIMALS, ROUND_HALF_UP))
        return new, avg if self.averages.add(avg) else None

    def save(self) -> None:
        if self.values.changed:
            self.heads.updateValue((self.s,), (json.dumps(self.record()),))

    def record(self) -> list:
        """The slice's record; blocks that do not fit in it are written."""
        inline = []
        for which, got in enumerate((self.values, self.averages)):
            one = len(got.directory) <= 1
            inline.append((got._block(0) if got.directory else []) if one else None)
            if not one:
                for number in got.changed:  # has block 0 when it stops being inline: it was cut
                    self.stored.updateValue((self.s, which, number), (bytearray(array("d", got.blocks[number]).tobytes()),))
        return [self.total, [self.values.directory, self.averages.directory], inline]


class Panes(StatefulProcessor):
    """Advances a key over its closed panes in order; see ``advance`` and ``emit``.

    The saved state is a JSON list ``[next pane, last pane with rows, window, ...]``; ``window`` has one
    entry per pane with rows that a window still reaches back to.
    """

    fields: Sequence[str] = ("pane",)  # columns of the input that are read, the pane first
    columns: Sequence[str] = ("pane",)  # columns that come out besides the keys

    def __init__(self, keys: Sequence[str], pane_seconds: int, panes_per_window: int, tail: int = 0,
                 backfilled: int | None = None):
        self.keys, self.pane_ms, self.size, self.tail = list(keys), pane_seconds * 1000, panes_per_window, tail
        self.backfilled = backfilled  # last pane of the initial state
        self.types: list = []  # of ``fields``; set by ``advanced``

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("panes", StructType([StructField("state", StringType())]))

    def begin(self) -> list:
        """The state before a key's first pane, without its first three entries."""
        raise NotImplementedError

    def advance(self, state: list, pane: int, rows: list[tuple], out: list) -> list:
        """Take in a pane's rows (``fields``, sorted); returns the pane's window entry, whose first item is the pane."""
        raise NotImplementedError

    def emit(self, state: list, pane: int, out: list) -> None:
        """Close the window that ends with ``pane``."""
        raise NotImplementedError

    def leave(self, state: list, entry: list) -> None:
        """A pane leaves the window."""

    def packed(self, key, out: list[tuple]) -> Iterator[Row]:
        """``out`` as few rows with an array per column, so that a key costs no data frame; see ``advanced``.

        Arrays of objects go to Arrow as they are; lists are first copied value by value.
        """
        row = Row(*self.keys, *self.columns)
        for at in range(0, len(out), PACK):
            yield row(*key, *(np.array(c, dtype=object) for c in zip(*out[at:at + PACK])))

    def _close(self, state: list, pane: int, out: list) -> None:
        while state[2] and state[2][0][0] <= pane - self.size:
            self.leave(state, state[2].pop(0))
        self.emit(state, pane, out)
        state[0] = pane + 1

    def _catch_up(self, state: list, pane: int, out: list) -> None:
        """Close windows without new rows, up to ``pane``."""
        for p in range(state[0], min(pane, state[1] + self.size - 1 + self.tail) + 1):
            self._close(state, p, out)

    def _settle(self, state: list, timerValues, out: list) -> None:  # noqa: N803
        self._catch_up(state, timerValues.getCurrentWatermarkInMs() // self.pane_ms - 1, out)
        if state[0] <= state[1] + self.size - 1 + self.tail:
            self.handle.registerTimer((state[0] + 1) * self.pane_ms)
        self.save(state)
        self.state.update((json.dumps(state),))

    def save(self, state: list) -> None:
        """Write back what ``advance`` and ``emit`` hold besides the state."""

    def _read(self, row: str) -> tuple:
        """The ``fields`` of a row written by ``advanced``."""
        return tuple(None if x == "" else t(x) for t, x in zip(self.types, row.split(",")))

    def _take(self, state: list | None, rows: Iterable[tuple], out: list) -> list:
        """Advance over a key's closed panes, given as ``fields``."""
        for pane, part in groupby(sorted(rows), itemgetter(0)):
            if state is None:
                state = [pane, pane, [], *self.begin()]
            self._catch_up(state, pane - 1, out)
            state[2].append(self.advance(state, pane, list(part), out))
            state[1] = pane
            self._close(state, pane, out)
        return state

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        held, out = self.state.get(), []
        state = self._take(json.loads(held[0]) if held else None, map(self._read, map(itemgetter(-1), rows)), out)
        self._settle(state, timerValues, out)
        yield from self.packed(key, out)

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:  # noqa: N802, N803
        """Take in a backfill's panes; windows up to its last pane are the backfill's output, not the stream's."""
        out: list = []
        state = self._take(None, map(self._read, initialState["rows"]), out)
        self._catch_up(state, self.backfilled, out)
        out.clear()
        self._settle(state, timerValues, out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        state, out = json.loads(self.state.get()[0]), []
        self._settle(state, timerValues, out)
        yield from self.packed(key, out)

    def close(self) -> None:
        pass


def advanced(rows: DataFrame, processor: Panes, schema: StructType, before: DataFrame | None = None) -> DataFrame:
    """The rows of ``schema`` that ``processor`` makes of the closed panes ``rows``; ``before`` are a backfill's panes.

    Each value that goes to Python costs as much as parsing a whole row, so a pane's row goes there as one string.
    """
    keys = processor.keys
    processor.types = [float if isinstance(rows.schema[c].dataType, DoubleType) else int for c in processor.fields]
    row = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in processor.fields]).alias("row")
    rows = rows.select(*keys, row)
    if before is not None:
        before = before.select(*keys, row).groupBy(*keys).agg(F.collect_list("row").alias("rows")).groupBy(*keys)
    lists = StructType([f if f.name in keys else StructField(f.name, ArrayType(f.dataType)) for f in schema])
    got = rows.groupBy(*keys).transformWithState(processor, lists, "Append", "EventTime", before)
    return got.select(*keys, F.inline(F.arrays_zip(*processor.columns)))


def head_order(ts: int, rid: int):
    """Sort key over rows with a head reading's timestamp and id at these places; no reading is last."""
    return lambda r: (r[ts] is None, r[ts], r[rid])


class SetsAndPredictions(Panes):
    """Per key: distinct values, stored averages and a prediction per closed window.

    Emits ``(kind, pane, slice, value, head_timestamp, n)``: ``measure`` for each value new to its slice, ``average``
    for each average new to its slice, ``prediction`` with ``slice`` the target slice.
    """

    fields = ("pane", "s", "v", "n", "head_ts", "head_id")
    columns = ("kind", "pane", "slice", "value", "head_timestamp", "n")

    def __init__(self, keys, pane_seconds, panes_per_window, rule, tables: bool, backfilled: int | None = None):
        super().__init__(keys, pane_seconds, panes_per_window, backfilled=backfilled)
        self.rule, self.tables = rule, tables

    def init(self, handle):
        super().init(handle)
        key = [StructField("s", IntegerType())]
        self.heads = handle.getMapState("slices", StructType(key), StructType([StructField("record", StringType())]))
        key = [*key, StructField("set", IntegerType()), StructField("number", IntegerType())]
        self.blocks = handle.getMapState("blocks", StructType(key), StructType([StructField("data", BinaryType())]))
        self.open: dict[int, SliceSets] = {}  # of the key and call at hand

    def begin(self):
        return [0.0, 0, {}]  # running total and counter over windows; records of the slices, None: in the map state

    def _sets(self, state: list, s: int) -> SliceSets:
        if s not in self.open:
            held = state[5] if len(state) > 5 else None  # states of older checkpoints have no records
            self.open[s] = SliceSets(self.heads, self.blocks, s, held)
        return self.open[s]

    def save(self, state):
        held = state[5] if len(state) > 5 else None
        if held is None:
            for sets in self.open.values():
                sets.save()
        else:
            held.update((str(s), sets.record()) for s, sets in self.open.items() if sets.values.changed)
            if sum(d[1] for r in held.values() for directory in r[1] for d in directory) > KEPT:
                for s, record in held.items():
                    self.heads.updateValue((int(s),), (json.dumps(record),))
                state[5] = None
        self.open.clear()

    def advance(self, state, pane, rows, out):
        for s, part in groupby(rows, itemgetter(1)):
            new, avg = self._sets(state, s).add([r[2] for r in part])
            if self.tables:
                out += [("measure", pane, s, v, None, None) for v in new]
                if avg is not None:
                    out.append(("average", pane, s, avg, None, None))
        first = min(rows, key=head_order(4, 5))
        return [pane, sum(r[2] * r[3] for r in rows), sum(r[3] for r in rows), first[4], first[5], first[1]]

    def emit(self, state, pane, out):
        window = state[2]
        if not window:
            return
        state[3] += sum(e[1] for e in window)
        state[4] += sum(e[2] for e in window)
        _, _, _, ts, _, s = min(window, key=head_order(3, 4))
        median = self._sets(state, s).averages.median(self.rule)
        out.append(("prediction", pane, s + 1, (state[3] / state[4] + median) / 2, ts, state[4]))


def pane_values(measurements: DataFrame, keys: Sequence[str], tf: int, pane_seconds: int, watermark: str,
                origin: int = ORIGIN_TS) -> DataFrame:
    """``keys, pane, s, v, n, head_ts, head_id`` of closed panes, one row per distinct value."""
    p = prepared(valid_load(measurements), keys, tf, origin=origin).select(
        *keys, "s", "v", head_key().alias("_hk"), F.timestamp_seconds("timestamp").alias("_et"))
    w = F.window("_et", f"{pane_seconds} seconds")
    g = p.withWatermark("_et", watermark).groupBy(*keys, w.alias("w"), "s", "v").agg(
        F.count(F.lit(1)).alias("n"), F.min("_hk").alias("_hk"))
    ts, rid = _head("_hk")
    return g.select(*keys, F.call_function("div", F.unix_seconds(F.col("w.start")), F.lit(pane_seconds)).alias("pane"), "s", "v",
                    "n", ts.alias("head_ts"), rid.alias("head_id"), F.window_time("w").alias("_time"))


def _head(key: str):
    """Timestamp and id of a packed head key."""
    unit = F.lit(str(HEAD_UNIT)).cast("decimal(20,0)")
    ts = head_timestamp(key)
    rid = F.col(key) - (ts.cast("decimal(11,0)") * unit).cast("decimal(33,0)") - F.lit(str(HEAD_UNIT // 2)).cast("decimal(20,0)")
    return ts, rid.cast("long")


def sets_and_predictions(measurements: DataFrame, keys: Sequence[str], tf: int = DEFAULT_TF,
                         pane_seconds: int = DEFAULT_PANE_SECONDS,
                         panes_per_window: int = DEFAULT_PANES_PER_WINDOW, *, watermark: str, rule: str = "reference",
                         origin: int = ORIGIN_TS, tables: bool = True,
                         backfill: tuple[DataFrame, int] | None = None) -> DataFrame:
    """Append-mode stream of ``keys, kind, pane, slice, value, head_timestamp, n`` (``SetsAndPredictions``).

    Equal to the batch ``measure_set``, ``averages_set`` and ``state_prediction`` (``intended``) of all readings that are not
    behind the watermark.  State: one number per distinct value and stored average, as those sets are.
    """
    if rule not in ("reference", "exact"):
        raise ValueError(f"median rule must be 'reference' or 'exact', not {rule!r}")
    require_rocksdb(measurements.sparkSession)
    schema = StructType([*[StructField(k, IntegerType()) for k in keys], StructField("kind", StringType()),
                         StructField("pane", LongType()), StructField("slice", IntegerType()), StructField("value", DoubleType()),
                         StructField("head_timestamp", IntegerType()), StructField("n", LongType())])
    rows = pane_values(measurements, keys, tf, pane_seconds, watermark, origin)
    before, upto = (None, None) if backfill is None else backfill
    if before is not None:
        before = pane_values(before, keys, tf, pane_seconds, watermark, origin)
    return advanced(rows, SetsAndPredictions(keys, pane_seconds, panes_per_window, rule, tables, upto), schema, before)


def median_prediction_stream(measurements: DataFrame, keys: Sequence[str], tf: int = DEFAULT_TF,
                             pane_seconds: int = DEFAULT_PANE_SECONDS,
                             panes_per_window: int = DEFAULT_PANES_PER_WINDOW, *, watermark: str,
                             rule: str = "reference", origin: int = ORIGIN_TS,
                             backfill: tuple[DataFrame, int] | None = None) -> DataFrame:
    """Predictions with the slice median as a stream: the columns of the batch ``state_prediction``."""
    got = sets_and_predictions(measurements, keys, tf, pane_seconds, panes_per_window, watermark=watermark, rule=rule,
                               origin=origin, tables=False, backfill=backfill)
    return got.select(*keys, "pane", "head_timestamp", "n", F.col("value").alias("predicted_load"),
                      F.col("slice").alias("target_slice"))


class LiveErrors(SetsAndPredictions):
    """Per key: the error of the least prediction of each slice against the slice's average so far.

    A slice has its plain sum and count over all readings of closed panes and the least prediction stored for it.  When
    either changes, the error is emitted anew as ``(pane, slice, predicted_load, avg_load, error)``: the last row of a slice holds.
    """

    columns = ("pane", "slice", "predicted_load", "avg_load", "error")

    def __init__(self, keys, pane_seconds, panes_per_window, rule, shift: int):
        super().__init__(keys, pane_seconds, panes_per_window, rule, tables=False)
        self.shift = shift  # slices from an average to the prediction it is compared with

    def init(self, handle):
        super().init(handle)
        self.report = handle.getMapState(
            "report", StructType([StructField("s", IntegerType())]), StructType([
                StructField("total", DoubleType()), StructField("n", LongType()), StructField("least", DoubleType())]))
        self.figures: dict[int, list] = {}  # of the key and call at hand: sum, count, least prediction for the slice
        self.changed: set[int] = set()

    def _figures(self, s: int) -> list:
        if s not in self.figures:
            self.figures[s] = list(self.report.getValue((s,)) or (0.0, 0, None))
        return self.figures[s]

    def advance(self, state, pane, rows, out):
        for s, part in groupby(rows, itemgetter(1)):
            part, f = list(part), self._figures(s)
            f[0] += sum(r[2] * r[3] for r in part)
            f[1] += sum(r[3] for r in part)
            self.changed.add(s)
        return super().advance(state, pane, rows, out)

    def emit(self, state, pane, out):
        made: list = []
        super().emit(state, pane, made)
        for _, _, target, load, _, _ in made:
            f = self._figures(target)
            if f[2] is None or load < f[2]:
                f[2] = load
                self.changed.add(target - self.shift)
        for s in sorted(self.changed):
            total, n, _ = self._figures(s)
            least = self._figures(s + self.shift)[2]
            if n and least is not None:
                out.append((pane, s, least, total / n, abs(least - total / n)))
        self.changed.clear()

    def save(self, state):
        super().save(state)
        for s, f in self.figures.items():
            self.report.updateValue((s,), tuple(f))
        self.figures.clear()

    def packed(self, key, out):
        return super().packed(key, list({r[1]: r for r in out}.values()))  # of one call the last figures of a slice


def live_errors(measurements: DataFrame, keys: Sequence[str], tf: int = DEFAULT_TF,
                pane_seconds: int = DEFAULT_PANE_SECONDS, panes_per_window: int = DEFAULT_PANES_PER_WINDOW, *,
                watermark: str, align: str = "reference", rule: str = "reference", origin: int = ORIGIN_TS) -> DataFrame:
    """``operators.quality.prediction_error`` as a stream: ``keys, pane, slice, predicted_load, avg_load, error``.

    A slice comes out again whenever its figures change; ``latest_errors`` keeps the last.
    """
    shift = {"reference": 1, "target": 0}.get(align)
    if shift is None:
        raise ValueError(f"align must be 'reference' or 'target', not {align!r}")
    require_rocksdb(measurements.sparkSession)
    schema = StructType([*[StructField(k, IntegerType()) for k in keys], StructField("pane", LongType()),
                         StructField("slice", IntegerType()),
                         *[StructField(c, DoubleType()) for c in ("predicted_load", "avg_load", "error")]])
    rows = pane_values(measurements, keys, tf, pane_seconds, watermark, origin)
    return advanced(rows, LiveErrors(keys, pane_seconds, panes_per_window, rule, shift), schema)


def latest_errors(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last row of each (key, slice) of ``live_errors``."""
    held = F.max_by(F.struct("predicted_load", "avg_load", "error"), "pane").alias("_held")
    return rows.groupBy(*keys, "slice").agg(held).select(*keys, "slice", "_held.*")


class Predictions(Panes):
    """Per key: a prediction per closed window with the head reading's own value as median (``as_run``)."""

    fields = ("pane", "total", "n", "head_ts", "head_id", "head_v", "head_s")
    columns = ("pane", "head_timestamp", "n", "predicted_load", "target_slice")

    def begin(self):
        return [0.0, 0]

    def advance(self, state, pane, rows, out):
        return [pane, *rows[0][1:]]

    def emit(self, state, pane, out):
        window = state[2]
        if window:
            state[3] += sum(e[1] for e in window)
            state[4] += sum(e[2] for e in window)
            head = min(window, key=head_order(3, 4))
            out.append((pane, head[3], state[4], (state[3] / state[4] + head[5]) / 2, head[6] + 1))


def prediction_stream(measurements: DataFrame, keys: Sequence[str], tf: int = DEFAULT_TF,
                      pane_seconds: int = DEFAULT_PANE_SECONDS,
                      panes_per_window: int = DEFAULT_PANES_PER_WINDOW,
                      *, watermark: str, origin: int = ORIGIN_TS) -> DataFrame:
    """Append-mode stream of predictions; same rows as the batch ``state_prediction`` (``as_run``) for every window
    that has closed."""
    require_rocksdb(measurements.sparkSession)
    p = prepared(valid_load(measurements), keys, tf, origin=origin).select(
        *keys, "v", head_key().alias("_hk"), F.timestamp_seconds("timestamp").alias("_et"))
    g = p.withWatermark("_et", watermark).groupBy(*keys, F.window("_et", f"{pane_seconds} seconds").alias("w")).agg(
        F.sum("v").alias("total"), F.count(F.lit(1)).alias("n"), F.min("_hk").alias("_hk"), F.min_by("v", "_hk").alias("head_v"))
    ts, rid = _head("_hk")
    rows = g.select(*keys, F.call_function("div", F.unix_seconds(F.col("w.start")), F.lit(pane_seconds)).alias("pane"), "total",
                    "n", ts.alias("head_ts"), rid.alias("head_id"), "head_v", time_slice(ts, tf, origin).alias("head_s"),
                    F.window_time("w").alias("_time"))
    schema = StructType([*[StructField(k, IntegerType()) for k in keys], StructField("pane", LongType()),
                         StructField("head_timestamp", IntegerType()), StructField("n", LongType()),
                         StructField("predicted_load", DoubleType()), StructField("target_slice", IntegerType())])
    return advanced(rows, Predictions(keys, pane_seconds, panes_per_window), schema)


class SlidingCounts(Panes):
    """Per key: the window's count, increased by each pane that enters and decreased by each that leaves."""

    fields = ("pane", "n")
    columns = ("pane", "n")

    def begin(self):
        return [0]

    def advance(self, state, pane, rows, out):
        n = sum(r[1] for r in rows)
        state[3] += n
        return [pane, n]

    def leave(self, state, entry):
        state[3] -= entry[1]

    def emit(self, state, pane, out):
        out.append((pane, state[3]))


def sliding_count_stream(rows: DataFrame, keys: Sequence[str], ts: str, panes_per_window: int, pane_seconds: int, *,
                         watermark: str, zero_panes: int = 0) -> DataFrame:
    """``operators.windows.sliding_counts`` as a stream: ``keys, pane, window_start, window_end, n``.

    ``zero_panes``: for how many panes a key is still emitted, with count 0, after its last row has left the window.  State:
    one number per key and live pane.
    """
    require_rocksdb(rows.sparkSession)
    et = event_time(ts, rows.schema[ts].dataType)
    per = rows.select(*keys, et.alias("_et")).withWatermark("_et", watermark).groupBy(
        *keys, F.window("_et", f"{pane_seconds} seconds").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    per = per.select(*keys, F.call_function("div", F.unix_seconds(F.col("w.start")), F.lit(pane_seconds)).alias("pane"), "n",
                     F.window_time("w").alias("_time"))
    schema = StructType([*[StructField(k, rows.schema[k].dataType) for k in keys], StructField("pane", LongType()),
                         StructField("n", LongType())])
    got = advanced(per, SlidingCounts(keys, pane_seconds, panes_per_window, zero_panes), schema)
    return got.select(*keys, "pane", ((F.col("pane") - (panes_per_window - 1)) * pane_seconds).alias("window_start"),
                      ((F.col("pane") + 1) * pane_seconds).alias("window_end"), "n")
