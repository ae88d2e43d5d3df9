"""Streams that keep state by pane: sorted sets in state, median predictions, rolling predictions, sliding counts."""

import bisect
import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from conftest import SF_SMALL
from loadlens.functions.output import finish
from loadlens.operators.keys import HOUSE, PLUG
from loadlens.operators.measures import load_only, valid_load
from loadlens.operators.predict import rolling_prediction, state_prediction
from loadlens.operators.windows import sliding_counts
from loadlens.sources.tables import load_measurements
from loadlens.streaming import panes
from loadlens.streaming.rolling import rolling_prediction_stream
from loadlens.streaming.sinks import batch_progress, materialize, partition_per_batch, run_bounded
from loadlens.streaming.sources import end_of_events, end_of_input

TF, K = 3600, 3


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """Each partition of a stateful step costs a worker and a state store: two are enough here."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


class FakeMap(dict):
    """The map state calls that ``SliceSets`` makes; counts block reads."""

    reads = 0

    def getValue(self, key):  # noqa: N802
        self.reads += 1
        return self.get(key)

    def updateValue(self, key, value):  # noqa: N802
        self[key] = value


class FakeHandle:
    """The states of one key; counts the calls that go to the state store."""

    def __init__(self):
        self.held, self.calls, self.maps = None, 0, {}

    def getValueState(self, name, schema):  # noqa: N802
        return self

    def getMapState(self, name, key, value):  # noqa: N802
        return self.maps.setdefault(name, FakeMap())

    def registerTimer(self, at):  # noqa: N802
        self.calls += 1

    def get(self):
        self.calls += 1
        return self.held

    def update(self, value):
        self.calls += 1
        self.held = value


class Closed:
    """A watermark behind all panes."""

    def getCurrentWatermarkInMs(self):  # noqa: N802
        return 10 ** 15


def reference_median(values, rule):
    n = len(values)
    if rule == "exact":
        return (values[(n - 1) // 2] + values[n // 2]) / 2 if n else 0.0
    at = (n // 2, n // 2 + 1) if n % 2 == 0 else ((n + 1) // 2,) * 2
    return (values[at[0]] + values[at[1]]) / 2 if at[1] < n else 0.0


@pytest.mark.parametrize("block", [1, 2, 5, 512])
def test_sets_in_state_equal_a_sorted_list(monkeypatch, block):
    monkeypatch.setattr(panes, "BLOCK", block)
    draw = random.Random(block)
    heads, blocks = FakeMap(), FakeMap()
    values, averages = [], []
    for _ in range(60):
        sets = panes.SliceSets(heads, blocks, 3)  # read anew, as in another batch
        some = sorted({round(draw.uniform(0, 30), 1) for _ in range(draw.randint(1, 6))})
        new, avg = sets.add(some)
        assert new == [v for v in some if v not in values]
        for v in new:
            bisect.insort(values, v)
        if new:
            want = float(f"{sum(values) / len(values):.9f}")
            if avg is not None:
                assert abs(avg - want) < 1e-6 and avg not in averages
                bisect.insort(averages, avg)
        sets.save()
        again = panes.SliceSets(heads, blocks, 3)
        assert [again.values.kth(k) for k in range(len(values))] == values and again.values.kth(len(values)) is None
        for rule in ("reference", "exact"):
            assert again.averages.median(rule) == reference_median(averages, rule)
    assert panes.SliceSets(heads, blocks, 4).values.size == 0


def test_a_position_reads_one_block(monkeypatch):
    monkeypatch.setattr(panes, "BLOCK", 10)
    heads, blocks = FakeMap(), FakeMap()
    sets = panes.SliceSets(heads, blocks, 0)
    sets.add([float(i) for i in range(1000)])
    sets.save()
    blocks.reads = 0
    assert panes.SliceSets(heads, blocks, 0).values.kth(503) == 503.0 and blocks.reads == 1


def same(got, want):
    want = want.select(*got.columns)
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


class Feed:
    """A folder that files arrive in: ``rows`` dealt to ``files`` files by a hash, so each has rows of all times."""

    def __init__(self, spark, rows, folder, files):
        self.rows, self.folder, self.files = rows.withColumn("_f", F.pmod(F.xxhash64(rows.columns[0]), F.lit(files))).cache(), folder, files
        rows.limit(0).write.parquet(folder)
        self.stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(folder)

    def arrive(self, n):
        self.rows.where(F.col("_f") == n).drop("_f").coalesce(1).write.mode("append").parquet(self.folder)


def test_small_sets_of_a_key_cost_two_calls_and_large_ones_are_moved(monkeypatch):
    """Per key and batch one read and one write while its sets are small; the same rows when they outgrow its state."""
    draw = random.Random(7)
    batches = []
    for first in (0, 40, 80):  # panes of a batch; a reading without an id is no head
        rows = {(p, draw.randrange(24), float(draw.randrange(1, 90))) for p in range(first, first + 40) for _ in range(4)}
        batches.append([Row("house_id", "row")(1, f"{p},{s},{v},{draw.randrange(1, 4)}," + draw.choice([",", f"{p * 21600},5"]))
                        for p, s, v in sorted(rows)])
    made, handles = [], []
    for kept in (panes.KEPT, 100, 0):
        monkeypatch.setattr(panes, "KEPT", kept)
        handle, out = FakeHandle(), []
        step = panes.SetsAndPredictions(["house_id"], 21600, K, "reference", True)
        step.types = [int, int, float, int, int, int]
        for rows in batches:
            step.init(handle)  # anew, as in another batch
            for got in step.handleInputRows((1,), iter(rows), Closed()):
                out += zip(*map(list, got[1:]))
        made.append(out)
        handles.append(handle)
    assert made[0] == made[1] == made[2] and {r[0] for r in made[0]} == {"measure", "average", "prediction"}
    small, _, moved = handles
    assert small.calls == 6 and not small.maps["slices"] and small.maps["slices"].reads == 0
    assert len(moved.maps["slices"]) == 24


@pytest.mark.parametrize("keys,pane,rule", [(HOUSE, 21600, "reference"), (PLUG, 3600, "exact")])
def test_median_predictions_equal_batch_over_shuffled_files(spark, tmp_path, keys, pane, rule):
    m = load_measurements(spark, SF_SMALL)
    feed = Feed(spark, m, str(tmp_path / "feed"), 4)
    for n in (2, 0, 3, 1):
        feed.arrive(n)
    last, end = end_of_input(spark, feed.stream)
    s = panes.median_prediction_stream(feed.stream.unionByName(last), keys, TF, pane, K, watermark="400 days", rule=rule)
    got = finish(materialize(spark, s, "append", "median", end))
    same(got, finish(state_prediction(valid_load(m), keys, TF, pane, K, "intended", rule)))


def test_median_predictions_in_event_time_order_with_restarts(spark, tmp_path):
    """Readings arrive in order, so panes close batch by batch, some by timers; each file is a new run of the query."""
    m = load_measurements(spark, SF_SMALL).where("house_id < 4")
    first, last_ts = m.agg(F.min("timestamp"), F.max("timestamp")).first()
    folder, out, ckpt = (str(tmp_path / x) for x in ("feed", "out", "ckpt"))
    m.limit(0).write.parquet(folder)
    stream = spark.readStream.schema(m.schema).parquet(folder)
    last, end = end_of_input(spark, stream)
    s = panes.median_prediction_stream(stream.unionByName(last), ["house_id"], TF, 21600, K, watermark="0 seconds")
    step = (last_ts - first) // 4 + 1
    closed = []
    for i in range(4):
        lo = first + i * step
        m.where(F.col("timestamp").between(lo, lo + step - 1)).coalesce(1).write.mode("append").parquet(folder)
        run_bounded(s, partition_per_batch(out), "append", ckpt)
        closed.append(spark.read.schema(s.schema).parquet(out).count())
    end()
    run_bounded(s, partition_per_batch(out), "append", ckpt)
    got = finish(spark.read.parquet(out).drop("batch_id"))
    assert 0 < closed[1] < closed[2] < closed[3] < got.count()  # rows come out as panes close, not at the end
    same(got, finish(state_prediction(valid_load(m), ["house_id"], TF, 21600, K, "intended")))


def test_backfilled_state_then_stream_equals_batch(spark, tmp_path):
    """The first half as initial state from a table, the rest streamed in two runs of the query."""
    m = load_measurements(spark, SF_SMALL).where("house_id < 5")
    folder, out, ckpt = (str(tmp_path / x) for x in ("feed", "out", "ckpt"))
    size = 21600
    lo, hi = m.agg(F.min("timestamp"), F.max("timestamp")).first()
    cut, mid = (lo + hi) // 2 // size, (lo + 3 * hi) // 4 // size  # last panes of the backfill and of the first run
    pane = F.expr(f"timestamp div {size}")
    m.limit(0).write.parquet(folder)
    stream = spark.readStream.schema(m.schema).parquet(folder)
    last, end = end_of_input(spark, stream)
    before = m.where(pane <= cut)
    s = panes.median_prediction_stream(stream.unionByName(last), ["house_id"], TF, size, K, watermark="0 seconds",
                                       backfill=(before, cut))
    m.where((pane > cut) & (pane <= mid)).coalesce(1).write.mode("append").parquet(folder)
    run_bounded(s, partition_per_batch(out), "append", ckpt)
    m.where(pane > mid).coalesce(1).write.mode("append").parquet(folder)
    run_bounded(s, partition_per_batch(out), "append", ckpt)
    end()
    run_bounded(s, partition_per_batch(out), "append", ckpt)
    got = finish(spark.read.parquet(out).drop("batch_id"))
    assert got.agg(F.min("pane")).first()[0] > cut
    want = finish(state_prediction(valid_load(m), ["house_id"], TF, size, K, "intended"))
    head = finish(state_prediction(valid_load(before), ["house_id"], TF, size, K, "intended")).where(F.col("pane") <= cut)
    same(head.unionByName(got.select(*head.columns)), want)


def test_live_errors_end_as_the_batch_report(spark, tmp_path):
    """Readings arrive in time order, so the report changes as panes close; its last rows are the batch report."""
    from loadlens.operators.averages import slice_avg
    from loadlens.operators.predict import prediction_set
    from loadlens.operators.quality import prediction_error, prediction_min

    m = load_measurements(spark, SF_SMALL).where("house_id < 4")
    folder, out, ckpt = (str(tmp_path / x) for x in ("feed", "out", "ckpt"))
    m.limit(0).write.parquet(folder)
    stream = spark.readStream.schema(m.schema).parquet(folder)
    last, end = end_of_input(spark, stream)
    s = panes.live_errors(stream.unionByName(last), ["house_id"], TF, 21600, K, watermark="0 seconds", align="target")
    mid = m.agg(F.expr("percentile(timestamp, 0.5)")).first()[0]
    for part in (F.col("timestamp") < mid, F.col("timestamp") >= mid):
        m.where(part).coalesce(1).write.mode("append").parquet(folder)
        run_bounded(s, partition_per_batch(out), "append", ckpt)
    end()
    run_bounded(s, partition_per_batch(out), "append", ckpt)
    rows = spark.read.parquet(out)
    got = finish(panes.latest_errors(rows, ["house_id"]))
    assert rows.count() > got.count()  # slices came out more than once
    valid = valid_load(m)
    pmin = prediction_min(prediction_set(state_prediction(valid, ["house_id"], TF, 21600, K, "intended"), ["house_id"], TF), ["house_id"])
    same(got, finish(prediction_error(pmin, slice_avg(valid, ["house_id"], TF), ["house_id"], "target")))


def test_rolling_predictions_equal_batch_over_restarts(spark, tmp_path):
    m = load_measurements(spark, SF_SMALL)
    feed = Feed(spark, m, str(tmp_path / "feed"), 4)
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    last, end = end_of_input(spark, feed.stream)
    s = rolling_prediction_stream(load_only(feed.stream.unionByName(last)), watermark="400 days")
    for n in (3, 1, 0, 2):
        feed.arrive(n)
        run_bounded(s, partition_per_batch(out), "append", ckpt)  # a new run each time
    end()
    run_bounded(s, partition_per_batch(out), "append", ckpt)
    same(finish(spark.read.parquet(out).drop("batch_id")), finish(rolling_prediction(load_only(m))))


def test_rolling_predictions_come_out_as_the_watermark_passes(spark, tmp_path):
    rows = [(i, 1_400_000_000 + t, float(v), 1, 0, 0, h, "x") for i, (t, v, h) in enumerate(
        [(5, 1, 1), (1, -4, 1), (3, 2, 1), (1, 8, 2), (40, 1, 1), (35, 9, 1), (100, 3, 2), (60, 5, 1), (61, 0, 2)])]
    m = spark.createDataFrame(rows, load_measurements(spark, SF_SMALL).select(
        "id", "timestamp", "value", "property", "plug_id", "household_id", "house_id", "hhp_id").schema)
    folder, out, ckpt = (str(tmp_path / x) for x in ("feed", "out", "ckpt"))
    m.limit(0).write.parquet(folder)
    stream = spark.readStream.schema(m.schema).parquet(folder)
    last, end = end_of_input(spark, stream)
    s = rolling_prediction_stream(load_only(stream.unionByName(last)), watermark="50 seconds", narrow=False, bucket_seconds=10)
    seen = []
    for lo, hi in ((0, 4), (4, 6), (6, 9)):
        m.where(F.col("id").between(lo, hi - 1)).coalesce(1).write.mode("append").parquet(folder)
        run_bounded(s, partition_per_batch(out), "append", ckpt)
        seen.append(spark.read.schema(s.schema).parquet(out).count())
    assert seen == [0, 0, 6]  # the newest is second 100: up to second 50 all are released, house 2 by its timer or its rows
    end()
    run_bounded(s, partition_per_batch(out), "append", ckpt)
    same(finish(spark.read.parquet(out).drop("batch_id")), finish(rolling_prediction(load_only(m), narrow=False)))


@pytest.mark.parametrize("zero_panes", [0, 2])
def test_sliding_counts_by_subtraction_equal_batch(spark, tmp_path, zero_panes):
    from loadlens.functions.timeslice import epoch_seconds, idiv

    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").select("event_type", "ts")
    feed = Feed(spark, ev.select("ts", "event_type"), str(tmp_path / "feed"), 4)
    for n in range(4):
        feed.arrive(n)
    stream = feed.stream.select("event_type", "ts")
    last, end = end_of_events(spark, stream)
    s = panes.sliding_count_stream(stream.unionByName(last), ["event_type"], "ts", 10, 600, watermark="400 days",
                                   zero_panes=zero_panes)
    got = materialize(spark, s, "append", "sliding", end)
    secs = epoch_seconds("ts", ev.schema["ts"].dataType)
    want = sliding_counts(ev.select("event_type", idiv(secs, 600).alias("_p")), ["event_type"], "_p", 10, 600)
    same(got.where("n > 0"), want)
    zeros = got.where("n = 0")
    assert (zeros.count() > 0) == (zero_panes > 0)
    # a key at zero is emitted in the panes right after its window emptied, at most ``zero_panes`` of them
    before = zeros.join(want.withColumnRenamed("pane", "p"), "event_type").where(f"pane - p between 1 and {zero_panes}")
    assert before.select("event_type", "pane").distinct().count() == zeros.count()
