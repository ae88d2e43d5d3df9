"""Stream forms: stream = batch, restart from checkpoint, progress, idempotent sinks."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from loadlens.functions.parsing import encode_csv, parse_csv
from loadlens.operators.measures import valid_load
from loadlens.operators.predict import state_prediction
from loadlens.operators.windows import run_verdict
from loadlens.functions.output import finish
from loadlens.sources.tables import load_measurements
from loadlens.streaming.queries import word_count_stream
from loadlens.streaming.sinks import (batch_progress, overwrite_each_batch, partition_per_batch, read_set_table,
                                      run_bounded, set_table_sink)
from loadlens.streaming.sources import stream_lines
from loadlens.streaming.panes import prediction_stream

TF, P, K = 3600, 21600, 3


def _write_lines(path, lines):
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


def test_prediction_stream_equals_batch(spark, tmp_path):
    m = load_measurements(spark, SF_SMALL)
    rows = m.select("timestamp", encode_csv().alias("line")).orderBy("timestamp").collect()
    half = len(rows) // 2
    src = tmp_path / "in"
    src.mkdir()
    _write_lines(src / "part1.csv", [r.line for r in rows[:half]])
    _write_lines(src / "part2.csv", [r.line for r in rows[half:]])
    # sentinel: a reading far later, of a house not in the data, closes every window
    last = rows[-1].timestamp + 10 * 86400
    _write_lines(src / "part3.csv", [f"999999,{last},1.0,1,0,0,999"])

    parsed = parse_csv(stream_lines(spark, str(src), max_files_per_trigger=1))
    out = str(tmp_path / "out")
    q = run_bounded(prediction_stream(parsed, ["house_id"], TF, P, K, watermark="0 seconds"), partition_per_batch(out), "append",
                    str(tmp_path / "ckpt"))
    assert len(batch_progress(q)) >= 3
    got = finish(spark.read.parquet(out).drop("batch_id").filter(F.col("house_id") != 999))
    want = finish(state_prediction(valid_load(m), ["house_id"], TF, P, K, "as_run"))
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_word_count_restarts_from_checkpoint(spark, tmp_path):
    src, out, ckpt = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ckpt")
    src.mkdir()
    _write_lines(src / "a.txt", ["To be, or not to be", "that is the question"])
    counts = word_count_stream(stream_lines(spark, str(src)))
    q1 = run_bounded(counts, overwrite_each_batch(out), "complete", ckpt)
    first = {r.word: r.n for r in spark.read.parquet(out).collect()}
    assert first["to"] == 2 and first["be"] == 2
    assert run_verdict(sum(p["num_input_rows"] for p in batch_progress(q1))) == "PASSED"
    # new input after a restart: state resumes from the checkpoint
    _write_lines(src / "b.txt", ["To sleep, perchance to dream"])
    run_bounded(word_count_stream(stream_lines(spark, str(src))), overwrite_each_batch(out), "complete", ckpt)
    second = {r.word: r.n for r in spark.read.parquet(out).collect()}
    assert second["to"] == 4 and second["sleep"] == 1 and second["be"] == 2
    # nothing new: a further run reads no rows and changes nothing
    q3 = run_bounded(word_count_stream(stream_lines(spark, str(src))), overwrite_each_batch(out), "complete", ckpt)
    assert sum(p["num_input_rows"] for p in batch_progress(q3)) == 0
    assert {r.word: r.n for r in spark.read.parquet(out).collect()} == second


def test_set_table_sink_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "house_measure")
    batch = spark.createDataFrame([(1, 0, 5.0), (1, 0, 5.0), (1, 0, 6.0)], "slice int, house_id int, value double")
    write = set_table_sink(path, ["slice", "house_id", "value"])
    write(batch, 0)
    write(batch, 0)          # a replayed batch rewrites its own partition
    write(batch.limit(1), 1)
    got = sorted(r.value for r in read_set_table(spark, path, ["slice", "house_id", "value"]).collect())
    assert got == [5.0, 6.0]


def test_verdict():
    assert run_verdict(0) == "FAILED" and run_verdict(3) == "PASSED"


def test_progress_listener_and_text_sink(spark, tmp_path):
    import time

    from loadlens.streaming.sinks import ProgressRecorder

    src = tmp_path / "in"
    src.mkdir()
    _write_lines(src / "a.txt", ["x y", "z"])
    rec = ProgressRecorder()
    spark.streams.addListener(rec)
    try:
        out = str(tmp_path / "out")
        run_bounded(stream_lines(spark, str(src)), partition_per_batch(out, single_file=True, fmt="text"),
                    "append", str(tmp_path / "ckpt"))
        deadline = time.time() + 20
        while rec.total() < 2 and time.time() < deadline:
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(rec)
    assert rec.total() == 2 and run_verdict(rec.total()) == "PASSED"
    table = rec.to_dataframe(spark)
    assert table.agg(F.sum("num_input_rows")).first()[0] == 2
    assert sorted(r.value for r in spark.read.text(f"{out}/batch_id=0").collect()) == ["x y", "z"]


def test_progress_of_more_batches_than_are_held(spark, tmp_path):
    from types import SimpleNamespace

    from loadlens.streaming.sinks import ProgressRecorder

    rec = ProgressRecorder(3, spark, str(tmp_path / "progress"))
    for i in range(14):
        rec.onQueryProgress(SimpleNamespace(progress=SimpleNamespace(
            batchId=i, numInputRows=i, durationMs={"triggerExecution": 5}, processedRowsPerSecond=1.0)))
    assert len(rec.rows) < 6 and rec.total() == sum(range(14))
    assert sorted(r.batch_id for r in rec.to_dataframe(spark).collect()) == list(range(14))


def test_run_for_a_fixed_time(spark, tmp_path):
    from loadlens.streaming.sinks import run_for

    src = tmp_path / "in"
    src.mkdir()
    _write_lines(src / "a.txt", ["a b", "c"])
    out = str(tmp_path / "out")
    q = run_for(stream_lines(spark, str(src)), partition_per_batch(out), "append", str(tmp_path / "ckpt"),
                seconds=8, interval="1 second")
    assert not q.isActive
    assert spark.read.parquet(out).count() == 2


def test_empty_stream_gives_empty_result(spark, tmp_path):
    from loadlens.streaming.sinks import materialize

    src = tmp_path / "in"
    src.mkdir()
    out = materialize(spark, word_count_stream(stream_lines(spark, str(src))), "complete", "empty")
    assert out.count() == 0 and out.columns == ["word", "n"]
    appended = materialize(spark, stream_lines(spark, str(src)), "append", "empty-append")
    assert appended.count() == 0 and appended.columns == ["value"]


def test_sliding_counts_append_mode_equal_batch(spark, tmp_path):
    import datetime as dt

    from loadlens.functions.timeslice import epoch_seconds, idiv
    from loadlens.operators.windows import sliding_counts
    from loadlens.sources.tables import read_table
    from loadlens.streaming.queries import finish_sliding_event_counts, sliding_event_counts

    events = read_table(spark, SF_SMALL, "events").select("event_type", "ts")
    src = tmp_path / "events"
    events.write.parquet(str(src / "part=1"))
    last = events.agg(F.max("ts")).first()[0]
    sentinel = spark.createDataFrame([("sentinel", last + dt.timedelta(days=10))], "event_type string, ts timestamp_ntz")
    sentinel.write.parquet(str(src / "part=2"))
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(str(src / "*"))
    out = str(tmp_path / "out")
    run_bounded(sliding_event_counts(stream, 6000, 600, watermark="0 seconds"), partition_per_batch(out), "append",
                str(tmp_path / "ckpt"))
    got = finish_sliding_event_counts(spark.read.parquet(out).drop("batch_id"), 600).filter("event_type != 'sentinel'")
    secs = epoch_seconds("ts", events.schema["ts"].dataType)
    want = sliding_counts(events.select("event_type", idiv(secs, 600).alias("_p")), ["event_type"], "_p", 10, 600)
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_tumbling_sum_append_mode_equal_batch(spark, tmp_path):
    import datetime as dt

    from loadlens.operators.windows import tumbling_sum
    from loadlens.sources.tables import measurements_from_events, read_table
    from loadlens.streaming.queries import finish_tumbling, tumbling_sum_stream

    events = read_table(spark, SF_SMALL, "events")
    src = tmp_path / "events"
    events.write.parquet(str(src / "part=1"))
    last = events.agg(F.max("ts")).first()[0]
    sentinel = spark.createDataFrame([(10**9, last + dt.timedelta(days=10), 10**6, "view", 1.0, "{}")], events.schema)
    sentinel.write.parquet(str(src / "part=2"))
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(str(src / "*"))
    out = str(tmp_path / "out")
    g = tumbling_sum_stream(measurements_from_events(stream), ["house_id"], 3600, watermark="0 seconds")
    run_bounded(g, partition_per_batch(out), "append", str(tmp_path / "ckpt"))
    sentinel_house = 10**6 // 15
    got = finish(finish_tumbling(spark.read.parquet(out).drop("batch_id"), ["house_id"]).filter(
        F.col("house_id") != sentinel_house))
    want = finish(tumbling_sum(measurements_from_events(events), ["house_id"], 3600))
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_word_count_update_mode_latest_equals_batch(spark, tmp_path):
    from pyspark.sql import Window

    from loadlens.operators.text import word_count
    from loadlens.sources.text import literal_lines

    src = tmp_path / "in"
    src.mkdir()
    files = [["To be, or not to be", "that is the question"], ["Whether 'tis nobler", "to suffer; to be"]]
    for i, lines in enumerate(files):
        _write_lines(src / f"f{i}.txt", lines)
    out = str(tmp_path / "out")
    run_bounded(word_count_stream(stream_lines(spark, str(src), max_files_per_trigger=1)),
                partition_per_batch(out), "update", str(tmp_path / "ckpt"))
    upd = spark.read.parquet(out)
    assert upd.select("batch_id").distinct().count() == 2          # two batches, each with its changed words
    latest = upd.withColumn("_r", F.row_number().over(Window.partitionBy("word").orderBy(F.desc("batch_id"))))
    got = {r.word: r.n for r in latest.filter("_r = 1").collect()}
    want = {r.word: r.n for r in word_count(literal_lines(spark, [s for f in files for s in f]), keep_empty=False).collect()}
    assert got == want and got["to"] == 4


def test_slice_avg_update_mode_latest_equals_batch(spark, tmp_path):
    from pyspark.sql import Window

    from loadlens.operators.averages import slice_avg
    from loadlens.operators.measures import valid_load
    from loadlens.sources.tables import measurements_from_events, read_table
    from loadlens.streaming.queries import slice_avg_stream

    events = read_table(spark, SF_SMALL, "events")
    src = tmp_path / "events"
    ordered = events.orderBy("ts")
    n = events.count()
    ordered.limit(n // 2).write.parquet(str(src / "part=1"))
    ordered.subtract(ordered.limit(n // 2)).write.parquet(str(src / "part=2"))
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(str(src / "*"))
    out = str(tmp_path / "out")
    run_bounded(slice_avg_stream(measurements_from_events(stream), ["house_id"], 3600), partition_per_batch(out),
                "update", str(tmp_path / "ckpt"))
    upd = spark.read.parquet(out)
    w = Window.partitionBy("house_id", "slice").orderBy(F.desc("batch_id"))
    got = finish(upd.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r", "batch_id"))
    want = finish(slice_avg(valid_load(measurements_from_events(events)), ["house_id"], 3600))
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_table_stored_as_a_directory_streams_whole_in_any_order(spark, tmp_path):
    """Files arriving newest first, one per trigger: no reading is lost and the last windows close."""
    import os

    from loadlens.sources.tables import measurements_from_events
    from loadlens.streaming.sinks import materialize
    from loadlens.streaming.sources import end_of_input, stream_measurements

    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    table = tmp_path / "events.parquet"
    edges = events.approxQuantile("event_id", [i / 6 for i in range(7)], 0)
    for i in range(6):
        part = events.where((F.col("event_id") >= edges[i]) & ((F.col("event_id") < edges[i + 1]) | (i == 5)))
        part.coalesce(1).write.mode("append").parquet(str(table))
    files = sorted((f for f in os.listdir(table) if f.endswith(".parquet")),
                   key=lambda f: spark.read.parquet(str(table / f)).agg(F.min("ts")).first()[0], reverse=True)
    for n, f in enumerate(files):
        os.utime(table / f, (1_700_000_000 + n, 1_700_000_000 + n))
    m = stream_measurements(spark, str(tmp_path), max_files_per_trigger=1)
    last, end = end_of_input(spark, m)
    s = prediction_stream(m.unionByName(last), ["house_id"], 3600, 21600, 3, watermark="400 days")
    got = materialize(spark, s, "append", "shuffled", end)
    want = state_prediction(valid_load(measurements_from_events(events)), ["house_id"], 3600, 21600, 3)
    key = lambda df: sorted((r.house_id, r.pane, r.n, round(r.predicted_load, 6)) for r in df.collect())
    assert key(got) == key(want) and got.count() > 0


def test_stream_sets_in_any_order_with_compaction(spark, tmp_path):
    from loadlens.operators.averages import averages_set, measure_set
    from loadlens.operators.keys import HOUSE, PLUG
    from loadlens.operators.measures import valid_load
    from loadlens.sources.tables import load_measurements
    from loadlens.streaming import sets
    from loadlens.streaming.sinks import read_set_table, run_bounded, set_table_sink

    m = load_measurements(spark, SF_SMALL)
    feed, table, ckpt = (str(tmp_path / n) for n in ("feed", "table", "ckpt"))
    parts = m.withColumn("_d", F.expr("pmod(id, 5)")).cache()

    def same(a, b):
        b = b.select(*a.columns)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0

    def insert(n):
        parts.where(f"_d = {n}").drop("_d").coalesce(1).write.mode("append").parquet(feed)
        rows = sets.arrivals(spark.readStream.schema(m.schema).parquet(feed), 3600, 300)
        return sets.insert_available(rows, table, ckpt)

    for n in (4, 2, 0):
        insert(n)
    before = read_set_table(spark, table, sets.ARRIVAL)
    count = before.count()
    sets.compact(spark, table, 1)
    import os
    kept = sorted(int(n.split("=")[1]) for n in os.listdir(table) if n.startswith("batch_id="))
    assert kept == [-3, 2] and read_set_table(spark, table, sets.ARRIVAL).count() == count
    # a batch written again changes nothing
    set_table_sink(table, sets.ARRIVAL)(spark.read.parquet(f"{table}/batch_id=2"), 3)
    assert read_set_table(spark, table, sets.ARRIVAL).count() == count
    for n in (1, 3):
        got = insert(n)
    v = valid_load(m)
    for keys in (HOUSE, PLUG):
        same(sets.measure_set_of(got, keys, 3600), measure_set(v, keys, 3600))
        same(sets.averages_set_of(got, keys, 3600), averages_set(v, keys, 3600, 300))
    parts.unpersist()
