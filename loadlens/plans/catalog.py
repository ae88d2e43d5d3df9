"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the driver's tables (``events`` as measurements,
``documents`` as text) over whole tables and whole texts.  Operators return
full-precision doubles; queries round double columns once, at the output
(``functions.output.finish``, 6 decimals) so engines that sum in a different order agree.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.functions.output import finish
from loadlens.functions.parsing import encode_csv, parse_csv, parse_regex
from loadlens.operators import averages as avg
from loadlens.operators import measures as ms
from loadlens.operators import medians as med
from loadlens.operators import predict as pr
from loadlens.operators import quality as q
from loadlens.operators import text as tx
from loadlens.operators import windows as wn
from loadlens.operators.keys import HOUSE, keys_of
from loadlens.sources.tables import (MEASUREMENT_COLUMNS, load_candidate_measurements, load_measurements, read_table)
from loadlens.session import scratch_path
from loadlens.sources.text import document_texts, union_sources

# Test parameters: slice size, pane length, panes per window.
TF = 3600
PANE = 21600
SHORT_PANE = 300  # several panes a slice
K = 3
SLICES = (1, 7, 60, 3600)
# Sliding event count: window length and slide in seconds.
EVENT_WINDOW = 6000
EVENT_SLIDE = 600
WIDE_PANES = 300  # panes per window of the wide form
# Sliding word count: messages (documents) per pane and panes per window.
DOCS_PER_PANE = 50
DOCS_PER_LONG_PANE = 500  # where words are kept at zero
WORD_PANES = 3
TUMBLE_SECONDS = 3600
FIRST = 5  # positions read from the head of each sorted set
# Delay of the prediction streams: covers files of the table arriving in any order.
STREAM_DELAY = "400 days"
# Domain bounds that cut: largest id, first and last slice.
CUT_ID = 4
CUT_SLICES = (6, 17)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def _m(spark, d):
    return load_measurements(spark, d)


def _v(spark, d):
    return ms.valid_load(load_candidate_measurements(spark, d))


def _loads(spark, d):
    return ms.load_only(load_candidate_measurements(spark, d, positive=False))


def _rows(df: DataFrame) -> DataFrame:
    return finish(df.select(*MEASUREMENT_COLUMNS))


# ---- filters, projections, parsing -------------------------------------------------

@query("valid_measurements")
def valid_measurements(spark, d):
    return _rows(_v(spark, d))


@query("load_measurements")
def load_measurements_q(spark, d):
    return _rows(_loads(spark, d))


@query("household_filter")
def household_filter(spark, d):
    return _rows(ms.household_filter(_m(spark, d), 0))


@query("domain_bounds")
def domain_bounds(spark, d):
    return _rows(ms.domain_bounds(_m(spark, d)))


@query("domain_bounds_cut")
def domain_bounds_cut(spark, d):
    m = ms.with_slices(_m(spark, d), [TF])
    return finish(ms.domain_bounds(m, CUT_ID, CUT_SLICES, f"slice_{TF}").select(*MEASUREMENT_COLUMNS, f"slice_{TF}"))


@query("plug_measurements")
def plug_measurements(spark, d):
    return finish(ms.plug_measurements(_v(spark, d)))


@query("house_measurements")
def house_measurements(spark, d):
    return finish(ms.house_measurements(_v(spark, d)))


@query("house_value_pairs")
def house_value_pairs(spark, d):
    return finish(ms.house_value_pairs(_m(spark, d)))


@query("plug_value_pairs")
def plug_value_pairs(spark, d):
    return finish(ms.plug_value_pairs(_loads(spark, d)))


@query("time_slice")
def time_slice_q(spark, d):
    return ms.with_slices(_m(spark, d).select("id", "timestamp"), SLICES)


def _csv_lines(spark, d) -> DataFrame:
    return _m(spark, d).select(encode_csv().alias("value"))


@query("encode_csv")
def encode_csv_q(spark, d):
    return _m(spark, d).select(F.lit(None).cast("string").alias("key"), encode_csv().alias("value"))


@query("parse_csv")
def parse_csv_q(spark, d):
    return _rows(parse_csv(_csv_lines(spark, d)))


def _faulty_lines(spark, d) -> DataFrame:
    """The encoded lines, with a fault in most that goes by the id (4 kinds are bad, 2 are good)."""
    line, kind = encode_csv(), F.pmod("id", F.lit(8))
    return _m(spark, d).select(
        F.when(kind == 1, F.regexp_replace(line, r",[^,]*$", ""))                           # six fields
        .when(kind == 2, F.regexp_replace(line, r"^([^,]*,[^,]*),[^,]*", "$1,inf"))         # not a float literal
        .when(kind == 3, F.regexp_replace(line, r"^([^,]*,[^,]*),[^,]*", "$1,+1e1f"))       # one that is
        .when(kind == 4, F.concat(F.lit("99999999999999999999"), line))                     # id beyond a long
        .when(kind == 5, F.concat(line, F.lit(",more")))                                    # an eighth field
        .when(kind == 6, F.regexp_replace(line, r"^([^,]*),", "$1 ,"))                      # blank in an integer
        .otherwise(line).alias("value"))


@query("parse_csv_faulty")
def parse_csv_faulty(spark, d):
    return _rows(parse_csv(_faulty_lines(spark, d)))


@query("parse_csv_rejects")
def parse_csv_rejects(spark, d):
    return parse_csv(_faulty_lines(spark, d), mode="reject")


@query("parse_regex")
def parse_regex_q(spark, d):
    return _rows(parse_regex(_csv_lines(spark, d)))


@query("union_sources")
def union_sources_q(spark, d):
    direct = _m(spark, d).select(*MEASUREMENT_COLUMNS)
    via_wire = parse_csv(_csv_lines(spark, d)).select(*MEASUREMENT_COLUMNS)
    return _rows(union_sources([direct, via_wire]))


# ---- aggregates and set tables -------------------------------------------------------

def _pred(spark, d, keys, source: str, pane: int = PANE) -> DataFrame:
    return pr.state_prediction(_v(spark, d), keys, TF, pane, K, source)


def _pred_set(spark, d, keys) -> DataFrame:
    """The set of predictions (intended median), not rounded.  ``jobs.energy`` stores it."""
    return pr.prediction_set(_pred(spark, d, keys, "intended"), keys, TF)


def _first_measures(spark, d, keys) -> DataFrame:
    """The first members of every measure set, read by position from a stored sorted set."""
    from loadlens.operators.ranks import numbered
    from loadlens.sinks.sorted_sets import SortedSets

    rows = avg.distinct_values(_v(spark, d), keys, TF)
    sets = SortedSets(spark, scratch_path(spark, "measure-sets"), [*keys, "s"], "v")
    sets.write(numbered(rows, [*keys, "s"], "v"))
    return sets.first(FIRST).select(*keys, F.col("s").alias("slice"), "rank", F.col("v").alias("value"))


def _register_level(level: str) -> None:
    """House and plug variants are one operator with a ``keys`` argument."""
    keys = keys_of(level)
    per_level: dict[str, Query] = {
        "slice_avg": lambda spark, d: finish(avg.slice_avg(_v(spark, d), keys, TF)),
        "distinct_avg": lambda spark, d: finish(avg.distinct_slice_avg(_v(spark, d), keys, TF)),
        "measure": lambda spark, d: finish(avg.measure_set(_v(spark, d), keys, TF)),
        "averages": lambda spark, d: finish(avg.averages_set(_v(spark, d), keys, TF, PANE)),
        "overall_avg": lambda spark, d: finish(avg.overall_avg(_v(spark, d), keys)),
        "overall_prediction": lambda spark, d: finish(avg.overall_prediction(_v(spark, d), keys)),
        "median_ref": lambda spark, d: finish(
            med.final_median(_v(spark, d), keys, TF, PANE, "reference", "averages")),
        "median_exact": lambda spark, d: finish(
            med.final_median(_v(spark, d), keys, TF, PANE, "exact", "averages")),
        "with_median": lambda spark, d: finish(med.with_median(_v(spark, d), keys, TF, PANE, K, "intended")),
        "with_median_as_run": lambda spark, d: finish(
            med.with_median(_v(spark, d), keys, TF, PANE, K, "as_run")),
        "state_prediction": lambda spark, d: finish(_pred(spark, d, keys, "intended")),
        "state_prediction_as_run": lambda spark, d: finish(_pred(spark, d, keys, "as_run")),
        "with_median_short": lambda spark, d: finish(
            med.with_median(_v(spark, d), keys, TF, SHORT_PANE, K, "intended")),
        "state_prediction_short": lambda spark, d: finish(_pred(spark, d, keys, "intended", SHORT_PANE)),
        "median_measures": lambda spark, d: finish(
            med.final_median(_v(spark, d), keys, TF, PANE, "reference", "measures")),
        "measure_card": lambda spark, d: avg.measure_card(_v(spark, d), keys, TF),
        "measure_sorted": lambda spark, d: finish(med.sorted_measures(_v(spark, d), keys, TF)),
        "measure_first": lambda spark, d: finish(_first_measures(spark, d, keys)),
        "prediction": lambda spark, d: finish(_pred_set(spark, d, keys)),
        "prediction_min": lambda spark, d: finish(q.prediction_min(_pred_set(spark, d, keys), keys)),
        "error": lambda spark, d: finish(q.prediction_error(
            q.prediction_min(_pred_set(spark, d, keys), keys),
            avg.slice_avg(_v(spark, d), keys, TF), keys, "reference")),
    }
    for suffix, fn in per_level.items():
        query(f"{level}_{suffix}")(fn)


for _level in ("house", "plug"):
    _register_level(_level)


@query("house_error_target")
def house_error_target(spark, d):
    pmin = q.prediction_min(_pred_set(spark, d, HOUSE), HOUSE)
    return finish(q.prediction_error(pmin, avg.slice_avg(_v(spark, d), HOUSE, TF), HOUSE, "target"))


# ---- windows and running state -------------------------------------------------------

@query("sliding_panes")
def sliding_panes(spark, d):
    return finish(pr.sliding_panes(_v(spark, d), HOUSE, PANE, K))


@query("batch_counts")
def batch_counts(spark, d):
    return wn.batch_counts(_m(spark, d), PANE)


@query("tumbling_house_sum")
def tumbling_house_sum(spark, d):
    return finish(wn.tumbling_sum(_m(spark, d), HOUSE, TUMBLE_SECONDS))


@query("rolling_prediction")
def rolling_prediction(spark, d):
    return finish(pr.rolling_prediction(_loads(spark, d), narrow=False))


@query("rolling_prediction_float")
def rolling_prediction_float(spark, d):
    return finish(pr.rolling_prediction(_loads(spark, d)))


def _event_panes(spark, d) -> DataFrame:
    from loadlens.functions.timeslice import epoch_seconds, idiv

    ev = read_table(spark, d, "events")
    secs = epoch_seconds("ts", ev.schema["ts"].dataType)
    return ev.select("event_type", idiv(secs, EVENT_SLIDE).alias("_pane"))


@query("sliding_event_count")
def sliding_event_count(spark, d):
    return wn.sliding_counts(_event_panes(spark, d), ["event_type"], "_pane", EVENT_WINDOW // EVENT_SLIDE, EVENT_SLIDE)


@query("sliding_event_count_wide")
def sliding_event_count_wide(spark, d):
    return wn.sliding_counts(_event_panes(spark, d), ["event_type"], "_pane", WIDE_PANES, EVENT_SLIDE)


# ---- text ---------------------------------------------------------------------------

@query("word_count")
def word_count(spark, d):
    return tx.word_count(document_texts(spark, d), keep_empty=True)


@query("word_count_nonempty")
def word_count_nonempty(spark, d):
    return tx.word_count(document_texts(spark, d), keep_empty=False)


@query("line_contains_counts")
def line_contains_counts(spark, d):
    return tx.line_contains_counts(document_texts(spark, d))


@query("sliding_word_count")
def sliding_word_count(spark, d):
    return tx.sliding_word_count(document_texts(spark, d), "doc_id", DOCS_PER_PANE, WORD_PANES)


@query("sliding_word_count_zeros")
def sliding_word_count_zeros(spark, d):
    return tx.sliding_word_count(document_texts(spark, d), "doc_id", DOCS_PER_LONG_PANE, WORD_PANES,
                                 keep_zeros=True)


__all__ = ["QUERIES", "finish"]


# ---- streaming forms (bounded availableNow runs, complete mode, read back) ----------

@query("stream_sliding_event_count")
def stream_sliding_event_count(spark, d):
    from loadlens.streaming import queries as sq
    from loadlens.streaming.sinks import materialize
    from loadlens.streaming.sources import stream_table

    g = sq.sliding_event_counts(stream_table(spark, d, "events"), EVENT_WINDOW, EVENT_SLIDE)
    return sq.finish_sliding_event_counts(materialize(spark, g, "complete", "sliding-events"), EVENT_SLIDE)


@query("stream_house_slice_avg")
def stream_house_slice_avg(spark, d):
    from loadlens.streaming import queries as sq
    from loadlens.streaming.sinks import materialize
    from loadlens.streaming.sources import stream_measurements

    g = sq.slice_avg_stream(stream_measurements(spark, d), HOUSE, TF)
    return finish(materialize(spark, g, "complete", "house-slice-avg"))


@query("stream_tumbling_house_sum")
def stream_tumbling_house_sum(spark, d):
    from loadlens.streaming import queries as sq
    from loadlens.streaming.sinks import materialize
    from loadlens.streaming.sources import stream_measurements

    g = sq.tumbling_sum_stream(stream_measurements(spark, d), HOUSE, TUMBLE_SECONDS)
    return finish(sq.finish_tumbling(materialize(spark, g, "complete", "tumbling"), HOUSE))


@query("stream_word_count")
def stream_word_count(spark, d):
    from loadlens.streaming import queries as sq
    from loadlens.streaming.sinks import materialize
    from loadlens.streaming.sources import stream_table

    # the documents table is one file: rebalance each batch before tokenizing
    docs = stream_table(spark, d, "documents", partitions=spark.sparkContext.defaultParallelism).select(
        F.col("text").alias("value"))
    return materialize(spark, sq.word_count_stream(docs), "complete", "word-count")


def _stream_prediction(level: str) -> Query:
    keys = keys_of(level)

    def run(spark, d):
        from loadlens.streaming.sinks import materialize
        from loadlens.streaming.sources import end_of_input, stream_measurements
        from loadlens.streaming.panes import prediction_stream

        m = stream_measurements(spark, d)
        last, end = end_of_input(spark, m)
        s = prediction_stream(m.unionByName(last), keys, TF, PANE, K, watermark=STREAM_DELAY)
        return finish(materialize(spark, s, "append", f"{level}-prediction", end))
    return run


def _stream_set(level: str, table: str) -> Query:
    keys = keys_of(level)

    def run(spark, d):
        from loadlens.streaming import sets
        from loadlens.streaming.sources import stream_measurements

        rows = sets.arrivals(stream_measurements(spark, d), TF, PANE)
        got = sets.insert_available(rows, scratch_path(spark, "arrivals"), scratch_path(spark, "arrivals-ckpt"))
        return finish(getattr(sets, f"{table}_set_of")(got, keys, TF))
    return run


for _level in ("house", "plug"):
    query(f"stream_{_level}_measure")(_stream_set(_level, "measure"))
    query(f"stream_{_level}_averages")(_stream_set(_level, "averages"))


# the end-of-input reading closes the last windows, so the result is that of the batch form
query("stream_house_state_prediction_as_run")(_stream_prediction("house"))
query("stream_plug_state_prediction_as_run")(_stream_prediction("plug"))


# ---- state kept in the engine: the table arrives in four files, each with rows of all times ----

def _feed(spark, d):
    """Measurements arriving over several triggers, and what ends the input."""
    from loadlens.sources.tables import measurements_from_events
    from loadlens.streaming.sources import arriving_in_files, end_of_input

    m = measurements_from_events(arriving_in_files(spark, read_table(spark, d, "events"), "event_id"))
    last, end = end_of_input(spark, m)
    return m.unionByName(last), end


def _stream_median_prediction(level: str) -> Query:
    keys = keys_of(level)

    def run(spark, d):
        from loadlens.streaming.panes import median_prediction_stream
        from loadlens.streaming.sinks import materialize

        m, end = _feed(spark, d)
        s = median_prediction_stream(m, keys, TF, PANE, K, watermark=STREAM_DELAY)
        return finish(materialize(spark, s, "append", f"{level}-median-prediction", end))
    return run


def _stream_processor(level: str) -> Query:
    keys = keys_of(level)

    def run(spark, d):
        from loadlens.streaming.processor import ProcessorTables

        m, end = _feed(spark, d)
        tables = ProcessorTables(spark, scratch_path(spark, "processor"), TF, PANE, K, STREAM_DELAY)
        checkpoint = scratch_path(spark, "processor-ckpt")
        tables.run_available(m, checkpoint)
        end()
        tables.run_available(m, checkpoint)
        return finish(pr.prediction_set(tables.predictions(level), keys, TF))
    return run


def _stream_averages_delta(level: str) -> Query:
    keys = keys_of(level)

    def run(spark, d):
        from loadlens.sources.tables import measurements_from_events
        from loadlens.streaming import sets
        from loadlens.streaming.history import AveragesHistory
        from loadlens.streaming.sinks import run_bounded
        from loadlens.streaming.sources import arriving_in_files

        m = measurements_from_events(arriving_in_files(spark, read_table(spark, d, "events"), "event_id"))
        kept = AveragesHistory(spark, scratch_path(spark, "history"), keys, slice_buckets=8, key_buckets=2)
        run_bounded(sets.arrivals(m, TF, PANE), kept.apply, "append", scratch_path(spark, "history-ckpt"))
        return finish(kept.averages(TF))
    return run


for _level in ("house", "plug"):
    query(f"stream_{_level}_averages_delta")(_stream_averages_delta(_level))
    query(f"stream_{_level}_state_prediction")(_stream_median_prediction(_level))
    query(f"stream_{_level}_prediction")(_stream_processor(_level))


@query("stream_house_error")
def stream_house_error(spark, d):
    from loadlens.streaming.panes import latest_errors, live_errors
    from loadlens.streaming.sinks import materialize

    m, end = _feed(spark, d)
    s = live_errors(m, HOUSE, TF, PANE, K, watermark=STREAM_DELAY)
    return finish(latest_errors(materialize(spark, s, "append", "live-error", end), HOUSE))


@query("stream_rolling_prediction")
def stream_rolling_prediction(spark, d):
    from loadlens.streaming.rolling import rolling_prediction_stream
    from loadlens.streaming.sinks import materialize

    m, end = _feed(spark, d)
    s = rolling_prediction_stream(ms.load_only(m), watermark=STREAM_DELAY)
    return finish(materialize(spark, s, "append", "rolling", end))


@query("stream_sliding_event_count_wide")
def stream_sliding_event_count_wide(spark, d):
    from loadlens.streaming.panes import sliding_count_stream
    from loadlens.streaming.sinks import materialize
    from loadlens.streaming.sources import arriving_in_files, end_of_events

    ev = arriving_in_files(spark, read_table(spark, d, "events").select("event_id", "event_type", "ts"), "event_id")
    ev = ev.select("event_type", "ts")
    last, end = end_of_events(spark, ev)
    s = sliding_count_stream(ev.unionByName(last), ["event_type"], "ts", WIDE_PANES, EVENT_SLIDE, watermark=STREAM_DELAY)
    return materialize(spark, s, "append", "sliding-wide", end)
