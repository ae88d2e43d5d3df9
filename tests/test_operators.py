"""Semantics on hand-made rows (FIXTURES.md section 4)."""

import pytest
from pyspark.sql import functions as F

from conftest import measurement_rows
from loadlens.functions.timeslice import ORIGIN_TS as O
from loadlens.operators import averages as avg
from loadlens.operators import measures as ms
from loadlens.operators import medians as med
from loadlens.operators import predict as pr
from loadlens.operators import quality as q
from loadlens.operators.asof import asof_lookup
from loadlens.operators.keys import HOUSE, PLUG
from loadlens.operators.ranks import ranked
from loadlens.operators.windows import sliding_counts


def test_validity_edges(spark):
    rows = [(1, O, 0.0, 1, 0, 0, 0), (2, O, -1.0, 1, 0, 0, 0), (3, O, float("nan"), 1, 0, 0, 0),
            (4, O, float("inf"), 1, 0, 0, 0), (5, O, 2.0, 0, 0, 0, 0), (6, O, 2.0, 1, 0, 0, 0),
            (7, O, 2.0, 2, 0, 0, 0)]
    m = measurement_rows(spark, rows)
    assert sorted(r.id for r in ms.valid_load(m).collect()) == [4, 6]
    assert sorted(r.id for r in ms.load_only(m).collect()) == [1, 2, 3, 4, 6]


def test_composite_id_stays_apart(spark):
    m = measurement_rows(spark, [(1, O, 1.0, 1, 2, 11, 1), (2, O, 2.0, 1, 2, 1, 11)])
    out = avg.overall_avg(m, PLUG).collect()
    assert sorted(r.hhp_id for r in out) == ["11:1:2", "1:11:2"]


def test_set_semantics(spark):
    # one value three times in one slice counts once; the same value in two slices counts in each
    m = measurement_rows(spark, [(1, O, 5.0, 1, 0, 0, 0), (2, O, 5.0, 1, 0, 0, 0), (3, O, 5.0, 1, 0, 0, 0),
                                 (4, O + 1, 5.0, 1, 0, 0, 0), (5, O, 7.0, 1, 0, 0, 0)])
    card = {r.slice: r.card for r in avg.measure_card(m, HOUSE, 1).collect()}
    assert card == {0: 2, 1: 1}
    plain = {r.slice: (r.n, r.avg_load) for r in avg.slice_avg(m, HOUSE, 1).collect()}
    assert plain[0] == (4, 5.5)
    dist = {r.slice: r.avg_load for r in avg.distinct_slice_avg(m, HOUSE, 1).collect()}
    assert dist[0] == 6.0


def test_day_folding(spark):
    m = measurement_rows(spark, [(1, O + 10, 1.0, 1, 0, 0, 0), (2, O + 86400 + 10, 3.0, 1, 0, 0, 0)])
    out = avg.slice_avg(m, HOUSE, 1).collect()
    assert [(r.slice, r.n, r.avg_load) for r in out] == [(10, 2, 2.0)]


def test_averages_history_and_median(spark):
    # pane 10 s; values arrive in three panes of slice 0 (tf = 60)
    rows = [(1, O, 1.0, 1, 0, 0, 0), (2, O + 10, 3.0, 1, 0, 0, 0), (3, O + 20, 5.0, 1, 0, 0, 0),
            (4, O + 30, 1.0, 1, 0, 0, 0)]
    m = measurement_rows(spark, rows)
    h = sorted((r.fp, r.avg_load) for r in avg.averages_history(m, HOUSE, 60, 10).collect())
    p0 = O // 10
    assert h == [(p0, 1.0), (p0 + 1, 2.0), (p0 + 2, 3.0)]   # the repeated 1.0 adds nothing
    mh = sorted((r.fp, r.n, r.median) for r in med.median_history(m, HOUSE, 60, 10).collect())
    assert mh == [(p0, 1, 0.0), (p0 + 1, 2, 0.0), (p0 + 2, 3, 3.0)]
    fin = med.final_median(m, HOUSE, 60, 10, "exact").collect()
    assert [(r.n, r.median) for r in fin] == [(3, 2.0)]
    raw = med.final_median(m, HOUSE, 60, 10, "reference", over="measures").collect()
    assert [(r.n, r.median) for r in raw] == [(3, 5.0)]


def test_asof_lookup_takes_latest_at_or_before(spark):
    probes = spark.createDataFrame([(1, 5), (1, 7), (1, 2), (2, 9)], "k int, t long")
    hist = spark.createDataFrame([(1, 3, 10.0), (1, 7, 20.0), (2, 10, 1.0)], "k int, f long, val double")
    got = {(r.k, r.t): r.val for r in asof_lookup(probes, hist, ["k"], "t", "f", ["val"]).collect()}
    assert got == {(1, 5): 10.0, (1, 7): 20.0, (1, 2): None, (2, 9): None}


def test_ranked_exact_with_many_buckets(spark):
    df = spark.range(0, 500).select((F.col("id") % 3).alias("g"), ((F.col("id") * 7919) % 1009).cast("double").alias("v")).distinct()
    r = ranked(df, ["g"], "v", 16)
    for g in range(3):
        rows = sorted((x.rank, x.v) for x in r.filter(F.col("g") == g).collect())
        assert [k for k, _ in rows] == list(range(len(rows)))
        assert [v for _, v in rows] == sorted(v for _, v in rows)


def test_rolling_prediction_signs_and_narrowing(spark):
    m = measurement_rows(spark, [(1, O, -4.0, 1, 0, 0, 0), (2, O + 1, 10.0, 1, 0, 0, 0), (3, O + 2, 0.1, 1, 0, 0, 0)])
    out = {r.id: r.predicted_load for r in pr.rolling_prediction(ms.load_only(m), narrow=False, target_rows=1).collect()}
    # row 1: avg -4, prior sum 0 -> +|-0.04|: (-4 + 0.04) / 2
    assert out[1] == pytest.approx((-4 + 0.04) / 2)
    # row 2: avg 3, prior -4 < 0 -> -0.03
    assert out[2] == pytest.approx((3 - 0.03) / 2)
    avg3 = (-4 + 10 + float(__import__("numpy").float32(0.1))) / 3
    assert out[3] == pytest.approx((avg3 + abs(avg3 * 0.01)) / 2)
    narrow = {r.id: r.predicted_load for r in pr.rolling_prediction(ms.load_only(m), narrow=True).collect()}
    assert narrow[3] == pytest.approx(out[3], rel=1e-6) and narrow[3] != out[3]


def test_state_prediction_counts_window_copies(spark):
    # two readings in consecutive panes (P = 10, K = 3): windows see 1, 2, 2, 1 readings
    m = measurement_rows(spark, [(1, O, 2.0, 1, 0, 0, 0), (2, O + 10, 4.0, 1, 0, 0, 0)])
    out = sorted((r.pane, r.n, r.predicted_load, r.target_slice)
                 for r in pr.state_prediction(m, HOUSE, 1, 10, 3, "as_run").collect())
    assert [n for _, n, _, _ in out] == [1, 3, 5, 6]
    # pane 0: total 2, n 1, head value 2 -> 2;  pane 1: total 8, n 3, head value 2 -> (8/3 + 2)/2
    assert out[0][2] == 2.0 and out[1][2] == pytest.approx((8 / 3 + 2) / 2)
    # head of the last window is the later reading
    assert out[3][2] == pytest.approx((18 / 6 + 4) / 2) and out[3][3] == 11


def test_day_end_target_slice_is_not_wrapped(spark):
    m = measurement_rows(spark, [(1, O + 86399, 2.0, 1, 0, 0, 0)])
    out = pr.state_prediction(m, HOUSE, 1, 10, 3, "intended").collect()
    assert {r.target_slice for r in out} == {86400}
    # history of one value: shifted median is 0.0, so the intended prediction is avg / 2
    assert {r.predicted_load for r in out} == {1.0}


def test_error_alignment(spark):
    pmin = spark.createDataFrame([(1, 0, 5.0)], "target_slice int, house_id int, predicted_load double")
    avgs = spark.createDataFrame([(0, 0, 3.0), (0, 1, 9.0)], "house_id int, slice int, avg_load double")
    ref = q.prediction_error(pmin, avgs, HOUSE, "reference").collect()
    assert [(r.slice, r.error) for r in ref] == [(0, 2.0)]
    tgt = q.prediction_error(pmin, avgs, HOUSE, "target").collect()
    assert [(r.slice, r.error) for r in tgt] == [(1, 4.0)]


def test_domain_bounds(spark):
    m = measurement_rows(spark, [(1, O, 1.0, 1, 0, 0, 0), (2, O, 1.0, 1, 41, 0, 0), (3, O, 1.0, 1, 0, 0, 40)])
    assert sorted(r.id for r in ms.domain_bounds(m).collect()) == [1, 3]


def test_sliding_counts_keep_zeros(spark):
    from loadlens.operators.windows import sliding_counts

    rows = spark.createDataFrame([("a", 0), ("a", 0), ("b", 3)], "k string, p long")
    plain = sorted((r.k, r.pane, r.n) for r in sliding_counts(rows, ["k"], "p", 2).collect())
    assert plain == [("a", 0, 2), ("a", 1, 2), ("b", 3, 1), ("b", 4, 1)]
    zeros = sorted((r.k, r.pane, r.n) for r in sliding_counts(rows, ["k"], "p", 2, keep_zeros=True).collect())
    assert zeros == [("a", 0, 2), ("a", 1, 2), ("a", 2, 0), ("a", 3, 0), ("a", 4, 0), ("b", 3, 1), ("b", 4, 1)]


def test_text_file_batch_scan_and_parse(spark, tmp_path):
    from loadlens.functions.parsing import parse_csv
    from loadlens.operators.text import line_contains_counts
    from loadlens.sources.text import text_lines

    f = tmp_path / "sample.csv"
    f.write_text("1,1377986401,68.451,0,11,0,0\nbad line\n2,1377986402,1.5,1,2,3,4\n")
    lines = text_lines(spark, str(f), min_partitions=2)
    assert lines.rdd.getNumPartitions() >= 2
    assert sorted(r.id for r in parse_csv(lines).collect()) == [1, 2]
    counts = line_contains_counts(lines).first()
    assert (counts.lines_with_a, counts.lines_with_b) == (1, 1)


def test_ranked_spreads_a_hot_group(spark):
    # one group with all rows lies in all partitions of the sort, and its ranks go on across them
    from loadlens.operators import ranks

    df = spark.range(0, 20000).select(F.lit(1).alias("g"), (F.col("id") * 1.5).alias("v"))
    sizes = ranks.numbered(df, ["g"], "v", 16).groupBy("_part").count()
    assert sizes.count() >= 12 and sizes.agg(F.max("count")).first()[0] <= 3 * 20000 / 16
    r = ranks.ranked(df, ["g"], "v", 16)
    assert r.where(F.col("rank") * 1.5 != F.col("v")).count() == 0 and r.count() == 20000


def test_cluster_conf_sizes_partitions():
    from loadlens.session import cluster_conf

    big = cluster_conf(100 * 10**12, cores=4000)
    assert int(big["spark.sql.shuffle.partitions"]) == 60_000
    assert big["spark.sql.autoBroadcastJoinThreshold"] == "-1"          # no static, size-unchecked broadcast
    assert int(big["spark.sql.adaptive.autoBroadcastJoinThreshold"]) == 64 << 20
    small = cluster_conf(10 << 20, cores=8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16


def test_sql_views_match_the_dataframe_query(spark):
    from conftest import SF_SMALL
    from loadlens.plans.catalog import QUERIES
    from loadlens.plans.sql import register

    register(spark, SF_SMALL)
    via_sql = spark.sql("""SELECT house_id, time_slice(timestamp, 3600) AS slice, count(*) AS n,
                                  round(avg(CAST(value AS DOUBLE)), 6) AS avg_load
                           FROM valid_measurements GROUP BY 1, 2""")
    via_df = QUERIES["house_slice_avg"](spark, SF_SMALL)
    assert via_sql.exceptAll(via_df).count() == 0 and via_df.exceptAll(via_sql).count() == 0


def test_exact_median_over_raw_measures(spark):
    # distinct readings {1, 2, 4, 8} in one slice (8 arrives twice): exact median 3.0, reference rule 6.0
    rows = [(i, O + i, float(v), 1, 0, 0, 0) for i, v in enumerate([1, 2, 4, 8, 8])]
    m = measurement_rows(spark, rows)
    exact = med.final_median(m, HOUSE, 60, 10, "exact", over="measures").collect()
    assert [(r.n, r.median) for r in exact] == [(4, 3.0)]
    ref = med.final_median(m, HOUSE, 60, 10, "reference", over="measures").collect()
    assert [(r.n, r.median) for r in ref] == [(4, 6.0)]


@pytest.mark.parametrize("block", [1, 3, 7, 4096])
@pytest.mark.parametrize("size", [1, 4, 25])
def test_sliding_counts_do_not_depend_on_blocks(spark, block, size):
    # two thirds of the rows under one key, panes below zero, gaps longer than a window and than a block
    rows = [("hot", p) for p in range(-12, 40) for _ in range(3)] + [("rare", p) for p in (-11, 0, 1, 17, 60, 61)]
    df = spark.createDataFrame(rows, "k string, p long")
    got = {(r.k, r.pane): r.n for r in sliding_counts(df, ["k"], "p", size, block_panes=block).collect()}
    want = {}
    for k, p in rows:
        for q in range(p, p + size):
            want[k, q] = want.get((k, q), 0) + 1
    assert got == want


@pytest.mark.parametrize("zeros", [False, True])
@pytest.mark.parametrize("block", [1, 7, 4096])
def test_sliding_word_counts_do_not_depend_on_blocks(spark, block, zeros):
    from loadlens.operators.text import sliding_word_count

    docs = [(0, "a b a"), (1, ""), (5, "b  c"), (5, "b"), (9, None), (14, "d"), (40, "a"), (41, "   "), (None, "e a"), (44, "c")]
    df = spark.createDataFrame(docs, "doc_id long, value string")
    got = {(r.word, r.pane): r.n for r in sliding_word_count(df, "doc_id", 3, 4, keep_zeros=zeros, block_offsets=block).collect()}
    want = {}
    toks = [(w, d // 3) for d, t in docs if d is not None and t is not None and t != "   " for w in t.split(" ")]
    for w, p in toks:
        for q in range(p, p + 4):
            want[w, q] = want.get((w, q), 0) + 1
    if zeros:
        end = max(p for _, p in toks) + 4
        want = {(w, q): want.get((w, q), 0) for w in {w for w, _ in toks} for q in range(min(p for x, p in toks if x == w), end)}
    assert got == want


def test_words_at_zero_take_few_bytes_a_row(spark, tmp_path):
    import pyarrow.parquet as pq

    from loadlens.operators.text import sliding_word_count

    # 400 words in 40 texts, then none for 4,000 panes: nearly all rows are at zero
    docs = [(7 * i, " ".join(f"w{i}x{j}" for j in range(10))) for i in range(40)] + [(4000, "last")]
    df = spark.createDataFrame(docs, "doc_id long, value string").coalesce(1)
    sliding_word_count(df, "doc_id", 1, 3, keep_zeros=True, block_offsets=8).write.parquet(f"{tmp_path}/out")
    files = [pq.ParquetFile(f).metadata for f in (tmp_path / "out").glob("*.parquet")]
    rows = sum(m.num_rows for m in files)
    assert rows == sum(10 * (4003 - 7 * i) for i in range(40)) + 3
    columns = [m.row_group(g).column(c) for m in files for g in range(m.num_row_groups) for c in range(m.num_columns)]
    assert sum(c.total_compressed_size for c in columns) < rows / 2


@pytest.mark.parametrize("block", [1, 2, 4096])
def test_running_total_does_not_depend_on_blocks(spark, block):
    from loadlens.operators.windows import batch_counts

    df = spark.createDataFrame([(t,) for t in (0, 1, 9, 10, 35, 36, 37, 99, 100)], "timestamp int")
    got = [(r.pane, r.n, r.running_total) for r in batch_counts(df, 10, block_panes=block).orderBy("pane").collect()]
    assert got == [(0, 3, 3), (1, 1, 4), (3, 3, 7), (9, 1, 8), (10, 1, 9)]


def test_lookup_repeats_only_the_rows_of_large_keys(spark):
    from loadlens.operators.salt import salted_lookup

    rows = spark.range(1000).select(F.when(F.col("id") < 700, 0).otherwise(F.col("id")).alias("k"), "id")
    table = rows.select("k").distinct().withColumn("x", F.col("k") * 2)
    sizes = rows.groupBy("k").agg(F.count(F.lit(1)).alias("_rows"))
    got = salted_lookup(rows, table, ["k"], ["id"], sizes, rows_per_task=100)
    assert got.count() == 1000 and got.where("x != 2 * k").count() == 0
    # the large key is dealt out, the 300 others are neither salted nor repeated
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        got.explain()
    assert "explode(sequence(0, (coalesce(_salts" in buf.getvalue() and "0, 31" not in buf.getvalue()


@pytest.mark.parametrize("size", [1, 3, 5])
def test_attached_medians_equal_a_plain_replay(spark, size):
    from loadlens.operators.medians import with_median
    from loadlens.operators.orderstat import GrowingSet
    from loadlens.operators.measures import prepared

    rows = [(i, 1377986401 + t, float(v), 1, 0, 0, h) for i, (h, t, v) in enumerate(
        [(1, 0, 5), (1, 3, 9), (1, 10, 5), (1, 21, 7), (1, 22, 1), (1, 65, 4), (1, 66, 4), (1, 3599, 2), (1, 3600, 8), (2, 40, 3), (2, 41, 3)])]
    valid = measurement_rows(spark, rows)
    got = sorted((r.house_id, r.id, r.pane, r.median) for r in with_median(valid, ["house_id"], 3600, 10, size, "intended").collect())
    p = prepared(valid, ["house_id"], 3600, 10).collect()
    want = []
    for r in p:
        for pane in range(r.p0, r.p0 + size):
            values, stored = set(), GrowingSet()
            for q in sorted({x.p0 for x in p if (x.house_id, x.s) == (r.house_id, r.s) and x.p0 <= pane}):
                new = {x.v for x in p if (x.house_id, x.s, x.p0) == (r.house_id, r.s, q)} - values
                values |= new
                if new:
                    stored.add(round(sum(values) / len(values), 6))
            want.append((r.house_id, r.id, pane, stored.median("reference")))
    assert got == sorted(want)
