"""Stored sorted sets: positions, ranges and heads against sorted lists, and what their reads touch."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from loadlens.operators.ranks import numbered
from loadlens.sinks.sorted_sets import SortedSets


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    # group (0, 0) holds most rows and spans partitions; others are small
    rows = [(0, 0, (i * 7919 % 10007) / 4) for i in range(6000)] + [(g, h, float(v)) for g in (0, 1, 2) for h in (1, 2) for v in range(g, 40)]
    df = spark.createDataFrame(rows, "g int, h int, v double").distinct()
    sets = SortedSets(spark, str(tmp_path_factory.mktemp("sets") / "s"), ["g", "h"], "v")
    sets.write(numbered(df, ["g", "h"], "v", 12), row_group_bytes=4096)
    want = {}
    for g, h, v in sorted({(g, h, v) for g, h, v in rows}):
        want.setdefault((g, h), []).append(v)
    return sets, want


def test_ranges_equal_lists(stored):
    sets, want = stored
    assert len({b["_part"] for b in sets.blocks().where("g = 0 and h = 0").collect()}) >= 5
    for key in ((0, 0), (1, 2)):
        vals = want[key]
        assert sets.card(key) == len(vals)
        for a, b in ((0, 0), (0, -1), (3, 7), (-5, -1), (len(vals) - 2, len(vals) + 9), (len(vals), len(vals)), (5, 2), (-10 ** 6, 1)):
            got = [(r["rank"], r["v"]) for r in sets.range(key, a, b).orderBy("rank").collect()]
            n = len(vals)
            lo, hi = (max(0, a + n) if a < 0 else a), (b + n if b < 0 else b)
            assert got == [(i, vals[i]) for i in range(lo, min(hi, n - 1) + 1)], (key, a, b)
        assert sets.rank_of(key, vals[17]) == 17 and sets.rank_of(key, -1.0) is None and sets.rank_of(key, vals[3] + 1e-9) is None
    assert sets.card((9, 9)) == 0 and sets.range((9, 9), 0, -1).count() == 0


def test_whole_tables_equal_lists(stored):
    sets, want = stored
    got = {(r.g, r.h, r.v): r["rank"] for r in sets.ranked().collect()}
    assert got == {(*k, v): i for k, vals in want.items() for i, v in enumerate(vals)}
    assert {(r.g, r.h): r.n for r in sets.cards().collect()} == {k: len(v) for k, v in want.items()}
    assert {(r.g, r.h): r.v for r in sets.heads().collect()} == {k: v[0] for k, v in want.items()}
    first = {(r.g, r.h, r["rank"]): r.v for r in sets.first(3).collect()}
    assert first == {(*k, i): v for k, vals in want.items() for i, v in enumerate(vals[:3])}


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def test_reads_need_no_exchange_and_skip_row_groups(stored):
    sets, want = stored
    one = sets.range((0, 0), 4000, 4003)
    assert "Exchange" not in plan(one) and "PushedFilters: [" in plan(one) and "_place" in plan(one).split("PushedFilters")[1]
    assert "Exchange" not in plan(sets.heads())
    assert "Exchange hashpartitioning" not in plan(sets.ranked()) and "Exchange hashpartitioning" not in plan(sets.first(2))
    one.collect()
    scans, todo = [], [one._jdf.queryExecution().executedPlan()]
    while todo:
        p = todo.pop()
        if p.metrics().contains("numFiles"):
            scans.append(p.metrics().apply("numOutputRows").value())
        todo += [p.children().apply(i) for i in range(p.children().size())]
    assert sum(scans) < 1500 < len(want[0, 0])  # one partition's folder at most, and of it some row groups


def test_ranks_of_a_third_in_one_group_use_one_exchange_of_rows(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id").cast("int")).alias("g"), F.col("id").cast("double").alias("v"))
    assert plan(numbered(df, ["g"], "v")).count("Exchange") == 1
