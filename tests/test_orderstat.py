"""The replay of the averages history equals a running-array window."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from loadlens.functions.stats import exact_median, shifted_median
from loadlens.operators import orderstat
from loadlens.operators.asof import asof_lookup
from loadlens.operators.averages import averages_history
from loadlens.operators.keys import HOUSE, PLUG
from loadlens.operators.measures import valid_load
from loadlens.operators.medians import median_history
from loadlens.sources.tables import load_measurements


def test_growing_set_small_cases():
    s, got, exact = orderstat.GrowingSet(), [], []
    for v in (1.0, 2.0, 3.0, 1.0, 5.0, 4.0):
        if s.add(v):
            got.append(s.median("reference"))
            exact.append(s.median("exact"))
    # sets: {1}, {1,2}, {1,2,3}, {1,2,3,5}, {1,2,3,4,5}
    assert got == [0.0, 0.0, 3.0, 4.0, 4.0] and exact == [1.0, 1.5, 2.0, 2.5, 3.0]


def test_growing_set_in_many_blocks(monkeypatch):
    import random

    monkeypatch.setattr(orderstat, "BLOCK", 3)
    r, s, seen = random.Random(5), orderstat.GrowingSet(), set()
    for _ in range(2000):
        v = float(r.randrange(700))
        assert s.add(v) == (v not in seen)
        seen.add(v)
        k = r.randrange(len(seen))
        assert s.size == len(seen) and s.kth(k) == sorted(seen)[k]
    assert s.kth(-1) is None and s.kth(s.size) is None and len(s.blocks) > 50


@pytest.mark.parametrize("keys,rule,pane", [(HOUSE, "reference", 300), (PLUG, "reference", 300), (HOUSE, "exact", 300),
                                            (HOUSE, "reference", 21600)])
def test_replay_equals_window(spark, keys, rule, pane):
    v, tf = valid_load(load_measurements(spark, SF_SMALL)), 3600
    w = Window.partitionBy(*keys, "s").orderBy("fp").rowsBetween(Window.unboundedPreceding, 0)
    arr = F.array_sort(F.collect_set("avg_load").over(w))
    win = averages_history(v, keys, tf, pane).select(*keys, "s", "fp", arr.alias("a")).select(
        *keys, "s", "fp", F.size("a").cast("long").alias("n"),
        (shifted_median if rule == "reference" else exact_median)(F.col("a")).alias("median"))
    rep = median_history(v, keys, tf, pane, rule)
    # every change pane of the window form looks up the same median in the replay
    looked = asof_lookup(win.select(*keys, "s", "fp"), rep, [*keys, "s"], "fp", "fp", ["median", "n"])
    j = win.join(looked.withColumnRenamed("median", "m2").withColumnRenamed("n", "n2"), [*keys, "s", "fp"])
    assert j.count() == win.count() > 0
    assert j.filter((F.abs(F.col("median") - F.col("m2")) > 1e-12) | (F.col("n") != F.col("n2"))).count() == 0


def test_replay_adds_no_sort_or_exchange(spark):
    import contextlib
    import io

    v = valid_load(load_measurements(spark, SF_SMALL))

    def plan(df):
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
        return buf.getvalue()

    before, after = plan(averages_history(v, HOUSE, 3600, 300)), plan(median_history(v, HOUSE, 3600, 300))
    assert after.count("Exchange") == before.count("Exchange") and after.count("Sort [") == before.count("Sort [")
