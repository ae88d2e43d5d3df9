"""Property tests: Spark expressions against plain-Python models of the same rules.

Each test draws a batch of cases and checks them in one Spark job.
"""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loadlens.functions import ORIGIN_TS, java_split, shifted_median, time_slice
from loadlens.operators.ranks import ranked

TFS = (1, 7, 60, 3600, 5000, 86400)
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def py_div(a: int, b: int) -> int:
    """Integer division truncating toward zero (JVM int division)."""
    q = abs(a) // abs(b)
    return q if (a >= 0) == (b > 0) else -q


def py_time_slice(ts: int, tf: int) -> int:
    r = ts - ORIGIN_TS
    days = py_div(r, 86400)
    return py_div(r, tf) - days * py_div(86400, tf) if days > 0 else py_div(r, tf)


def py_java_split(s: str, pattern: str) -> list[str]:
    """java.lang.String.split(regex): no match -> [s]; trailing empty strings dropped."""
    if re.search(pattern, s) is None:
        return [s]
    parts = re.split(pattern, s)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def py_shifted(values: list[float]) -> float:
    a = sorted(set(values))
    n = len(a)
    if n % 2 == 0:
        i, j = n // 2, n // 2 + 1
        return (a[i] + a[j]) / 2 if j < n else 0.0
    i = (n + 1) // 2
    return a[i] if i < n else 0.0


@SETTINGS
@given(st.lists(st.tuples(st.integers(ORIGIN_TS - 20 * 86400, ORIGIN_TS + 800 * 86400),
                          st.sampled_from(TFS)), min_size=1, max_size=200))
def test_time_slice_matches_model(spark, cases):
    df = spark.createDataFrame(cases, "ts long, tf int")
    expr = None
    for tf in TFS:
        e = time_slice("ts", tf)
        expr = F.when(F.col("tf") == tf, e) if expr is None else expr.when(F.col("tf") == tf, e)
    got = [r.s for r in df.select(expr.alias("s")).collect()]
    assert got == [py_time_slice(ts, tf) for ts, tf in cases]


@SETTINGS
@given(st.lists(st.text(alphabet="ab !,-\n", max_size=12), min_size=1, max_size=60))
def test_jvm_split_matches_model(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    rows = df.select(java_split(F.col("s"), r"\W+").alias("w"), java_split(F.col("s"), " ").alias("sp")).collect()
    assert [r.w for r in rows] == [py_java_split(t, r"[^A-Za-z0-9_]+") for t in texts]
    assert [r.sp for r in rows] == [py_java_split(t, " ") for t in texts]


@SETTINGS
@given(st.lists(st.lists(st.integers(-50, 50).map(lambda x: x / 4), max_size=9), min_size=1, max_size=40))
def test_shifted_median_matches_model(spark, sets):
    df = spark.createDataFrame([(i, [float(x) for x in s]) for i, s in enumerate(sets)], "i int, a array<double>")
    got = {r.i: r.m for r in df.select("i", shifted_median(F.array_sort(F.array_distinct("a"))).alias("m")).collect()}
    assert [got[i] for i in range(len(sets))] == [py_shifted(s) for s in sets]


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(-1000, 1000)), min_size=1, max_size=300, unique=True))
def test_distributed_ranks_match_sorting(spark, pairs):
    df = spark.createDataFrame([(g, float(v)) for g, v in pairs], "g int, v double")
    got = {(r.g, r.v): r.rank for r in ranked(df, ["g"], "v", 4).collect()}
    for g in {g for g, _ in pairs}:
        vals = sorted(float(v) for gg, v in pairs if gg == g)
        assert [got[(g, v)] for v in vals] == list(range(len(vals)))
