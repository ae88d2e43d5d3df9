import math

import pytest
from pyspark.sql import functions as F

from loadlens.functions import (ORIGIN_TS, java_split, lines_of, parse_csv, parse_regex, regex_split,
                                shifted_median, time_slice, words)
from loadlens.functions.stats import exact_median


def _slice(spark, ts, tf):
    return spark.range(1).select(time_slice(F.lit(ts), tf).alias("s")).first()["s"]


@pytest.mark.parametrize("ts,tf,expected", [
    (ORIGIN_TS, 1, 0),
    (ORIGIN_TS - 1, 1, -1),          # before the origin: negative, not folded
    (ORIGIN_TS - 61, 60, -1),        # truncation toward zero, not floor
    (ORIGIN_TS - 59, 60, 0),
    (ORIGIN_TS + 86399, 1, 86399),
    (ORIGIN_TS + 86400, 1, 0),       # next day folds onto slice 0
    (ORIGIN_TS + 3 * 86400, 7, 3 * 86400 // 7 - 3 * (86400 // 7)),  # 86400 % 7 != 0 drifts
    (ORIGIN_TS + 86400 + 7200, 3600, 2),
])
def test_time_slice(spark, ts, tf, expected):
    assert _slice(spark, ts, tf) == expected


def test_time_slice_same_time_of_day_folds(spark):
    assert _slice(spark, ORIGIN_TS + 5 * 86400 + 123, 60) == _slice(spark, ORIGIN_TS + 123, 60)


def test_time_slice_sql_function(spark):
    from loadlens.functions import time_slice_sql_function

    time_slice_sql_function(spark)
    got = spark.sql(f"SELECT time_slice({ORIGIN_TS + 86400 + 7200}, 3600) AS s").first()["s"]
    assert got == 2


def test_parse_csv_good_bad_and_extra(spark):
    lines = spark.createDataFrame([(s,) for s in [
        "1,1377986401,68.451,0,11,0,0",       # good
        "2,3,4",                               # 3 fields
        "3,1377986401,1.5,1,2,3,4,8,9",        # 9 fields: extras ignored
        "4,1377986401,x,1,2,3,4",              # bad value
        " 5,1377986401,1.5,1,2,3,4",           # leading space on an int: rejected
        "",                                    # empty line
        "7,1377986401,NaN,1,2,3,4",            # NaN is a float
        "8,1377986401,1.5,1,2,3,",             # missing last field
    ]], "value string")
    good = {r["id"]: r for r in parse_csv(lines).collect()}
    assert set(good) == {1, 3, 7}
    assert good[1]["hhp_id"] == "0:0:11" and good[3]["hhp_id"] == "4:3:2"
    assert math.isnan(good[7]["value"])
    assert len(parse_csv(lines, mode="reject").collect()) == 5
    with pytest.raises(Exception):
        parse_csv(lines, mode="failfast").collect()


def test_parse_regex_and_split_delimiter(spark):
    lines = spark.createDataFrame([("1,1377986401,68.451,0,11,0,0",), ("-1,2,3.0,1,1,1,1",)], "value string")
    got = parse_regex(lines).collect()
    assert len(got) == 1 and got[0]["plug_id"] == 11 and got[0]["house_id"] == 0
    assert abs(got[0]["value"] - 68.451) < 1e-4
    # as a split delimiter the pattern swallows the whole line: nothing comes out
    assert regex_split(lines.limit(1)).count() == 0


@pytest.mark.parametrize("text,expected", [
    ("", [""]),
    ("!!!", []),
    ("Hello, World!", ["hello", "world"]),
    ("  leading", ["", "leading"]),
    ("a  b", ["a", "b"]),
    ("--that:--", ["", "that"]),
])
def test_words_follow_jvm_split(spark, text, expected):
    got = spark.range(1).select(words(F.lit(text)).alias("w")).first()["w"]
    assert got == expected


def test_java_split_on_space_keeps_inner_empties(spark):
    got = spark.range(1).select(java_split(F.lit(" a  b  "), " ").alias("w")).first()["w"]
    assert got == ["", "a", "", "b"]


def test_lines_of(spark):
    got = spark.range(1).select(lines_of(F.lit("a\r\nb\n\nc\n")).alias("l")).first()["l"]
    assert got == ["a", "b", "", "c"]


@pytest.mark.parametrize("values,expected", [
    ([], 0.0), ([5.0], 0.0), ([1.0, 2.0], 0.0),
    ([1.0, 2.0, 3.0], 3.0),                 # n = 3 gives the maximum
    ([1.0, 2.0, 3.0, 4.0], 3.5),            # mean of [2] and [3] (0-based)
    ([1.0, 2.0, 3.0, 4.0, 5.0], 4.0),       # fourth smallest
    ([1.0, 2.0, 3.0, 4.0, 5.0, 6.0], 4.5),
])
def test_shifted_median(spark, values, expected):
    arr = F.array_sort(F.array(*[F.lit(v) for v in values])) if values else F.array().cast("array<double>")
    assert spark.range(1).select(shifted_median(arr).alias("m")).first()["m"] == expected


def test_exact_median(spark):
    arr = F.array(*[F.lit(float(v)) for v in [1, 2, 3, 10]])
    assert spark.range(1).select(exact_median(arr).alias("m")).first()["m"] == 2.5


def test_encode_parse_roundtrip_special_values(spark):
    from loadlens.functions import encode_csv
    from loadlens.functions.parsing import hhp_id

    vals = [0.0001, 1e10, float("nan"), float("inf"), -2.5, 68.451]
    m = spark.createDataFrame([(i, 1377986401 + i, v, 1, 2, 3, 4) for i, v in enumerate(vals)],
                              "id int, timestamp int, value float, property int, plug_id int, household_id int, "
                              "house_id int").withColumn("hhp_id", hhp_id())
    lines = m.select(encode_csv().alias("value"))
    back = {r.id: r.value for r in parse_csv(lines).collect()}
    assert len(back) == len(vals)
    for i, v in enumerate(vals):
        want = spark.range(1).select(F.lit(v).cast("float").alias("x")).first().x
        assert (math.isnan(back[i]) and math.isnan(want)) or back[i] == want
    # the line pattern has no exponent, sign or letters: those lines do not match
    matched = {r.id for r in parse_regex(lines).collect()}
    assert matched == {5}
