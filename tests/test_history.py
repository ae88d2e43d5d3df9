"""Averages history kept by deltas: equal to the batch history in any order, small reads, crashes and replays."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from loadlens.operators.averages import averages_history, averages_set
from loadlens.operators.keys import HOUSE, PLUG
from loadlens.operators.measures import prepared, valid_load
from loadlens.sources.tables import load_measurements
from loadlens.streaming.history import AveragesHistory

TF, PANE = 3600, 300


@pytest.fixture(autouse=True)
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def same(got, want):
    want = want.select(*got.columns)
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


@pytest.mark.parametrize("keys", [HOUSE, PLUG])
def test_deltas_in_any_order_equal_the_batch_history(spark, tmp_path, keys):
    valid = valid_load(load_measurements(spark, SF_SMALL))
    rows = prepared(valid, keys, TF, PANE).select(*keys, "s", "v", "p0").cache()
    kept = AveragesHistory(spark, str(tmp_path / "h"), keys, 6, 2)
    for n, part in enumerate((2, 0, 3, 1)):  # each part has arrivals of all times
        assert kept.apply(rows.where(F.pmod(F.hash("v", "p0"), F.lit(4)) == part), n)
    same(kept.history(), averages_history(valid, keys, TF, PANE))
    same(kept.averages(TF), averages_set(valid, keys, TF, PANE))
    before = kept.history().collect()
    # known arrivals again, and later repeats of known values, change nothing
    assert kept.apply(rows.limit(50).unionByName(rows.limit(50).withColumn("p0", F.col("p0") + 5)), 4)
    assert not kept.apply(rows.limit(5).withColumn("v", F.lit(1e9)), 4)
    assert sorted(kept.history().collect()) == sorted(before)
    rows.unpersist()


def test_a_batch_reads_and_writes_only_the_buckets_it_touches(spark, tmp_path):
    rows = spark.range(40_000).select((F.col("id") % 50).cast("int").alias("house_id"), (F.col("id") % 24).cast("int").alias("s"),
                                      (F.col("id") * 7 % 4001).cast("double").alias("v"), (F.col("id") % 30).cast("long").alias("p0"))
    kept = AveragesHistory(spark, str(tmp_path / "h"), ["house_id"], 24, 8)
    kept.apply(rows, 0)
    groups = kept.history().select("house_id", "s").distinct().count()
    delta = spark.createDataFrame([(h, 5, -1.0, 31) for h in (1, 3, 5)], "house_id int, s int, v double, p0 long")
    assert 3 <= 0.01 * groups
    before = set(kept.folders("firsts"))
    kept.apply(delta, 1)
    read = before - set(kept.folders("firsts"))  # the folders that were replaced
    total = spark.read.parquet(*before).count()
    assert 0 < spark.read.parquet(*read).count() < 0.1 * total
    last = {r.house_id: r.avg_load for r in kept.history().where("s = 5 and fp = 31").collect()}
    assert set(last) == {1, 3, 5}
    want = rows.unionByName(delta).where("s = 5 and house_id = 3").select("v").distinct().agg(F.avg("v")).first()[0]
    assert abs(last[3] - want) < 1e-6


def test_an_earlier_arrival_replays_from_its_pane(spark, tmp_path):
    schema = "house_id int, s int, v double, p0 long"
    kept = AveragesHistory(spark, str(tmp_path / "h"), ["house_id"], 2, 1)
    kept.apply(spark.createDataFrame([(1, 0, 10.0, 5), (1, 0, 20.0, 7), (1, 0, 60.0, 9)], schema), 0)
    kept.apply(spark.createDataFrame([(1, 0, 20.0, 3), (1, 0, 30.0, 8)], schema), 1)
    got = [(r.fp, r.avg_load) for r in kept.history().orderBy("fp").collect()]
    assert got == [(3, 20.0), (5, 15.0), (8, 20.0), (9, 30.0)]  # 20 now comes first; pane 7 no longer changes the set


def test_a_crash_before_the_commit_changes_nothing(spark, tmp_path, monkeypatch):
    schema = "house_id int, s int, v double, p0 long"
    kept = AveragesHistory(spark, str(tmp_path / "h"), ["house_id"])
    kept.apply(spark.createDataFrame([(1, 0, 10.0, 5)], schema), 0)
    more = spark.createDataFrame([(1, 0, 30.0, 6), (2, 3, 1.0, 1)], schema)

    def cut(number, content):
        raise RuntimeError("cut off")

    with monkeypatch.context() as m:
        m.setattr(kept.manifests, "commit", cut)
        with pytest.raises(RuntimeError):
            kept.apply(more, 1)
    assert os.path.exists(tmp_path / "h/batch=1")
    assert [(r.house_id, r.avg_load) for r in kept.history().collect()] == [(1, 10.0)]
    assert kept.apply(more, 1)
    assert sorted((r.house_id, r.fp, r.avg_load) for r in kept.history().collect()) == [(1, 5, 10.0), (1, 6, 20.0), (2, 1, 1.0)]


def test_a_delta_broadcasts_nothing(spark, tmp_path, monkeypatch):
    schema = "house_id int, s int, v double, p0 long"
    kept = AveragesHistory(spark, str(tmp_path / "h"), ["house_id"], 2, 1)
    kept.apply(spark.createDataFrame([(1, 0, 10.0, 5), (2, 1, 20.0, 7)], schema), 0)
    plans, write = [], AveragesHistory._write

    def watched(self, new, firsts, history, batch_id):
        took = type(new).repartition

        def seen(rows, *by):
            plans.append(rows._jdf.queryExecution().executedPlan().toString())
            return took(rows, *by)

        with monkeypatch.context() as m:
            m.setattr(type(new), "repartition", seen)
            write(self, new, firsts, history, batch_id)

    monkeypatch.setattr(AveragesHistory, "_write", watched)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")  # Spark's default
    try:
        kept.apply(spark.createDataFrame([(1, 0, 30.0, 6), (None, 0, 1.0, 6)], schema), 1)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plans and not any("Broadcast" in p for p in plans)
    assert sorted((r.house_id, r.fp, r.avg_load) for r in kept.history().collect()) == [(1, 5, 10.0), (1, 6, 20.0), (2, 7, 20.0)]
