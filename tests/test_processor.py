"""The processor as one stream: tables committed together, crashes and replays, late readings and their repair."""

import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from conftest import SF_SMALL
from loadlens.functions.output import finish
from loadlens.operators.averages import averages_set, measure_set
from loadlens.operators.keys import keys_of
from loadlens.operators.measures import valid_load
from loadlens.operators.predict import state_prediction
from loadlens.sources.tables import load_measurements
from loadlens.streaming.processor import CommittedTables, ProcessorTables, delay_ms
from loadlens.streaming.sources import end_of_input

TF, PANE, K = 3600, 21600, 3


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """Each partition of a stateful step costs a worker and a state store: two are enough here."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def same(got, want):
    want = want.select(*got.columns)
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def batch_tables(valid, level):
    keys = keys_of(level)
    return {"measures": measure_set(valid, keys, TF), "averages": averages_set(valid, keys, TF, PANE),
            "predictions": state_prediction(valid, keys, TF, PANE, K, "intended")}


def rows_of(spark, n, table="a"):
    return spark.createDataFrame([(table, n, float(n))], "table string, k int, v double")


def test_commits_are_all_or_nothing(spark, tmp_path):
    store = CommittedTables(spark, str(tmp_path / "t"))
    assert store.manifest()[1]["batch"] == -1 and store.read("a") is None
    assert store.write(rows_of(spark, 0).unionByName(rows_of(spark, 5, "b")), 0)
    assert store.read("a").count() == 1 and store.read("b").first().k == 5 and store.read("c").count() == 0
    # a folder without its manifest is not seen, and is written anew
    rows_of(spark, 9).write.partitionBy("table").parquet(str(tmp_path / "t/batch=1"))
    assert store.read("a").count() == 1
    assert store.write(rows_of(spark, 1), 1) and {r.k for r in store.read("a").collect()} == {0, 1}
    # a replayed batch changes nothing
    assert not store.write(rows_of(spark, 7), 1) and {r.k for r in store.read("a").collect()} == {0, 1}
    # a batch without rows is a commit as well
    assert store.write(rows_of(spark, 1).limit(0), 2) and store.read("a").count() == 2
    # two writers of one manifest number: the second fails
    number, content = store.manifest()
    with pytest.raises(Exception, match="FileAlreadyExists"):
        store.commit(number, content)
    store.compact()
    assert {r.k for r in store.read("a").collect()} == {0, 1} and store.read("b").first().k == 5
    store.vacuum()
    left = {n for n in os.listdir(tmp_path / "t") if "=" in n}
    assert left == {"merged=3"} and {r.k for r in store.read("a").collect()} == {0, 1}
    assert store.write(rows_of(spark, 3), 3) and store.read("a").count() == 3


def test_delay():
    assert delay_ms("2 hours") == 7_200_000 and delay_ms("400 days") == 400 * 86_400_000 and delay_ms("1 second") == 1000


class Cut(Exception):
    pass


def test_a_crash_between_writing_and_commit_shows_no_table(spark, tmp_path, monkeypatch):
    m = load_measurements(spark, SF_SMALL).where("house_id < 6").cache()
    folder, ckpt = str(tmp_path / "feed"), str(tmp_path / "ckpt")
    m.limit(0).write.parquet(folder)
    stream = spark.readStream.schema(m.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    last, end = end_of_input(spark, stream)
    tables = ProcessorTables(spark, str(tmp_path / "t"), TF, PANE, K, "400 days")
    for n in range(2):
        m.where(f"pmod(id, 2) = {n}").coalesce(1).write.mode("append").parquet(folder)
    src = stream.unionByName(last)
    tables.run_available(src, ckpt)
    before = tables.store.manifest()
    end()  # the batch that closes all panes is cut off after its folder is written
    commit = tables.store.commit

    def cut(number, content):
        if os.path.exists(f"{tmp_path}/t/batch={content['batch']}/table=plug_measure"):
            raise Cut("cut off")
        commit(number, content)

    monkeypatch.setattr(tables.store, "commit", cut)
    with pytest.raises((StreamingQueryException, Cut)):
        tables.run_available(src, ckpt)
    written = {n for n in os.listdir(tmp_path / "t") if n.startswith("batch=")}
    assert len(written) > len(tables.store.manifest()[1]["folders"]) >= len(before[1]["folders"])
    for level in ("house", "plug"):
        assert not any(getattr(tables, t)(level).count() for t in ("measures", "averages", "predictions"))
    monkeypatch.setattr(tables.store, "commit", commit)
    tables.run_available(src, ckpt)
    assert tables.late().count() == 0
    for level in ("house", "plug"):
        for name, want in batch_tables(valid_load(m), level).items():
            same(finish(getattr(tables, name)(level)), finish(want))
    m.unpersist()


def test_late_readings_are_kept_and_repaired(spark, tmp_path):
    """Files of mixed times and no delay: most readings of later files are late."""
    m = load_measurements(spark, SF_SMALL).cache()
    folder, ckpt = str(tmp_path / "feed"), str(tmp_path / "ckpt")
    m.limit(0).write.parquet(folder)
    stream = spark.readStream.schema(m.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    last, end = end_of_input(spark, stream)
    tables = ProcessorTables(spark, str(tmp_path / "t"), TF, PANE, K, "5 days")
    src = stream.unionByName(last)
    half = m.agg(F.expr("percentile(timestamp, 0.5)")).first()[0]
    early = F.col("timestamp") < F.lit(half)
    # the first half in time, then the rest with stragglers of the first half
    m.where(early & F.expr("pmod(id, 10) > 0")).coalesce(1).write.mode("append").parquet(folder)
    tables.run_available(src, ckpt)
    m.where(~early & F.expr("pmod(id, 2) = 0")).coalesce(1).write.mode("append").parquet(folder)
    tables.run_available(src, ckpt)
    m.where(~early & F.expr("pmod(id, 2) = 1") | early & F.expr("pmod(id, 10) = 0")).coalesce(1).write.mode("append").parquet(folder)
    tables.run_available(src, ckpt)
    end()
    tables.run_available(src, ckpt)
    valid = valid_load(m)
    late = tables.late()
    assert 0 < late.count() < valid.count()
    # each reading is in its house's counter (once per window) or among the late ones
    counted = tables.predictions("house").groupBy("house_id").agg(F.max("n").alias("n")).agg(F.sum("n")).first()[0]
    assert counted == K * (valid.count() - late.count())
    assert late.join(valid, ["id", "timestamp", "value"], "left_anti").count() == 0
    on_time = valid.join(late.select("id"), "id", "left_anti")
    same(finish(tables.predictions("plug")), finish(batch_tables(on_time, "plug")["predictions"]))
    for level in ("house", "plug"):
        got = tables.repaired(level, m)
        for name, want in batch_tables(valid, level).items():
            same(finish(got[name]), finish(want))
    m.unpersist()
