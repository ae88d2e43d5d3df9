"""End-to-end batch jobs: set tables written, then evaluated from storage."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from loadlens.jobs.energy import SET_TABLES, run_processor, run_quality
from loadlens.operators.keys import HOUSE
from loadlens.operators.measures import valid_load
from loadlens.operators.predict import prediction_set, state_prediction
from loadlens.functions.output import finish
from loadlens.sources.tables import load_measurements


def test_processor_then_quality(spark, tmp_path):
    m = load_measurements(spark, SF_SMALL)
    out = str(tmp_path / "energy")
    paths = run_processor(m, out, tf=3600, pane_seconds=21600, panes_per_window=3, median_source="intended")
    assert set(paths) == set(SET_TABLES)
    stored = spark.read.parquet(paths["house_prediction"])
    assert "tf" in stored.columns and stored.select("tf").distinct().collect()[0].tf == 3600
    want = finish(prediction_set(state_prediction(valid_load(m), HOUSE, 3600, 21600, 3, "intended"), HOUSE, 3600))
    got = finish(stored.select(*want.columns))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    errors = run_quality(spark, m, out, tf=3600)
    h = errors["house_error"]
    assert h.count() > 0 and h.filter(F.col("error") < 0).count() == 0


def test_two_slice_sizes_stay_side_by_side(spark, tmp_path):
    from loadlens.sinks.writers import write_set_table

    for tf in (60, 3600, 60):
        rows = spark.createDataFrame([(tf, 1, 0, 2.0)], "tf int, slice int, house_id int, value double")
        write_set_table(rows, str(tmp_path / "set"), ["tf", "slice", "house_id", "value"])
    got = spark.read.parquet(str(tmp_path / "set")).collect()
    assert sorted(r.tf for r in got) == [60, 3600]


def test_ids_over_32_bits(spark):
    from loadlens.functions.parsing import parse_csv
    from loadlens.operators.measures import valid_load
    from loadlens.operators.predict import state_prediction

    lines = spark.createDataFrame([("3000000000,1377986401,2.0,1,0,0,0",), ("2999999999,1377986401,5.0,1,0,0,0",),
                                   ("1,1377986401,inf,1,0,0,0",), ("1,1377986401,nan,1,0,0,0",)], "value string")
    m = parse_csv(lines)
    assert sorted(r.id for r in m.collect()) == [2999999999, 3000000000]
    first = state_prediction(valid_load(m), ["house_id"], 3600, 10, 1).collect()
    assert [(r.head_timestamp, r.n, r.predicted_load) for r in first] == [(1377986401, 2, (3.5 + 5.0) / 2)]


def test_a_cluster_without_a_shared_folder_is_refused():
    from loadlens.session import single_machine

    assert single_machine("local[8]") and single_machine("local")
    assert not any(map(single_machine, ("local-cluster[3,2,1024]", "yarn", "spark://host:7077", "k8s://x")))
