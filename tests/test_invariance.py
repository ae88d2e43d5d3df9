"""Shuffled input order and different partition counts give the same results."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from loadlens.operators import averages as avg
from loadlens.operators import medians as med
from loadlens.operators import predict as pr
from loadlens.operators.keys import HOUSE, PLUG
from loadlens.operators.measures import load_only, valid_load
from loadlens.functions.output import finish
from loadlens.sources.tables import measurements_from_events, read_table

TF, P, K = 3600, 21600, 3

OPS = {
    "state_prediction": lambda m: pr.state_prediction(valid_load(m), HOUSE, TF, P, K, "intended"),
    "plug_state_prediction": lambda m: pr.state_prediction(valid_load(m), PLUG, TF, P, K, "as_run"),
    "rolling": lambda m: pr.rolling_prediction(load_only(m), narrow=True, target_rows=3),
    "averages_set": lambda m: avg.averages_set(valid_load(m), HOUSE, TF, P),
    "median_measures": lambda m: med.final_median(valid_load(m), HOUSE, TF, P, "reference", "measures"),
    "sorted": lambda m: med.sorted_measures(valid_load(m), PLUG, TF),
}


@pytest.mark.parametrize("name", sorted(OPS))
def test_order_and_partitioning_do_not_matter(spark, name):
    events = read_table(spark, SF_SMALL, "events")
    base = finish(OPS[name](measurements_from_events(events)))
    for n, seed in ((3, 1), (11, 7)):
        shuffled = events.repartition(n).orderBy(F.rand(seed))
        other = finish(OPS[name](measurements_from_events(shuffled)))
        assert base.count() == other.count()
        assert base.exceptAll(other).count() == 0 and other.exceptAll(base).count() == 0
