"""Every registered query equals its DuckDB oracle on the smallest driver tables."""

import pytest

from conftest import SF_SMALL
from __spark_entry__ import entry, oracle_sql
from loadlens.plans.catalog import QUERIES
from loadlens.plans.verify import compare, duckdb_connection

SQL = {k: v for k, v in oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    if name.startswith("stream_"):  # each partition of a stateful step costs a worker and a state store
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        ok, msg, _ = compare(QUERIES[name](spark, SF_SMALL), con, SQL[name])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert ok, msg


def test_entry_runs(spark):
    df = entry(spark)
    assert df.count() > 0
    assert df.columns == ["house_id", "pane", "head_timestamp", "n", "predicted_load", "target_slice"]
