import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from loadlens.session import get_spark

    s = get_spark("local[4]", 8, app="loadlens-tests")
    yield s
    s.stop()


def measurement_rows(spark, rows):
    """Hand-made measurement rows: (id, timestamp, value, property, plug, household, house)."""
    from loadlens.functions.parsing import hhp_id

    schema = ("id int, timestamp int, value float, property int, plug_id int, "
              "household_id int, house_id int")
    return spark.createDataFrame(rows, schema).withColumn("hhp_id", hhp_id())
