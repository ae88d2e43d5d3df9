"""Exact ranks inside groups by one range sort.

Rows are range-partitioned once by (group, value) and sorted in their partitions, so a group
holding a third of the data lies in as many partitions as it needs, with no salts and no
sketch.  A streaming pass numbers the rows of each (partition, group); only the first group of a partition can
have begun in an earlier one, so the offsets that turn these numbers into ranks have at most one row per
partition.  The numbered rows are stored in the shared folder (``sinks.sorted_sets``): offsets and rows then come from
the same partitions, also when an executor is lost.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from loadlens.session import scratch_path
from loadlens.sinks.sorted_sets import SortedSets

# shipped by value: executors need no installed copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def numbered(df: DataFrame, group: Sequence[str], value: str, partitions: int | None = None) -> DataFrame:
    """Sorted rows with ``_part`` (partition of the sort) and ``_place`` (0-based position in that part of the group)."""
    group = list(group)
    parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = df.repartitionByRange(parts, *group, value).sortWithinPartitions(*group, value)

    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        last, count = None, 0  # the group at hand and its rows so far
        for b in batches:
            n = b.num_rows
            if n == 0:
                continue
            new = np.zeros(n, bool)
            for g in group:
                v = b.column(g).to_numpy(zero_copy_only=False)
                new[1:] |= v[1:] != v[:-1]
            begin = np.maximum.accumulate(np.where(new, np.arange(n), 0))
            place = np.arange(n) - begin
            if tuple(b.column(g)[0].as_py() for g in group) == last:
                place[begin == 0] += count
            last, count = tuple(b.column(g)[n - 1].as_py() for g in group), int(place[-1]) + 1
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(n, part, np.int32)), pa.array(place, pa.int64())],
                                             [*b.schema.names, "_part", "_place"])

    schema = StructType([*df.schema.fields, StructField("_part", IntegerType()), StructField("_place", LongType())])
    return ordered.mapInArrow(run, schema)


def ranked(df: DataFrame, group: Sequence[str], value: str, partitions: int | None = None) -> DataFrame:
    """Adds ``rank`` (0-based, ascending ``value``) within each group.

    Rows must be distinct on (group, value) for set semantics; ties would get
    consecutive ranks in an arbitrary order.  Group columns hold no nulls.
    """
    sets = SortedSets(df.sparkSession, scratch_path(df.sparkSession, "ranked"), group, value)
    sets.write(numbered(df, group, value, partitions))
    return sets.ranked().select(*df.columns, "rank")
