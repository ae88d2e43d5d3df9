"""Sorted sets as stored tables: positions, heads and ranges read without an exchange.

A store has the sets' rows, sorted by (group, value), one folder per partition of the sort, and an index of blocks: for each
partition's part of a group its number of rows, the rows of the group before it, and its least and greatest value.
Counts and heads come from the index alone; a range of one set opens only the folders its positions lie in, and row
groups outside the range are skipped by their statistics.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Bytes of a Parquet row group, what a position read decodes at most.
ROW_GROUP_BYTES = 8 << 20


class SortedSets:
    """The sets stored under ``path``: one per value of the ``group`` columns, ordered by ``value``."""

    def __init__(self, spark: SparkSession, path: str, group: Sequence[str], value: str):
        self.spark, self.path, self.group, self.value = spark, path.rstrip("/"), list(group), value

    def write(self, numbered: DataFrame, row_group_bytes: int = ROW_GROUP_BYTES) -> None:
        """Store rows as ``operators.ranks.numbered`` gives them, and their index."""
        (numbered.write.mode("overwrite").option("parquet.block.size", row_group_bytes).partitionBy("_part")
         .parquet(f"{self.path}/rows"))
        self._schema = numbered.schema
        counts = self._rows().groupBy("_part", *self.group).agg(
            (F.max("_place") + 1).alias("n"), F.min(self.value).alias("least"), F.max(self.value).alias("most"))
        before = Window.partitionBy(*self.group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        counts = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
        counts.write.mode("overwrite").parquet(f"{self.path}/blocks")

    def _rows(self, parts: Sequence[int] | None = None) -> DataFrame:
        if parts is None:
            read = self.spark.read
            return (read.schema(self._schema) if hasattr(self, "_schema") else read).parquet(f"{self.path}/rows")
        return self.spark.read.option("basePath", f"{self.path}/rows").parquet(*[f"{self.path}/rows/_part={p}" for p in parts])

    def blocks(self) -> DataFrame:
        """``_part``, group columns, ``n``, ``least``, ``most``, ``before``."""
        return self.spark.read.parquet(f"{self.path}/blocks")

    def cards(self) -> DataFrame:
        """Size of each set, from the index."""
        return self.blocks().groupBy(*self.group).agg(F.sum("n").alias("n"))

    def heads(self) -> DataFrame:
        """First member of each set, from the index: no exchange."""
        return self.blocks().where("before = 0").select(*self.group, F.col("least").alias(self.value))

    def ranked(self) -> DataFrame:
        """All rows with ``rank``; no exchange of rows: what is broadcast has at most one row per partition of the sort."""
        offsets = self.blocks().where("before > 0").select("_part", *self.group, "before")
        rows = self._rows().join(F.broadcast(offsets), ["_part", *self.group], "left")
        return rows.withColumn("rank", F.col("_place") + F.coalesce("before", F.lit(0))).drop("_part", "_place", "before")

    def first(self, count: int) -> DataFrame:
        """The first ``count`` members of every set with their ``rank``; rows at later places are not read past the filter."""
        offsets = self.blocks().where("before > 0").select("_part", *self.group, "before")
        rows = self._rows().where(F.col("_place") < count).join(F.broadcast(offsets), ["_part", *self.group], "left")
        rank = F.col("_place") + F.coalesce("before", F.lit(0))
        return rows.withColumn("rank", rank).where(F.col("rank") < count).drop("_part", "_place", "before")

    def _is(self, key: Sequence):
        cond = F.lit(True)
        for g, k in zip(self.group, key, strict=True):
            cond = cond & (F.col(g) == F.lit(k))
        return cond

    def _blocks_of(self, key: Sequence):
        """The index rows of one set, in order: at most one per partition of the sort."""
        return self.blocks().where(self._is(key)).orderBy("before").collect()

    def card(self, key: Sequence) -> int:
        return sum(b["n"] for b in self._blocks_of(key))

    def range(self, key: Sequence, start: int, stop: int) -> DataFrame:
        """Members at positions ``start`` to ``stop`` (both included; negative: from the end) of one set, with ``rank``."""
        blocks = self._blocks_of(key)
        n = sum(b["n"] for b in blocks)
        start, stop = (max(0, start + n) if start < 0 else start), (stop + n if stop < 0 else min(stop, n - 1))
        hit = [b for b in blocks if b["before"] <= stop and b["before"] + b["n"] > start]
        parts = []
        for b in hit:
            at = F.col("_place").between(max(0, start - b["before"]), min(b["n"] - 1, stop - b["before"]))
            rows = self._rows([b["_part"]]).where(self._is(key) & at)
            parts.append(rows.withColumn("rank", F.col("_place") + F.lit(b["before"])).drop("_part", "_place"))
        if not parts:
            return self._rows().where(F.lit(False)).withColumn("rank", F.col("_place")).drop("_part", "_place")
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def rank_of(self, key: Sequence, value) -> int | None:
        """Position of a member; None if the set does not hold it.  Opens one block."""
        for b in self._blocks_of(key):
            if b["least"] <= value <= b["most"]:
                row = self._rows([b["_part"]]).where(self._is(key) & (F.col(self.value) == F.lit(value))).select("_place").first()
                return None if row is None else row[0] + b["before"]
        return None
