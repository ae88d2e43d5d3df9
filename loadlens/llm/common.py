"""Shared pieces of the training-data operators: stored intermediates, salted joins, hot-group splitting."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.session import scratch_path

#: The characters ``[\x20\x09-\x0D]`` of the contracts, as bytes; ``bytes.split()`` cuts at these and no others.
ASCII_SPACE = b" \t\n\x0b\x0c\r"


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the executors' Python workers, once per application (as ``--py-files`` would)."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="ship-")), "loadlens-package.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    z.write(os.path.join(folder, n), os.path.relpath(os.path.join(folder, n), os.path.dirname(root)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and continue from the files.

    Cuts lineage: a lost executor costs a re-read of files that every machine sees.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def narrow(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id long, text string)`` under private names, so extra input columns cannot clash."""
    ship(df.sparkSession)
    return df.select(df[f"`{id_col}`"].cast("long").alias("id"), df[f"`{text_col}`"].cast("string").alias("text"))


def train_part(id_col: Column, modulus: int, held_out: int) -> Column:
    """True for rows whose crc32 of the id as text leaves another remainder than ``held_out`` (null id: false)."""
    rest = F.crc32(id_col.cast("string").cast("binary")) % F.lit(modulus)
    return F.coalesce(rest != F.lit(held_out), F.lit(False))


def sized_broadcast(df: DataFrame, most: int = 1_000_000) -> DataFrame:
    """``df`` (a stored or cheap narrow table) marked for broadcast if it has at most ``most`` rows, else unchanged."""
    return F.broadcast(df) if df.count() <= most else df


def salted_join(left: DataFrame, right: DataFrame, on: str, spread: Sequence[str], salts: int = 16,
                how: str = "inner") -> DataFrame:
    """Equi-join in which one key value of ``left`` is spread over ``salts`` tasks.

    ``right`` has one row per key and is repeated ``salts`` times; ``left`` rows go to
    the copy chosen by a hash of their ``spread`` columns.
    """
    lsalt = left.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))
    rsalt = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return lsalt.join(rsalt, [on, "_salt"], how).drop("_salt")


def split_hot(df: DataFrame, keys: Sequence[str], row_hash: Column, cap: int, sample: int = 16,
              broadcast_rows: int = 100_000) -> DataFrame:
    """Add ``ci, cj, side`` so that groups of ``keys`` far over ``cap`` rows are compared in several tasks.

    A hot group is cut into k chunks by ``row_hash``; each row is sent to the k chunk pairs
    ``(ci <= cj)`` that hold its chunk, so any two rows of the group meet in exactly one
    sub-group (same chunk: ``ci = cj``; else the pair of their chunks, on different sides).
    Other groups stay whole with ``ci = cj = side = 0``.  Hot keys are found by counting a
    hashed 1-in-``sample`` share of the rows: that choice only moves work between tasks, every
    row is compared either way.
    """
    keys = list(keys)
    hot = (df.where(F.pmod(row_hash, F.lit(sample)) == 0).groupBy(*keys).count()
           .where(F.col("count") * sample > cap)
           .select(*keys, F.ceil(F.col("count") * sample / F.lit(cap)).cast("int").alias("_k")))
    hot = stored(hot, "hot-keys")
    n = hot.count()
    if n == 0:
        return df.select("*", F.lit(0).alias("ci"), F.lit(0).alias("cj"), F.lit(0).alias("side"))
    hot = F.broadcast(hot) if n <= broadcast_rows else hot
    c = F.pmod(F.shiftright(row_hash, 8), F.col("_k")).cast("int")
    out = df.join(hot, keys, "left").withColumn("_k", F.coalesce("_k", F.lit(1))).withColumn("_c", c)
    out = out.withColumn("_j", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)))
    return (out.withColumn("ci", F.least("_c", "_j")).withColumn("cj", F.greatest("_c", "_j"))
            .withColumn("side", (F.col("_c") != F.col("ci")).cast("int")).drop("_k", "_c", "_j"))


class Forest:
    """Union-find over ``n`` local rows; ``label`` is the smallest row of each row's set."""

    def __init__(self, n: int):
        import numpy as np

        self.label = np.arange(n)

    def _find(self, i):
        label = self.label
        while label[i] != i:
            label[i] = label[label[i]]
            i = label[i]
        return i

    def link(self, i, j) -> None:
        """Join the sets of rows ``i[n]`` and ``j[n]`` (arrays); only pairs still apart cost a step."""
        import numpy as np

        a, b = self.label[i], self.label[j]
        apart = a != b
        if not apart.any():
            return
        pairs = np.unique(np.stack([np.minimum(a[apart], b[apart]), np.maximum(a[apart], b[apart])], 1), axis=0)
        for x, y in pairs.tolist():
            x, y = self._find(x), self._find(y)
            if x != y:
                self.label[max(x, y)] = min(x, y)
        while True:  # point every row at its root
            up = self.label[self.label]
            if (up == self.label).all():
                return
            self.label = up


def grouped_batches(batches, key_names, fields):
    """Re-cut a stream of Arrow batches sorted by ``key_names`` so that no group spans two outputs.

    Yields dicts of numpy arrays (or Arrow arrays for nested fields).  Holds one group at most
    beside the current batch.
    """
    import numpy as np
    import pyarrow as pa

    held: list = []

    def out(parts):
        t = pa.Table.from_batches(parts).combine_chunks()
        return {f: (t.column(f).chunk(0) if t.num_rows else pa.array([])) for f in fields}

    for b in batches:
        if b.num_rows == 0:
            continue
        change = np.zeros(b.num_rows, bool)
        for k in key_names:
            v = b.column(k).to_numpy(zero_copy_only=False)
            change[1:] |= v[1:] != v[:-1]
            if held:
                change[0] |= held[-1].column(k)[-1].as_py() != b.column(k)[0].as_py()
        cuts = np.flatnonzero(change)
        if len(cuts) == 0:
            held.append(b)
            continue
        last = int(cuts[-1])
        head = b.slice(0, last)
        if held or last:
            yield out([*held, *([head] if last else [])])
        held = [b.slice(last)]
    if held:
        yield out(held)
