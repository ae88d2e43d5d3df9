"""Line deduplication with levelled sorted runs of line hashes.

A line's key is the line with ``[\\x20\\x09-\\x0D]`` stripped at both ends and A-Z
lower-cased, held as its 128-bit XXH3 digest.  The index of lines seen so far is a set of
sorted runs (tables ``key, owner`` in the shared folder) on levels: every batch of documents
merge-anti-joins the runs, writes its new keys as a run of level 0, and ``fanout`` runs of one
level are compacted into one run of the next level before the next batch.

Defined cases: null or empty text is one empty line and never dropped; keys under
``min_chars`` code points are never dropped; lines repeated within one document stay; rows that
share a doc_id are the same document; rows without a doc_id own nothing and lose nothing; an
empty table gives an empty table.  Whole texts, however long; only lines are hashed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.llm.common import ASCII_SPACE, narrow, salted_join, stored

STRIP = ASCII_SPACE.decode()


def line_digest(line: str, min_chars: int) -> bytes | None:
    """Digest of a line's key, or None when the key is shorter than ``min_chars`` code points."""
    import xxhash

    s = line.strip(STRIP)
    return xxhash.xxh3_128_digest(s.encode("utf-8", "surrogatepass").lower()) if len(s) >= min_chars else None


def document_keys(docs: DataFrame, min_chars: int) -> DataFrame:
    """Distinct ``(id, key)`` of documents ``(id, text)``."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            ids, keys = [], []
            for i, t in zip(b.column(0).to_pylist(), b.column(1)):  # one text at a time as Python strings
                got = {line_digest(x, min_chars) for x in (t.as_py() or "").split("\n")}
                got.discard(None)
                ids.extend([i] * len(got))
                keys.extend(got)
                if len(ids) >= 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.binary())],
                                                     ["id", "key"])
                    ids, keys = [], []
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.binary())], ["id", "key"])

    return docs.where(F.col("id").isNotNull()).mapInArrow(run, "id long, key binary")


class LineRuns:
    """The levelled index: ``add`` dedups one batch of ``(id, key)`` and keeps its new keys."""

    def __init__(self, spark: SparkSession, fanout: int = 2):
        self.spark, self.fanout = spark, fanout
        self.levels: list[list[DataFrame]] = []

    def runs(self) -> list[DataFrame]:
        return [r for level in self.levels for r in level]

    def _compact(self) -> None:
        for n in range(len(self.levels)):
            if len(self.levels[n]) >= self.fanout:
                merged = self.levels[n][0]
                for r in self.levels[n][1:]:
                    merged = merged.unionByName(r)
                run = stored(merged.repartition("key").sortWithinPartitions("key"), f"run-{n + 1}")
                if n + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[n] = []
                self.levels[n + 1].append(run)

    def add(self, keys: DataFrame) -> DataFrame:
        """``(id, key)`` of the batch's lines to drop.

        Batches arrive in id order, so an owner found in a run is smaller than any id here.
        """
        self._compact()
        firsts = keys.groupBy("key").agg(F.min("id").alias("first"), F.max("id").alias("last"))
        seen = self.spark.createDataFrame([], "key binary, owner long")
        for r in self.runs():
            seen = seen.unionByName(r)
        merged = stored(firsts.join(seen, "key", "left").sortWithinPartitions("key"), "run-0")
        if not self.levels:
            self.levels.append([])
        self.levels[0].append(merged.where(F.col("owner").isNull()).select("key", F.col("first").alias("owner")))
        doubled = (merged.where(F.col("owner").isNotNull() | (F.col("last") > F.col("first")))
                   .select("key", F.coalesce("owner", "first").alias("owner")))
        return stored(salted_join(keys, doubled, "key", ["id"]).where(F.col("id") > F.col("owner"))
                      .select("id", "key"), "drops")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10,
                batches: int = 4, fanout: int = 2) -> DataFrame:
    """``docs`` with ``text_col`` cut to its kept lines, plus ``n_lines`` (before) and ``n_dropped``.

    Keys of at least ``min_chars`` code points lose all their lines except in the smallest id
    holding them.  Documents are taken in ``batches`` id ranges of about equal size; the result
    does not depend on their number.
    """
    spark = docs.sparkSession
    src = narrow(docs, id_col, text_col)
    cuts = src.agg(F.percentile_approx("id", [i / batches for i in range(1, batches)], 1000)).first()[0] or []
    batch = F.lit(0)
    for c in sorted(set(cuts)):
        batch = batch + (F.col("id") > F.lit(c)).cast("int")
    keys = stored(document_keys(src, min_chars).withColumn("batch", batch), "line-keys")
    index, drops = LineRuns(spark, fanout), None
    for n in range(len(set(cuts)) + 1):
        got = index.add(keys.where(F.col("batch") == n).select("id", "key"))
        drops = got if drops is None else drops.unionByName(got)
    per_doc = drops.groupBy("id").agg(F.collect_set("key").alias("drop"))

    @F.pandas_udf("text string, n_lines long, n_dropped long")
    def cut(text, drop):
        import pandas as pd

        kept, total, lost = [], [], []
        for t, d in zip(text, drop):
            lines = (t or "").split("\n")
            total.append(len(lines))
            if d is None or len(d) == 0:
                kept.append(t)
                lost.append(0)
                continue
            gone = set(d)
            stay = [x for x in lines if line_digest(x, min_chars) not in gone]
            kept.append("\n".join(stay))
            lost.append(len(lines) - len(stay))
        return pd.DataFrame({"text": kept, "n_lines": total, "n_dropped": lost})

    cols = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    wrapped = docs.select(F.struct(*[docs[f"`{c}`"] for c in cols if c != text_col]).alias("row"),
                          docs[f"`{id_col}`"].cast("long").alias("id"), docs[f"`{text_col}`"].alias("text"))
    out = wrapped.join(per_doc, "id", "left").withColumn("cut", cut("text", "drop"))
    return out.select(*[F.col("cut.text").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in cols],
                      F.col("cut.n_lines").alias("n_lines"), F.col("cut.n_dropped").alias("n_dropped"))
