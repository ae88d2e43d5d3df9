"""A corpus pipeline of five stages, each one training-data operator.

``STAGES`` lists ``(name, function)``; a function takes ``(spark, docs, sf_dir)`` and returns a
DataFrame that is written as Parquet and read again as the next stage's ``docs``.  All but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.llm import bpe, decontaminate, line_dedup, simhash, toxicity
from loadlens.llm.common import stored
from loadlens.llm.queries import PATTERN, RANKS
from loadlens.sources.tables import read_table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject."""
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(docs, model)
    return scored.where("predicted = 0").select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that an earlier document holds; ``n_chars`` follows the text."""
    out = line_dedup.dedup_lines(docs).withColumn("n_chars", F.length("text").cast("long"))
    return out.select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: the smallest doc_id."""
    return simhash.simhash_dedup(docs, shingle=4, radius=4)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontaminate.drop_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (packed little-endian unsigned 32-bit), their number, and digests of ids and decoded bytes."""
    got = bpe.bpe_encode(docs, RANKS, PATTERN, decode=True)
    return got.select(F.col("id").alias("doc_id"), "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_dedup", drop_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("byte_bpe", encode_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each but the last written to the shared folder."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: SQL has no string kernel, XXH64, edit distance of substrings or byte-level BPE: tests use brute force.
ORACLE_SQL = None
