"""Connected components over a distributed edge table (alternating large-star / small-star)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.llm.common import salted_join, stored


def _state(e: DataFrame) -> tuple:
    r = e.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return r["n"], r["x"]


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of an edge, ``root`` the smallest node reachable.

    Large-star links each larger neighbour of a node to the node's smallest neighbour;
    small-star does the same among smaller neighbours; rounds repeat until the edges are
    stars, which takes a logarithmic number in practice.  Each round is written to the shared
    folder; the driver sees only a count and a checksum.  A hub with a large share of the
    edges is spread by salting.  Self-loops and null ends are ignored; no edges give no rows.
    """
    x, y = F.col(a).cast("long"), F.col(b).cast("long")
    e = stored(edges.where(x != y).select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct(), "edges")
    before = _state(e)
    for _ in range(max_rounds):
        if before[0] == 0:
            break
        sym = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = sym.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (salted_join(sym, low, "u", ["v"]).where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        large = stored(large, "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("u"), F.col("m").alias("v")))).alias("p")).select("p.u", "p.v")
            .where(F.col("u") != F.col("v")).distinct())
        e = stored(small, "small-star")
        after = _state(e)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
