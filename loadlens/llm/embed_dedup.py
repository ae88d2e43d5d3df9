"""Embedding near-duplicates with a pivot-permutation index.

Every vector is described by its ``prefix`` nearest reference points (pivots) in order.  Inverted
lists hold, per label and pair of pivots, the vectors with both in their prefix, so two vectors
sharing at least two pivots meet; a pair is verified once, in the list of its two smallest
shared pivots, by cosine in double precision.  Pivots are fitted on a bounded sample
(``sample`` vectors, spread out by farthest-point choice); every vector is indexed.  The index
is approximate by its nature: the tests and the README give its recall.

Equal vectors are one node with a count.  A list emits, not its links, but the links' number per
vector and a star per connected part, so dense groups cost no quadratic output; lists far over
``cap`` vectors are compared in several tasks and none is cut.

Defined cases: a null label, a null or empty or all-zero vector, null or non-finite components: no links;
vectors of different length never link; a null id: component null, not kept; rows that share an
id are separate vectors; an empty table gives an empty table.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.llm.common import Forest, grouped_batches, ship, split_hot, stored
from loadlens.llm.components import connected_components


def choose_pivots(sample, count: int):
    """Up to ``count`` rows of the unit vectors ``sample``, each far from those chosen before."""
    import numpy as np

    chosen, near = [0], sample @ sample[0]
    while len(chosen) < min(count, len(sample)):
        i = int(near.argmin())
        if near[i] > 0.999:
            break  # only copies are left
        chosen.append(i)
        near = np.maximum(near, sample @ sample[i])
    return sample[chosen]


def unit_rows(vectors):
    import numpy as np

    x = np.asarray(vectors, np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # keeps squares in range
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def fit_pivots(reps: DataFrame, count: int, sample: int):
    """Pivots by vector length, from a hashed sample of about ``sample`` vectors."""
    import numpy as np

    n = reps.count()
    share = max(1, n // sample)
    rows = (reps.where(F.pmod(F.xxhash64("rep"), F.lit(share)) == 0).select("rep", "embedding")
            .limit(4 * sample).collect())
    by: dict[int, list] = {}
    for r in sorted(rows, key=lambda r: r["rep"]):
        by.setdefault(len(r["embedding"]), []).append(r["embedding"])
    pivots = {d: choose_pivots(unit_rows(np.array(v)), count) for d, v in by.items()}
    if pivots:  # lengths outside the sample use the commonest length's pivots, cut or padded
        pivots[0] = pivots[max(by, key=lambda d: len(by[d]))]
    return pivots


def pivot_prefixes(pivots, vectors, prefix: int):
    """Ids of the nearest pivots of each row, nearest first."""
    import numpy as np

    x = unit_rows(vectors)
    p = pivots.get(x.shape[1])
    if p is None:
        p = np.zeros((len(pivots[0]), x.shape[1]))
        w = min(p.shape[1], pivots[0].shape[1])
        p[:, :w] = pivots[0][:, :w]
    return np.argsort(-(x @ p.T), axis=1, kind="stable")[:, :prefix]


def list_links(vectors, member, mult, side, b: int, threshold: float, step: int = 1024):
    """Links of one inverted list whose larger pivot is ``b``: (links per row, component label per row).

    ``member`` has a row's prefix as 0/1 per pivot.  A pair counts here only if it shares exactly
    one pivot below ``b`` (the list's smaller pivot): then this is the pair's first list.
    """
    import numpy as np

    n = len(vectors)
    x, low = unit_rows(vectors), member[:, :b]
    links, forest = np.zeros(n, np.int64), Forest(n)
    for s in range(0, n, step):
        part = slice(s, min(n, s + step))
        hit = x[part] @ x[s:].T >= threshold
        hit &= low[part] @ low[s:].T == 1
        hit &= np.arange(s, part.stop)[:, None] < np.arange(s, n)[None, :]
        if side is not None:
            hit &= side[part][:, None] != side[s:][None, :]
        i, j = np.nonzero(hit)
        if len(i) == 0:
            continue
        i, j = i + s, j + s
        np.add.at(links, i, mult[j])
        np.add.at(links, j, mult[i])
        forest.link(i, j)
    return links, forest.label


def embedding_groups(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                     label_col: str = "label", threshold: float = 0.93, pivot_count: int = 128, prefix: int = 7,
                     sample: int = 2048, cap: int = 4096) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per input row."""
    ship(vectors.sparkSession)
    v = vectors
    vec = v[f"`{vector_col}`"].cast("array<float>")
    rows = v.select(v[f"`{id_col}`"].cast("long").alias("vec_id"), v[f"`{label_col}`"].cast("string").alias("label"),
                    vec.alias("embedding"))
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    usable = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("embedding") > 0) & ~bad
              & F.exists("embedding", lambda x: x != 0))
    h1, h2 = F.xxhash64("label", "embedding"), F.xxhash64(F.lit(1), "label", "embedding")
    rows = rows.withColumn("ok", F.coalesce(usable, F.lit(False))).withColumn("h1", h1).withColumn("h2", h2)
    reps = stored(rows.where("ok").groupBy("h1", "h2").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("mult"), F.min_by("label", "vec_id").alias("label"),
        F.min_by("embedding", "vec_id").alias("embedding")), "vectors")
    pivots = fit_pivots(reps, pivot_count, sample)
    if not pivots:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                           F.col("vec_id").isNotNull().alias("kept"))
    sent = v.sparkSession.sparkContext.broadcast(pivots)  # pivot_count vectors per length

    @F.pandas_udf("array<int>")
    def prefixes(e):
        import numpy as np
        import pandas as pd

        out = [None] * len(e)
        sizes = e.map(len).to_numpy()
        for d in np.unique(sizes):
            at = np.flatnonzero(sizes == d)
            got = pivot_prefixes(sent.value, np.stack(e.iloc[at].to_list()), prefix).astype(np.int32)
            for i, g in zip(at, got):
                out[i] = g
        return pd.Series(out)

    indexed = stored(reps.select("rep", "mult", "label", "embedding", F.size("embedding").alias("dims"),
                                 F.array_sort(prefixes("embedding")).alias("near")), "index")
    pairs = F.array(*[F.when(F.size("near") > j, F.element_at("near", i + 1) * F.lit(1 << 16) + F.element_at("near", j + 1))
                      for i, j in combinations(range(prefix), 2)])
    # with a single pivot there are no pairs: one list for all of a label
    pairs = F.when(F.size("near") > 1, F.filter(pairs, lambda x: x.isNotNull())).otherwise(F.array(F.lit(-1)))
    lists = indexed.select(F.explode(pairs).alias("pair"), "label", "dims", "rep", "mult", "near", "embedding")
    keys = ["label", "dims", "pair"]
    lists = split_hot(lists, keys, F.xxhash64("rep"), cap)
    order = [*keys, "ci", "cj"]

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for g in grouped_batches(batches, order, [*order, "side", "rep", "mult", "near", "embedding"]):
            label, dims, pair, ci, cj, side, rep, mult = (g[c].to_numpy(zero_copy_only=False)
                                                          for c in [*order, "side", "rep", "mult"])
            new = (label[1:] != label[:-1]) | (pair[1:] != pair[:-1]) | (dims[1:] != dims[:-1])
            new |= (ci[1:] != ci[:-1]) | (cj[1:] != cj[:-1])
            cuts = np.r_[0, np.flatnonzero(new) + 1, len(rep)]
            a, counts, b, root = [], [], [], []
            off_e, off_n = g["embedding"].offsets.to_numpy(), g["near"].offsets.to_numpy()
            flat_e = g["embedding"].values.to_numpy(zero_copy_only=False)
            flat_n = g["near"].values.to_numpy(zero_copy_only=False)
            for s, e in zip(cuts[:-1], cuts[1:]):
                if e - s < 2:
                    continue
                d, p = int(dims[s]), int(pair[s])
                x = flat_e[off_e[s]:off_e[e]].reshape(e - s, d)
                near = flat_n[off_n[s]:off_n[e]].reshape(e - s, -1)
                if p < 0:
                    member, top = np.ones((e - s, 1), np.float32), 1
                else:
                    top = p & 0xFFFF
                    member = np.zeros((e - s, int(flat_n.max()) + 1), np.float32)
                    np.put_along_axis(member, near, 1, axis=1)
                cross = side[s:e] if ci[s] != cj[s] else None
                links, part = list_links(x, member, mult[s:e], cross, top, threshold)
                on = np.flatnonzero(links)
                if len(on) == 0:
                    continue
                a.append(rep[s:e][on])
                counts.append(links[on])
                low = np.full(e - s, np.iinfo(np.int64).max)
                np.minimum.at(low, part, rep[s:e])
                far = np.flatnonzero(low[part] != rep[s:e])
                b.append(rep[s:e][far])
                root.append(low[part][far])
            if a:
                n, m = sum(map(len, a)), sum(map(len, b))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(a + b)), pa.array(np.concatenate(counts + [np.zeros(m, np.int64)])),
                     pa.array([None] * n + np.concatenate(root).tolist(), pa.int64())], ["a", "n", "b"])

    found = stored(lists.repartition(*order).sortWithinPartitions(*order)
                   .select(*order, "side", "rep", "mult", "near", "embedding")
                   .mapInArrow(run, "a long, n long, b long"), "links")
    degree = found.groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("others"))
    comp = connected_components(found.where(F.col("b").isNotNull()))
    named = (reps.select("h1", "h2", "rep", "mult").join(degree, "rep", "left")
             .join(comp, F.col("rep") == comp["node"], "left")
             .select("h1", "h2", (F.col("mult") - 1 + F.coalesce("others", F.lit(0))).alias("links"),
                     F.coalesce("root", "rep").alias("component")))
    ids = rows.select("vec_id", "ok", "h1", "h2")
    out = ids.join(named.withColumn("ok", F.lit(True)), ["h1", "h2", "ok"], "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(False)).alias("kept"))
