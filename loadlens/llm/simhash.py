"""SimHash near-duplicates with bit-sliced distances.

A document's fingerprint holds, per bit, whether over half of its shingle hashes (XXH64, seed
42, of ``shingle`` space-joined words) set it.  Fingerprints at ``radius`` or fewer differing
bits link; components of links are the duplicate groups.

Pairs are found exactly: 64 bits are cut into ``radius + 2`` blocks, and two fingerprints at
``radius`` bits agree on at least two whole blocks, so each distinct fingerprint is filed under
every pair of its blocks.  Inside a file distances are counted bit-sliced: bit planes are stored
vertically (bit k of 64 fingerprints in one word), shifted planes are xored and summed with
carry-save counters, and blocks are abandoned once every lane exceeds the radius.

Defined cases: null, empty or blank text has fingerprint zero and links like any other; fewer
words than a shingle: the whole sequence is one shingle; repeated shingles count each time;
rows with a null id are returned with component null and link nothing; rows that share an id keep
one row each; an empty table gives an empty table.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.llm.common import Forest, grouped_batches, narrow, split_hot, stored
from loadlens.llm.components import connected_components


def simhash64(text: str | None, shingle: int = 4, seed: int = 42, step: int = 1 << 16) -> int:
    """The 64-bit fingerprint of one text, as an unsigned integer."""
    import numpy as np
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = (ends - [len(w) + 1 for w in words])[:n].tolist()
    stops = (ends[min(shingle, len(words)) - 1:] - 1).tolist()
    h, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for i in range(0, n, step):
        got = np.array([h(line[a:b], seed) for a, b in zip(starts[i:i + step], stops[i:i + step])], np.uint64)
        bits = np.unpackbits(got.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """``(id, fp)``; fp is the fingerprint as a signed long."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            fp = np.array([simhash64(t.as_py(), shingle) for t in b.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp)], ["id", "fp"])

    return narrow(docs, id_col, text_col).mapInArrow(run, "id long, fp long")


def block_keys(radius: int):
    """Native expressions: one key per pair of the ``radius + 2`` blocks of ``fp``."""
    n = radius + 2
    sizes = [64 // n + (i < 64 % n) for i in range(n)]
    parts, at = [], 0
    for s in sizes:
        parts.append((F.shiftrightunsigned("fp", at).bitwiseAND(F.lit((1 << s) - 1)), s))
        at += s
    return [(F.shiftleft(a, sb).bitwiseOR(b)).bitwiseOR(F.lit(t << 40))
            for t, ((a, _), (b, sb)) in enumerate(combinations(parts, 2))]


def bit_planes(fps):
    """64 x words array: bit k of fingerprints 64w..64w+63 in word w of row k (one spare word)."""
    import numpy as np

    words = len(fps) // 64 + 2
    padded = np.zeros(words * 64, np.uint64)
    padded[:len(fps)] = fps
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view(np.uint64)


def _add(a, b, c):
    """Carry-save adder over lanes: sum and carry of three bit vectors."""
    u = a ^ b
    return u ^ c, (a & b) | (u & c)


def lanes_within(planes, words, shift: int, mask, radius: int):
    """Lanes i of ``words`` whose fingerprint is within ``radius`` (under 8) of fingerprint ``i + shift``.

    ``mask`` has the lanes to look at; returns (words, mask) of the lanes that are within.
    """
    import numpy as np

    q, s = divmod(shift, 64)
    s, back = np.uint64(s), np.uint64(64 - s if s else 0)
    zero = np.zeros(len(words), np.uint64)
    c1, c2, c4, over = zero, zero, zero, zero
    for k in range(0, 64, 8):
        near = planes[k:k + 8, words + q]
        if s:
            near = (near >> s) | (planes[k:k + 8, words + q + 1] << back)
        x = planes[k:k + 8, words] ^ near
        c1, t1 = _add(c1, x[0], x[1])
        c1, t2 = _add(c1, x[2], x[3])
        c2, f1 = _add(c2, t1, t2)
        c1, t1 = _add(c1, x[4], x[5])
        c1, t2 = _add(c1, x[6], x[7])
        c2, f2 = _add(c2, t1, t2)
        c4, eight = _add(c4, f1, f2)
        over = over | eight
        # lanes over the radius, by comparing the three counter bits with its bits from the top
        more, same = over, ~over
        for c, bit in ((c4, radius >> 2 & 1), (c2, radius >> 1 & 1), (c1, radius & 1)):
            if bit:
                same = same & c
            else:
                more, same = more | (same & c), same & ~c
        mask = mask & ~more
        live = np.flatnonzero(mask)
        if len(live) == 0:
            return words[:0], mask[:0]
        if len(live) < len(words):
            words, mask = words[live], mask[live]
            c1, c2, c4, over = c1[live], c2[live], c4[live], over[live]
    return words, mask


def local_forest(group, fps, radius: int):
    """Component label (an index) of every row, linking rows of one group within ``radius`` bits.

    ``group`` is sorted; rows are compared at shift 1, 2, ... while any group is longer.
    """
    import numpy as np

    n = len(fps)
    forest = Forest(n)
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    sizes = np.diff(np.r_[starts, n])
    left = np.repeat(starts + sizes, sizes) - np.arange(n)  # rows from here to the group's end
    planes = bit_planes(fps)
    width = planes.shape[1]

    for d in range(1, int(sizes.max()) if n else 0):
        lanes = np.zeros(width * 64, np.uint8)
        lanes[:n] = left > d
        mask = np.packbits(lanes, bitorder="little").view(np.uint64)
        words = np.flatnonzero(mask)
        words, hit = lanes_within(planes, words, d, mask[words], radius)
        if len(words) == 0:
            continue
        bits = np.unpackbits(hit.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").reshape(len(words), 64)
        w, lane = np.nonzero(bits)
        i = words[w] * 64 + lane
        forest.link(i, i + d)
    return forest.label


def near_links(reps: DataFrame, radius: int, cap: int) -> DataFrame:
    """Edges ``(a, b)`` that connect what is linked, from distinct ``(fp, rep)``: a star per local component."""
    keyed = reps.select(F.explode(F.array(*block_keys(radius))).alias("k"), "fp", "rep")
    keyed = split_hot(keyed, ["k"], F.xxhash64("fp"), cap)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for g in grouped_batches(batches, ["k", "ci", "cj"], ["k", "ci", "cj", "fp", "rep"]):
            k, ci, cj, fp, rep = (g[c].to_numpy(zero_copy_only=False) for c in ("k", "ci", "cj", "fp", "rep"))
            new = np.r_[True, (k[1:] != k[:-1]) | (ci[1:] != ci[:-1]) | (cj[1:] != cj[:-1])]
            alone = new & np.r_[new[1:], True]
            group, fp, rep = np.cumsum(new)[~alone], fp[~alone], rep[~alone]
            if len(fp) == 0:
                continue
            label = local_forest(group, fp.view(np.uint64), radius)
            low = np.full(len(fp), np.iinfo(np.int64).max)
            np.minimum.at(low, label, rep)
            root = low[label]
            far = root != rep
            if far.any():
                pair = np.unique(np.stack([rep[far], root[far]], 1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(pair[:, 0]), pa.array(pair[:, 1])], ["a", "b"])

    return (keyed.repartition("k", "ci", "cj").sortWithinPartitions("k", "ci", "cj")
            .select("k", "ci", "cj", "fp", "rep").mapInArrow(run, "a long, b long"))


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                   radius: int = 4, cap: int = 20_000) -> DataFrame:
    """``(id, fingerprint, component_id)``: one row per input row, the smallest id reachable by links.

    Copies of one fingerprint are one node (its smallest id), so a large group of exact copies
    costs one comparison partner.  ``cap`` is the size above which a file of equal block pairs
    is compared in several tasks; no pair is left out.
    """
    if not 0 <= radius <= 6:
        raise ValueError("radius must be 0 to 6")
    fps = stored(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    reps = stored(fps.where(F.col("id").isNotNull()).groupBy("fp").agg(F.min("id").alias("rep")), "reps")
    comp = connected_components(near_links(reps, radius, cap))
    named = (reps.join(comp, reps["rep"] == comp["node"], "left")
             .select(reps["fp"].alias("fp"), F.coalesce("root", "rep").alias("component_id")))
    out = fps.join(named, "fp", "left")
    return out.select("id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                      F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id"))


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                  radius: int = 4) -> DataFrame:
    """``docs`` with one document of each group: the smallest id.  Rows with a null id stay."""
    g = simhash_groups(docs, id_col, text_col, shingle, radius)
    gone = g.where(F.col("component_id") != F.col("id")).select(F.col("id").alias("_gone")).distinct()
    return docs.join(gone, docs[f"`{id_col}`"].cast("long") == gone["_gone"], "left_anti")
