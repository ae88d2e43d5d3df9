"""Language-model scores from a hashed maximum-entropy model with class-factored softmax.

A token's probability is P(first class | context) * P(second class | first class, context) *
P(token | both classes).  The two class factors are maximum-entropy models: softmax over sums of
weights for hashed features, the last word, the last two words (n-grams) and the word before the
last (skip).  Classes come from a token's spelling (its end and its beginning), so no vocabulary
has to be known to place a token; within its classes a token has its smoothed share of the training
counts, one unseen token included, so probabilities add up to 1.

Training reads all training rows: one pass gathers token counts and, per hashed feature, class
counts, from which the weights start; then ``rounds`` gradient updates, each over another
share of the training rows and together over all of them, sum empirical minus expected counts on the
executors and update the tables.  The tables' rows follow the training text up to 2**16 a feature (``Shape.sized``);
only they travel through the driver.  Texts are cut into words in Arrow and
scored in sparse numpy batches that gather only the rows of the features present.  Counts of
frequent tokens are broadcast (at most ``HEAD`` of them), the others are joined per distinct
token of a text.

Defined cases: null and empty texts hold one token, the end; without training rows every count is
0; rows with a null id are not trained on and are scored as not held out; rows sharing an id
are scored each; token counts are kept by 64-bit hash; whole texts of any length.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import ClassVar

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.llm.common import narrow, stored, train_part

HEAD = 1 << 16
CHUNK = 3 << 19  # bytes of text whose words are told apart at once
PART = 4_000  # tokens whose class probabilities are computed at once, in cache
ADDED = 32_000  # tokens whose class probabilities are added to the tables at once
LOGIT = 60.0  # largest logit either way
BLOCK = 256  # table rows per shuffled block


@dataclass(frozen=True)
class Shape:
    """Sizes of the model: feature rows (a power of two up to 2**16), first and second classes."""

    #: Bytes of training text behind each row of a feature, between 2**14 and 2**16 rows.
    PER_ROW: ClassVar[int] = 1 << 14

    rows: int = 1 << 14
    first: int = 32
    second: int = 16

    def sizes(self):
        """Weights per feature row of the six tables: three features by two factors."""
        return [self.first] * 3 + [self.second] * 3

    @classmethod
    def sized(cls, text_bytes: int) -> Shape:
        """The shape for so many bytes of training text."""
        return cls(rows=1 << min(16, max(14, (text_bytes // cls.PER_ROW).bit_length() - 1)))


def _crc32(columns, lengths):
    """crc32 of the first ``lengths`` bytes of each row of the byte columns."""
    import zlib

    import numpy as np

    table = np.array([zlib.crc32(bytes([i ^ 0xFF])) ^ 0xFF000000 for i in range(256)], np.uint32)
    crc = np.full(len(lengths), 0xFFFFFFFF, np.uint32)
    for i, c in enumerate(columns):
        crc = np.where(lengths > i, table[(crc ^ c) & np.uint32(0xFF)] ^ (crc >> np.uint32(8)), crc)
    return ~crc


def _told_apart(words, shape: Shape):
    """``(hash, first, second)`` of distinct Arrow strings without white space."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    import xxhash

    n = len(words)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), words), "\n")[0].as_buffer().to_pybytes()
    h = np.fromiter(map(xxhash.xxh64_intdigest, joined.split(b"\n")), np.uint64, n)
    size = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    start = np.cumsum(size + 1) - size - 1
    data = np.frombuffer(joined + b"\n\n\n", np.uint8)
    tail = np.maximum(start, start + size - 2)
    c1 = _crc32([data[tail], data[tail + 1]], size) % np.uint32(shape.first - 1)
    c2 = _crc32([data[start + i] for i in range(3)], size) % np.uint32(shape.second)
    return h, c1.astype(np.int64), c2.astype(np.int64)


def _chunk(texts, shape: Shape):
    """One chunk of ``token_chunks``."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    import xxhash

    k = len(texts)
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), "")))
    coded = lists.flatten().dictionary_encode()
    full = pc.binary_length(coded.dictionary).to_numpy(zero_copy_only=False)[coded.indices.to_numpy()] > 0
    owner = np.repeat(np.arange(k, dtype=np.int32), np.diff(lists.offsets.to_numpy()))[full]
    n = np.bincount(owner, minlength=k)
    line = np.zeros(len(owner) + 3 * k, np.int32)  # two words 0, the text's words, word 1
    line[np.arange(len(owner)) + 3 * owner + 2] = coded.indices.to_numpy()[full] + 2
    line[np.cumsum(n + 3) - 1] = 1
    place = np.flatnonzero(line)
    edges = np.array([xxhash.xxh64_intdigest(b"\t"), xxhash.xxh64_intdigest(b"\n")], np.uint64)  # no word holds white space
    h, c1, c2 = _told_apart(coded.dictionary, shape)
    # the end of a text has a class of its own
    return (np.repeat(np.arange(k), n + 1), line[place], line[place - 1], line[place - 2],
            np.r_[edges, h], np.r_[0, shape.first - 1, c1], np.r_[0, 0, c2])


def token_chunks(texts, shape: Shape):
    """Chunks of whole texts of an Arrow array: ``(text index, word, word before, word two before)`` per token and
    ``(hash, first, second)`` per word.

    A text of more than a chunk is one chunk by itself.  Word 0 stands before a text and word 1 is its end.
    """
    import numpy as np
    import pyarrow.compute as pc

    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CHUNK, "right")))
        owner, *rest = _chunk(texts.slice(at, to - at), shape)
        yield owner + at, *rest
        at = to


def feature_rows(before, second_before, first, shape: Shape):
    """Table rows of the three features for the first factor, then for the second (given its class)."""
    import numpy as np

    def cut(x):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        return (x >> np.uint64(48)).astype(np.intp) & (shape.rows - 1)

    feats = [before, second_before * np.uint64(3) + np.uint64(1),
             before * np.uint64(0xC2B2AE3D27D4EB4F) + second_before * np.uint64(0x165667B19E3779F9)]
    given = first.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(7)
    return [cut(f) for f in feats] + [cut(f + given) for f in feats]


class Weights:
    """The six tables and the class priors of a model."""

    def __init__(self, shape: Shape, counts=None):
        import numpy as np

        self.shape = shape
        self.tables = [np.zeros((shape.rows, s), np.float32) for s in shape.sizes()]
        self.prior = [np.zeros(shape.first, np.float32), np.zeros((shape.first, shape.second), np.float32)]
        self.counts = None
        if counts is not None:
            self._start(*counts)

    def __getstate__(self):
        return self.__dict__ | {"counts": None}  # only updates need the counts, and they are made on the driver

    def _start(self, counts, pairs, pull: float = 20.0):
        """Weights from class counts per feature row, pulled to the priors."""
        import numpy as np

        self.counts = counts
        first = pairs.sum(axis=1) + 0.5
        second = pairs + 0.5
        self.prior = [np.log(first / first.sum()).astype(np.float32),
                      np.log(second / second.sum(axis=1, keepdims=True)).astype(np.float32)]
        marginal = np.exp(np.log((second.sum(axis=0)) / second.sum()))
        for i, n in enumerate(counts):
            p0 = first / first.sum() if i < 3 else marginal
            ratio = (n + pull * p0) / (n.sum(axis=1, keepdims=True) + pull) / p0
            self.tables[i] = (np.log(ratio) * (0.5, 0.25, 0.25)[i % 3]).astype(np.float32)

    def update(self, gradient, share: float, rate: float = 0.4, pull: float = 20.0):
        """One step: empirical minus expected counts, scaled by the counts behind each weight."""
        import numpy as np

        for i, g in enumerate(gradient):
            self.tables[i] += (rate * g / (share * self.counts[i] + pull)).astype(np.float32)

    def shares(self, rows, first):
        """Per factor ``(exp of the logits, their sum per token)``; the second given the token's first class.

        Logits are cut at ``LOGIT`` either way, so that no exponential overflows.
        """
        import numpy as np

        out = []
        for k, base in ((0, self.prior[0]), (3, self.prior[1].take(first, axis=0, mode="clip"))):
            x = self.tables[k].take(rows[k], axis=0, mode="clip")
            x += self.tables[k + 1].take(rows[k + 1], axis=0, mode="clip")
            x += self.tables[k + 2].take(rows[k + 2], axis=0, mode="clip")
            x += base
            np.clip(x, -LOGIT, LOGIT, out=x)
            np.exp(x, out=x)
            out.append((x, x @ np.ones(x.shape[1], np.float32)))
        return out

    def probabilities(self, rows, first):
        """Class probabilities ``(tokens x first, tokens x second)``; the second given the token's first class."""
        out = self.shares(rows, first)
        for x, total in out:
            x /= total[:, None]
        return [x for x, _ in out]


def _blocks(tables):
    """``(table * 2**16 + block, float32 bytes)`` of the non-zero blocks."""
    import numpy as np

    for i, t in enumerate(tables):
        for b in range(0, len(t), BLOCK):
            part = t[b:b + BLOCK]
            if part.any():
                yield i << 16 | b // BLOCK, part.astype(np.float32).tobytes()


def summed_blocks(blocks: DataFrame) -> list:
    """``(block, bytes)`` rows summed by block; at most the tables' fixed size reaches the driver."""

    def add(batches):
        import numpy as np
        import pyarrow as pa

        at, total = None, None

        def out():
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([total.astype(np.float32).tobytes()], pa.binary())],
                                              ["block", "data"])

        for b in batches:
            for k, d in zip(b.column(0).to_pylist(), b.column(1)):
                x = np.frombuffer(d.as_buffer(), np.float32)
                if k == at:
                    total = total + x
                    continue
                if at is not None:
                    yield out()
                at, total = k, x.astype(np.float64)
        if at is not None:
            yield out()

    rows = (blocks.repartition("block").sortWithinPartitions("block").select("block", "data")
            .mapInArrow(add, "block long, data binary"))
    return rows.collect()


def _tables(rows, shapes):
    import numpy as np

    out = [np.zeros(s, np.float32) for s in shapes]
    while rows:  # rows are let go as they are placed
        r = rows.pop()
        i, b = r["block"] >> 16, r["block"] & 0xFFFF
        got = np.frombuffer(r["data"], np.float32).reshape(-1, shapes[i][1])
        out[i][b * BLOCK:b * BLOCK + len(got)] = got
    return out


def _shapes(shape: Shape):
    return [(shape.rows, s) for s in shape.sizes()] + [(shape.first, shape.second)]


def few_tasks(df: DataFrame, text_bytes: int) -> DataFrame:
    """``df`` in at most two partitions per core, or one per GB of training text if that is more.

    Each task returns one set of tables, whatever its share of the text.
    """
    return df.coalesce(max(2 * df.sparkSession.sparkContext.defaultParallelism, text_bytes >> 30))


def gather(train: DataFrame, shape: Shape) -> DataFrame:
    """One pass over training texts: token counts ``(h, leaf, n)`` and class counts per feature row ``(block, data)``."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        names = ["h", "leaf", "n", "block", "data"]
        tables = [np.zeros(s, np.int64) for s in _shapes(shape)]
        held, size = [], 0

        def words():
            h, leaf, n = (np.concatenate(x) for x in zip(*held))
            h, first, same = np.unique(h, return_index=True, return_inverse=True)
            n = np.bincount(same, n, minlength=len(h))
            none = pa.nulls(len(h))
            return pa.RecordBatch.from_arrays(
                [pa.array(h.view(np.int64)), pa.array(leaf[first].astype(np.int32)), pa.array(n.astype(np.int64)),
                 none.cast(pa.int64()), none.cast(pa.binary())], names)

        for b in batches:
            for _, w, before, second, h, c1, c2 in token_chunks(b.column(0), shape):
                leaf, a1, a2 = c1 * shape.second + c2, c1[w], c2[w]
                for i, r in enumerate([*feature_rows(h[before], h[second], a1, shape), None]):
                    cell = leaf[w] if r is None else r * tables[i].shape[1] + (a1 if i < 3 else a2)
                    tables[i] += np.bincount(cell, minlength=tables[i].size).reshape(tables[i].shape)
                n = np.bincount(w, minlength=len(h))
                some = np.flatnonzero(n)
                held.append((h[some], leaf[some], n[some]))
                size += len(some)
                if size >= 500_000:
                    yield words()
                    held, size = [], 0
        if held:
            yield words()
        for block, data in _blocks(tables):
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.int64()),
                                              pa.array([block], pa.int64()), pa.array([data], pa.binary())], names)

    return train.select("text").mapInArrow(run, "h long, leaf int, n long, block long, data binary")


def gradient(part: DataFrame, sent, shape: Shape) -> list:
    """Empirical minus expected class counts per feature row over the texts of ``part``."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        model = sent.value
        tables = [np.zeros(s[::-1], np.float32) for s in _shapes(shape)[:6]]  # a line per class: added up by bincount
        for b in batches:
            for _, w, before, second, h, c1, c2 in token_chunks(b.column(0), shape):
                c1, c2 = c1[w], c2[w]
                rows = feature_rows(h[before], h[second], c1, shape)
                for s in range(0, len(c1), ADDED):
                    n = min(ADDED, len(c1) - s)
                    surplus = [np.empty((shape.first, n)), np.empty((shape.second, n))]
                    for at in range(0, n, PART):
                        to = min(at + PART, n)
                        cut = slice(s + at, s + to)
                        for out, p, c in zip(surplus, model.probabilities([r[cut] for r in rows], c1[cut]), (c1[cut], c2[cut])):
                            p[np.arange(len(c)), c] -= 1
                            out[:, at:to] = p.T
                    for i, r in enumerate(rows):
                        r = r[s:s + n]
                        for line, p in zip(tables[i], surplus[i // 3]):
                            line -= np.bincount(r, p, minlength=shape.rows)
        for block, data in _blocks([t.T for t in tables]):
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([data], pa.binary())],
                                             ["block", "data"])

    return summed_blocks(part.select("text").mapInArrow(run, "block long, data binary"))


def head_counts(vocab: DataFrame):
    """Hashes and counts of at most ``HEAD`` frequent tokens: those above a count that so few reach."""
    import numpy as np

    bins = vocab.groupBy(F.floor(F.log2("c") * 8).alias("b")).count().orderBy(F.desc("b")).collect()
    total, low = 0, None
    for r in bins:
        total += r["count"]
        if total > HEAD:
            break
        low = r["b"]
    if low is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    rows = vocab.where(F.floor(F.log2("c") * 8) >= low).select("h", "c").collect()
    h, c = np.array([r["h"] for r in rows], np.int64), np.array([r["c"] for r in rows], np.int64)
    order = np.argsort(h)
    return h[order], c[order]


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", modulus: int = 5, held_out: int = 1,
                shape: Shape | None = None, rounds: int = 4, share: int = 4) -> DataFrame:
    """``(id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` per row.

    The model learns from rows whose crc32 of the id leaves another remainder than ``held_out``;
    each of the ``rounds`` updates takes another ``1 / share`` of them, so fewer rounds than shares would
    leave rows out and are refused.  Without a ``shape`` the model is sized by the training text.
    """
    import numpy as np

    if rounds < share:
        raise ValueError(f"{rounds} rounds leave out {share - rounds} of {share} shares of the training rows")
    spark = docs.sparkSession
    src = narrow(docs, id_col, text_col).withColumn("train", train_part(F.col("id"), modulus, held_out))
    train = src.where("train")
    text_bytes = train.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shape = shape or Shape.sized(text_bytes)
    got = stored(gather(few_tasks(train, text_bytes), shape), "lm-counts")
    vocab = stored(got.where("h IS NOT NULL").groupBy("h").agg(F.min("leaf").alias("leaf"), F.sum("n").alias("c")), "vocab")
    counts = _tables(summed_blocks(got.where("block IS NOT NULL").select("block", "data")), _shapes(shape))
    model = Weights(shape, (counts[:6], counts[6]))
    for i in range(rounds):
        part = train.where(F.pmod(F.xxhash64("id"), F.lit(share)) == i % share)
        sent = spark.sparkContext.broadcast(model)
        step = gradient(few_tasks(part, text_bytes), sent, shape)
        sent.destroy()
        model.update(_tables(step, _shapes(shape)[:6]), 1 / share)
    model.counts = None
    leaves = np.zeros((shape.first * shape.second, 2))
    for r in vocab.groupBy("leaf").agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect():
        leaves[r["leaf"]] = r["n"], r["v"]
    n, v = int(leaves[:, 0].sum()), int(leaves[:, 1].sum())
    sent = spark.sparkContext.broadcast((model, np.log10(leaves[:, 0] + 0.5 * (leaves[:, 1] + 1)), *head_counts(vocab)))

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        model, size, head, count = sent.value
        uid = TaskContext.get().partitionId() << 33
        for b in (b.slice(i, 1000) for b in batches for i in range(0, b.num_rows, 1000)):
            k = b.num_rows
            tokens, known, base, fit = np.zeros(k, np.int64), np.zeros(k, np.int64), np.zeros(k), np.zeros(k)
            rare, times, each_rare = [], [], np.zeros(k, np.int64)
            for doc, w, before, second, h, c1, c2 in token_chunks(b.column(2), shape):
                tokens += np.bincount(doc, minlength=k)
                a1, a2 = c1[w], c2[w]
                rows = feature_rows(h[before], h[second], a1, shape)
                each = -size[c1 * shape.second + c2][w]
                for at in range(0, len(w), PART):
                    cut = slice(at, at + PART)
                    for (p, total), c in zip(model.shares([r[cut] for r in rows], a1[cut]), (a1[cut], a2[cut])):
                        each[cut] += np.log10(p[np.arange(len(c)), c].astype(float) / total)
                fit += np.bincount(doc, each, minlength=k)
                h = h.view(np.int64)
                place = np.minimum(np.searchsorted(head, h), max(0, len(head) - 1))
                seen = head[place] == h if len(head) else np.zeros(len(h), bool)
                logs = np.zeros(len(h))
                logs[seen] = np.log10(count[place[seen]] + 0.5)
                there = seen[w]
                known += np.bincount(doc[there], minlength=k)
                base += np.bincount(doc, logs[w], minlength=k)
                found, reps = np.unique(doc[~there] * len(h) + w[~there], return_counts=True)
                rare.append(h[found % len(h)])
                times.append(reps)
                each_rare += np.bincount(found // len(h), minlength=k)
            ends = pa.array(np.r_[0, np.cumsum(each_rare)].astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(uid, uid + k)), b.column(0), b.column(1), pa.array(tokens), pa.array(known),
                 pa.array(base), pa.array(fit), *(pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x).astype(np.int64)))
                                                  for x in (rare, times))],
                ["uid", "id", "train", "n_tokens", "known", "base", "fit", "rare", "times"])
            uid += k

    rows = stored(src.select("id", "train", "text").mapInArrow(
        run, "uid long, id long, train boolean, n_tokens long, known long, base double, fit double, "
             "rare array<long>, times array<long>"), "lm-scores")
    tail = rows.select("uid", F.explode(F.arrays_zip("rare", "times")).alias("x")).select(
        "uid", F.col("x.rare").alias("h"), F.col("x.times").alias("k"))
    more = (tail.join(vocab.select("h", "c"), "h", "left").groupBy("uid").agg(
        F.sum(F.when(F.col("c") > 0, F.col("k")).otherwise(0)).alias("more_known"),
        F.sum(F.col("k") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("more_base")))
    out = rows.drop("rare", "times").join(more, "uid", "left")
    counted = F.col("base") + F.coalesce("more_base", F.lit(0.0))
    every = F.lit(float(np.log10(n + 0.5 * (v + 1))))
    return out.select("id", (F.col("id").isNotNull() & ~F.col("train")).alias("held_out"), "n_tokens",
                      (F.col("known") + F.coalesce("more_known", F.lit(0))).cast("long").alias("n_known"),
                      F.lit(n).cast("long").alias("train_tokens"),
                      (counted - F.col("n_tokens") * every).alias("base_score"), (counted + F.col("fit")).alias("score"))
