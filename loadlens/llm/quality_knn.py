"""Quality by nearest-neighbour voting in a latent-semantic space.

A text's terms are of three families, all hashed to fixed widths: lower-cased words (runs of letters,
digits and non-ASCII bytes), runs of three character classes (lower, upper, digit, space, line end, each
mark for itself; equal neighbours count once), and by how many words ago a word was last
seen (powers of two; or never).  A term weighs ``log(1 + count) * idf``, each family has length one, and
a truncated singular value decomposition of the labelled texts gives the latent axes.

The labelled latent vectors are broadcast (``Settings.labelled`` bounds them).  Every document is multiplied with
all of them in blocks, exactly; its ``neighbours`` nearest, and whatever ties with the last of them,
vote with their labels, weighted by cosine (negative: no vote).

Document frequencies cover all documents; labelled texts are a sample bounded by ``Settings.labelled``, taken
by a hash of the id.  Defined cases: null and empty texts, and texts without a vote, score the mean
label of the sample; labels that are null or not 0 or 1, or of unknown ids, are ignored; an id labelled both ways
gives an example of each; without labelled texts every score is 0.5; whole texts of any length; rows come
back one for one, repeated ids included; an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.llm.common import narrow, ship, stored, train_part

WORDS, SHAPES, GAPS = 8192, 2048, 17  # hashed widths of the three families
WIDTH = WORDS + SHAPES + GAPS
FAMILIES = ((0, WORDS), (WORDS, WORDS + SHAPES), (WORDS + SHAPES, WIDTH))
BLOCK_DOCS, BLOCK_BYTES = 256, 4 << 20
BASE, MIX = 0x9E3779B97F4A7C15 | 1, 0xD6E8FEB86659FD93


@dataclass(frozen=True)
class Settings:
    """``labelled`` bounds the texts that vote, and so the model's size; the rest are the model's shape."""

    labelled: int = 4096
    axes: int = 64
    neighbours: int = 7
    power_rounds: int = 3


def _tables():
    """Class and lower-case form of each byte."""
    import numpy as np

    kind = np.arange(256, dtype=np.int64) % 64  # marks and control characters: classes of their own below
    kind[33:48], kind[58:65], kind[91:97], kind[123:127] = (np.arange(6, 21), np.arange(21, 28), np.arange(28, 34),
                                                            np.arange(34, 38))
    kind[:33], kind[127] = 38, 38
    kind[[32, 9]], kind[10:14] = 0, 1
    kind[97:123], kind[128:], kind[65:91], kind[48:58] = 2, 2, 3, 4
    low = np.arange(256, dtype=np.uint64)
    low[65:91] += 32
    return kind, low


_POWERS: list = []


def _powers(n: int):
    """``BASE ** i`` and ``BASE ** -i`` modulo 2**64 for i < n."""
    import numpy as np

    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, BLOCK_BYTES + 1)
        up, down = np.full(size, BASE, np.uint64), np.full(size, pow(BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _POWERS[:] = [np.multiply.accumulate(up), np.multiply.accumulate(down)]
    return _POWERS


def term_counts(texts: list[str]):
    """Dense ``len(texts) x WIDTH`` counts of the texts' terms."""
    import numpy as np

    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    n = len(raw)
    if not len(data):
        return np.zeros((n, WIDTH), np.float32)
    size = np.array([len(b) for b in raw])
    doc = np.repeat(np.arange(n), size)
    kind, low = _tables()
    k = kind[data]
    first = np.zeros(len(data), bool)
    first[np.cumsum(size)[:-1][np.cumsum(size)[:-1] < len(data)]] = True
    first[0] = True

    # runs of character classes
    run = first.copy()
    run[1:] |= k[1:] != k[:-1]
    c, d = k[run], doc[run]
    codes = []
    if len(c) >= 3:
        inside = d[2:] == d[:-2]
        shape = ((c[:-2] * 64 + c[1:-1]) * 64 + c[2:])[inside].astype(np.uint64)
        shape = (shape * np.uint64(MIX)) >> np.uint64(64 - 11)
        codes.append(d[2:][inside] * WIDTH + WORDS + shape.astype(np.int64))

    # words, by a polynomial hash of their bytes
    letter = (k >= 2) & (k <= 4)
    start = letter & first
    start[1:] |= letter[1:] & ~letter[:-1]
    end = np.ones(len(data), bool)
    end[:-1] = ~letter[1:] | first[1:]
    begin, stop = np.flatnonzero(start), np.flatnonzero(letter & end) + 1
    if len(begin):
        up, down = _powers(len(data) + 1)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((low[data] + np.uint64(1)) * up[:len(data)], out=total[1:])
        word = (total[stop] - total[begin]) * down[begin] * np.uint64(MIX)
        word ^= word >> np.uint64(29)
        word *= np.uint64(BASE)
        at = doc[begin]
        codes.append(at * WIDTH + (word >> np.uint64(64 - 13)).astype(np.int64))
        key = (word + at.astype(np.uint64) * np.uint64(MIX)) * np.uint64(BASE)
        order = np.argsort(key, kind="stable")
        seen = key[order][1:] == key[order][:-1]
        gap = np.full(len(word), GAPS - 1)
        ago = (order[1:] - order[:-1])[seen]
        gap[order[1:][seen]] = np.minimum(GAPS - 2, np.log2(ago).astype(int))
        codes.append(at * WIDTH + WORDS + SHAPES + gap)
    code = np.concatenate(codes) if codes else np.zeros(0, np.int64)
    return np.bincount(code, minlength=n * WIDTH).reshape(n, WIDTH).astype(np.float32)


def blocks(texts: list[str]):
    """``(begin, end)`` of blocks of texts, bounded in number and, beyond one text, in bytes."""
    begin, size = 0, 0
    for i, t in enumerate(texts):
        if i > begin and (i - begin >= BLOCK_DOCS or size + len(t) > BLOCK_BYTES // 2):
            yield begin, i
            begin, size = i, 0
        size += len(t)
    if begin < len(texts):
        yield begin, len(texts)


def weighted(counts, idf):
    """Term weights: logarithmic counts times idf, each family of length one (or zero)."""
    import numpy as np

    x = np.log1p(counts) * idf
    for a, b in FAMILIES:
        norm = np.sqrt((x[:, a:b] ** 2).sum(1, keepdims=True))
        np.divide(x[:, a:b], norm, out=x[:, a:b], where=norm > 0)
    return x


def unit_rows(x):
    import numpy as np

    norm = np.sqrt((x.astype(np.float64) ** 2).sum(1, keepdims=True))
    return np.divide(x, norm, out=np.zeros(x.shape), where=norm > 1e-9)


class Model:
    """Idf, latent axes, and the labelled latent vectors with their labels."""

    def __init__(self, idf, rows: list[tuple], settings: Settings):
        """``rows``: ``(terms, weights, label)`` of each labelled text, weights as ``weighted`` gives them."""
        import numpy as np

        self.idf, self.neighbours = idf, settings.neighbours
        self.labels = np.array([y for _, _, y in rows], np.float64)
        self.prior = float(self.labels.mean()) if rows else 0.5
        self.vectors, self.axes = np.zeros((0, 0)), np.zeros((WIDTH, 0), np.float32)
        if not rows:
            return

        def dense(i):
            x = np.zeros((len(rows[i:i + BLOCK_DOCS]), WIDTH), np.float32)
            for r, (terms, w, _) in enumerate(rows[i:i + BLOCK_DOCS]):
                x[r, terms] = w
            return x

        # randomised subspace iteration on X^T X, block by block of labelled rows
        width = min(settings.axes + 8, len(rows), WIDTH)
        q = np.linalg.qr(np.random.default_rng(7).standard_normal((WIDTH, width)))[0].astype(np.float32)
        for _ in range(settings.power_rounds):
            s = np.zeros((WIDTH, width))
            for i in range(0, len(rows), BLOCK_DOCS):
                x = dense(i)
                s += x.T @ (x @ q)
            q = np.linalg.qr(s)[0].astype(np.float32)
        y = np.concatenate([dense(i) @ q for i in range(0, len(rows), BLOCK_DOCS)])
        _, _, turn = np.linalg.svd(y, full_matrices=False)
        turn = turn[:settings.axes].T
        self.axes = (q @ turn).astype(np.float32)
        self.vectors = unit_rows(y @ turn)

    def latent(self, texts: list[str]):
        """Latent vectors of length one (zero where a text has no terms)."""
        return unit_rows(weighted(term_counts(texts), self.idf) @ self.axes)

    def score(self, texts: list[str]):
        """Share of label 1 among each text's nearest labelled vectors, weighted by cosine."""
        import numpy as np

        out = np.full(len(texts), self.prior)
        if not len(self.labels):
            return out
        k = min(self.neighbours, len(self.labels))
        for a, b in blocks(texts):
            # rounded, so that a last bit of the product decides no neighbour
            near = np.round(self.latent(texts[a:b]) @ self.vectors.T, 9)
            least = np.partition(near, near.shape[1] - k, axis=1)[:, near.shape[1] - k]
            vote = np.where(near >= least[:, None], np.maximum(near, 0.0), 0.0)
            total = vote.sum(1)
            np.divide(vote @ self.labels, total, out=out[a:b], where=total > 0)
        return np.clip(out, 0.0, 1.0)


def inverse_frequencies(texts: DataFrame):
    """Idf of every hashed term over all rows of ``(id, text)``; what is collected has ``WIDTH`` rows."""
    import numpy as np

    def run(batches):
        import pyarrow as pa

        found, rows = np.zeros(WIDTH, np.int64), 0
        for b in batches:
            part = [t or "" for t in b.column(1).to_pylist()]
            rows += len(part)
            for i, j in blocks(part):
                found += (term_counts(part[i:j]) > 0).sum(0)
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[some, -1]), pa.array(np.r_[found[some], rows])], ["term", "n"])

    got = texts.mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    df, n = np.zeros(WIDTH), 0
    for r in got:
        if r["term"] < 0:
            n = r["n"]
        else:
            df[r["term"]] = r["n"]
    return np.log((n + 1.0) / (df + 0.5)).clip(0.0).astype(np.float32)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", modulus: int = 5, held_out: int = 0, settings: Settings = Settings()) -> Model:
    """A model from labelled rows whose crc32 of the id leaves another remainder than ``held_out``."""
    import numpy as np

    src = narrow(docs, id_col, text_col)
    idf = inverse_frequencies(src)
    y = labels.select(labels[f"`{id_col}`"].cast("long").alias("id"), labels[f"`{label_col}`"].cast("int").alias("y"))
    y = y.where(F.col("y").isin(0, 1) & train_part(F.col("id"), modulus, held_out)).distinct()
    # the broadcast side has a fixed bound; some of its ids may lack a document
    y = stored(y.orderBy(F.xxhash64("id"), "id", "y").limit(4 * settings.labelled), "quality-labels")
    rows = src.join(F.broadcast(y), "id").select("id", "y", F.coalesce("text", F.lit("")).alias("text"))

    def run(batches):
        import pyarrow as pa

        for b in batches:
            texts = b.column(2).to_pylist()
            terms, weights = [], []
            for i, j in blocks(texts):
                for row in weighted(term_counts(texts[i:j]), idf):
                    terms.append(np.flatnonzero(row).astype(np.int32).tobytes())
                    weights.append(row[row != 0].tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(terms, pa.binary()),
                                              pa.array(weights, pa.binary())], ["id", "y", "terms", "weights"])

    got = rows.mapInArrow(run, "id long, y int, terms binary, weights binary")
    got = got.orderBy(F.xxhash64("id"), "id", "y", "terms", "weights").limit(settings.labelled).collect()
    return Model(idf, [(np.frombuffer(r["terms"], np.int32), np.frombuffer(r["weights"], np.float32), r["y"])
                       for r in got], settings)


def score_quality(docs: DataFrame, model: Model, threshold: float = 0.3, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` (score >= threshold), replacing columns of those names."""
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # Settings bound its size

    @F.pandas_udf("double")
    def score(text):
        import pandas as pd

        return pd.Series(sent.value.score([t or "" for t in text.tolist()]), dtype=float)

    keep = [c for c in docs.columns if c not in ("score", "predicted")]
    out = docs.select(*[docs[f"`{c}`"] for c in keep], score(docs[f"`{text_col}`"].cast("string")).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= F.lit(threshold)).cast("int"))
