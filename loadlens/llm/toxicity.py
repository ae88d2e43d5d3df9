"""Toxicity by a subsequence string-kernel support vector machine with Nyström landmarks.

A text is taken apart into sentences and these into units: words with edges, inner marks and digit look-alikes
removed, single letters set apart by spaces or marks put together, long words in overlapping
windows.  The kernel of two units sums, over common letter subsequences of 3 and 4 letters,
``DECAY ** gaps`` of both occurrences, which may stretch over ``SPAN`` letters: gapped or
padded insults stay close to the plain ones, and inflected forms to their stem.  Landmarks are
units of labelled toxic texts, spread out, and their closest clean look-alikes; a unit's features are its kernel
values with the landmarks times ``K_LL ** -1/2``, and a linear SVM (squared hinge) separates the
witnesses of toxic sentences from units of clean ones.  A sentence is as toxic as its most toxic unit, a text as
its most toxic sentence; the score is the logistic of the margin.

Counts of units by label cover all labelled training rows; landmarks and the SVM's examples are
bounded (``Settings``).  Clean look-alikes are mined by scoring every clean unit.  Defined cases: null
and empty texts score as having no units (the SVM's bias); labels null or other than 0 and 1, or of
unknown ids, are ignored; an id labelled both ways counts as both; with no unit of enough evidence every score is
0.0; whole texts of any length; rows come back one for one.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.llm.common import narrow, sized_broadcast, stored, train_part

DECAY = 0.5  # per letter of gap
SHARE = {3: 0.3, 4: 1.0}  # weight of common subsequences by length
SPAN = {3: 5, 4: 6}  # letters an occurrence may stretch over, by subsequence length
WINDOW, STEP = 24, 12  # longer units are cut into overlapping windows
CACHE_TOKENS = 300_000
DENSE_CODES = 1 << 20  # codes of three letters held in a table; more are looked up by search
LOOKALIKES = str.maketrans("013457@$!|", "oieastasil")
SPACED = re.compile(r"(?<!\w)[^\W\d_](?:[ .\-_*+~]{1,2}[^\W\d_]){2,}(?!\w)")


@dataclass(frozen=True)
class Settings:
    """Bounds of what training holds on the driver."""

    landmarks: int = 40
    look_alikes: int = 24
    rounds: int = 2
    clean_cost: float = 5.0  # a clean sentence misjudged, in toxic texts missed
    toxic_units: int = 4000
    clean_units: int = 12_000
    purity: float = 0.95  # least share of a witness's sentences that are toxic
    evidence: float = 11.5  # least log-likelihood gain of its counts over the base rate
    contexts: int = 4  # least number of texts that show it anew, whatever other witnesses have


def token_units(token: str) -> list[str]:
    """Units of one lower-cased token."""
    if not token.isalpha():
        token = "".join(c for c in token.strip("!|.,;:?()\"'").translate(LOOKALIKES) if c.isalpha())
    if len(token) < 3:
        return []
    if len(token) <= WINDOW:
        return [token]
    return [token[i:i + WINDOW] for i in range(0, len(token) - STEP, STEP)]


def text_tokens(text: str | None) -> set[str]:
    """Distinct tokens of a text; a run of single letters is one token more."""
    low = (text or "").lower()
    got = set(low.split())
    got.update("".join(c for c in m[0] if c.isalpha()) for m in SPACED.finditer(low))
    return got


def occurrences(p: int):
    """``(offsets, span)`` of the ways p letters can lie within ``SPAN[p]``."""
    return [((0, *rest), rest[-1] + 1) for rest in combinations(range(1, SPAN[p]), p - 1)]


def size_norm(n: int) -> float:
    """Norm of a unit of n letters whose subsequences are all different."""
    return sum(max(0, n - span + 1) * SHARE[p] * DECAY ** (2 * (span - p)) for p in SPAN for _, span in occurrences(p)) ** 0.5


class Kernel:
    """Kernel values of units with fixed landmarks, scaled by both sizes, in numpy over many units at once."""

    def __init__(self, landmarks: list[str]):
        import numpy as np

        self.landmarks = landmarks
        self.norms = np.array([size_norm(n) or 1.0 for n in range(WINDOW + 1)])
        # letters are numbered from 1; others are 0 and match nothing (four numbers fit a long code)
        letters = sorted({ord(c) for w in landmarks for c in w})
        self.base = len(letters) + 1
        self.letter = np.zeros(max(letters, default=0) + 2, np.int32)
        self.letter[letters] = np.arange(1, self.base)
        own = self._ids(landmarks)
        self.tables = []
        for p in sorted(SPAN):
            feats: dict[int, dict[int, float]] = {}
            for j in range(len(landmarks)):
                for at, span in occurrences(p):
                    for s in range(len(landmarks[j]) - span + 1):
                        got = [int(own[j, s + o]) for o in at]
                        code = 0
                        for g in got:
                            code = code * self.base + g
                        if all(got):
                            row = feats.setdefault(code, {})
                            row[j] = row.get(j, 0.0) + SHARE[p] * DECAY ** (span - p) / self.norms[len(landmarks[j])]
            codes = np.array(sorted(feats), np.int64)
            lists = [sorted(feats[c].items()) for c in codes.tolist()]
            start = np.r_[0, np.cumsum([len(x) for x in lists])].astype(np.int64)
            mark = np.array([j for x in lists for j, _ in x], np.int64)
            value = np.array([v for x in lists for _, v in x])
            place = None
            if p == min(SPAN) and self.base ** p <= DENSE_CODES:
                place = np.full(self.base ** p, -1, np.int16 if len(codes) < 1 << 15 else np.int32)
                place[codes] = np.arange(len(codes))
            self.tables.append((p, codes, place, start, mark, value))

    def _ids(self, units):
        import numpy as np

        width = max(map(len, units), default=0)
        raw = np.frombuffer("".join(u.ljust(width, "\0") for u in units).encode("utf-32-le", "surrogatepass"), np.uint32)
        raw = raw.reshape(len(units), width)
        return self.letter[np.minimum(raw, len(self.letter) - 1)].astype(np.int64)

    def __call__(self, units: list[str], step: int = 10_000):
        import numpy as np

        out = np.zeros((len(units), len(self.landmarks)))
        for at in self._parts(units, step):
            out[at] = self._part([units[i] for i in at])
        return out

    @staticmethod
    def _parts(units, step):
        order = sorted(range(len(units)), key=lambda i: len(units[i]))
        return [order[s:s + step] for s in range(0, len(units), step)]

    def code_weights(self, beta):
        """Per table each code's values with the landmarks, summed with weights ``beta``."""
        import numpy as np

        return [np.add.reduceat(value * beta[mark], start[:-1]) if len(codes) else np.zeros(0)
                for _, codes, _, start, mark, value in self.tables]

    def weighted(self, units: list[str], weights, step: int = 10_000):
        """``self(units) @ beta`` from ``code_weights(beta)``, without the values of single landmarks."""
        import numpy as np

        out = np.zeros(len(units))
        for at in self._parts(units, step):
            out[at] = self._part([units[i] for i in at], weights)[:, 0]
        return out

    def _part(self, units, weights=None):
        """Kernel values with each landmark, or their weighted sum as the only column."""
        import numpy as np

        n, m = len(units), len(self.landmarks) if weights is None else 1
        ids, rows, total = self._ids(units), np.arange(n), np.zeros(n * m)
        for t, (p, codes, place, start, mark, value) in enumerate(self.tables):
            if len(codes) == 0:
                break
            hit_any = np.zeros(len(rows), bool)
            for at, span in occurrences(p):
                w = ids.shape[1] - span + 1
                if w <= 0:
                    continue
                code = ids[:, :w]
                for o in at[1:]:
                    code = code * self.base + ids[:, o:o + w]
                if place is not None:
                    feat = place[code]
                    r, c = np.nonzero(feat >= 0)
                else:
                    feat = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
                    r, c = np.nonzero(codes[feat] == code)
                if len(r) == 0:
                    continue
                hit_any[r] = True
                feat = feat[r, c].astype(np.int64)
                if weights is not None:
                    total += np.bincount(rows[r], weights[t][feat] * DECAY ** (span - p), minlength=n)
                    continue
                count = start[feat + 1] - start[feat]
                first = np.repeat(start[feat] - np.r_[0, np.cumsum(count)[:-1]], count)
                pick = first + np.arange(len(first))
                total += np.bincount(np.repeat(rows[r], count) * m + mark[pick],
                                     value[pick] * DECAY ** (span - p), minlength=n * m)
            # a common subsequence of 4 letters holds a common one of 3: other units are done
            rows, ids = rows[hit_any], ids[hit_any]
        return total.reshape(n, m) / self.norms[[len(u) for u in units]][:, None]


class Model:
    """Nyström features and a linear SVM; ``weights`` None scores every text 0."""

    def __init__(self, landmarks: list[str]):
        import numpy as np

        self.kernel = Kernel(landmarks)
        values, vectors = np.linalg.eigh(self.kernel(landmarks))
        good = values > values.max(initial=0) * 1e-6
        self.map = vectors[:, good] / np.sqrt(values[good])
        self.weights, self.bias = None, 0.0
        self.cache: dict[str, float] = {}

    def features(self, units: list[str]):
        return self.kernel(units) @ self.map

    def fit(self, units: list[str], label, weight, ridge: float = 0.02, rounds: int = 50) -> None:
        """Squared-hinge SVM by Newton steps on the examples inside the margin."""
        import numpy as np

        x = np.c_[self.features(units), np.ones(len(units))]
        y = np.where(label, 1.0, -1.0)
        w, reg = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
        reg[-1] = 1e-6

        def loss(w):
            return (weight * np.maximum(0, 1 - y * (x @ w)) ** 2).sum() + reg @ (w * w)

        now = loss(w)
        for _ in range(rounds):
            inside = y * (x @ w) < 1
            a = x[inside] * weight[inside, None]
            step = np.linalg.solve(a.T @ x[inside] + np.diag(reg), a.T @ y[inside]) - w
            size = next((t for t in 0.5 ** np.arange(20) if loss(w + t * step) < now), 0)
            w = w + size * step
            before, now = now, loss(w)
            if before - now <= 1e-9 * before:
                break
        self.weights, self.bias = w[:-1], float(w[-1])
        self.code_weights = self.kernel.code_weights(self.map @ self.weights)

    def margins(self, units: list[str]):
        return self.kernel.weighted(units, self.code_weights) + self.bias

    def score(self, texts: list[str | None]) -> list[float]:
        """0 to 1 per text, 0.5 at a zero margin of its most toxic unit."""
        import numpy as np

        if self.weights is None:
            return [0.0] * len(texts)
        out = []
        for s in range(0, len(texts), 100):
            part = [text_tokens(t) for t in texts[s:s + 100]]
            if len(self.cache) > CACHE_TOKENS:
                self.cache.clear()
            new = list(set().union(*part).difference(self.cache))
            units = [token_units(t) for t in new]
            flat = [u for us in units for u in us]
            got = iter(self.margins(flat).tolist() if flat else [])
            for t, us in zip(new, units):
                self.cache[t] = max([next(got) for _ in us], default=self.bias)
            out += [max(map(self.cache.__getitem__, p), default=self.bias) for p in part]
        return (1 / (1 + np.exp(-4 * np.clip(np.array(out), -20, 20)))).tolist()


def sentences(text: str | None) -> list[str]:
    """Sentences of a text, lower-cased, each with its runs of single letters put together."""
    out = []
    for part in re.split(r"(?<=[.!?])\s|\n", (text or "").lower()):
        if part.strip():
            out.append(part.strip())
    return out


def unit_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(unit, toxic, clean)``: distinct labelled sentences of either label that hold the unit.

    A sentence has the label of its texts, clean if any of them is; copies count once.
    """

    def cut(batches):
        import pyarrow as pa

        for b in (b.slice(i, 500) for b in batches for i in range(0, b.num_rows, 500)):
            rows = [(s, y) for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for s in set(sentences(t))]
            cols = list(zip(*rows)) or [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int32())], ["s", "y"])

    def count(batches):
        import pyarrow as pa

        for b in batches:
            counts: dict[str, list[int]] = {}
            for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for u in {u for k in text_tokens(t) for u in token_units(k)}:
                    counts.setdefault(u, [0, 0])[y] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array([c[1] for c in counts.values()], pa.int64()),
                 pa.array([c[0] for c in counts.values()], pa.int64())], ["unit", "toxic", "clean"])

    rows = docs.join(labels, "id").select("text", "y").mapInArrow(cut, "s string, y int")
    rows = rows.groupBy("s").agg(F.min("y").alias("y"))
    return (rows.select("s", "y").mapInArrow(count, "unit string, toxic long, clean long")
            .groupBy("unit").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))


def unit_contexts(texts: DataFrame, units: list[str]) -> dict[str, int]:
    """Texts ``(id, text)`` that are the first to hold a unit between some pair of words, by unit.

    Copies of a text, edited or not, and repetition within a text add few.
    """
    sent = texts.sparkSession.sparkContext.broadcast(frozenset(units))

    def run(batches):
        import pyarrow as pa
        import xxhash

        wanted = sent.value
        for b in (b.slice(i, 500) for b in batches for i in range(0, b.num_rows, 500)):
            got = set()
            for n, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words = ["", *(t or "").lower().split(), ""]
                for i in range(1, len(words) - 1):
                    for u in token_units(words[i]):
                        if u in wanted:
                            near = f"{words[i - 1]} {words[i + 1]}".encode("utf-8", "surrogatepass")
                            got.add((u, xxhash.xxh64_intdigest(near) >> 1, n))
            cols = list(zip(*got)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()),
                                              pa.array(cols[2], pa.int64())], ["unit", "near", "id"])

    rows = texts.mapInArrow(run, "unit string, near long, id long")
    rows = rows.groupBy("unit", "near").agg(F.min("id").alias("id"))
    rows = rows.groupBy("unit").agg(F.count_distinct("id").alias("n")).collect()
    return {r["unit"]: r["n"] for r in rows}


def spread(units: list[str], count: int) -> list[str]:
    """Up to ``count`` units in order, leaving out near copies of those taken."""
    import numpy as np

    units = units[:8 * count]
    if not units:
        return []
    k = Kernel(units)(units)
    size = np.sqrt(np.diag(k))
    near = k / np.outer(np.where(size > 0, size, 1.0), np.where(size > 0, size, 1.0))
    taken: list[int] = []
    for i in range(len(units)):
        # a unit without a value for itself would be no landmark
        if len(taken) < count and size[i] > 0 and (not taken or near[i, taken].max() < 0.35):
            taken.append(i)
    return [units[i] for i in taken]


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", modulus: int = 5, held_out: int = 0, settings: Settings = Settings()) -> Model | None:
    """A model from the labelled rows whose crc32 of the id leaves another remainder than ``held_out``."""
    import numpy as np

    src = narrow(docs, id_col, text_col).where(train_part(F.col("id"), modulus, held_out))
    y = labels.select(labels[f"`{id_col}`"].cast("long").alias("id"), labels[f"`{label_col}`"].cast("int").alias("y"))
    y = sized_broadcast(stored(y.where(F.col("y").isin(0, 1)).distinct(), "labels"))
    counts = stored(unit_counts(src, y), "unit-counts")
    n = counts.agg(F.sum("toxic"), F.sum("clean")).first()
    if not n[0]:
        return None
    base = n[0] / (n[0] + n[1])
    share = F.col("toxic") / (F.col("toxic") + F.col("clean"))
    gain = F.col("toxic") * F.log(share / F.lit(base)) + F.when(
        F.col("clean") > 0, F.col("clean") * F.log((1 - share) / F.lit(1 - base if base < 1 else 1.0))).otherwise(0)
    toxic = (counts.withColumn("w", gain).where((share >= settings.purity) & (F.col("w") >= settings.evidence))
             .orderBy(F.desc("w"), "unit").limit(settings.toxic_units).collect())
    if not toxic:
        return None
    near = unit_contexts(src.join(y.where("y = 1"), "id").select("id", "text"), [r["unit"] for r in toxic])
    units = sorted((u for u in near if near[u] >= settings.contexts), key=lambda u: (-near[u], u))
    if not units:
        return None
    seen = np.array([near[u] for u in units], float)
    clean = counts.where((F.col("clean") > 0) & (share < F.lit(base))).select("unit", "clean")
    some = [r["unit"] for r in clean.orderBy(F.xxhash64("unit"), "unit").limit(settings.clean_units // 2).collect()]

    def fitted(landmarks, negatives):
        m = Model(landmarks)
        # clean units weigh more in all, as a text has many; a witness by its contexts, dampened
        w = np.sqrt(seen) / np.sqrt(seen).sum() * 0.2 * len(negatives)
        m.fit(units + negatives, np.r_[np.ones(len(units), bool), np.zeros(len(negatives), bool)],
              np.r_[w, np.ones(len(negatives))])
        return m

    def closest(model) -> list[tuple[str, int, float]]:
        sent = counts.sparkSession.sparkContext.broadcast(model)

        def run(batches):
            import pyarrow as pa

            for b in batches:
                m = pa.array(sent.value.margins(b.column(0).to_pylist()))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), m], ["unit", "clean", "m"])

        return [tuple(r) for r in clean.mapInArrow(run, "unit string, clean long, m double")
                .orderBy(F.desc("m"), "unit").limit(settings.clean_units // 2).collect()]

    toxic_marks = spread(units, settings.landmarks)
    worst = [u for u, _, _ in closest(fitted(toxic_marks, some))]
    marks = toxic_marks + spread([u for u in worst if u not in toxic_marks], settings.look_alikes)
    hard = set(worst)
    for _ in range(settings.rounds):
        model = fitted(marks, sorted(hard.union(some)))
        worst = closest(model)
        hard.update(u for u, _, _ in worst[:settings.clean_units // 4])
    # the cut between witnesses and look-alikes that misplaces least, by contexts and by sentences
    m = np.r_[model.margins(units), [x for _, _, x in worst]]
    gain = np.r_[seen, [-settings.clean_cost * c for _, c, _ in worst]]
    order = np.argsort(-m, kind="stable")
    best = int(np.argmax(np.cumsum(gain[order])))
    after = m[order[best + 1]] if best + 1 < len(order) else m[order[best]] - 1.0
    model.bias -= float((m[order[best]] + after) / 2)
    return model


def score_toxicity(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` (replacing columns of those names)."""
    narrow(docs, id_col, text_col)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # Settings bound its size

    @F.pandas_udf("double")
    def score(text):
        import pandas as pd

        got = [x for i in range(0, len(text), 500) for x in sent.value.score(text.iloc[i:i + 500].tolist())] if sent.value \
            else [0.0] * len(text)
        return pd.Series(got, dtype=float)

    keep = [c for c in docs.columns if c not in ("score", "predicted")]
    out = docs.select(*[docs[f"`{c}`"] for c in keep], score(docs[f"`{text_col}`"].cast("string")).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
