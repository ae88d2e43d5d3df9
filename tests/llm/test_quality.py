"""Nearest-neighbour quality voting: terms and votes against plain loops, odd rows, held-out accuracy."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadlens.llm import quality_knn as qk
from loadlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
MASK = (1 << 64) - 1


def word_bucket(word: bytes) -> int:
    h = sum((b + 1) * pow(qk.BASE, i, 1 << 64) for i, b in enumerate(word.lower())) * qk.MIX & MASK
    h ^= h >> 29
    return (h * qk.BASE & MASK) >> (64 - 13)


def plain_counts(text: str) -> Counter:
    """The terms of one text, byte by byte."""
    kind, _ = qk._tables()
    data = text.encode("utf-8", "surrogatepass")
    out: Counter = Counter()
    runs = [k for i, k in enumerate(kind[b] for b in data) if i == 0 or k != kind[data[i - 1]]]
    for a, b, c in zip(runs, runs[1:], runs[2:]):
        out[qk.WORDS + (int((a * 64 + b) * 64 + c) * qk.MIX & MASK) // (1 << 53)] += 1
    words, now = [], b""
    for b in data + b" ":
        if 2 <= kind[b] <= 4:
            now += bytes([b])
        elif now:
            words.append(now.lower())
            now = b""
    last: dict = {}
    for i, w in enumerate(words):
        out[word_bucket(w)] += 1
        out[qk.WORDS + qk.SHAPES + (min(qk.GAPS - 2, int(math.log2(i - last[w]))) if w in last else qk.GAPS - 1)] += 1
        last[w] = i
    return out


TEXTS = ["The cat. The CAT, the dog!!", "", "x", "ÄÖ ä1 ä1 a\n\nb | b | b", "one two three one two three one", "&&& $$$", "\x00\x7f~"]


def test_terms_equal_a_plain_loop():
    got = qk.term_counts(TEXTS)
    for row, text in zip(got, TEXTS):
        want = plain_counts(text)
        assert {int(i): int(row[i]) for i in np.flatnonzero(row)} == dict(want), text


def test_terms_do_not_depend_on_the_block():
    whole = qk.term_counts(TEXTS)
    for i, t in enumerate(TEXTS):
        assert (qk.term_counts([t])[0] == whole[i]).all()


@pytest.fixture(scope="module")
def labelled(spark):
    good = [(i, f"A plain sentence number {i} about rivers and towns. It goes on for a while.", 1) for i in range(0, 60)]
    bad = [(i, f"BUY!!! now### {i} $$$ cheap&&& cheap&&& cheap&&&", 0) for i in range(60, 120)]
    rows = spark.createDataFrame(good + bad, "doc_id long, text string, quality int")
    return rows.select("doc_id", "text"), rows.select("doc_id", "quality")


def test_votes_equal_brute_force(labelled):
    model = qk.train(*labelled)
    assert len(model.labels) <= 120 and model.vectors.shape[1] <= qk.Settings().axes
    texts = [r.text for r in labelled[0].orderBy("doc_id").collect()[::5]] + ["", "rivers and towns", "cheap&&&"]
    got = model.score(texts)
    for text, score in zip(texts, got):
        v = model.latent([text])[0]
        near = sorted(((round(float(v @ w), 9), y) for w, y in zip(model.vectors, model.labels)), reverse=True)
        least = near[model.neighbours - 1][0]
        votes = [(max(c, 0.0), y) for c, y in near if c >= least]
        total = sum(c for c, _ in votes)
        want = sum(c * y for c, y in votes) / total if total > 0 else model.prior
        assert abs(score - want) < 1e-6


def test_odd_rows(spark, labelled):
    model = qk.train(*labelled)
    long = "word " * 200_000
    rows = [(1, None), (2, ""), (None, "rivers and towns"), (3, long), (3, "rivers and towns"), (3, "rivers and towns"), (4, " \n")]
    odd = spark.createDataFrame(rows, "doc_id long, text string").select("*", F.lit(9).alias("id"), F.lit("a").alias("score"))
    got = qk.score_quality(odd, model).collect()
    assert len(got) == len(rows) and set(got[0].asDict()) == {"doc_id", "text", "id", "score", "predicted"}
    empties = {r.score for r in got if not (r.text or "").strip()}
    assert len(empties) <= 2 and all(0 <= s <= 1 for s in empties)
    assert {r.score for r in got if r.text == ""} == {r.score for r in got if r.text is None} == {model.prior}
    assert len({r.score for r in got if r.text == "rivers and towns"}) == 1
    assert qk.score_quality(odd.limit(0), model).count() == 0


def test_labels_that_cannot_be_used(spark, labelled):
    docs, labels = labelled
    none = spark.createDataFrame([(1, None), (2, 7), (10_000, 1), (None, 1)], "doc_id long, quality int")
    model = qk.train(docs, none)
    assert not len(model.labels)
    assert {r.score for r in qk.score_quality(docs, model).collect()} == {0.5}
    # both labels for one id: an example of each; rows of other labels change nothing
    both = labels.unionByName(none).unionByName(spark.createDataFrame([(1, 0)], "doc_id long, quality int"))
    assert len(qk.train(docs, both).labels) == len(qk.train(docs, labels).labels) + 1
    assert qk.train(docs.limit(0), labels).prior == 0.5


def test_the_sample_is_bounded(labelled):
    model = qk.train(*labelled, settings=qk.Settings(labelled=20, axes=5))
    assert len(model.labels) == 20 and model.vectors.shape == (20, 5)


def test_held_out_accuracy(spark):
    got = QUERIES["op11_quality"](spark, SF)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    rows = got.where("held_out").join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").collect()
    good = [r.predicted for r in rows if r.quality == 1]
    bad = [r.predicted for r in rows if r.quality == 0]
    assert np.mean(good) >= 0.97 and np.mean(bad) <= 0.2
