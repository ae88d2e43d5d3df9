"""Token alignment: sparse products against dense ones, the whole job against plain loops over tokens and bytes."""

import hashlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from loadlens.llm import align as al
from loadlens.llm.queries import BYTE_LEVEL, PIECES, QUERIES

SF_SMALL = "/root/testdata/sf0.001"


def dense(matrix, columns):
    out = np.zeros((len(matrix[0]) - 1, columns), int)
    for i, (s, e) in enumerate(zip(matrix[0], matrix[0][1:])):
        out[i, matrix[1][s:e]] += 1
    return out


@pytest.mark.parametrize("terms", [3, 1 << 20])
def test_products_equal_dense_products(monkeypatch, terms):
    monkeypatch.setattr(al, "TERMS", terms)
    rng = np.random.default_rng(1)
    for _ in range(20):
        n, k, m = rng.integers(1, 12, 3)
        a, b = rng.random((n, k)) < 0.4, rng.random((m, k)) < 0.4
        csr = [(np.r_[0, np.cumsum(x.sum(1))], np.nonzero(x)[1]) for x in (a, b)]
        bt = al.transposed(csr[1], k)
        assert (dense(bt, m) == b.T).all()
        want = a.astype(int) @ b.T.astype(int)
        got = np.zeros((n, m), int)
        for row, col, value in al.product(csr[0], bt):
            assert not got[row, col].any()
            got[row, col] = value
        assert (got == want).all()
        sizes = al.row_sizes(csr[0], bt)
        assert sizes.tolist() == [sum(b.T[c].sum() for c in np.flatnonzero(r)) for r in a]


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(BYTE_LEVEL)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PIECES)


def by_hand(texts, tokenizers):
    """``(n_a, n_b, n_groups, n_links, n_shared, n_best, count_sum, sha)`` per text, token by token."""
    a, b = tokenizers
    letters = al.byte_letters()
    made, counts = [], Counter()
    for t in texts:
        ids = a.encode(" " + t, add_special_tokens=False).ids if t else []
        pieces = b.encode(t) if t else []
        left = [bytes(letters[c] for c in a.id_to_token(i)) if i != 50256 else b"<|endoftext|>" for i in ids]
        right = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
                 for i in pieces]
        if not t or not b"".join(left) == b"".join(right) == (" " + t).encode():
            made.append(None)
            continue

        def spans(tokens):
            at, out = 0, []
            for x in tokens:
                out.append((at, at + len(x)))
                at += len(x)
            return out

        sa, sb = spans(left), spans(right)
        ends = sorted({e for _, e in sa} & {e for _, e in sb})
        links, j = [], 0
        for i, (s, e) in enumerate(sa):
            while sb[j][1] <= s:
                j += 1
            k = j
            while k < len(sb) and sb[k][0] < e:
                links.append((ids[i], pieces[k]))
                k += 1
        counts.update(links)
        groups, low = [], 0
        for e in ends:
            groups.append(([i for i, x in zip(ids, sa) if low < x[1] <= e], [i for i, x in zip(pieces, sb) if low < x[1] <= e]))
            low = e
        made.append((len(ids), len(pieces), groups, links))
    most: dict = {}
    for (_, y), n in counts.items():
        most[y] = max(most.get(y, 0), n)
    out = []
    for m in made:
        if m is None:
            out.append((0,) * 7 + ("",))
            continue
        n_a, n_b, groups, links = m
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((n_a, n_b, len(groups), len(links), sum(len(x) * len(y) for x, y in groups),
                    sum(counts[p] == most[p[1]] for p in links), sum(counts[p] for p in links),
                    hashlib.sha256(text.encode()).hexdigest()))
    return out


TEXTS = ["Hello world, tokenization!", None, "", " ", "  two  spaces ", "line\nbreak\r\n\ttab", "日本語 と 漢字", "ümläut £5 œuvre",
         "<|endoftext|> and </s> <s> <unk> <0x41>", "▁ marks ▁", "é combining", "\U0001f600 smile", "Hello world, tokenization!",
         "\x00\x7f", "word " * 3000, "a" * 5000, "ﬁ ligature", "1234567890 " * 3, " nbsp", "xyz"]


def key(rows):
    return sorted(((-1 if r[0] is None else r[0], *r[1:]) for r in rows))


def test_odd_texts_equal_plain_loops(spark, tokenizers):
    rows = [(i if i != 7 else None, t) for i, t in enumerate(TEXTS)] + [(0, "repeated id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    df = df.select("*", F.lit(1).alias("id"), F.lit("x").alias("pair"), F.lit(2).alias("n_a"))
    got = al.align(df, BYTE_LEVEL, PIECES).collect()
    want = [(i, *w) for (i, _), w in zip(rows, by_hand([t for _, t in rows], tokenizers))]
    assert key([tuple(r) for r in got]) == key(want)
    assert sum(r.n_a > 0 for r in got) > 8


def test_segments_are_tokenized_alike_wherever_they_stand(tokenizers):
    a, b = tokenizers
    vocab = al.Vocabularies(a.to_str(), b.serialized_model_proto())
    texts = [t for t in TEXTS if t] + ["don't  stop\n now ,ok  it's \x1c x\u3000y z ", " a b", "tab\tand space ok"]
    for t in texts:
        parts = al.segments(t)
        assert " ".join(parts) == t
        whole, cut = vocab._spell(t), [vocab._spell(p) for p in parts]
        assert (whole is None) == (None in cut)
        if whole:
            assert [i for x in cut for i in x[0]] == whole[0] and [i for x in cut for i in x[1]] == whole[1]


def test_links_of_both_products(spark):
    df = spark.createDataFrame([(1, "Hello tokenization"), (2, None)], "doc_id long, text string")
    near, shared = (al.links(df, BYTE_LEVEL, PIECES, shared=s).collect() for s in (False, True))
    figures = al.align(df, BYTE_LEVEL, PIECES).where("id = 1").first()
    assert len(near) == figures.n_links and len(shared) == figures.n_shared
    assert sum(r.n_bytes for r in near) == len(" Hello tokenization")
    assert {(r.a_place, r.b_place) for r in near} <= {(r.a_place, r.b_place) for r in shared}


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert al.align(none, BYTE_LEVEL, PIECES).count() == 0 and al.links(none, BYTE_LEVEL, PIECES).count() == 0


def test_query_equals_plain_loops(spark, tokenizers):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = {r.doc_id: w for r, w in zip(docs, by_hand([r.text for r in docs], tokenizers))}
    got = QUERIES["op13_token_alignment"](spark, SF_SMALL).collect()
    assert len(got) == len(docs) and all(tuple(r)[1:] == want[r.doc_id] for r in got)
