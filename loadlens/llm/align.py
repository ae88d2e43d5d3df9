"""Cross-tokenizer alignment by sparse products of token incidence matrices.

Two tokenizers cut the same bytes.  Token-byte incidence matrices A and B (rows: tokens, columns: the bytes of a block
of texts) are held in hand-built CSR form; the row products of Gustavson's method give A·Bᵀ, whose non-zeros are the
pairs of overlapping tokens and whose values are the bytes shared.  Bytes where tokens of both end cut a text into
groups; with group incidence matrices the same product gives the pairs of tokens that share a group (counted by its
symbolic phase, which needs no pair to be written out).

Both tokenizers end a token before a single space between two non-spaces, so a text is cut there into segments
that are tokenized alike wherever they stand (``Vocabularies`` checks the vocabularies for it).  The matrices are
those of a batch's distinct segments; a text's figures are sums over its segments.

Corpus-wide pair counts: a batch of texts sends each distinct pair once with its number, Spark sums them and
finds the highest per B id, and each batch gets back the figures of its own pairs, which it adds up by segment and then by
text.  No row per link is shuffled.

Defined cases: texts that are null, empty, or whose token bytes (of either tokenizer) are not exactly a space and the
text have no tokens, no links and an empty group string; strings of special tokens are plain text; whole texts of
any length; rows come back one for one, repeated and null ids included; an empty table gives none.
"""

from __future__ import annotations

import hashlib
import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.llm.common import narrow, stored

BATCH_CHARS, BATCH_TEXTS = 4 << 20, 4000  # texts whose distinct segments and pairs are gathered together
CHUNK_CHARS = 1 << 16  # segments tokenized in one call
CUT = re.compile(r"(?<=\S) (?=\S)")
UNEVEN = re.compile(r"\s\s|\A\s|\s\Z")  # no such place: every space is a cut
TERMS = 4 << 20  # products held at a time
SHIFT = 32  # a pair is ``a << SHIFT | b``


def byte_letters() -> dict[str, int]:
    """The letter that a byte-level vocabulary writes for each byte: printable ones themselves, the rest from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in shown}
    for b in range(256):
        if b not in shown:
            out[chr(256 + len(out) - len(shown))] = b
    return out


class Vocabularies:
    """Both tokenizers and the bytes of their ids, built once per process from their files' contents."""

    def __init__(self, byte_level: str, pieces: bytes):
        import numpy as np
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(byte_level)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        letters = byte_letters()
        vocab = self.a.get_vocab()
        special = {t["id"] for t in json.loads(byte_level).get("added_tokens", [])}
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.a_bytes[i] = token.encode() if i in special else bytes(letters[c] for c in token)
        b = self.b
        self.b_bytes = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i)
                        else b.id_to_piece(i).replace("▁", " ").encode() for i in range(b.get_piece_size())]
        self.a_size = np.array([len(x) for x in self.a_bytes])
        self.b_size = np.array([len(x) for x in self.b_bytes])
        # an id in decimals with each of the signs that can follow it
        self.marked = [f"{i}{mark}" for i in range(max(len(self.a_bytes), len(self.b_bytes))) for mark in (",", "|", ";", "")]

        crossing = [p for p in (x.decode("utf-8", "replace") for x in self.b_bytes) if re.search(r"\S ", p)]
        if crossing:
            raise ValueError(f"pieces that go on past a space: {crossing[:3]}")

    def _spell(self, text: str) -> tuple[list[int], list[int]] | None:
        """Ids of both for a text; None where either does not spell a space and the text."""
        spaced = " " + text
        a = self.a.encode_batch_fast([spaced], add_special_tokens=False)[0].ids
        b = self.b.encode(text)
        raw = spaced.encode("utf-8", "surrogatepass")
        good = b"".join(map(self.a_bytes.__getitem__, a)) == raw == b"".join(map(self.b_bytes.__getitem__, b))
        return (a, b) if good else None

    def encode(self, parts: list[str], together: int):
        """Ids of both over all parts, end to end, and each part's bytes (0: not spelled by both, no ids).

        The first ``together`` parts have no white space at either end and are tokenized many at a time.
        """
        import numpy as np

        ids_a, ids_b, size = [], [], []

        def put(got, part, n):
            ids_a.append(np.array(got[0], np.int64))
            ids_b.append(np.array(got[1], np.int64))
            size.extend(n)

        for i, j in [*text_blocks(parts[:together], CHUNK_CHARS, len(parts)), *((k, k + 1) for k in range(together, len(parts)))]:
            part = parts[i:j]
            got = self._spell(" ".join(part))
            if got:
                put(got, part, [len(p.encode()) + 1 for p in part])
                continue
            for p in part:
                got = self._spell(p) if j > i + 1 else None
                put(got or ([], []), [p], [len(p.encode()) + 1 if got else 0])
        return *(np.concatenate(x or [np.zeros(0, np.int64)]) for x in (ids_a, ids_b)), np.array(size, np.int64)


_BUILT: dict = {}


def vocabularies(files) -> Vocabularies:
    """This process's tokenizers for the broadcast files."""
    digest, byte_level, pieces = files.value
    if digest not in _BUILT:
        _BUILT.clear()
        _BUILT[digest] = Vocabularies(byte_level, pieces)
    return _BUILT[digest]


# sparse matrices of ones: (row pointers, column indices)

def token_bytes(ends):
    """Token-byte incidence: token i has the bytes from the end of token i - 1 to its own."""
    import numpy as np

    return np.r_[0, ends], np.arange(ends[-1] if len(ends) else 0)


def token_groups(group):
    """Token-group incidence: token i has the one group ``group[i]``."""
    import numpy as np

    return np.arange(len(group) + 1), group


def transposed(matrix, columns: int):
    """The transpose in CSR form: rows of one column each, in order of the old rows."""
    import numpy as np

    ptr, idx = matrix
    rows = np.repeat(np.arange(len(ptr) - 1), np.diff(ptr))
    order = np.argsort(idx, kind="stable") if len(idx) and (idx[1:] < idx[:-1]).any() else slice(None)
    return np.r_[0, np.cumsum(np.bincount(idx, minlength=columns))], rows[order]


def row_sizes(a, b):
    """Gustavson's symbolic phase: terms of each row of the product, before equal columns are added up."""
    import numpy as np

    total = np.r_[0, np.cumsum(np.diff(b[0])[a[1]])]
    return total[a[0][1:]] - total[a[0][:-1]]


def product(a, b):
    """Gustavson's numeric phase, in blocks of rows: yields ``(row, column, value)`` of the non-zeros of a·b.

    Row i of the product is the sum of those rows of ``b`` that row i of ``a`` names.
    """
    import numpy as np

    size = row_sizes(a, b)
    upto = np.cumsum(size)
    begin = 0
    while begin < len(size):
        done = upto[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(upto, done + TERMS, side="right")))
        named = a[1][a[0][begin]:a[0][end]]
        length = b[0][named + 1] - b[0][named]
        first = np.cumsum(length) - length
        at = np.arange(int(length.sum())) + np.repeat(b[0][named] - first, length)
        col = b[1][at]
        row = np.repeat(np.arange(begin, end), size[begin:end])
        # add up equal columns of a row: runs, once rows are in column order
        if len(col) and ((col[1:] < col[:-1]) & (row[1:] == row[:-1])).any():
            order = np.lexsort((col, row))
            row, col = row[order], col[order]
        new = np.ones(len(col), bool)
        new[1:] = (col[1:] != col[:-1]) | (row[1:] != row[:-1])
        starts = np.flatnonzero(new)
        yield row[starts], col[starts], np.diff(np.r_[starts, len(col)])
        begin = end


class Block:
    """The tokens of some parts (segments or whole texts) end to end, their overlap links and shared groups."""

    def __init__(self, vocab: Vocabularies, parts: list[str], together: int):
        import numpy as np

        self.a, self.b, size = vocab.encode(parts, together)
        self.good = size > 0
        self.a_ends, self.b_ends = np.cumsum(vocab.a_size[self.a]), np.cumsum(vocab.b_size[self.b])
        ends = np.cumsum(size)
        self.a_part, self.b_part = np.searchsorted(ends, self.a_ends), np.searchsorted(ends, self.b_ends)
        self.n_a, self.n_b = (np.bincount(x, minlength=len(parts)) for x in (self.a_part, self.b_part))
        cuts = np.intersect1d(self.a_ends, self.b_ends, assume_unique=True)
        self.n_groups = np.bincount(np.searchsorted(ends, cuts), minlength=len(parts))
        self.a_group, self.b_group = np.searchsorted(cuts, self.a_ends), np.searchsorted(cuts, self.b_ends)
        self.groups = len(cuts)

    def overlaps(self):
        """``(a token, b token, bytes)`` of all overlapping pairs: the non-zeros of A·Bᵀ."""
        bytes_ = int(self.a_ends[-1]) if len(self.a_ends) else 0
        yield from product(token_bytes(self.a_ends), transposed(token_bytes(self.b_ends), bytes_))

    def sharing(self):
        """``(a token, b token, 1)`` of all pairs in one group, by the same product."""
        yield from product(token_groups(self.a_group), transposed(token_groups(self.b_group), self.groups))

    def n_shared(self):
        """Pairs in one group by part, from the symbolic phase."""
        import numpy as np

        size = row_sizes(token_groups(self.a_group), transposed(token_groups(self.b_group), self.groups))
        return np.bincount(self.a_part, size, minlength=len(self.n_a)).astype(np.int64)

    def group_strings(self, vocab: Vocabularies) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` of each part."""
        import numpy as np

        a_last = np.r_[self.a_group[1:] != self.a_group[:-1], True][:len(self.a)]
        b_last = np.r_[self.b_group[1:] != self.b_group[:-1], True][:len(self.b)]
        a_sign, b_sign = np.where(a_last, 1, 0), np.where(b_last, 2, 0)
        ends = np.cumsum(self.n_b)[self.n_b > 0] - 1
        b_sign[ends] = 3
        # a group's A tokens, then its B tokens
        b_start = np.r_[0, np.cumsum(np.bincount(self.b_group, minlength=self.groups))]
        a_upto = np.cumsum(np.bincount(self.a_group, minlength=self.groups))
        code = np.empty(len(self.a) + len(self.b), np.int64)
        code[np.arange(len(self.a)) + b_start[self.a_group]] = self.a * 4 + a_sign
        code[np.arange(len(self.b)) + a_upto[self.b_group]] = self.b * 4 + b_sign
        words = list(map(vocab.marked.__getitem__, code.tolist()))
        ends = np.cumsum(self.n_a + self.n_b).tolist()
        return ["".join(words[i:j]) for i, j in zip([0, *ends], ends)]


def segments(text: str) -> list[str]:
    """The segments of a text, without the space that each begins with (the first: the one put before the text)."""
    if not text:
        return []
    return CUT.split(text) if UNEVEN.search(text) else text.split(" ")


def text_blocks(texts: list[str], chars: int, most: int):
    """``(begin, end)`` of runs of texts of up to ``chars`` characters (or one text) and ``most`` texts."""
    begin, size = 0, 0
    for i, t in enumerate(texts):
        if i > begin and (size + len(t) > chars or i - begin >= most):
            yield begin, i
            begin, size = i, 0
        size += len(t)
    if begin < len(texts):
        yield begin, len(texts)


def tokenizer_files(spark: SparkSession, byte_level_path: str, piece_path: str):
    """Both vocabulary files, broadcast (their size is that of the vocabularies)."""
    with open(byte_level_path, encoding="utf-8") as f, open(piece_path, "rb") as g:
        byte_level, pieces = f.read(), g.read()
    digest = hashlib.sha256(byte_level.encode() + pieces).hexdigest()
    return spark.sparkContext.broadcast((digest, byte_level, pieces))


def links(docs: DataFrame, byte_level_path: str, piece_path: str, shared: bool = False, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """One row per link: ``id, a_place, b_place, a_id, b_id, n_bytes`` (``shared``: pairs in one group, value 1).

    Places count a text's tokens from 0.
    """
    files = tokenizer_files(docs.sparkSession, byte_level_path, piece_path)
    names = ["id", "a_place", "b_place", "a_id", "b_id", "n_bytes"]

    def run(batches):
        import numpy as np
        import pyarrow as pa

        vocab = vocabularies(files)
        for batch in batches:
            ids, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
            for i, j in text_blocks(texts, CHUNK_CHARS, BATCH_TEXTS):
                held = [k for k in range(i, j) if texts[k]]
                block = Block(vocab, [texts[k] for k in held], 0)
                a_first, b_first = (np.cumsum(n) - n for n in (block.n_a, block.n_b))
                for a, b, value in (block.sharing() if shared else block.overlaps()):
                    part = block.a_part[a]
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(np.array(held)[part])), *map(pa.array, (a - a_first[part], b - b_first[part],
                                                                                   block.a[a], block.b[b], value))], names)

    return narrow(docs, id_col, text_col).mapInArrow(run, ", ".join(f"{x} long" for x in names))


def align(docs: DataFrame, byte_level_path: str, piece_path: str, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """``id, n_a, n_b, n_groups, n_links, n_shared, n_best, count_sum, groups_sha256`` per row.

    ``n_shared`` counts token pairs in one group; ``n_best`` links whose id pair has the highest count of its B id over
    all rows; ``count_sum`` adds the counts over links.
    """
    files = tokenizer_files(docs.sparkSession, byte_level_path, piece_path)
    names = ["batch", "kind", "place", "id", *FIGURES, "groups_sha256", "packed", "pair", "n"]

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        vocab = vocabularies(files)
        number = TaskContext.get().partitionId() << 32

        def rows(count, kind, **cols):
            given = {"batch": pa.array([number] * count, pa.int64()), "kind": pa.array([kind] * count, pa.int64()), **cols}
            types = dict.fromkeys(names, pa.int64()) | {"groups_sha256": pa.string(), "packed": pa.binary()}
            return pa.RecordBatch.from_arrays([given[x] if x in given else pa.nulls(count, types[x]) for x in names], names)

        for arrow in batches:
            texts = [t or "" for t in arrow.column(1).to_pylist()]
            for i, j in text_blocks(texts, BATCH_CHARS, BATCH_TEXTS):
                yield from _one_batch(vocab, arrow.column(0).slice(i, j - i), texts[i:j], rows)
                number += 1

    schema = ("batch long, kind long, place long, id long, " + ", ".join(f"{x} long" for x in FIGURES)
              + ", groups_sha256 string, packed binary, pair long, n long")
    both = stored(narrow(docs, id_col, text_col).mapInArrow(run, schema), "alignment")
    pairs = both.where(F.col("kind") == PAIR).select("batch", "kind", "place", "pair", "n")
    counts = stored(pairs.groupBy("pair").agg(F.sum("n").alias("count")), "pair-counts")
    b_id = F.col("pair").bitwiseAND((1 << SHIFT) - 1)
    # as many rows as the B vocabulary has ids at most
    best = counts.groupBy(b_id.alias("b")).agg(F.max("count").alias("most"))
    counts = counts.withColumn("b", b_id).join(F.broadcast(best), "b").select(
        "pair", "count", (F.col("count") == F.col("most")).alias("is_best"))
    back = pairs.join(counts, "pair").select("batch", "kind", "place", "count", "is_best")
    rest = both.where(F.col("kind") != PAIR).drop("pair", "n")
    stream = rest.unionByName(back, allowMissingColumns=True).repartition("batch").sortWithinPartitions("batch", "kind", "place")
    return stream.mapInArrow(_sum_up, "id long, " + ", ".join(f"{x} long" for x in FIGURES)
                             + ", n_best long, count_sum long, groups_sha256 string")


FIGURES = ("n_a", "n_b", "n_groups", "n_links", "n_shared")
PAIR, SEGMENTS, TEXT = range(3)  # kinds of rows of a batch, in the order they are read back
SEGMENT_ROWS = 1 << 16  # segments in one row


def _one_batch(vocab: Vocabularies, ids, texts: list[str], rows):
    """Rows of a batch: its texts (segment places), its segments (pair places) and its distinct pairs."""
    import numpy as np
    import pyarrow as pa

    cut = [segments(t) for t in texts]
    distinct = set().union(*cut)
    plain = [p for p in distinct if p and not (p[0].isspace() or p[-1].isspace())]
    parts = plain + [p for p in distinct if not p or p[0].isspace() or p[-1].isspace()]
    place = {p: k for k, p in enumerate(parts)}
    length = np.array([len(c) for c in cut])
    at = np.array([k for c in cut for k in map(place.__getitem__, c)], np.int64)
    owner = np.repeat(np.arange(len(texts)), length)
    block = Block(vocab, parts, len(plain))
    bad = np.bincount(owner[~block.good[at]], minlength=len(texts)) > 0
    at, owner = at[~bad[owner]], owner[~bad[owner]]
    length = np.where(bad, 0, length)

    links, where = [], []
    for a, b, _ in block.overlaps():
        links.append(block.a[a] << SHIFT | block.b[b])
        where.append(block.a_part[a])
    links, where = (np.concatenate(x or [np.zeros(0, np.int64)]) for x in (links, where))
    n_links = np.bincount(where, minlength=len(parts))
    pairs, of = np.unique(links, return_inverse=True)
    times = np.bincount(at, minlength=len(parts))
    total = np.bincount(of, times[where], minlength=len(pairs)).astype(np.int64)

    strings = block.group_strings(vocab)
    stops = np.cumsum(length).tolist()
    spans = list(zip([0, *stops], stops))
    listed = at.tolist()
    sums = {x: np.bincount(owner, v[at], minlength=len(texts)).astype(np.int64) for x, v in
            zip(FIGURES, (block.n_a, block.n_b, block.n_groups, n_links, block.n_shared()))}
    sha = [hashlib.sha256(";".join(map(strings.__getitem__, listed[s:e])).encode()).hexdigest() if e > s else "" for s, e in spans]
    small = at.astype("<u4")
    yield rows(len(texts), TEXT, id=ids, **{x: pa.array(v) for x, v in sums.items()}, groups_sha256=pa.array(sha, pa.string()),
               packed=pa.array([small[s:e].tobytes() for s, e in spans], pa.binary()))
    # the pair places of each segment: lengths, then places, some segments to a row
    first = np.r_[0, np.cumsum(n_links)]
    for k in range(0, len(parts), SEGMENT_ROWS):
        some = n_links[k:k + SEGMENT_ROWS].astype("<u4")
        held = of[first[k]:first[min(k + SEGMENT_ROWS, len(parts))]].astype("<u4")
        head = np.array([len(some)], "<u4")
        yield rows(1, SEGMENTS, place=pa.array([k], pa.int64()),
                   packed=pa.array([head.tobytes() + some.tobytes() + held.tobytes()], pa.binary()))
    if len(pairs):
        yield rows(len(pairs), PAIR, place=pa.array(np.arange(len(pairs))), pair=pa.array(pairs), n=pa.array(total))


def _sum_up(batches):
    """Per text the sums over its links: of a batch come the figures of its pairs, its segments, then its texts."""
    import numpy as np
    import pyarrow as pa

    now, figures, by_segment = None, [], []
    for arrow in batches:
        mark = arrow.column("batch").to_numpy() * 4 + arrow.column("kind").to_numpy()
        cuts = [0, *(np.flatnonzero(mark[1:] != mark[:-1]) + 1).tolist(), len(mark)]
        for s, e in zip(cuts, cuts[1:]):
            if s == e:
                continue
            part, batch, kind = arrow.slice(s, e - s), mark[s] // 4, mark[s] % 4
            if batch != now:
                now, figures, by_segment = batch, [], []
            if kind == PAIR:
                figures.append(np.stack([part.column(x).cast(pa.int64()).to_numpy(zero_copy_only=False)
                                         for x in ("count", "is_best")]))
                continue
            if len(figures) > 1:
                figures = [np.concatenate(figures, axis=1)]
            if kind == SEGMENTS:
                for packed in part.column("packed").to_pylist():
                    data = np.frombuffer(packed, "<u4")
                    n, places = data[1:1 + data[0]].astype(np.int64), data[1 + data[0]:]
                    upto = np.zeros((2, len(places) + 1), np.int64)
                    if len(places):
                        np.cumsum(figures[0][:, places], axis=1, out=upto[:, 1:])
                    ends = np.cumsum(n)
                    by_segment.append(upto[:, ends] - upto[:, ends - n])
                continue
            if len(by_segment) > 1:
                by_segment = [np.concatenate(by_segment, axis=1)]
            got = [by_segment[0][:, np.frombuffer(x, "<u4")].sum(axis=1) if x else (0, 0) for x in part.column("packed").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), *[part.column(x) for x in FIGURES], pa.array([int(g[1]) for g in got], pa.int64()),
                 pa.array([int(g[0]) for g in got], pa.int64()), part.column("groups_sha256")],
                ["id", *FIGURES, "n_best", "count_sum", "groups_sha256"])
