"""Byte-level BPE encoding and decoding in length-bucketed padded numpy matrices.

Texts are cut by the vocabulary's pattern; each distinct piece of a batch becomes a row of a
matrix of its length bucket, one cell per byte, padded.  Each round every row merges its
leftmost pair of minimum rank (looked up by a vectorised open-addressing hash of the two ids)
and is compacted by one cell; rows without a mergeable pair leave the matrix.  Pieces over
``LONG_PIECE`` bytes, whose matrix would be quadratic, merge the same pairs in the same order
with a heap.  Encoded pieces are kept in a bounded per-process cache.

Defined cases: null and empty texts encode to no ids; strings of special tokens are ordinary
text; texts of any length are encoded whole; ids and decoded bytes come back per input row, so
repeated rows and null ids stay; an empty table gives an empty table.
"""

from __future__ import annotations

import base64
import heapq

from pyspark.sql import DataFrame

from loadlens.llm.common import narrow

LONG_PIECE = 512
CACHE_PIECES = 200_000
CELLS = 1 << 20
NONE = 1 << 30  # no such pair


def read_ranks(path: str) -> list[bytes]:
    """Tokens by rank from a file of ``base64 rank`` lines."""
    with open(path, "rb") as f:
        got = {int(r): base64.b64decode(t) for t, r in map(bytes.split, filter(bytes.strip, f))}
    if sorted(got) != list(range(len(got))):
        raise ValueError("ranks must be 0, 1, 2, ...")
    return [got[i] for i in range(len(got))]


class PairHash:
    """Open-addressing hash from (left id, right id) to the rank of the joined token."""

    def __init__(self, tokens: list[bytes]):
        import numpy as np

        rank = {t: i for i, t in enumerate(tokens)}
        keys, ranks = [], []
        for t, r in rank.items():
            for cut in range(1, len(t)):
                a, b = rank.get(t[:cut]), rank.get(t[cut:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    ranks.append(r)
        bits = max(4, (4 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.ranks = np.full(1 << bits, NONE, np.int32)
        todo, rest = np.array(keys, np.int64), np.array(ranks, np.int32)
        slot = self._slot(todo)
        while len(todo):
            free = self.keys[slot] == -1
            at, first = np.unique(slot[free], return_index=True)
            pick = np.flatnonzero(free)[first]
            self.keys[at], self.ranks[at] = todo[pick], rest[pick]
            keep = np.ones(len(todo), bool)
            keep[pick] = False
            todo, rest, slot = todo[keep], rest[keep], (slot[keep] + 1) & self.mask

    def _slot(self, key):
        import numpy as np

        return ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def __call__(self, left, right):
        """Ranks for arrays of ids; ``NONE`` where the pair does not merge (or an id is -1)."""
        import numpy as np

        key = (left.astype(np.int64) << 32) | right.astype(np.int64)
        out = np.full(key.shape, NONE, np.int32)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        flat, want = out.reshape(-1), key.reshape(-1)[todo]
        slot = self._slot(want)
        while len(todo):
            seen = self.keys[slot]
            hit = seen == want
            flat[todo[hit]] = self.ranks[slot[hit]]
            on = ~hit & (seen != -1)
            todo, want, slot = todo[on], want[on], (slot[on] + 1) & self.mask
        return out


class ByteBpe:
    """Encoder and decoder for one vocabulary (tokens by rank, pre-split pattern)."""

    def __init__(self, tokens: list[bytes], pattern: str):
        import numpy as np
        import regex

        self.tokens, self.pattern = tokens, regex.compile(pattern)
        self.pairs = PairHash(tokens)
        rank = {t: i for i, t in enumerate(tokens)}
        self.rank = rank
        self.byte_id = np.array([rank[bytes([b])] for b in range(256)], np.int32)
        self.cache: dict[str, bytes] = {}

    def _matrix(self, pieces: list[bytes], width: int) -> list[bytes]:
        """Packed ids of pieces of at most ``width`` bytes."""
        import numpy as np

        n = len(pieces)
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(n, width)
        size = np.array([len(p) for p in pieces])
        ids = np.where(np.arange(width) < size[:, None], self.byte_id[raw], -1).astype(np.int32)
        ranks = self.pairs(ids[:, :-1], ids[:, 1:]) if width > 1 else np.full((n, 0), NONE, np.int32)
        row, out = np.arange(n), [b""] * n
        while len(row):
            if ranks.shape[1]:
                at = ranks.argmin(axis=1)
                low = ranks[np.arange(len(row)), at]
                done = low == NONE
            else:
                done = np.ones(len(row), bool)
            for r, s, i in zip(row[done].tolist(), size[done].tolist(), np.flatnonzero(done).tolist()):
                out[r] = ids[i, :s].tobytes()
            if done.all():
                break
            if done.any():
                ids, ranks, row, size, at, low = (x[~done] for x in (ids, ranks, row, size, at, low))
            # merge (at, at + 1), then close the gap: cells right of the pair move left by one
            here = np.arange(len(row))
            ids[here, at] = low
            take = np.arange(ids.shape[1] - 1)
            ids = np.take_along_axis(ids, take + (take > at[:, None]), axis=1)
            size = size - 1
            if ids.shape[1] == 1:
                ranks = ranks[:, :0]
                continue
            take = np.arange(ids.shape[1] - 1)
            ranks = np.take_along_axis(ranks, take + (take >= at[:, None]), axis=1)
            right = at < ids.shape[1] - 1
            ranks[here[right], at[right]] = self.pairs(ids[here[right], at[right]], ids[here[right], at[right] + 1])
            left = at > 0
            ranks[here[left], at[left] - 1] = self.pairs(ids[here[left], at[left] - 1], ids[here[left], at[left]])
            most = int(size.max())
            if most < ids.shape[1]:
                ids, ranks = ids[:, :most], ranks[:, :max(most - 1, 0)]
        return out

    def _long(self, piece: bytes) -> bytes:
        """Packed ids of one long piece: the same merges through a heap of (rank, place)."""
        import numpy as np

        part = [bytes([b]) for b in piece]
        after, before = list(range(1, len(part) + 1)), list(range(-1, len(part) - 1))
        heap: list = []

        def push(i):
            j = after[i]
            if j < len(part):
                joined = part[i] + part[j]
                r = self.rank.get(joined)
                if r is not None:
                    heapq.heappush(heap, (r, i, joined))

        for i in range(len(part) - 1):
            push(i)
        while heap:
            _, i, joined = heapq.heappop(heap)
            j = after[i] if part[i] is not None else len(part)
            if j >= len(part) or part[i] + part[j] != joined:
                continue
            part[i], part[j] = joined, None
            after[i] = after[j]
            if after[j] < len(part):
                before[after[j]] = i
            push(i)
            if before[i] >= 0:
                push(before[i])
        return np.array([self.rank[p] for p in part if p is not None], np.int32).tobytes()

    def _learn(self, pieces: list[str]) -> dict[str, bytes]:
        """Encode distinct pieces, bucketed by byte length."""
        raw = [p.encode("utf-8") for p in pieces]
        by: dict[int, list[int]] = {}
        for i, b in enumerate(raw):
            n = len(b)
            width = n if n <= 8 else 1 << (n - 1).bit_length() if n <= LONG_PIECE else 0
            by.setdefault(width, []).append(i)
        got: dict[str, bytes] = {}
        for width, rows in by.items():
            if not width:
                got.update((pieces[i], self._long(raw[i])) for i in rows)
                continue
            step = max(1, CELLS // width)
            for s in range(0, len(rows), step):
                part = rows[s:s + step]
                got.update(zip([pieces[i] for i in part], self._matrix([raw[i] for i in part], width)))
        return got

    def _pieces(self, text: str, step: int = 1 << 20):
        """Lists of pieces of a text; a very long text in several lists."""
        if len(text) <= step:
            yield self.pattern.findall(text)
            return
        held: list[str] = []
        for m in self.pattern.finditer(text):
            held.append(m[0])
            if len(held) >= 100_000:
                yield held
                held = []
        yield held

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as packed little-endian unsigned 32-bit integers."""
        out: list[list[bytes]] = [[] for _ in texts]
        cut, waiting = [], 0
        for i, t in enumerate(texts):
            for pieces in self._pieces(t or ""):
                cut.append((i, pieces))
                waiting += len(pieces)
                if waiting >= 400_000:
                    self._flush(cut, out)
                    cut, waiting = [], 0
        self._flush(cut, out)
        return [x[0] if len(x) == 1 else b"".join(x) for x in out]

    def _flush(self, cut, out) -> None:
        new = set().union(*(p for _, p in cut)).difference(self.cache) if cut else set()
        if len(self.cache) + len(new) > CACHE_PIECES:
            self.cache.clear()
            new = set().union(*(p for _, p in cut))
        self.cache.update(self._learn(list(new)))
        for i, pieces in cut:
            out[i].append(b"".join(map(self.cache.__getitem__, pieces)))

    def decode(self, packed: bytes) -> bytes:
        """Bytes of packed ids."""
        import numpy as np

        return b"".join([self.tokens[i] for i in np.frombuffer(packed, "<u4").tolist()])


_BUILT: dict = {}


def coder(tokens: list[bytes], pattern: str) -> ByteBpe:
    """The coder of this process for a vocabulary (built once)."""
    key = (len(tokens), hash(tuple(tokens)), pattern)
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = ByteBpe(tokens, pattern)
    return _BUILT[key]


def bpe_encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
               decode: bool = False) -> DataFrame:
    """``(id, n_tokens, ids)`` per row, ids packed as little-endian unsigned 32-bit integers.

    With ``decode`` also ``decoded``, the bytes the ids stand for.  The vocabulary file is read on
    the driver and broadcast; its size is that of the vocabulary, not of the data.
    """
    vocab = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    fields = ["id", "n_tokens", "ids"] + ["decoded"] * decode

    def run(batches):
        import pyarrow as pa

        bpe = coder(vocab.value, pattern)
        for b in batches:
            at = 0
            while at < b.num_rows:  # parts of bounded text
                n, size = 0, 0
                while at + n < b.num_rows and (n == 0 or size < 8 << 20) and n < 2000:
                    size += len(b.column(1)[at + n].as_py() or "")
                    n += 1
                part = b.slice(at, n)
                ids = bpe.encode(part.column(1).to_pylist())
                cols = [part.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
                if decode:
                    cols.append(pa.array([bpe.decode(x) for x in ids], pa.binary()))
                yield pa.RecordBatch.from_arrays(cols, fields)
                at += n

    schema = "id long, n_tokens long, ids binary" + ", decoded binary" * decode
    return narrow(docs, id_col, text_col).mapInArrow(run, schema)


def bpe_decode(encoded: DataFrame, ranks_path: str, pattern: str, id_col: str = "id",
               ids_col: str = "ids") -> DataFrame:
    """``(id, decoded)`` from packed ids; null ids decode to no bytes."""
    vocab = encoded.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def run(batches):
        import pyarrow as pa

        bpe = coder(vocab.value, pattern)
        for b in batches:
            got = [bpe.decode(x or b"") for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got, pa.binary())], ["id", "decoded"])

    return (encoded.select(encoded[f"`{id_col}`"].cast("long").alias("id"), encoded[f"`{ids_col}`"].alias("ids"))
            .mapInArrow(run, "id long, decoded binary"))
