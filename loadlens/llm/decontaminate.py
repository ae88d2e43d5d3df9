"""Benchmark decontamination by pigeonhole edit matching.

Texts are compared lower-cased with white space runs as one space.  A test item of m characters
has an error budget of ``k = floor(m * max_error)`` edits and is split into k + 1 pieces; if the
item stands in a text with at most k edits, one piece stands there unchanged.  Exact piece hits
are found with one Aho-Corasick pass per text; the windows they point at are verified with
Myers' bit-parallel distance, the item's best place in the window.

The benchmark is the stated query set: it is taken in blocks of bounded size, each broadcast and
matched against all texts.  Defined cases: null and empty texts match nothing; items that are
null or blank are ignored; equal item texts all match; repeated rows give the same pair again
once per row id (the best match is kept per id and item); rows with a null id are reported with
a null id; an empty benchmark gives no pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.llm.common import narrow


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def pieces(item: str, max_error: float) -> list[tuple[int, str]]:
    """``(offset, piece)``: error budget plus one pieces of near-equal length."""
    k = int(len(item) * max_error)
    ends = [len(item) * (i + 1) // (k + 1) for i in range(k + 1)]
    return [(a, item[a:b]) for a, b in zip([0, *ends], ends)]


def myers(pattern: str, text: str) -> tuple[int, int]:
    """Least edit distance of ``pattern`` to a substring of ``text`` and where that ends (Myers 1999)."""
    m = len(pattern)
    eq: dict[str, int] = {}
    for i, c in enumerate(pattern):
        eq[c] = eq.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, end = m, 0
    for j, c in enumerate(text):
        x = eq.get(c, 0) | minus
        d = ((((x & plus) + plus) ^ plus) | x) & full
        up, down = minus | (full & ~(d | plus)), plus & d
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        if score < best:
            best, end = score, j + 1
        up <<= 1
        minus = up & d
        plus = ((down << 1) | (full & ~(d | up))) & full
    return best, end


class Matcher:
    """Items of one block, ready to be searched in texts."""

    def __init__(self, items: list[tuple[int, str]], max_error: float):
        import ahocorasick

        self.items = [(i, normal(t)) for i, t in items]
        self.items = [(i, t) for i, t in self.items if t]
        where: dict[str, list] = {}
        for n, (_, t) in enumerate(self.items):
            for at, p in pieces(t, max_error):
                where.setdefault(p, []).append((n, at))
        self.max_error = max_error
        self.automaton = None
        if where:
            self.automaton = ahocorasick.Automaton()
            for p, places in where.items():
                self.automaton.add_word(p, (len(p), places))
            self.automaton.make_automaton()

    def search(self, text: str | None) -> list[tuple[int, int, int]]:
        """``(item_id, distance, end)`` of every item within its budget; end counts in the normal form."""
        text = normal(text)
        if not text or self.automaton is None:
            return []
        starts: dict[int, set[int]] = {}
        for end, (size, places) in self.automaton.iter(text):
            for n, at in places:
                starts.setdefault(n, set()).add(end - size + 1 - at)
        out = []
        for n, found in starts.items():
            item_id, item = self.items[n]
            m = len(item)
            k = int(m * self.max_error)
            best = None
            for s in found:  # an unchanged copy needs no counting
                if s >= 0 and text.startswith(item, s) and (best is None or s + m < best[1]):
                    best = (0, s + m)
            if best is None:
                spans: list[list[int]] = []
                for s in sorted(found):
                    a, b = max(0, s - k), min(len(text), s + m + k)
                    if b - a < m - k:
                        continue
                    if spans and a <= spans[-1][1] - (m - k):
                        spans[-1][1] = max(spans[-1][1], b)
                    else:
                        spans.append([a, b])
                for a, b in spans:
                    d, e = myers(item, text[a:b])
                    if d <= k and (best is None or d < best[0]):
                        best = (d, a + e)
            if best is not None:
                out.append((item_id, *best))
        return out


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text", max_error: float = 0.08,
               block_chars: int = 1_000_000) -> DataFrame:
    """``(id, item_id, distance, end)``: items found in texts within ``max_error`` edits per character.

    ``block_chars`` bounds the items matched in one pass (about that many characters a block).
    """
    spark = docs.sparkSession
    bench = narrow(benchmark, item_col, item_text_col).select(F.col("id").alias("item"), F.col("text").alias("body"))
    total = bench.agg(F.sum(F.length("body"))).first()[0] or 0
    blocks = max(1, -(-total // block_chars))
    src, out = narrow(docs, id_col, text_col), None
    for n in range(blocks):
        part = bench.where(F.pmod(F.xxhash64("item", "body"), F.lit(blocks)) == n)
        sent = spark.sparkContext.broadcast([(r["item"], r["body"]) for r in part.collect()])

        def run(batches, sent=sent):
            import pyarrow as pa

            matcher = Matcher(sent.value, max_error)
            for b in batches:
                rows = [(i, *m) for i, t in zip(b.column(0), b.column(1)) for m in matcher.search(t.as_py())
                        for i in [i.as_py()]]
                cols = list(zip(*rows)) or [(), (), (), ()]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                                 ["id", "item_id", "distance", "end"])

        got = src.mapInArrow(run, "id long, item_id long, distance long, end long")
        out = got if out is None else out.unionByName(got)
    best = F.min(F.struct("distance", "end")).alias("best")
    return out.groupBy("id", "item_id").agg(best).select("id", "item_id", F.col("best.distance").alias("distance"),
                                                         F.col("best.end").alias("end"))


def drop_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               **more) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark item; rows with a null id stay."""
    hit = find_leaks(docs, benchmark, id_col, text_col, **more).select(F.col("id").alias("_hit")).distinct()
    return docs.join(hit, docs[f"`{id_col}`"].cast("long") == hit["_hit"], "left_anti")
