"""Conversation structure repair by a persistent audit dynamic program.

A conversation's role initials must read ``(s?(ua)+)?``.  Rows are kept (K, cost 0), given the role the
pattern asks for (R, 3), deleted (D, 4; required of blank and repeated rows), and empty user or
assistant rows are inserted anywhere (I, 3); a truncated row that is not deleted adds 3.  Of
the cheapest edits the ones whose initials are ASCII-least are taken.

The program keeps, per place in the pattern, the least cost and the edits that lead there as a linked node:
edit prefixes are shared, a node knows its ancestors 1, 2, 4, ... steps up and a rolling hash of its prefix.  Prefixes of
equal cost are compared by searching their longest common prefix over the ancestors' hashes; that the prefixes
there are equal is verified letter by letter, and verified prefixes are joined, so no stretch is
verified twice.  What all places share is written out and dropped from time to time.

Rows are first reduced to flags: equal rows of a turn are one run, and rows whose role and text an earlier turn
holds are found by a grouped minimum.  Flags and texts of a conversation then pass one task as a sorted stream,
flags first; held are the undecided nodes and one letter per edit, never the texts.

Defined cases: rows are taken by turn (nulls first), then role, then SHA-256 of the text; null roles and
texts are one space; rows with a null id form one conversation; texts of any length; extra
columns are ignored; an empty table gives none.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlens.llm.common import salted_join, ship

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
BEGIN, SYSTEM, USER, ASSISTANT = range(4)  # what the pattern has read last
ROLE = {USER: "user", ASSISTANT: "assistant"}
MODULUS, BASE = (1 << 61) - 1, 1_000_003
KEEP_AT_LEAST = 1024


def after(place: int, initial: str) -> int | None:
    """The place after a row of a role with this initial; None where the pattern does not allow it."""
    if initial == "s":
        return SYSTEM if place == BEGIN else None
    if initial == "u":
        return USER if place != USER else None
    return ASSISTANT if initial == "a" and place == USER else None


def next_role(place: int) -> int:
    """The place after an inserted or re-roled row."""
    return ASSISTANT if place == USER else USER


class Node:
    """The last edit of a prefix; ``up[k]`` is the prefix without its last ``2 ** k`` edits."""

    __slots__ = ("up", "edit", "hash", "depth")

    def __init__(self, before: Node | None, edit: str):
        self.edit = edit
        self.depth = before.depth + 1 if before else 0
        self.hash = (before.hash * BASE + ord(edit)) % MODULUS if before else 0
        self.up = []
        k = 0
        while before is not None:
            self.up.append(before)
            before = before.up[k] if k < len(before.up) else None
            k += 1


def spelled(node: Node, top: Node | None = None) -> str:
    """The edits of a prefix below ``top``."""
    out = []
    while node is not top and node.up:
        out.append(node.edit)
        node = node.up[0]
    return "".join(reversed(out))


def lifted(node: Node, depth: int) -> Node:
    gone = node.depth - depth
    for k in range(gone.bit_length()):
        if gone >> k & 1:
            node = node.up[k]
    return node


def equal(a: Node, b: Node) -> bool:
    """Whether prefixes of equal depth and hash are equal, letter by letter; if so they share their ancestors from now on."""
    pairs = []
    while a is not b:
        if a.edit != b.edit:
            return False
        pairs.append((a, b))
        a, b = a.up[0], b.up[0]
    for x, y in reversed(pairs):
        y.up = x.up
    return True


def less(a: Node, b: Node) -> bool:
    """Whether prefix ``a`` comes before prefix ``b`` in ASCII order (a proper prefix comes first)."""
    if a is b:
        return False
    depth = min(a.depth, b.depth)
    x, y = lifted(a, depth), lifted(b, depth)
    if x is y or x.hash == y.hash:
        if x is y or equal(x, y):
            return a.depth < b.depth
        return spelled(a) < spelled(b)  # two prefixes with one hash
    for k in reversed(range(depth.bit_length())):
        if k < len(x.up) and x.up[k].hash != y.up[k].hash:
            x, y = x.up[k], y.up[k]
    if not equal(x.up[0], y.up[0]):
        return spelled(a) < spelled(b)
    return x.edit < y.edit


class Audit:
    """The cheapest edits of one conversation, fed row by row."""

    def __init__(self):
        self.done: list[str] = []  # what all places share, written out
        self.best: list[tuple[int, Node] | None] = [(0, Node(None, "")), None, None, None]
        self.drop_at = KEEP_AT_LEAST
        self._insert()

    @staticmethod
    def _take(best: list, place: int, cost: int, before: Node, edit: str) -> None:
        now = best[place]
        if now is None or cost < now[0]:
            best[place] = (cost, Node(before, edit))
        elif cost == now[0]:
            node = Node(before, edit)
            if less(node, now[1]):
                best[place] = (cost, node)

    def _insert(self) -> None:
        """Empty rows after what was read: a user row from the other places, an assistant row from the user place."""
        for place in (BEGIN, SYSTEM, ASSISTANT, USER):
            if self.best[place]:
                cost, node = self.best[place]
                self._take(self.best, next_role(place), cost + INSERT, node, "I")

    def row(self, initial: str, must_go: bool, truncated: bool) -> None:
        best: list = [None] * 4
        more = TRUNCATED if truncated else 0
        for place, now in enumerate(self.best):
            if now is None:
                continue
            cost, node = now
            self._take(best, place, cost + DELETE, node, "D")
            if not must_go:
                kept = after(place, initial)
                if kept is not None:
                    self._take(best, kept, cost + more, node, "K")
                self._take(best, next_role(place), cost + REROLE + more, node, "R")
        self.best = best
        self._insert()
        if max(b[1].depth for b in best if b) > self.drop_at:
            self._write_out()

    def _write_out(self) -> None:
        live = [b[1] for b in self.best if b]
        depth = min(n.depth for n in live)
        shared = {id(n): n for n in (lifted(n, depth) for n in live)}
        while len(shared) > 1:
            shared = {id(n.up[0]): n.up[0] for n in shared.values()}
        top = next(iter(shared.values()))
        self.done.append(spelled(top))
        # rebuilt below the shared prefix, which becomes the new root; prefixes stay shared
        root, made = Node(None, ""), {}
        made[id(top)] = root
        best: list = [None] * 4
        for place, now in enumerate(self.best):
            if now is None:
                continue
            chain, node = [], now[1]
            while id(node) not in made:
                chain.append(node)
                node = node.up[0]
            for old in reversed(chain):
                made[id(old)] = Node(made[id(old.up[0])], old.edit)
            best[place] = (now[0], made[id(now[1])])
        self.best = best
        self.drop_at = max(KEEP_AT_LEAST, 2 * max(b[1].depth for b in best if b))

    def result(self) -> tuple[int, str]:
        """Least cost and its ASCII-least edits."""
        cost, node = self.best[BEGIN]
        other = self.best[ASSISTANT]
        if other and (other[0] < cost or other[0] == cost and less(other[1], node)):
            cost, node = other
        return cost, "".join(self.done) + spelled(node)


class Shape:
    """Counts and audit of one conversation from its runs of equal rows, in order."""

    def __init__(self):
        self.blank = self.duplicate = self.truncated = self.illegal = self.rows = 0
        self.first = self.last = None
        self.turns = 0
        self.role = None
        self.audit = Audit()

    def run(self, turn, role: str, n: int, seen: bool, blank: bool, truncated: bool) -> None:
        if turn is not None:
            self.first = turn if self.first is None else self.first
            self.turns += turn != self.last
            self.last = turn
        for i in range(n):
            if self.role is not None:
                self.illegal += self.role + role not in ("su", "ua", "au")
            self.role = role
            again = not blank and (seen or i > 0)
            self.blank += blank
            self.duplicate += again
            cut = truncated and not blank and not again
            self.truncated += cut
            self.audit.row(role, blank or again, cut)

    def gaps(self) -> int:
        return 0 if self.first is None else self.last - self.first + 1 - self.turns


def flags(rows: DataFrame) -> DataFrame:
    """Runs of equal rows: ``conv_id, turn, role, digest, n, seen, blank, truncated``, ``role`` being the initial."""
    space = r"\x20\x09-\x0D"
    one = rows.select(
        "conv_id", "turn", "role", "digest", "present", (~F.col("text").rlike(f"[^{space}]")).alias("blank"),
        (~F.col("text").rlike(rf"[.!?][{space}]*\z")).alias("truncated"))
    runs = one.groupBy("conv_id", "turn", "role", "digest", "present", "blank", "truncated").agg(
        F.count(F.lit(1)).alias("n"))
    key = F.sha2(F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit("")), F.lit("\n"), "digest", "role"), 256)
    runs = runs.withColumn("key", key)
    order = F.struct(F.col("turn").isNotNull().alias("late"), "turn")
    held = runs.where("present").groupBy("key").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("turns"))
    held = held.where("turns > 1").select("key", "first")
    out = salted_join(runs, held, "key", ["turn"], how="left")
    seen = F.coalesce(order > F.col("first"), F.lit(False))
    return out.select("conv_id", "turn", "role", "digest", "present", "n", seen.alias("seen"), "blank", "truncated")


def repair(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", present: Column | None = None) -> DataFrame:
    """Repaired conversations: per conversation its counts, then its rows in order.

    ``(conv_id, position, role, text, gaps, blank, duplicate, truncated, illegal, cost, audit)``: position 0
    has the counts, 1 and on the repaired rows.  Rows for which ``present`` does not hold only name
    their conversation.  Rows stay partitioned by conversation and in order, so a narrow step can read them on.
    """
    ship(conversations.sparkSession)
    c = conversations
    space = F.lit(" ")
    rows = c.select(c[f"`{conv_col}`"].cast("long").alias("conv_id"), c[f"`{turn_col}`"].cast("long").alias("turn"),
                    F.coalesce(c[f"`{role_col}`"].cast("string"), space).alias("role"),
                    F.coalesce(c[f"`{text_col}`"].cast("string"), space).alias("text"),
                    F.coalesce(F.lit(True) if present is None else present, F.lit(False)).alias("present"))
    rows = rows.withColumn("digest", F.sha2(F.col("text").cast("binary"), 256))
    shape = flags(rows).select("conv_id", F.lit(0).alias("kind"), "turn", "role", "digest", F.lit(None).cast("string").alias("text"),
                               "present", "n", "seen", "blank", "truncated")
    texts = rows.where("present").select("conv_id", F.lit(1).alias("kind"), "turn", "role", "digest", "text", "present",
                                         F.lit(1).cast("long").alias("n"), F.lit(False).alias("seen"),
                                         F.lit(False).alias("blank"), F.lit(False).alias("truncated"))
    both = shape.unionByName(texts).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "digest")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    names = ["conv_id", "position", "role", "text", *numbers, "audit"]

    def run(batches):
        import pyarrow as pa

        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), *[pa.int64()] * 6, pa.string()]
        out: list[tuple] = []

        def batch():
            got = pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out), kinds)], names)
            out.clear()
            return got

        conv, shape, plan = (), None, None

        def head():
            cost, audit = shape.audit.result()
            out.append((conv, 0, None, None, shape.gaps(), shape.blank, shape.duplicate, shape.truncated, shape.illegal,
                        cost, audit))
            return Plan(conv, audit)

        def end():
            nonlocal plan
            if shape is not None:
                plan = plan or head()
                plan.insert(out)

        size = 0
        for b in batches:
            cols = [b.column(x).to_pylist() for x in ("conv_id", "kind", "turn", "role", "text", "present", "n", "seen",
                                                      "blank", "truncated")]
            for i, kind, turn, role, text, there, n, seen, blank, truncated in zip(*cols):
                if shape is None or i != conv:
                    end()
                    conv, shape, plan = i, Shape(), None
                if kind == 0:
                    if there:
                        shape.run(turn, role[:1], n, seen, blank, truncated)
                    continue
                plan = plan or head()
                plan.row(role, text, out)
                size += len(text)
                if size > 4 << 20 or len(out) > 4000:
                    yield batch()
                    size = 0
        end()
        if out:
            yield batch()

    return both.select("conv_id", "kind", "turn", "role", "text", "present", "n", "seen", "blank", "truncated").mapInArrow(
        run, "conv_id long, position long, role string, text string, " + ", ".join(f"{x} long" for x in numbers)
        + ", audit string")


class Plan:
    """Applies an audit to a conversation's rows, in order."""

    def __init__(self, conv, audit: str):
        self.conv, self.audit, self.at, self.place, self.position = conv, audit, 0, BEGIN, 0

    def _emit(self, role: str, text: str, out: list) -> None:
        self.position += 1
        out.append((self.conv, self.position, role, text, *[None] * 7))

    def insert(self, out: list) -> None:
        """The rows inserted here."""
        while self.audit[self.at:self.at + 1] == "I":
            self.at += 1
            self.place = next_role(self.place)
            self._emit(ROLE[self.place], "", out)

    def row(self, role: str, text: str, out: list) -> None:
        self.insert(out)
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.place = after(self.place, role[:1])
            self._emit(role, text, out)
        elif edit == "R":
            self.place = next_role(self.place)
            self._emit(ROLE[self.place], text, out)


def digests(repaired: DataFrame) -> DataFrame:
    """Per conversation its counts, audit and ``repaired_sha256``, read from the repaired rows in their order."""
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    names = ["conv_id", *numbers, "audit", "repaired_sha256"]

    def run(batches):
        import pyarrow as pa

        held = sha = None
        rows: list[tuple] = []

        def batch():
            kinds = [*[pa.int64()] * 7, pa.string(), pa.string()]
            got = pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), kinds)], names)
            rows.clear()
            return got

        for b in batches:
            cols = [b.column(x).to_pylist() for x in ("conv_id", "position", "role", "text", *numbers, "audit")]
            for conv, position, role, text, *rest in zip(*cols):
                if position == 0:
                    if held:
                        rows.append((*held, sha.hexdigest()))
                    held, sha = (conv, *rest), hashlib.sha256()
                else:
                    sha.update(f"{chr(10) if position > 1 else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
            if rows:
                yield batch()
        if held:
            rows.append((*held, sha.hexdigest()))
            yield batch()

    return repaired.mapInArrow(run, "conv_id long, " + ", ".join(f"{x} long" for x in numbers)
                               + ", audit string, repaired_sha256 string")


def damaged(conversations: DataFrame) -> DataFrame:
    """Damage for trials, by crc32 of ``conv_id:turn`` modulo 20: ``conv_id, turn, role, text, present``.

    0 drops the row (``present`` false), 1 empties its text, 2 removes its ``[.!?]``, 3 repeats it, 4 sets its role to
    user; nulls are one space.
    """
    space = F.lit(" ")
    c = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), space).alias("role"), F.coalesce(F.col("text").cast("string"), space).alias("text"))
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"),
                    F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(name.cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(kind == 4, "user").otherwise(F.col("role"))
    times = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return c.select("conv_id", "turn", role.alias("role"), text.alias("text"), (kind != 0).alias("present"),
                    F.explode(times).alias("_again")).drop("_again")
