"""Order statistics of a growing set: the averages history of each (key, slice), replayed in pane order.

A history is bounded by the panes that touch its slice.  A running ``collect_set`` window would
hold one array per row, quadratic in the history; here the rows stream through a task sorted by
(key, slice, pane) and only the current set is held, in sorted blocks.
"""

from __future__ import annotations

import sys
from bisect import bisect_left, insort
from collections.abc import Sequence

from pyspark import cloudpickle
from pyspark.sql import DataFrame

# shipped by value: executors need no installed copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = 1000  # a block of the sorted set is cut in two above twice this size


class GrowingSet:
    """A sorted set of floats: add a value, read the k-th smallest."""

    def __init__(self):
        self.blocks: list[list[float]] = []
        self.size = 0

    def add(self, v: float) -> bool:
        """Whether ``v`` is new."""
        if not self.blocks:
            self.blocks.append([])
        n = min(bisect_left(self.blocks, v, key=lambda b: b[-1] if b else v), len(self.blocks) - 1)
        block = self.blocks[n]
        at = bisect_left(block, v)
        if at < len(block) and block[at] == v:
            return False
        insort(block, v)
        self.size += 1
        if len(block) > 2 * BLOCK:
            self.blocks[n:n + 1] = [block[:BLOCK], block[BLOCK:]]
        return True

    def kth(self, k: int) -> float | None:
        """The value at 0-based position ``k``; None outside the set."""
        if not 0 <= k < self.size:
            return None
        for block in self.blocks:
            if k < len(block):
                return block[k]
            k -= len(block)

    def median(self, rule: str) -> float:
        """``exact``, or ``reference``: one position too high, 0.0 where the set has no such position."""
        n = self.size
        if rule == "exact":
            lo, hi = self.kth((n - 1) // 2), self.kth(n // 2)
        elif n % 2 == 0:
            lo, hi = self.kth(n // 2), self.kth(n // 2 + 1)
        else:
            lo = hi = self.kth((n + 1) // 2)
        return 0.0 if lo is None or hi is None else (lo + hi) / 2


def replayed_medians(history: DataFrame, keys: Sequence[str], rule: str = "reference") -> DataFrame:
    """``keys, s, fp, avg_load`` history -> ``keys, s, fp, n, median`` at each new average.

    ``history`` comes out of a window partitioned by (key, slice) and ordered by pane, so its
    rows already lie together and in order: the sort below is dropped from the plan.
    """
    group = [*keys, "s"]
    schema = ", ".join([f"{k} int" for k in group] + ["fp long", "n long", "median double"])

    def run(batches):
        import pyarrow as pa

        names = [*group, "fp", "n", "median"]
        types = [*[pa.int32()] * len(group), pa.int64(), pa.int64(), pa.float64()]
        now, members = None, GrowingSet()
        for b in batches:
            out = []
            for row in zip(*[c.to_pylist() for c in b.columns]):
                if row[:-2] != now:
                    now, members = row[:-2], GrowingSet()
                if members.add(row[-1]):
                    out.append((*row[:-1], members.size, members.median(rule)))
            cols = list(zip(*out)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

    ordered = history.select(*group, "fp", "avg_load").sortWithinPartitions(*group, "fp")
    return ordered.mapInArrow(run, schema)
