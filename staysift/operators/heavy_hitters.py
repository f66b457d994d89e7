"""Frequent keys by a mergeable summary of bounded size.

A summary holds at most ``capacity`` keys with lower bounds of their counts and an error: a
key's true count lies between its bound and its bound plus the error, and a key that is not
held occurs at most ``error`` times. Merging adds bounds and errors, then takes the next largest
bound away from all keys beyond the capacity, so the error stays at most ``rows / (capacity
+ 1)`` over any number of merges. Summaries of parts (tasks, tables, stream batches) merge to
one of the whole, whatever the number of distinct keys.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class KeySummary:
    """Lower bounds of the counts of frequent keys (tuples of text, None for NULL)."""

    capacity: int = 1000
    counts: dict[tuple, int] = field(default_factory=dict)
    rows: int = 0
    error: int = 0

    def merge(self, other: KeySummary) -> KeySummary:
        """The summary of both inputs together."""
        both = dict(self.counts)
        for key, n in other.counts.items():
            both[key] = both.get(key, 0) + n
        out = KeySummary(self.capacity, both, self.rows + other.rows, self.error + other.error)
        if len(both) > self.capacity:
            cut = sorted(both.values(), reverse=True)[self.capacity]
            out.counts = {k: n - cut for k, n in both.items() if n > cut}
            out.error += cut
        return out

    def above(self, share: float) -> list[tuple]:
        """Every key that may hold at least ``share`` of the rows (commonest first): at most
        about ``1 / share`` keys more than there are, and none is missed while ``share`` is
        above ``1 / capacity``."""
        least = share * self.rows - self.error
        found = [(n, k) for k, n in self.counts.items() if n >= least]
        return [k for n, k in sorted(found, key=lambda x: (-x[0], tuple("" if v is None else v for v in x[1])))]

    def to_json(self) -> str:
        return json.dumps([self.capacity, self.rows, self.error, [[*k, n] for k, n in self.counts.items()]])

    @staticmethod
    def from_json(text: str) -> KeySummary:
        capacity, rows, error, held = json.loads(text)
        return KeySummary(capacity, {tuple(x[:-1]): x[-1] for x in held}, rows, error)


MERGE_GROUPS = 64  # summaries that reach the driver, whatever the number of tasks


def summarise_keys(df: DataFrame, keys: Sequence[str], capacity: int = 1000) -> KeySummary:
    """The summary of a table's key tuples, in one job and one pass over ``df``: each task
    keeps a summary, tasks' summaries are merged in groups, and at most ``MERGE_GROUPS`` of
    them reach the driver. Distinct keys are never grouped or shuffled."""

    def of_task(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = KeySummary(capacity)
        for frame in frames:
            rows = Counter(zip(*[[v if isinstance(v, str) else None for v in frame[c]] for c in frame.columns], strict=True))
            held = held.merge(KeySummary(capacity, dict(rows), len(frame)))
        yield pd.DataFrame({"part": [TaskContext.get().partitionId() % MERGE_GROUPS], "summary": [held.to_json()]})

    def merged(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"summary": [merge_all(capacity, frame["summary"]).to_json()]})

    named = df.select(*[F.col(k).cast("string").alias(f"k{i}") for i, k in enumerate(keys)])
    parts = named.mapInPandas(of_task, "part int, summary string").groupBy("part").applyInPandas(merged, "summary string")
    return merge_all(capacity, [r["summary"] for r in parts.collect()])


def merge_all(capacity: int, summaries: Iterable[str]) -> KeySummary:
    out = KeySummary(capacity)
    for text in summaries:
        out = out.merge(KeySummary.from_json(text))
    return out


def is_one_of(keys: Sequence[str], values: Sequence[tuple]) -> Column:
    """Whether a row's key tuple (NULL equal to NULL) is among ``values``."""
    found = F.lit(False)
    for value in values:
        same = F.lit(True)
        for k, v in zip(keys, value, strict=True):
            same = same & F.col(k).cast("string").eqNullSafe(F.lit(v).cast("string"))
        found = found | same
    return found
