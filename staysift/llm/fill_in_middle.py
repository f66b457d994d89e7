"""Fill-in-middle transformation over a Roaring-style set of line boundaries.

A document's possible cuts are the offsets at which its lines end. They form a set of
integers kept as a Roaring bitmap does: offsets are grouped by their high 16 bits into
containers, and a container stores its low 16 bits as a sorted array, as a bitmap or as
runs, whichever is smallest. Cumulative cardinalities over the containers make the k-th
boundary a container search and a select inside one container; two selects give both cut
offsets, and the text is taken apart there.

Scale: a map over the rows, no shuffle. Cut numbers come from a hash of the id, so a
retried task repeats them. A task holds one block of texts and one boundary set at a time.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staysift.llm.common import text_blocks

ARRAY_LIMIT = 4096  # values from which a bitmap (8 KB) is smaller than an array
BITMAP_WORDS = 1024  # of 64 bits: one container spans 65,536 offsets


class ArrayContainer:
    """Sorted 16-bit values."""

    def __init__(self, low: np.ndarray):
        self.low = low.astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.low[k])


class BitmapContainer:
    """One bit per value, with the cumulative cardinality of the words."""

    def __init__(self, low: np.ndarray):
        bits = np.zeros(BITMAP_WORDS * 64, dtype=np.uint8)
        bits[low] = 1
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        self.ends = np.cumsum(bits.reshape(BITMAP_WORDS, 64).sum(axis=1, dtype=np.int64))

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.ends, k, side="right"))
        word = int(self.words[at])
        for _ in range(k - (int(self.ends[at - 1]) if at else 0)):
            word &= word - 1  # drop the lowest bit that is set
        return 64 * at + (word & -word).bit_length() - 1


class RunContainer:
    """Runs of consecutive values: first values and cumulative lengths."""

    def __init__(self, low: np.ndarray, firsts: np.ndarray):
        self.first = low[firsts].astype(np.uint16)
        self.ends = np.append(firsts[1:], len(low)).astype(np.int64)

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.ends, k, side="right"))
        return int(self.first[at]) + k - (int(self.ends[at - 1]) if at else 0)


def container(low: np.ndarray) -> ArrayContainer | BitmapContainer | RunContainer:
    """The smallest container of the sorted distinct values ``low`` (0 to 65,535)."""
    firsts = np.flatnonzero(np.diff(low, prepend=-2) != 1)
    plain = min(2 * len(low), 8 * BITMAP_WORDS)
    if 4 * len(firsts) + 2 < plain:
        return RunContainer(low, firsts)
    return ArrayContainer(low) if len(low) <= ARRAY_LIMIT else BitmapContainer(low)


class BoundarySet:
    """A set of offsets in containers by their high bits, with cumulative cardinalities."""

    def __init__(self, offsets: np.ndarray):
        """``offsets``: sorted and distinct, not negative."""
        high = offsets >> 16
        begins = np.flatnonzero(np.diff(high, prepend=-1))
        self.keys = high[begins].tolist()
        self.ends = [*begins[1:].tolist(), len(offsets)] if len(offsets) else []
        self.containers = [container(offsets[a:b] & 0xFFFF) for a, b in pairwise([*begins.tolist(), len(offsets)])]

    def __len__(self) -> int:
        return self.ends[-1] if self.ends else 0

    def select(self, k: int) -> int:
        """The k-th smallest offset (from 0)."""
        at = bisect_right(self.ends, k)
        return (self.keys[at] << 16) + self.containers[at].select(k - (self.ends[at - 1] if at else 0))


def line_ends(text: str) -> np.ndarray:
    """Offsets, in code points, at which the lines ``[^\\n]*\\n|[^\\n]+`` of the text end."""
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    ends = np.flatnonzero(data == 10) + 1
    if len(data) != len(text):  # byte offsets to code points: count the bytes that begin one
        ends = np.cumsum((data & 0xC0) != 0x80)[ends - 1]
    if text and text[-1] != "\n":
        ends = np.append(ends, len(text))
    return ends.astype(np.int64)


def check_marks(marks: tuple[str, str, str]) -> None:
    """Marks must be found again at their first place: none is empty, holds another, or
    begins with what another ends with."""
    for a in marks:
        for b in marks:
            if not a or (a is not b and a in b) or any(a.endswith(b[:k]) for k in range(1, min(len(a), len(b)))):
                raise ValueError(f"marks {marks} cannot be told apart")
    if len(set(marks)) < 3:
        raise ValueError("the three marks must differ")


def _draws(id_col: Column, seed: int) -> list[Column]:
    """Four numbers of 32 bits: the first groups of sha256 of ``seed:id``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def fill_in_middle(
    docs: DataFrame,
    rate: int = 100,
    spm_rate: int = 50,
    marks: tuple[str, str, str] = ("<P>", "<S>", "<M>"),
    seed: int = 7,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Cut every whole text into prefix, middle and suffix at two line boundaries and
    reorder the parts: id, ``n`` (lines), ``form``, ``prefix_chars``, ``middle_chars``
    (code points; NULL if plain) and ``output`` (the transformed text).

    ``rate`` percent of the documents are transformed, ``spm_rate`` percent of these as
    ``spm`` (suffix, prefix, middle), the others as ``psm``; an empty text or one that holds
    a mark stays ``plain``. A NULL text is empty; a NULL id is hashed as an empty one and
    kept; repeated rows give the same result each; other columns are not read; an empty
    table gives no rows.
    """
    check_marks(marks)
    p_mark, s_mark, m_mark = marks
    source = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        *[h.alias(f"h{k}") for k, h in enumerate(_draws(F.col(id_col), seed), start=1)],
    )

    def cut(text: str, h1: int, h2: int, h3: int, h4: int) -> tuple[int, str, int | None, int | None, str]:
        ends = line_ends(text)
        n = len(ends)
        if not text or h3 % 100 >= rate or any(m in text for m in marks):
            return n, "plain", None, None, text
        low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
        bounds = BoundarySet(ends)
        a, b = (bounds.select(k - 1) if k else 0 for k in (low, high))
        prefix, middle, suffix = text[:a], text[a:b], text[b:]
        if h4 % 100 < spm_rate:
            return n, "spm", a, b - a, "".join((s_mark, suffix, p_mark, prefix, m_mark, middle))
        return n, "psm", a, b - a, "".join((p_mark, prefix, s_mark, suffix, m_mark, middle))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, 1):
            texts, *hashes = (block.column(k).to_pylist() for k in range(1, 6))
            rows = [cut(*r) for r in zip(texts, *hashes, strict=True)]
            n, form, prefix, middle, output = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [
                    block.column(0), pa.array(n, pa.int64()), pa.array(form, pa.string()),
                    pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), pa.array(output, pa.string()),
                ],
                ["id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    kind = source.schema["id"].dataType.simpleString()
    out = source.mapInArrow(
        run, f"id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
    )
    return out.withColumnRenamed("id", id_col)


def restored(output: Column, form: Column, marks: tuple[str, str, str] = ("<P>", "<S>", "<M>")) -> Column:
    """The original text from a transformed one and its form, by the marks alone (each
    occurs once in it)."""
    check_marks(marks)
    p_mark, s_mark, m_mark = (F.lit(m) for m in marks)

    def between(left: Column, right: Column) -> Column:
        return F.split_part(F.split_part(output, left, F.lit(2)), right, F.lit(1))

    middle = F.split_part(output, m_mark, F.lit(2))
    psm = F.concat(between(p_mark, s_mark), middle, between(s_mark, m_mark))
    spm = F.concat(between(p_mark, m_mark), middle, between(s_mark, p_mark))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
