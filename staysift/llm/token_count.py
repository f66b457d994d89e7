"""Token counts by heap-and-linked-list byte-pair merging.

The symbols of a piece form a linked list; a heap holds the adjacent pairs that can
merge, by rank then position. Each pop merges one pair, and the count is the number
of initial symbols less the number of merges; no identifiers come out.

Runs as a map over Arrow batches: no shuffle, memory bounded by one block of text and
a bounded cache of piece counts.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staysift.llm.common import one_word, text_blocks, text_units

CACHE_PIECES = 800_000  # cached piece counts per Python worker; cleared when full
_POS = 40  # bits of a heap entry that hold the position


class PairCounter:
    """Counts the tokens of text under a byte-level BPE file of the tokenizers library."""

    def __init__(self, vocab_path: str):
        with open(vocab_path, encoding="utf-8") as f:
            spec = json.load(f)
        ids = spec["model"]["vocab"]
        self.merged: dict[int, int] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            # the new symbol's id is kept below the rank
            self.merged[ids[left] << 20 | ids[right]] = rank << 20 | ids[left + right]
        self.start = [ids[c] for c in _byte_letters()]
        special = [regex.escape(t["content"]) for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(special)) if special else None
        self.split = regex.compile(public_tokenizers.PATTERN)
        self.cache: dict[str, int] = {}

    def merge_count(self, data: bytes) -> int:
        """Symbols left of one piece when no adjacent pair can merge any more."""
        n = len(data)
        if n < 2:
            return n
        merged, start = self.merged.get, self.start
        symbol = [start[b] for b in data]
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            m = merged(symbol[i] << 20 | symbol[i + 1])
            if m is not None:
                heap.append(m << _POS | i)
        heapify(heap)
        left = n
        low = (1 << _POS) - 1
        while heap:
            entry = heappop(heap)
            i, m = entry & low, entry >> _POS
            j = after[i]
            # entries whose symbols have changed since are stale
            if j >= n or symbol[i] < 0 or merged(symbol[i] << 20 | symbol[j]) != m:
                continue
            new = m & 0xFFFFF
            symbol[i], symbol[j] = new, -1
            k = after[i] = after[j]
            left -= 1
            if k < n:
                before[k] = i
                m = merged(new << 20 | symbol[k])
                if m is not None:
                    heappush(heap, m << _POS | i)
            p = before[i]
            if p >= 0:
                m = merged(symbol[p] << 20 | new)
                if m is not None:
                    heappush(heap, m << _POS | p)
        return left

    def piece(self, piece: str) -> int:
        n = self.cache.get(piece)
        if n is None:
            if len(self.cache) >= CACHE_PIECES:
                self.cache.clear()
            n = self.cache[piece] = self.merge_count(piece.encode())
        return n

    def text(self, text: str) -> int:
        """Tokens of any text; the file's special strings count one each."""
        if one_word(text):
            return self.piece(text)
        if self.special is None or not self.special.search(text):
            return sum(map(self.piece, self.split.findall(text)))
        parts = self.special.split(text)
        return len(parts) - 1 + sum(self.piece(p) for part in parts for p in self.split.findall(part))


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies:
    printable Latin-1 bytes stand for themselves, the others follow from code 256."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


_counters: dict[str, PairCounter] = {}  # one per worker process and file


def _counter(path: str) -> PairCounter:
    if path not in _counters:
        _counters[path] = PairCounter(path)
    return _counters[path]


def count_tokens(
    docs: DataFrame,
    vocab_path: str,
    limit: int = 512,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Tokens of every whole text, as the tokenizers library counts them without
    added special tokens (special strings in a text count as their token).

    Returns one row per input row: the id, ``n_bytes`` (UTF-8), ``n_tokens``,
    ``over_limit`` (``n_tokens > limit``). A NULL text counts as empty (0 tokens); a
    NULL id is kept; repeated rows are each counted; other columns are not read. An
    empty table gives an empty result. The vocabulary path must exist on every node.
    """
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(vocab_path)
        for block in text_blocks(batches, 1):
            texts = block.column(1).fill_null("")
            units, codes, offsets = text_units(texts)
            each = np.fromiter(map(counter.text, units), dtype=np.int64, count=len(units))
            totals = np.add.reduceat(each[codes], offsets[:-1])
            sizes = pa.compute.binary_length(texts).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([block.column(0), sizes, pa.array(totals)], ["id", "n_bytes", "n_tokens"])

    id_type = source.schema["id"].dataType.simpleString()
    out = source.mapInArrow(counts, f"id {id_type}, n_bytes bigint, n_tokens bigint")
    return out.select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
