"""Best-fit packing of tokenised documents into sequences, by large-item matching.

Pieces above one third of the capacity fit at most two in a bin: a greedy matching
pairs them, longest first, each with the longest partner that still fits. Smaller pieces
then go, longest first, into the bin with the tightest remaining gap.

Pieces of one length are interchangeable, so the decisions are taken on the histogram
of lengths (at most ``capacity`` entries, whatever the input) with bins kept as ranges of
equal content. The result is a plan: for each length, ranges of ranks and where they go.
Each piece then only needs its rank among the pieces of its length. Every placement step
at least halves the gap of a whole range or finishes a length, so the plan has at most
about ``3 * capacity * log2(capacity)`` rows.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staysift.llm.common import BoundedCache, bounded_batches, gathered, ranked_in_groups, stored, text_blocks, text_units

CACHE_BYTES = 72 << 20  # of each generation of cached encodings, per Python worker
BLOCK_BYTES = 8 << 20  # of text that is tokenised at once


class PieceIds:
    """Token ids of text units by the tokenizers library, each distinct unit once."""

    def __init__(self, vocab_path: str, cache_bytes: int = CACHE_BYTES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks in parallel
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocab_path)
        self.cache = BoundedCache(cache_bytes)

    def _encode(self, units: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(units, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def encode(self, units: list[str]) -> list[bytes]:
        return self.cache.many(units, self._encode)


_encoders: dict[str, PieceIds] = {}  # one per worker process and file


def _encoder(path: str, cache_bytes: int) -> PieceIds:
    if path not in _encoders:
        _encoders[path] = PieceIds(path, cache_bytes)
    return _encoders[path]


def cut_pieces(
    docs: DataFrame, vocab_path: str, capacity: int, end_id: int, id_col: str = "doc_id", text_col: str = "text",
    cache_bytes: int = CACHE_BYTES, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Tokenise every text, append ``end_id`` and cut what is longer than ``capacity``
    into pieces of ``capacity`` tokens, of which the first may be shorter."""
    source = bounded_batches(docs, block_bytes).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    end = np.array([end_id], dtype="<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocab_path, cache_bytes)
        for block in text_blocks(batches, 1, block_bytes):
            units, codes, offsets = text_units(block.column(1).fill_null(""))
            ids, bounds = gathered(encoder.encode(units), codes, offsets)
            rows: list[tuple[int, int, int, int, int]] = []
            for row, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
                own = np.concatenate((ids[a:b], end))
                start, n = 0, len(own)
                stop, piece = n % capacity or capacity, 0
                while start < n:
                    rows.append((row, piece, start, stop - start, zlib.crc32(own[start:stop].tobytes())))
                    start, stop, piece = stop, stop + capacity, piece + 1
            cols = np.array(rows, dtype=np.int64).reshape(-1, 5)
            yield pa.RecordBatch.from_arrays(
                [block.column(0).take(pa.array(cols[:, 0])), pa.array(cols[:, 1].astype(np.int32))]
                + [pa.array(np.ascontiguousarray(cols[:, k])) for k in (2, 3, 4)],
                ["id", "piece", "start", "length", "ids_crc32"],
            )

    kind = source.schema["id"].dataType.simpleString()
    out = source.mapInArrow(run, f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")
    return out.withColumnRenamed("id", id_col)


def packing_plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Where the pieces of each length go: rows ``(length, rank, count, bin, per_bin,
    offset)``. Pieces with ranks from ``rank`` fill bins from ``bin`` on, ``per_bin``
    in each, the first at ``offset``."""
    left = {n: c for n, c in histogram.items() if c > 0}
    if any(n < 1 or n > capacity for n in left):
        raise ValueError("a piece must have 1 to capacity tokens")
    used: dict[int, int] = defaultdict(int)  # ranks already placed, by length
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap -> ranges (first bin, bins)
    plan: list[tuple[int, int, int, int, int, int]] = []
    bins = 0

    def put(length: int, count: int, first: int, per_bin: int, offset: int) -> None:
        plan.append((length, used[length], count, first, per_bin, offset))
        used[length] += count
        left[length] -= count

    large = sorted((n for n in left if 3 * n > capacity), reverse=True)
    for n in large:
        while left[n]:
            partner = next((m for m in large if m <= min(n, capacity - n) and left[m] > (m == n)), None)
            if partner is None:
                count = left[n]
                put(n, count, bins, 1, 0)
                gaps[capacity - n].append((bins, count))
            elif partner == n:
                count = left[n] // 2
                put(n, 2 * count, bins, 2, 0)
                gaps[capacity - 2 * n].append((bins, count))
            else:
                count = min(left[n], left[partner])
                put(n, count, bins, 1, 0)
                put(partner, count, bins, 1, n)
                gaps[capacity - n - partner].append((bins, count))
            bins += count
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[n]:
            gap = next((g for g in range(n, capacity + 1) if gaps.get(g)), None)
            if gap is None:
                gap, count = capacity, -(-left[n] // (capacity // n))
                gaps[gap].append((bins, count))
                bins += count
            first, count = gaps[gap].pop()
            # a bin that took one piece has the tightest gap for the next of its length
            each = min(gap // n, left[n])
            filled = min(count, left[n] // each)
            put(n, filled * each, first, each, capacity - gap)
            gaps[gap - each * n].append((first, filled))
            if filled < count:
                gaps[gap].append((first + filled, count - filled))
    return plan


def pack(
    docs: DataFrame,
    vocab_path: str,
    capacity: int = 1024,
    end_id: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    cache_bytes: int = CACHE_BYTES,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens.

    One row per piece: the id, ``piece`` (from 0), ``start`` (tokens of its document
    before it), ``length``, ``ids_crc32``, ``sequence_id``, ``offset`` (place in the
    sequence, gapless from 0). A NULL or empty text is the end token alone; NULL ids and
    repeated rows are packed like any other; other columns are not read; an empty table
    gives no rows. ``cache_bytes`` (two generations of cached encodings) and ``block_bytes`` bound
    what a Python worker holds; they change the speed, not the result.
    """
    pieces = stored(cut_pieces(docs, vocab_path, capacity, end_id, id_col, text_col, cache_bytes, block_bytes), "pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = packing_plan(histogram, capacity)
    rows = pieces.sparkSession.createDataFrame(
        plan, "p_length bigint, p_rank bigint, p_count bigint, p_bin bigint, p_each bigint, p_offset bigint"
    )
    keyed = pieces.withColumn("__h", F.xxhash64(*pieces.columns))
    ranked = ranked_in_groups(keyed, ["length"], "__h", "__rank", sum(histogram.values()))
    # the plan's size depends on the capacity alone (see the module's note)
    at = F.col("__rank") - F.col("p_rank")
    placed = ranked.join(
        F.broadcast(rows), (F.col("length") == F.col("p_length")) & (at >= 0) & (at < F.col("p_count"))
    )
    return placed.select(
        id_col, "piece", "start", "length", "ids_crc32",
        (F.col("p_bin") + F.floor(at / F.col("p_each"))).alias("sequence_id"),
        (F.col("p_offset") + (at % F.col("p_each")) * F.col("length")).alias("offset"),
    )
