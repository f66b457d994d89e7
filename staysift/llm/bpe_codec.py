"""Byte-level BPE encoding and decoding as a tree reduction.

Encodings of two neighbouring byte strings form a monoid under :meth:`Codec.join`:
the tokens around the boundary are re-encoded in a window that grows until its outer
tokens are stable. A piece is encoded by halves recursively; the pieces of a text
(each match of the splitting pattern) then concatenate, as no merge crosses them.
Decoding concatenates token bytes up a tree of the same shape.

Why a window is provably enough: a token sequence is the encoding of its bytes exactly
when each adjacent pair is the encoding of the pair's bytes. Inside the left part, the
window and the right part this holds by construction, so only the two pairs at the
window's edges need a check.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staysift.llm.common import gathered, one_word, text_blocks, text_units

CACHE_PIECES = 500_000  # cached encodings per Python worker; cleared when full
CACHE_PAIRS = 500_000
LEAF_BYTES = 16  # halves this short are merged directly
SCAN_BYTES = 64  # longer windows are merged with a heap


class Codec:
    """Encodes and decodes under a tiktoken rank file and a splitting pattern."""

    def __init__(self, ranks_path: str, pattern: str):
        with open(ranks_path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.split = regex.compile(pattern)
        self.cache: dict[str, bytes] = {}
        self.pairs: dict[tuple[int, int], bool] = {}

    def merge(self, data: bytes) -> list[int]:
        """Encode a byte string by merging its lowest-ranked pair repeatedly."""
        if len(data) > SCAN_BYTES:
            return self.merge_by_heap(data)
        rank = self.ranks.get
        parts = [data[i : i + 1] for i in range(len(data))]
        scores = [rank(data[i : i + 2]) for i in range(len(data) - 1)]
        while True:
            best, at = None, -1
            for i, s in enumerate(scores):
                if s is not None and (best is None or s < best):
                    best, at = s, i
            if best is None:
                return [self.ranks[p] for p in parts]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del scores[at]
            if at < len(scores):
                scores[at] = rank(parts[at] + parts[at + 1])
            if at:
                scores[at - 1] = rank(parts[at - 1] + parts[at])

    def merge_by_heap(self, data: bytes) -> list[int]:
        """As :meth:`merge`, near linear: for windows that had to grow long."""
        rank, n = self.ranks.get, len(data)
        end = list(range(1, n + 1))  # where the symbol that starts here ends; 0 once merged away
        before = list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(data[i : i + 2])) is not None]
        heapify(heap)
        while heap:
            _, i, stop = heappop(heap)
            j = end[i]
            if not j or j >= n or end[j] != stop:
                continue
            end[i], end[j] = stop, 0
            if stop < n:
                before[stop] = i
                if (r := rank(data[i : end[stop]])) is not None:
                    heappush(heap, (r, i, end[stop]))
            if (p := before[i]) >= 0 and (r := rank(data[p:stop])) is not None:
                heappush(heap, (r, p, stop))
        out, i = [], 0
        while i < n:
            out.append(self.ranks[data[i : end[i]]])
            i = end[i]
        return out

    def stable(self, a: int, b: int) -> bool:
        """Whether tokens ``a, b`` side by side are the encoding of their bytes."""
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) >= CACHE_PAIRS:
                self.pairs.clear()
            known = self.pairs[(a, b)] = self.merge(self.tokens[a] + self.tokens[b]) == [a, b]
        return known

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the two parts' concatenated bytes, given their encodings."""
        if not left or not right:
            return left + right
        i = j = 1
        while True:
            window = self.merge(b"".join(map(self.tokens.__getitem__, left[-i:] + right[:j])))
            grow_left = i < len(left) and not self.stable(left[-i - 1], window[0])
            grow_right = j < len(right) and not self.stable(window[-1], right[j])
            if not grow_left and not grow_right:
                return left[:-i] + window + right[j:]
            i = min(len(left), 2 * i) if grow_left else i
            j = min(len(right), 2 * j) if grow_right else j

    def encode_bytes(self, data: bytes) -> list[int]:
        """Encode by halves. The halves of each level are joined in pairs, so the tree
        needs no deep recursion and a very long piece stays near linear."""
        if len(data) <= LEAF_BYTES:
            return self.merge(data)
        level = [self.merge(data[i : i + LEAF_BYTES]) for i in range(0, len(data), LEAF_BYTES)]
        while len(level) > 1:
            level = [self.join(*level[i : i + 2]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
        return level[0]

    def piece(self, piece: str) -> bytes:
        """Ids of one match of the pattern, as little-endian unsigned 32-bit numbers."""
        ids = self.cache.get(piece)
        if ids is None:
            data = piece.encode()
            whole = self.ranks.get(data)
            codes = [whole] if whole is not None else self.encode_bytes(data)
            ids = np.array(codes, dtype="<u4").tobytes()
            if len(self.cache) >= CACHE_PIECES:
                self.cache.clear()
            self.cache[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if one_word(text):
            return self.piece(text)
        return b"".join(map(self.piece, self.split.findall(text)))

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of the ids: leaves join their tokens, inner nodes join their halves."""
        if len(ids) <= 4096:
            return b"".join(map(self.tokens.__getitem__, ids.tolist()))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


_codecs: dict[tuple[str, str], Codec] = {}  # one per worker process and file


def _codec(path: str, pattern: str) -> Codec:
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(path, pattern)
    return _codecs[path, pattern]


def _encoded(batches: Iterator[pa.RecordBatch], codec: Codec):
    """(block, ids of all its texts, bounds of each text's ids) for each block."""
    for block in text_blocks(batches, 1):
        units, codes, offsets = text_units(block.column(1).fill_null(""))
        ids, bounds = gathered([codec.encode(u) if u else b"" for u in units], codes, offsets)
        yield block, ids, bounds


def encode(
    docs: DataFrame,
    ranks_path: str,
    pattern: str = public_tokenizers.PATTERN,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(id, ids array<bigint>)``: the token ids of every whole text, in order.

    Each match of ``pattern`` is encoded separately, with no special tokens. A NULL or
    empty text gives an empty array; rows, NULL ids and repeats are kept one to one; other
    columns are not read. The rank file must exist on every node.
    """
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, ids, bounds in _encoded(batches, _codec(ranks_path, pattern)):
            lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.astype(np.int64)))
            yield pa.RecordBatch.from_arrays([block.column(0), lists], ["id", "ids"])

    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, ids array<bigint>").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, ranks_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(id, data binary)``: the bytes of each id sequence (NULL or empty: no bytes)."""
    source = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).cast("array<bigint>").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks_path, public_tokenizers.PATTERN)
        for batch in batches:
            data = [codec.decode(np.array(x or [], dtype=np.int64)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], ["id", "data"])

    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, data binary").withColumnRenamed("id", id_col)


def round_trip_digest(
    docs: DataFrame,
    ranks_path: str,
    pattern: str = public_tokenizers.PATTERN,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Encode then decode every text in one pass and return digests of both.

    Columns: the id, ``n_tokens``, ``ids_sha256`` (of the ids as little-endian unsigned
    32-bit numbers), ``decoded_sha256`` (of the decoded bytes). Edge cases as in
    :func:`encode`: a NULL text is an empty one, with the digests of no bytes.
    """
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks_path, pattern)
        for block, ids, bounds in _encoded(batches, codec):
            own = [ids[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    block.column(0),
                    pa.array(np.diff(bounds).astype(np.int64)),
                    pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x in own], pa.string()),
                    pa.array([hashlib.sha256(codec.decode(x)).hexdigest() for x in own], pa.string()),
                ],
                ["id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = source.schema["id"].dataType.simpleString()
    out = source.mapInArrow(run, f"id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("id", id_col)
