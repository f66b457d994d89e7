"""Target-distribution importance resampling over hashed word n-grams.

Every document is scored by how much likelier its features are in a target collection
than in the corpus, plus Gumbel noise from a hash of its id; the documents with the
highest scores are a draw without replacement in proportion to their weights.

* Feature counts of both collections are arrays of a fixed number of buckets; the gains
  made from them are one such array, and a weight is a sum of array entries.
* The cutoff is found without a sort: scores are persisted, and count jobs over them
  narrow the interval that holds the wanted rank, first by score, then by id among tied
  scores, then by row among equal ids. Each job counts at several thresholds at once and
  returns one row.
* Only the drawn rows are range-partitioned for their ranks; the offset of a range is the
  number of rows in the ranges before it.

Buckets of n-grams come from checksums of single words: the checksum of two strings in a
row is linear in both, so it needs no second look at the bytes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staysift.llm.common import stored, text_blocks

BUCKETS = 10_000
LONGEST = 3  # words of a feature
BLOCK_BYTES = 2 << 20
SHORT = 256  # byte lengths whose shift has a table of its own
PROBES = 31  # thresholds that one count job looks at
RANGE_ROWS = 500_000  # drawn rows of one range
HIGH = (1 << 63) - 1  # stands for a NULL id among ties

# words are runs of digits, letters and anything from 0x80 on, with A-Z lower-cased;
# all other bytes separate them
_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


@cache
def _shift_tables() -> np.ndarray:
    """``[k][byte place][byte]``: what a checksum becomes when ``2**k`` more bytes follow, by
    the bytes of the checksum (the map is linear over exclusive or)."""
    # the checksum of s + b"\0" is linear in that of s, but for a constant
    low = np.array([zlib.crc32(b"\0", 1 << i) ^ zlib.crc32(b"\0") for i in range(32)], dtype=np.uint32)
    rows = []
    for _ in range(40):
        values = np.zeros((4, 256), dtype=np.uint32)
        for place in range(4):
            for bit in range(8):
                values[place][(np.arange(256) >> bit & 1).astype(bool)] ^= low[8 * place + bit]
        rows.append(values)
        low = _apply(values, low)  # the shift by twice as many bytes
    return np.stack(rows)


def _apply(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return table[0][crc & 255] ^ table[1][crc >> 8 & 255] ^ table[2][crc >> 16 & 255] ^ table[3][crc >> 24]


@cache
def _short_tables() -> np.ndarray:
    """``[byte place][byte][length]`` for lengths below ``SHORT``."""
    powers = _shift_tables()
    out = np.zeros((4, 256, SHORT), dtype=np.uint32)
    for place in range(4):
        value = np.arange(256, dtype=np.uint32) << np.uint32(8 * place)
        for length in range(SHORT):
            moved = value
            for k in range(8):
                if length >> k & 1:
                    moved = _apply(powers[k], moved)
            out[place, :, length] = moved
    return out


def shifted(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Each checksum after ``length`` more bytes: ``crc(a + b) = shifted(crc(a), len(b)) ^ crc(b)``."""
    t = _short_tables()
    short = np.minimum(length, SHORT - 1)
    out = t[0][crc & 255, short] ^ t[1][crc >> 8 & 255, short] ^ t[2][crc >> 16 & 255, short] ^ t[3][crc >> 24, short]
    for i in np.flatnonzero(length >= SHORT).tolist():
        value, n = crc[i : i + 1], int(length[i])
        for k, power in enumerate(_shift_tables()):
            if n >> k & 1:
                value = _apply(power, value)
        out[i] = value[0]
    return out


def _segments(texts: list[str | None]) -> Iterator[tuple[int, list[bytes], int]]:
    """``(row, words, carried)``: each text's words; a long text comes in several parts, each
    of which begins with the last words of the one before (``carried`` of them)."""
    for row, text in enumerate(texts):
        data = (text or "").encode().translate(_WORDS)
        at, carry = 0, []
        while at < len(data):
            end = data.find(b" ", at + BLOCK_BYTES) if len(data) - at > BLOCK_BYTES else -1
            end = len(data) if end < 0 else end
            words = carry + data[at:end].split()
            yield row, words, len(carry)
            carry, at = words[1 - LONGEST :], end


def _bucketed(segments: list[tuple[int, list[bytes], int]], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows and buckets of all features of the segments, and the row of each new word."""
    words = [w for _, ws, _ in segments for w in ws]
    sizes = np.array([len(ws) for _, ws, _ in segments])
    crc = np.fromiter(map(zlib.crc32, words), dtype=np.uint32, count=len(words))
    length = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    row = np.repeat([r for r, _, _ in segments], sizes)
    place = np.arange(len(words)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    new = place >= np.repeat([c for _, _, c in segments], sizes)  # not carried over
    spaced = shifted(crc, np.ones_like(length)) ^ np.uint32(zlib.crc32(b" "))
    rows, found = [], []
    tail, tail_length = crc, length  # the feature's last words, by its first word's place
    for n in range(1, LONGEST + 1):
        if n > 1:
            count = len(words) - n + 1
            if count <= 0:
                break
            tail = shifted(spaced[:count], tail_length[1:]) ^ tail[1:]
            tail_length = length[:count] + 1 + tail_length[1:]
        last = np.arange(n - 1, len(words))
        keep = new[last] & (place[last] >= n - 1)
        rows.append(row[last[keep]])
        found.append((tail[keep] % np.uint32(buckets)).astype(np.int64))
    return np.concatenate(rows), np.concatenate(found), row[new]


def _feature_parts(texts: list[str | None], buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """:func:`_bucketed` over groups of segments of a bounded number of bytes."""
    held, size = [], 0
    for segment in _segments(texts):
        held.append(segment)
        size += sum(map(len, segment[1])) + len(segment[1])
        if size >= BLOCK_BYTES:
            yield _bucketed(held, buckets)
            held, size = [], 0
    if held:
        yield _bucketed(held, buckets)


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket is met by the features of all texts: one array per task, added up
    by a grouped sum; at most ``buckets`` numbers reach the driver."""
    source = texts.select(F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for block in text_blocks(batches, 0, BLOCK_BYTES):
            for _, found, _ in _feature_parts(block.column(0).to_pylist(), buckets):
                total += np.bincount(found, minlength=buckets)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), pa.array(total[met])], ["bucket", "n"])

    counts = source.mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, dtype=np.int64)
    for r in counts.collect():
        out[r["bucket"]] = r["n"]
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of each bucket's smoothed shares, rounded down."""
    size = float(len(source))
    s, t = source.astype(float) + 1, target.astype(float) + 1
    ratio = (t * (float(source.sum()) + size)) / (s * (float(target.sum()) + size))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def score_documents(
    docs: DataFrame,
    gains: np.ndarray,
    seed: int = 42,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(id, n_words, n_features, weight, score)`` of every row: the weight is the sum of its
    features' gains, the score the weight with Gumbel noise from a hash of the id."""
    shared = docs.sparkSession.sparkContext.broadcast(gains)
    source = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for block in text_blocks(batches, 1, BLOCK_BYTES):
            n = block.num_rows
            words, features, weight = (np.zeros(n, dtype=np.int64) for _ in range(3))
            for row, found, word_row in _feature_parts(block.column(1).to_pylist(), len(gain)):
                words += np.bincount(word_row, minlength=n)
                features += np.bincount(row, minlength=n)
                np.add.at(weight, row, gain[found])
            yield pa.RecordBatch.from_arrays(
                [block.column(0), pa.array(words), pa.array(features), pa.array(weight)],
                ["id", "n_words", "n_features", "weight"],
            )

    weighed = source.mapInArrow(run, "id bigint, n_words bigint, n_features bigint, weight bigint")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    uniform = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    noise = F.floor(-1000.0 * F.log(-F.log(uniform)))
    return weighed.withColumn("score", F.col("weight") + noise)


def _counts_below(rows: DataFrame, key: str, thresholds: list[int]) -> list[int]:
    """Rows whose ``key`` is below each threshold: one job, one row."""
    found = rows.agg(*[F.count(F.when(F.col(key) < F.lit(t), 1)).alias(f"n{i}") for i, t in enumerate(thresholds)]).first()
    return list(found)


def smallest_keys_cut(rows: DataFrame, key: str, wanted: int) -> tuple[int, int]:
    """``(cut, rest)``: all rows with a ``key`` below ``cut`` are among the ``wanted``
    smallest, and ``rest`` (at least 1) of those at the cut. Repeated exact counts narrow the
    interval of the cut; ``wanted`` must be 1 to the number of rows."""
    low, high = rows.agg(F.min(key), F.max(key)).first()
    below = 0  # rows below `low`; at least `wanted` rows are at or below `high`
    while low < high:
        steps = min(PROBES, high - low)
        tried = sorted({low + (high - low) * i // steps + 1 for i in range(steps)} - {low})
        counts = _counts_below(rows, key, tried)
        left = [(t, c) for t, c in zip(tried, counts, strict=True) if c < wanted]
        right = [t for t, c in zip(tried, counts, strict=True) if c >= wanted]
        if left:
            low, below = left[-1]
        if right:
            high = right[0] - 1
    return low, wanted - below


def draw_highest(
    scored: DataFrame, wanted: int, score: str = "score", id_col: str = "id", row: str = "row"
) -> tuple[DataFrame, Column]:
    """The ``wanted`` rows of highest score (ties to the smaller id, NULL ids last, then to the
    smaller ``row``, which is unique) with ``rank`` from 1, and the predicate that holds for
    just these rows."""
    keyed = scored.withColumn("__score", -F.col(score)).withColumn("__id", F.coalesce(F.col(id_col), F.lit(HIGH)))
    levels = ["__score", "__id", row]
    exprs = [-F.col(score), F.coalesce(F.col(id_col), F.lit(HIGH)), F.col(row)]
    part, rest, drawn, tied = keyed, wanted, F.lit(False), F.lit(True)
    for level, expr in zip(levels, exprs, strict=True):
        cut, rest = smallest_keys_cut(part, level, rest)
        drawn = drawn | (tied & (expr < F.lit(cut)))
        tied = tied & (expr == F.lit(cut))
        part = part.where(F.col(level) == F.lit(cut))
        if rest == part.count():  # all ties are drawn: no need to look at the next level
            break
    drawn = drawn | tied
    ranges = max(1, -(-wanted // RANGE_ROWS))
    chosen = keyed.where(drawn).repartitionByRange(ranges, *levels).withColumn("__range", F.spark_partition_id())
    chosen = stored(chosen, "importance-drawn")
    sizes = sorted((r["__range"], r["n"]) for r in chosen.groupBy("__range").agg(F.count(F.lit(1)).alias("n")).collect())
    before, offsets = 0, []
    for part_id, n in sizes:
        offsets.append((part_id, before))
        before += n
    starts = chosen.sparkSession.createDataFrame(offsets, "__range int, __before bigint")
    inside = F.row_number().over(Window.partitionBy("__range").orderBy(*levels))
    # one row per range of RANGE_ROWS drawn rows
    ranked = chosen.withColumn("__in", inside).join(F.broadcast(starts), "__range")
    ranked = ranked.withColumn("rank", (F.col("__before") + F.col("__in")).cast("bigint"))
    return ranked.drop("__score", "__id", "__range", "__in", "__before"), drawn


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 5,
    least_words: int = 20,
    buckets: int = BUCKETS,
    seed: int = 42,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
) -> DataFrame:
    """Draw ``percent`` of the documents with at least ``least_words`` words towards the
    distribution of ``target``: one row per document with the id, ``n_features``, ``weight``,
    ``score`` and ``rank`` (from 1 in the order of the draw, NULL if not drawn).

    Ids are integers. A NULL or empty text has no words, no features and weight 0, and cannot
    be drawn at ``least_words`` above 0. Ties go to the smaller id, then to any one of the
    rows that repeat it; a NULL id is hashed as an empty one and comes last among ties. An
    empty target has equal shares in every bucket. Other columns are not read; an empty table
    gives no rows.
    """
    gains = bucket_gains(bucket_counts(docs, text_col, buckets), bucket_counts(target, target_text_col, buckets))
    scored = score_documents(docs, gains, seed, id_col, text_col)
    # the written table fixes each row's number
    scored = stored(scored.withColumn("row", F.monotonically_increasing_id()), "importance-scores")
    fit = F.col("n_words") >= least_words
    able = scored.where(fit)
    wanted = able.count() * percent // 100
    columns = [F.col("id").alias(id_col), "n_features", "weight", "score"]
    none = F.lit(None).cast("bigint").alias("rank")
    if not wanted:
        return scored.select(*columns, none)
    ranked, drawn = draw_highest(able, wanted)
    left = scored.where(~(fit & drawn))
    return ranked.select(*columns, "rank").unionByName(left.select(*columns, none))
