"""N-gram Jaccard join with adaptive multi-match prefixes, and its link components.

A document's set is its distinct word shingles, as 64-bit hashes, sorted from rare to
common. Two sets that are similar enough share at least ``l`` elements among their first
``n - overlap + l`` (their l-prefixes), for every ``l``. Each document picks the ``l``
that it expects to be cheapest from estimated frequencies: a longer prefix costs more
postings, but candidates must then share ``l`` elements. A pair is held to the smaller
``l`` of the two, at the prefix lengths that its two sizes imply, and is then verified
on the whole texts.

Scale. Frequencies come from one fixed-size count sketch over all documents; they only
decide the order, so estimates cannot lose a link. Exact copies collapse into one class
first. Inside a posting list every member is compared with the list's head only (a
star, no pairs among members); once the links found so far are merged into components, a
second round compares just those members of a list that lie in different components. So a
large group of near copies costs a pass over its members, and no link between components
is missed. Long lists are salted. Only components and counts leave the operator, no list
of pairs.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staysift.llm.common import bounded_batches, stored, text_blocks

SKETCH_BITS = 21  # cells of the count sketch
SLICES = 64  # the sketch travels in so many parts
FAN_IN = 64  # partial sketches added up by one task
MAX_MATCHES = 5  # the longest adaptive prefix requires so many shared elements
VERIFY_COST = 30.0  # of verifying a candidate, in postings read
LIST_ROWS = 20_000  # members of a posting list per salt
LONG_LIST = 32  # members of a posting list from which its pairs are made once, not per token
BROADCAST_IDS = 1_000_000  # ids of documents to fetch texts of; more are joined by shuffle
BLOCK_BYTES = 2 << 20  # of text that a task holds as shingles at once
CACHE_WORDS = 200_000  # of at most SHORT_WORD bytes each
SHORT_WORD = 32
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


class _WordHashes(dict):
    """Hash of each word, kept for a bounded number of words per Python worker."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < CACHE_WORDS and len(word) <= SHORT_WORD:
            self[word] = value
        return value


_words = _WordHashes()


def shingle_set(text: str, size: int) -> np.ndarray:
    """Sorted distinct hashes of the text's word shingles. Words are runs of anything but
    space and control white space (9 to 13), with A-Z lower-cased; a text of fewer words
    than ``size`` is one shingle; without words the set is empty."""
    words = text.encode().translate(_LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(_words.__getitem__, words), dtype=np.uint64, count=len(words))
    size = min(size, len(w))
    h = np.full(len(w) - size + 1, 0x9E3779B97F4A7C15 * size & 0xFFFFFFFFFFFFFFFF, dtype=np.uint64)
    for k in range(size):
        h = (h ^ w[k : k + len(h)]) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
    return np.unique(h)


def _cell(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def _scan(docs: DataFrame, size: int) -> DataFrame:
    """One pass over all texts: a row ``(id, n, sig)`` per document and, per task, the
    sketch of its shingle counts in slices ``(part, slice, counts)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, dtype=np.uint32)  # of one task
        schema = None
        for block in text_blocks(batches, 1, BLOCK_BYTES):
            sets = [shingle_set(t or "", size) for t in block.column(1).to_pylist()]
            cells, met = np.unique(_cell(np.concatenate(sets)), return_counts=True)
            counts[cells] += met.astype(np.uint32)
            n = len(sets)
            schema = block.column(0).type
            yield pa.RecordBatch.from_arrays(
                [
                    block.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                    pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()),
                ],
                ["id", "n", "sig", "part", "slice", "counts"],
            )
        if schema is not None:
            parts = np.split(counts.astype("<u4"), SLICES)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.nulls(SLICES, schema), pa.nulls(SLICES, pa.int64()), pa.nulls(SLICES, pa.binary()),
                    pa.array([TaskContext.get().partitionId()] * SLICES, pa.int32()),
                    pa.array(range(SLICES), pa.int32()),
                    pa.array([zlib.compress(p.tobytes(), 1) for p in parts], pa.binary()),
                ],
                ["id", "n", "sig", "part", "slice", "counts"],
            )

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, n bigint, sig binary, part int, slice int, counts binary")


def _add_sketches(parts: DataFrame, tasks: int) -> np.ndarray:
    """Sum the tasks' sketches in a tree of bounded groups; returns the frequency level of
    each cell (8 steps per doubling, one byte)."""

    def total(frame: pd.DataFrame) -> pd.DataFrame:
        added = sum(np.frombuffer(zlib.decompress(c), dtype="<u4").astype(np.uint64) for c in frame["counts"])
        data = zlib.compress(np.minimum(added, 0xFFFFFFFF).astype("<u4").tobytes(), 1)
        return pd.DataFrame({"part": [int(frame["part"].iloc[0])], "slice": [int(frame["slice"].iloc[0])], "counts": [data]})

    while True:
        parts = parts.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("int"))
        parts = parts.groupBy("part", "slice").applyInPandas(total, "part int, slice int, counts binary")
        tasks = -(-tasks // FAN_IN)
        if tasks <= 1:
            break
    found = {r["slice"]: zlib.decompress(r["counts"]) for r in parts.collect()}
    if not found:
        return np.zeros(1 << SKETCH_BITS, dtype=np.uint8)
    counts = np.concatenate([np.frombuffer(found[s], dtype="<u4") for s in range(SLICES)])
    return np.minimum(255, np.round(8 * np.log2(1.0 + counts))).astype(np.uint8)


def choose_matches(frequency: np.ndarray, least: int) -> int:
    """The ``l`` with the cheapest estimate, for a set whose elements in order have these
    estimated frequencies and whose 1-prefix has ``least`` elements."""
    best, cost = 1, float("inf")
    for l in range(1, MAX_MATCHES + 1):  # noqa: E741
        if least - 1 + l > len(frequency):
            break
        read = float((frequency[: least - 1 + l] - 1).sum())
        # about 1 in l of the documents met by a posting is met l times
        estimate = (least - 1 + l) + read + VERIFY_COST * read / l**2
        if estimate < cost:
            best, cost = l, estimate
    return best


def _prefixes(docs: DataFrame, levels: np.ndarray, size: int, percent: int) -> DataFrame:
    """``(id, n, l, tokens, salts)``: each document's adaptive prefix, rare first, and
    over how many salts the posting list of each token is dealt."""
    shared = docs.sparkSession.sparkContext.broadcast(levels)
    floor = float(np.median(2.0 ** (levels / 8.0) - 1)) if levels.any() else 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for block in text_blocks(batches, 1, BLOCK_BYTES):
            rows, tokens, salts, ends = [], [], [], [0]
            for i, text in enumerate(block.column(1).to_pylist()):
                h = shingle_set(text or "", size)
                n = len(h)
                if not n:
                    continue
                level = known[_cell(h)]
                order = np.lexsort((h, level))
                least = n - (percent * n + 99) // 100 + 1
                order = order[: least - 1 + MAX_MATCHES]
                # cells hold other elements as well: the median cell's count is that noise
                count = np.maximum(1.0, 2.0 ** (level[order] / 8.0) - 1 - floor)
                matches = choose_matches(count, least)
                order, count = order[: least - 1 + matches], count[: least - 1 + matches]
                rows.append((i, n, matches))
                tokens.append(h[order].view(np.int64))
                salts.append(np.ceil(count / LIST_ROWS).astype(np.int32))
                ends.append(ends[-1] + len(order))
            if rows:
                at = np.array(rows, dtype=np.int64)
                ends = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        block.column(0).take(pa.array(at[:, 0])),
                        pa.array(np.ascontiguousarray(at[:, 1])),
                        pa.array(at[:, 2].astype(np.int32)),
                        pa.ListArray.from_arrays(ends, pa.array(np.concatenate(tokens))),
                        pa.ListArray.from_arrays(ends, pa.array(np.concatenate(salts))),
                    ],
                    ["id", "n", "l", "tokens", "salts"],
                )

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, n bigint, l int, tokens array<bigint>, salts array<int>")


def _possible(percent: int, a: str = "a_", b: str = "b_"):
    """Whether a shared token counts for a pair, by the sizes, the smaller ``l`` and the
    token's position in both sets (columns with the prefixes ``a`` and ``b``)."""
    na, nb = F.col(a + "n"), F.col(b + "n")
    matches = F.least(F.col(a + "l"), F.col(b + "l"))
    overlap = F.ceil(F.lit(percent) * (na + nb) / (100 + percent) - 1e-9)
    return (
        (100 * F.least(na, nb) >= percent * F.greatest(na, nb))
        & (F.col(a + "pos") < na - overlap + matches)
        & (F.col(b + "pos") < nb - overlap + matches)
    )


def _crossing(apart: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs ``(a, b)`` of different components among the members of lists.

    A pair of a long list usually shares many long lists. Their rows carry the long
    lists of their document, so that the pair is made once, at the first one that both have,
    and only if these and the short lists of either can reach the needed number; short
    lists make a row for each shared token.
    """
    common = ("id", "n", "l", "pos", "root")
    differ = F.col("a_root") < F.col("b_root")
    short = apart.where(F.col("members") <= LONG_LIST)
    side = lambda p: short.select("token", *[F.col(c).alias(p + c) for c in common])
    few = side("a_").join(side("b_"), "token").where(differ & _possible(percent)).withColumn("shared", F.lit(1))
    long = apart.where(F.col("members") > LONG_LIST)
    pair = F.when(F.col("members") > LONG_LIST, F.struct("pos", "token"))
    own = apart.groupBy("row").agg(
        F.array_sort(F.collect_list(pair)).alias("both"), F.count(F.when(F.col("members") <= LONG_LIST, 1)).alias("short")
    ).select("row", "short", F.col("both.pos").alias("at_pos"), F.col("both.token").alias("long"))
    long = long.join(own, "row").withColumn("at", F.array_position("long", F.col("token")).cast("int") - 1)
    side = lambda p: long.select("token", *[F.col(c).alias(p + c) for c in (*common, "long", "at_pos", "short", "at")])
    overlap = F.ceil(F.lit(percent) * (F.col("a_n") + F.col("b_n")) / (100 + percent) - 1e-9)
    matches = F.least("a_l", "b_l")
    counting = lambda p: F.slice(
        p + "long", F.lit(1), F.size(F.filter(p + "at_pos", lambda x: x < F.col(p + "n") - overlap + matches))
    )
    shared = F.size(F.array_intersect(counting("a_"), counting("b_")))
    met = F.arrays_overlap(F.expr("slice(a_long, 1, a_at)"), F.expr("slice(b_long, 1, b_at)"))
    # if any long list counts for the pair by its position, the first common one does
    many = side("a_").join(side("b_"), "token").where(
        differ & _possible(percent) & ~met & (shared + F.least("a_short", "b_short") >= matches)
    )
    many = many.withColumn("shared", shared)
    keep = [F.least("a_id", "b_id").alias("a"), F.greatest("a_id", "b_id").alias("b"), "shared", F.least("a_l", "b_l").alias("l")]
    return (
        few.select(*keep).union(many.select(*keep)).groupBy("a", "b")
        .agg(F.sum("shared").alias("shared"), F.max("l").alias("l"))
        .where((F.col("a") != F.col("b")) & (F.col("shared") >= F.col("l")))
        .select("a", "b")
    )


def _candidates(hits: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` that share as many counting tokens as their smaller ``l``."""
    return (
        hits.select(
            F.least("a_id", "b_id").alias("a"), F.greatest("a_id", "b_id").alias("b"), "token",
            F.least("a_l", "b_l").alias("l"),
        )
        .groupBy("a", "b")
        .agg(F.count(F.lit(1)).alias("shared"), F.max("l").alias("l"))
        .where((F.col("a") != F.col("b")) & (F.col("shared") >= F.col("l")))
        .select("a", "b")
    )


def _verified(docs: DataFrame, pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose whole texts reach the similarity."""
    pairs = stored(pairs, "ngram-candidates")
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    if pairs.count() <= BROADCAST_IDS // 2:
        ids = F.broadcast(ids)
    # rows of one id and text are one document; a hash stands for the text
    texts = docs.join(ids, "id", "left_semi").repartition("id").withColumn("h", F.xxhash64("text")).dropDuplicates(["id", "h"])
    both = pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("b_text")), "b").join(
        texts.select(F.col("id").alias("a"), F.col("text").alias("a_text")), "a"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, left = None, np.empty(0, np.uint64)
        for batch in batches:
            for block in text_blocks(iter([batch]), 3, BLOCK_BYTES):
                keep = []
                for a_text, b_text in zip(block.column(2).to_pylist(), block.column(3).to_pylist(), strict=True):
                    if a_text != last:
                        last, left = a_text, shingle_set(a_text, size)
                    right = shingle_set(b_text, size)
                    common = len(np.intersect1d(left, right, assume_unique=True))
                    keep.append(100 * common >= percent * (len(left) + len(right) - common) > 0)
                yield pa.RecordBatch.from_arrays(
                    [block.column(0).filter(pa.array(keep)), block.column(1).filter(pa.array(keep))], ["a", "b"]
                )

    kind = pairs.schema["a"].dataType.simpleString()
    linked = both.select("a", "b", "a_text", "b_text").mapInArrow(run, f"a {kind}, b {kind}")
    return stored(linked.distinct(), "ngram-links")


def components(links: DataFrame) -> DataFrame:
    """``(id, root)`` for every linked id: the smallest id that it reaches. Alternating
    large-star and small-star rounds; each round is written, none is collected."""
    edges = stored(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), "star"
    )
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == before:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("root"))
        before = state
        near = edges.union(edges.select("v", "u"))
        least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = near.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        edges = stored(
            large.join(small, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(small.select("u", F.col("m").alias("v")))
            .where("u != v")
            .distinct(),
            "star",
        )


def jaccard_components(
    docs: DataFrame,
    size: int = 3,
    percent: int = 90,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: the id, ``n_shingles`` (size of its set), ``component_id``
    (the smallest id it reaches over links, itself included).

    Two documents link when their sets' Jaccard similarity is at least ``percent`` / 100.
    A NULL or empty text, or one without words, has an empty set and links with nothing.
    Repeated rows are each returned; an id with several texts links by any of them. A row
    with a NULL id takes the component of its copies, if any, else NULL. Ids must be
    orderable; other columns are not read; an empty table gives no rows.
    """
    docs = bounded_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    scan = stored(_scan(docs, size), "ngram-scan")
    sets = scan.where("slice IS NULL").select("id", "n", "sig")
    classes = sets.where("n > 0").groupBy("sig").agg(F.min("id").alias("rep"))
    parts = scan.where("slice IS NOT NULL").select("part", "slice", "counts")
    tasks = (parts.agg(F.max("part")).first()[0] or 0) + 1
    levels = _add_sketches(parts, tasks)
    reps = classes.select(F.col("rep").alias("id")).distinct()
    prefixes = _prefixes(docs, levels, size, percent).join(reps, "id")
    prefixes = prefixes.withColumn("row", F.xxhash64("id", "tokens"))  # an id may have several texts
    lists = prefixes.select("id", "n", "l", "row", F.posexplode(F.arrays_zip("tokens", "salts")).alias("pos", "t")).select(
        F.col("t.tokens").alias("token"),
        F.pmod(F.xxhash64("id"), F.col("t.salts")).cast("int").alias("salt"),
        F.col("t.salts").alias("salts"), "id", "n", "l", "row", "pos",
    )
    # the head of a list has the fewest rarer elements of its own: the likely original
    heads = Window.partitionBy("token", "salt").orderBy("pos", "id").rowsBetween(Window.unboundedPreceding, 0)
    members = stored(
        lists.withColumn("head", F.first(F.struct("id", "n", "l", "row", "pos")).over(heads)).where(
            (F.col("id") != F.col("head.id")) | (F.col("salts") > 1)
        ),
        "ngram-lists",
    )
    own = [F.col(c).alias(f"b_{c}") for c in ("id", "n", "l", "pos")]
    head = [F.col(f"head.{c}").alias(f"a_{c}") for c in ("id", "n", "l", "pos")]
    tops = members.where("salts > 1").select("token", "head").distinct()
    top = tops.groupBy("token").agg(F.min(F.struct("head.pos", "head.id", "head.n", "head.l")).alias("top"))
    stars = members.select("token", *own, *head).unionByName(
        tops.join(top, "token").select(
            "token",
            *[F.col(f"head.{c}").alias(f"b_{c}") for c in ("id", "n", "l", "pos")],
            *[F.col(f"top.{c}").alias(f"a_{c}") for c in ("id", "n", "l", "pos")],
        )
    )
    first = _candidates(stars.where(_possible(percent)))
    links = _verified(docs, first, size, percent)
    roots = components(links)
    # second round: members of one list that are still apart
    one = ["token", "id", "n", "l", "row", "pos"]
    listed = members.select(one).union(members.select("token", "head.*").select(one))
    placed = listed.distinct().join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    roots_of = placed.groupBy("token").agg(
        F.min("root").alias("r0"), F.max("root").alias("r1"), F.count(F.lit(1)).alias("members")
    )
    apart = stored(placed.join(roots_of.where("r0 < r1").select("token", "members"), "token"), "ngram-apart")
    more = _verified(docs, _crossing(apart, percent), size, percent)
    roots = components(links.union(more))
    return (
        sets.join(classes, "sig", "left")
        .join(roots.select(F.col("id").alias("rep"), "root"), "rep", "left")
        .select(
            F.col("id").alias(id_col),
            F.col("n").alias("n_shingles"),
            F.coalesce("root", "rep", "id").alias("component_id"),
        )
    )


def keep_one_each(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, with one document left of each component: the
    one of smallest id, once. Rows with a NULL id stay."""
    found = stored(jaccard_components(docs, size, percent, id_col, text_col), "ngram-components")
    gone = found.where(F.col(id_col) != F.col("component_id")).select(id_col).distinct()
    repeated = found.where(F.col(id_col) == F.col("component_id")).groupBy(id_col).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if gone.count() <= BROADCAST_IDS:
        gone = F.broadcast(gone)
    kept = docs.join(gone, id_col, "left_anti")
    if repeated.isEmpty():
        return kept.select(*docs.columns)
    # rows that repeat an id: the one of least hash, once
    again = repeated.select(id_col)
    rows = kept.join(again, id_col, "left_semi").withColumn("__h", F.xxhash64(*docs.columns))
    first = rows.groupBy(id_col).agg(F.min("__h").alias("__h"))
    once = rows.join(first, [id_col, "__h"], "left_semi").dropDuplicates([id_col])
    return kept.join(again, id_col, "left_anti").select(*docs.columns).unionByName(once.select(*docs.columns))
