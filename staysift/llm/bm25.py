"""Exact top-k search: BM25 over sharded inverted indexes with block-max pruning.

Documents are indexed in shards of bounded size. A shard's index holds, for every term,
its postings in document order and, for longer lists, the greatest term frequency and
the least document length of each block of documents: together they bound a posting's
score under any global statistics. A query runs in each shard with the statistics of
the whole corpus. Blocks are visited by falling bound; a block whose bounds cannot reach
the k-th best score so far is skipped with all that follow, and inside a block documents
drop out as soon as their score plus the bounds of the terms still to come cannot reach
it. The shards' best rows merge exactly, as every shard used the same statistics.

Pruning costs a long query more than it saves, so long queries, and
all of a large block of queries, score all documents of a shard together: terms frequent on both
sides by a matrix product, the others by their postings. Weights are rounded to a multiple of a power of two that lets
every sum fit a double exactly, so that equal documents tie in whatever order terms add up.

Queries are cut into blocks of bounded size, and blocks and shards are cross-joined: neither
queries nor their terms pass through the driver. A task holds one block or few, reads its shards one
by one (each is a file of its own) and gives its best rows of all of them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staysift.llm.common import stored, text_blocks
from staysift.session import bounded_batches

K1, B = 1.2, 0.75
BLOCK_DOCS = 64  # documents per block of a posting list
SHARD_DOCS, SHARD_BYTES = 4096, 12 << 20  # a shard is closed at either size
CACHE_WORDS = 500_000
BLOCK_QUERIES, BLOCK_TERMS = 2048, 1_000_000  # a block of queries is closed at either size
TASK_SHARDS = 64  # that a block of queries meets in one task at most, on average
LONG_TERMS = 64  # a query of more distinct terms scores all documents of a shard,
FEW_QUERIES = 1000  # and so does every query of a block of more queries
TILE_QUERIES = 128  # long queries in one matrix product
DENSE_SHARE, DENSE_TERMS = 1 / 400, 512  # terms in more pairs than this go into the product
SCALE_STEP = 2  # long queries whose scales differ by fewer bits share one
# terms: runs of ASCII letters and digits and of any other non-ASCII characters
_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


class _TermHashes(dict):
    def __missing__(self, term: str) -> int:
        value = xxhash.xxh3_64_intdigest(term)
        if len(self) < CACHE_WORDS:
            self[term] = value
        return value


_hashes = _TermHashes()


def forget_words() -> None:
    """Free the worker's cache: a search needs its memory for the shard."""
    _hashes.clear()


def term_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the text's distinct terms (lower-cased) and their frequencies."""
    terms = _TERM.findall(text.lower())
    h = np.fromiter(map(_hashes.__getitem__, terms), dtype=np.uint64, count=len(terms))
    return np.unique(h, return_counts=True)


@dataclass
class Shard:
    """Postings of one shard: list i of ``terms`` is ``docs[starts[i]:starts[i + 1]]``; its
    block maxima, if it spans several blocks, are at ``block_starts[i]:block_starts[i + 1]``."""

    terms: np.ndarray
    starts: np.ndarray
    docs: np.ndarray
    tfs: np.ndarray
    lengths: np.ndarray
    block_starts: np.ndarray
    blocks: np.ndarray
    block_tf: np.ndarray
    block_len: np.ndarray

    PARTS = 9

    @staticmethod
    def build(counts: list[tuple[np.ndarray, np.ndarray]]) -> Shard:
        lengths = np.array([int(n.sum()) for _, n in counts], dtype="<u4")
        docs = np.repeat(np.arange(len(counts)), [len(h) for h, _ in counts])
        h = np.concatenate([h for h, _ in counts])
        tf = np.concatenate([n for _, n in counts])
        order = np.argsort(h, kind="stable")  # documents stay in order within a term
        h, docs, tf = h[order], docs[order], tf[order]
        terms, starts = np.unique(h, return_index=True)
        starts = np.append(starts, len(h))
        long = np.diff(starts) > BLOCK_DOCS
        in_long = np.repeat(long, np.diff(starts))
        key_term, key_block = np.repeat(np.arange(len(terms)), np.diff(starts))[in_long], docs[in_long] // BLOCK_DOCS
        if len(key_term):
            new = np.append(True, (np.diff(key_term) != 0) | (np.diff(key_block) != 0))
            at = np.flatnonzero(new)
            block_tf = np.maximum.reduceat(tf[in_long], at)
            block_len = np.minimum.reduceat(lengths[docs[in_long]], at)
            blocks, owner = key_block[at], key_term[at]
        else:
            block_tf = block_len = blocks = owner = np.empty(0, dtype=np.int64)
        block_starts = np.searchsorted(owner, np.arange(len(terms) + 1))
        return Shard(terms, starts, docs, tf, lengths, block_starts, blocks, block_tf, block_len)

    def to_bytes(self) -> list[bytes]:
        """``terms`` and ``lengths`` in 8 and 4 bytes, the others in the fewest bytes that hold them."""
        parts = (self.terms, self.starts, self.docs, self.tfs, self.lengths, self.block_starts, self.blocks, self.block_tf, self.block_len)
        kinds = [np.min_scalar_type(int(p.max(initial=0))).str for p in parts]
        kinds[0], kinds[4] = "<u8", "<u4"
        return [np.ascontiguousarray(p).astype(k).tobytes() for p, k in zip(parts, kinds, strict=True)]

    @staticmethod
    def from_bytes(parts: list[bytes]) -> Shard:
        def read(part: bytes, count: int) -> np.ndarray:
            return np.frombuffer(part, f"<u{len(part) // count}" if count else "<u1")

        terms, lengths = np.frombuffer(parts[0], "<u8"), np.frombuffer(parts[4], "<u4")
        starts, block_starts = read(parts[1], len(terms) + 1), read(parts[5], len(terms) + 1)
        docs, tfs = (read(p, int(starts[-1])) for p in parts[2:4])
        return Shard(terms, starts, docs, tfs, lengths, block_starts, *(read(p, int(block_starts[-1])) for p in parts[6:]))

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Places of the terms in this shard, -1 where absent."""
        at = np.searchsorted(self.terms, hashes)
        at = np.minimum(at, max(0, len(self.terms) - 1))
        return np.where(self.terms[at] == hashes, at, -1) if len(self.terms) else np.full(len(hashes), -1)

    def search(self, terms: np.ndarray, idf: np.ndarray, mean_length: float, k: int, ids: np.ndarray):
        """The k best documents: ordinals and scores (score falling, then id rising)."""
        places = self.find(terms)
        weight = lambda tf, n: tf * (K1 + 1) / (tf + K1 * (1 - B + B * n / mean_length))
        n_blocks = -(-len(self.lengths) // BLOCK_DOCS)
        lists = []
        bound = np.zeros(n_blocks)
        for place, w in zip(places.tolist(), idf.tolist(), strict=True):
            if place < 0:
                continue
            a, b = int(self.starts[place]), int(self.starts[place + 1])
            docs = self.docs[a:b].astype(np.int64)
            tops = np.zeros(n_blocks)
            if b - a > BLOCK_DOCS:
                c, d = int(self.block_starts[place]), int(self.block_starts[place + 1])
                tops[self.blocks[c:d]] = w * weight(self.block_tf[c:d].astype(float), self.block_len[c:d].astype(float))
            else:
                own = w * weight(self.tfs[a:b].astype(float), self.lengths[docs].astype(float))
                np.maximum.at(tops, docs // BLOCK_DOCS, own)
            bound += tops
            lists.append((w, docs, a, tops))
        best_docs, best = np.empty(0, dtype=np.int64), np.empty(0)
        bar, slack = -1.0, 1 - 1e-9  # bounds and scores add up in other orders
        visit = np.argsort(-bound, kind="stable")
        visit = visit[bound[visit] > 0]
        step, at = 4, 0
        while at < len(visit) and bound[visit[at]] >= bar * slack:
            group = np.sort(visit[at : at + step])
            group = group[bound[group] >= bar * slack]
            at, step = at + step, min(64, step * 2)
            score = np.zeros((len(group), BLOCK_DOCS))
            live = np.zeros(score.shape, dtype=bool)
            rest = bound[group].copy()
            for w, docs, a, tops in lists:
                low = np.searchsorted(docs, group * BLOCK_DOCS)
                high = np.searchsorted(docs, group * BLOCK_DOCS + BLOCK_DOCS)
                size = high - low
                rest -= tops[group]
                if not size.any():
                    continue
                row = np.repeat(np.arange(len(group)), size)
                post = np.repeat(low - (np.cumsum(size) - size), size) + np.arange(size.sum())
                doc = docs[post]
                if bar > 0:  # a document not met before must reach the bar from here on
                    open_ = live[row, doc % BLOCK_DOCS] | (rest[row] + tops[group][row] >= bar * slack - 1e-9)
                    row, post, doc = row[open_], post[open_], doc[open_]
                score[row, doc % BLOCK_DOCS] += w * weight(self.tfs[a + post].astype(float), self.lengths[doc].astype(float))
                live[row, doc % BLOCK_DOCS] = True
            row, place = np.nonzero(live)
            docs, scores = np.append(best_docs, group[row] * BLOCK_DOCS + place), np.append(best, score[row, place])
            keep = np.lexsort((ids[docs], -scores))[:k]
            best_docs, best = docs[keep], scores[keep]
            if len(best) == k:
                bar = best[-1]
        return best_docs, best

    def search_long(
        self, terms: np.ndarray, idf: np.ndarray, queries: dict[int, np.ndarray], mean_length: float, k: int,
        ids: np.ndarray, known: np.ndarray,
    ) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each query (places among ``terms``) the k best of the ``known`` documents, as ``search``."""
        if not queries:
            return
        n = len(self.lengths)
        at = self.find(terms)
        own = np.flatnonzero(at >= 0)
        first, last = np.zeros(len(terms), np.int64), np.zeros(len(terms), np.int64)
        first[own], last[own] = self.starts[at[own]], self.starts[at[own] + 1]
        weight = np.zeros(len(self.terms))
        weight[at[own]] = idf[own]
        norm = K1 * (1 - B + B * self.lengths / mean_length)
        docs, weights = self.docs, np.empty(len(self.docs))
        for term in range(0, len(self.terms), 4096):  # arrays as long as the postings are kept few
            starts = self.starts[term : term + 4097].astype(np.int64)
            part = slice(starts[0], starts[-1])
            tf = self.tfs[part].astype(float)
            np.divide(tf * (K1 + 1), tf + norm[docs[part]], out=weights[part])
            weights[part] *= np.repeat(weight[term : term + 4096], np.diff(starts))
        units = np.empty_like(weights)
        asked = np.bincount(np.concatenate(list(queries.values())), minlength=len(terms)) / len(queries)
        share = asked * (last - first) / n
        dense = np.argsort(-share, kind="stable")[:DENSE_TERMS]
        dense = dense[share[dense] > DENSE_SHARE]
        column = np.full(len(terms), -1)
        column[dense] = np.arange(len(dense))
        scales: dict[int, list[int]] = {}  # sums stay under 2**52 of the unit
        for i, q in queries.items():
            bits = 52 - int(np.frexp(idf[q].sum() * (K1 + 1))[1])
            scales.setdefault(bits // SCALE_STEP * SCALE_STEP, []).append(i)
        matrix = np.zeros((len(dense), n))
        for bits, group in scales.items():
            np.ldexp(weights, bits, out=units)
            np.maximum(np.rint(units, out=units), 1, out=units)
            for c, t in enumerate(dense.tolist()):
                matrix[c, docs[first[t] : last[t]]] = units[first[t] : last[t]]
            for start in range(0, len(group), TILE_QUERIES):
                tile = group[start : start + TILE_QUERIES]
                chosen = np.zeros((len(tile), len(dense)))
                for r, i in enumerate(tile):
                    columns = column[queries[i]]
                    chosen[r, columns[columns >= 0]] = 1
                scores = chosen @ matrix
                for r, i in enumerate(tile):
                    rare = queries[i][(column[queries[i]] < 0) & (last[queries[i]] > 0)]
                    if len(rare):
                        size = last[rare] - first[rare]
                        ends = np.cumsum(size)
                        post = np.repeat(first[rare] - (ends - size), size) + np.arange(ends[-1])
                        scores[r] += np.bincount(docs[post], units[post], n)
                scores[:, ~known] = 0
                # the k-th greatest of the groups' maxima is no more than the k-th greatest score
                tops = np.maximum.reduceat(scores, np.arange(0, n, BLOCK_DOCS), axis=1)
                bars = np.partition(tops, -k, axis=1)[:, -k] if tops.shape[1] >= k else np.zeros(len(tile))
                for r, i in enumerate(tile):
                    near = np.flatnonzero(scores[r] >= max(bars[r], 1))
                    near = near[np.lexsort((ids[near], -scores[r, near]))[:k]]
                    yield i, near, np.ldexp(scores[r, near], -bits)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Index every row: one row per shard, written to the shared scratch folder. A NULL id
    cannot be an answer but counts in the statistics; a NULL text is empty."""
    source = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    names = [f"p{i}" for i in range(Shard.PARTS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int | None] = []
        counts: list[tuple[np.ndarray, np.ndarray]] = []
        size = made = 0

        def close() -> pa.RecordBatch:
            shard = Shard.build(counts)
            name = f"{TaskContext.get().partitionId()}-{made}"
            return pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([len(ids)], pa.int64()), pa.array([int(shard.lengths.sum(dtype=np.int64))], pa.int64()),
                 pa.array([list(ids)], pa.list_(pa.int64()))] + [pa.array([p], pa.binary()) for p in shard.to_bytes()],
                ["shard", "n_docs", "n_terms", "ids", *names],
            )

        for block in text_blocks(batches, 1, 1 << 20):
            for key, text in zip(block.column(0).to_pylist(), block.column(1).to_pylist(), strict=True):
                ids.append(key)
                counts.append(term_counts(text or ""))
                size += len(text or "")
                if len(ids) >= SHARD_DOCS or size >= SHARD_BYTES:
                    yield close()
                    ids, counts, size, made = [], [], 0, made + 1
        if ids:
            yield close()

    kinds = ", ".join(f"{n} binary" for n in names)
    return stored(source.mapInArrow(run, f"shard string, n_docs bigint, n_terms bigint, ids array<bigint>, {kinds}"), "bm25-index", maxRecordsPerFile=1)


def _query_blocks(asked: DataFrame) -> DataFrame:
    """Queries ``q``, ``t`` in blocks of bounded size: their ids, the block's distinct terms
    and for each query, up to its end in ``ends``, the places of its terms among them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, 1, 1 << 20):
            terms = [term_counts(t)[0] for t in block.column(1).to_pylist()]
            found = pa.array([t.tobytes() for t in terms], pa.binary())
            yield pa.RecordBatch.from_arrays([block.column(0), found], ["q", "terms"]).filter(pa.array([len(t) > 0 for t in terms], pa.bool_()))

    counted = stored(bounded_batches(asked).mapInArrow(count, "q bigint, terms binary"), "bm25-queries")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int] = []
        terms: list[np.ndarray] = []
        size = made = 0

        def close() -> pa.RecordBatch:
            vocabulary, places = np.unique(np.concatenate(terms), return_inverse=True)
            ends = np.cumsum([len(t) for t in terms])
            name = f"{TaskContext.get().partitionId()}-{made}"
            return pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([ids], pa.list_(pa.int64())), pa.array([ends.astype("<i8").tobytes()], pa.binary()),
                 pa.array([places.astype("<u4").tobytes()], pa.binary()), pa.array([vocabulary.view(np.int64)], pa.list_(pa.int64()))],
                ["block", "queries", "ends", "places", "terms"],
            )

        for batch in batches:
            for q, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids.append(q)
                terms.append(np.frombuffer(t, dtype="<u8"))
                size += len(terms[-1])
                if len(ids) >= BLOCK_QUERIES or size >= BLOCK_TERMS:
                    yield close()
                    ids, terms, size, made = [], [], 0, made + 1
        if ids:
            yield close()

    dealt = counted.repartition(max(1, -(-counted.count() // BLOCK_QUERIES)))
    shape = "block string, queries array<bigint>, ends binary, places binary, terms array<bigint>"
    return stored(bounded_batches(dealt).mapInArrow(pack, shape), "bm25-blocks", maxRecordsPerFile=1)


def _with_frequencies(blocks: DataFrame, index: DataFrame) -> DataFrame:
    """The blocks with ``hits`` and ``dfs``: places and document frequencies of the terms that the index has."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p0, p1 in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                terms = np.frombuffer(p0, "<u8")
                df = np.diff(np.frombuffer(p1, f"<u{len(p1) // (len(terms) + 1)}").astype(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(terms.view(np.int64)), pa.array(df)], ["term", "df"])

    def gather(rows: pa.Table) -> pa.Table:
        found = [pa.array([rows[c].to_numpy().astype("<u4").tobytes()], pa.binary()) for c in ("place", "df")]
        return pa.table([pa.array([rows["block"][0].as_py()], pa.string()), *found], ["block", "hits", "dfs"])

    counted = bounded_batches(index.select("p0", "p1")).mapInArrow(count, "term bigint, df bigint")
    totals = counted.groupBy("term").agg(F.sum("df").alias("df"))
    asked = blocks.select("block", F.posexplode("terms").alias("place", "term"))
    found = asked.join(totals, "term").select("block", "place", "df").groupBy("block")
    found = found.applyInArrow(gather, "block string, hits binary, dfs binary")
    return stored(blocks.join(found, "block"), "bm25-weighted", maxRecordsPerFile=1)


def _best(found: list[np.ndarray], k: int) -> list[np.ndarray]:
    """Of rows ``query, document, score`` (arrays) the ``k`` best of each query."""
    query, doc, score = found
    order = np.lexsort((doc, -score, query))
    query = query[order]
    order = order[np.arange(len(query)) - np.searchsorted(query, query) < k]
    return [column[order] for column in found]


def search(index: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "query_id", text_col: str = "text") -> DataFrame:
    """The ``k`` documents of highest BM25 score for each query: ``query_id``, ``rank``
    (from 1), ``doc_id``, ``score``; ties go to the smaller id. Only documents that share a
    term with the query are answers.

    A query's repeated terms count once. Queries with a NULL id, a NULL text or no terms
    have no answers; a repeated query id is answered by its greatest text. Repeated
    documents are answers of their own.
    """
    asked = (
        queries.select(F.col(id_col).cast("bigint").alias("q"), F.col(text_col).cast("string").alias("t"))
        .where("q IS NOT NULL AND t IS NOT NULL").groupBy("q").agg(F.max("t").alias("t"))
    )
    totals = index.agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("t"), F.count(F.lit(1)).alias("shards")).first()
    n, mean = int(totals["n"] or 0), float(totals["t"] or 0) / max(1, int(totals["n"] or 0))
    blocks = _with_frequencies(_query_blocks(asked), index)
    parts = [f"p{i}" for i in range(Shard.PARTS)]

    def answers(batch: pa.RecordBatch, row: int) -> list[np.ndarray]:
        shard = Shard.from_bytes([batch.column(p)[row].as_buffer() for p in parts])
        keys = batch.column("ids")[row].values
        known = keys.is_valid().to_numpy(zero_copy_only=False)
        ids = keys.fill_null(0).to_numpy()
        asked = batch.column("queries")[row].values.to_numpy()
        terms = batch.column("terms")[row].values.to_numpy().view(np.uint64)
        places = np.frombuffer(batch.column("places")[row].as_buffer(), "<u4")
        parted = np.split(places, np.frombuffer(batch.column("ends")[row].as_buffer(), "<i8")[:-1])
        df = np.zeros(len(terms))
        hits, dfs = (np.frombuffer(batch.column(c)[row].as_buffer(), "<u4") for c in ("hits", "dfs"))
        df[hits] = dfs
        idf = np.log(1 + (n - df + 0.5) / (df + 0.5))
        long = np.array([len(own) > LONG_TERMS or len(asked) > FEW_QUERIES for own in parted])
        out = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
        for i in np.flatnonzero(~long):
            docs, scores = shard.search(terms[parted[i]], idf[parted[i]], mean, k + int((~known).sum()), ids)
            docs, scores = docs[known[docs]][:k], scores[known[docs]][:k]
            out.append((np.full(len(docs), asked[i]), ids[docs], scores))
        for i, docs, scores in shard.search_long(terms, idf, {i: parted[i] for i in np.flatnonzero(long)}, mean, k, ids, known):
            out.append((np.full(len(docs), asked[i]), ids[docs], scores))
        return [np.concatenate(column) for column in zip(*out, strict=True)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_words()
        best: dict[str, list[np.ndarray]] = {}
        for batch in batches:
            for row in range(batch.num_rows):
                block, found = batch.column("block")[row].as_py(), answers(batch, row)
                if block in best:
                    found = [np.concatenate(pair) for pair in zip(best[block], found, strict=True)]
                best[block] = _best(found, k)
            del batch  # before the next shard is read
        for found in best.values():
            yield pa.RecordBatch.from_arrays([pa.array(column) for column in found], ["query_id", "doc_id", "score"])

    shards, n_blocks = int(totals["shards"]), max(1, blocks.count())
    tasks = max(-(-shards // TASK_SHARDS), -(-8 * index.sparkSession.sparkContext.defaultParallelism // n_blocks))
    source = index.select(*parts, "ids").coalesce(tasks)
    asked = blocks.select("block", "queries", "ends", "places", "terms", "hits", "dfs").repartition(n_blocks)
    pairs = source.hint("shuffle_replicate_nl").crossJoin(asked)
    best = bounded_batches(pairs).mapInArrow(run, "query_id bigint, doc_id bigint, score double")
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    return (
        best.withColumn("rank", F.row_number().over(rank).cast("int"))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "doc_id", "score")
    )
