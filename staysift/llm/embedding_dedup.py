"""Near-duplicate vectors by a subspace pigeonhole join of chunks.

Two unit vectors have cosine ``c`` or more just when their squared distance is at most
``2 - 2c``. A random rotation spreads that distance over the coordinates; the rotated
vector is split into blocks of a few dimensions, each with a share of the squared distance
in proportion to its dimensions. If a pair is over its share in every block, it is over the
whole: so each linked pair is within the share in at least one block.

Vectors are packed in chunks, neighbours in the cells of the blocks' grids together as far as
they come in one task. Two chunks whose boxes are further apart than the share in every block
have no links; any other two meet, and one matrix product compares all their vectors.

Scale. Equal vectors are collapsed first, so a vector that a third of all rows share is one
row. A vector is written once, with its chunk, and pairs of chunks are made by a product that
reads the written chunks again: nothing is copied per cell, so disk grows with the vectors
alone. Pairs of chunks give only sums and a spanning forest of the links (at most one edge
per component of either chunk), never pairs of vectors. Time grows with the square of the
distinct vectors wherever boxes overlap.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log, sqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from staysift.llm.common import stored
from staysift.llm.ngram_join import components
from staysift.session import bounded_batches

NEAR = 1e-9  # closer than this to a limit, a comparison is repeated in a fixed order of operations
TILE = 256  # vectors of a chunk compared at once
WIDE = 2048  # with so many of another
COARSE = 1e-5  # rounding of single-precision cosines of 64 dimensions, and more
WINDOW = 8  # chunks whose vectors are put in order together
FILE_BYTES = 16 << 20  # of chunks in one file, which is read as a whole
KEPT_BYTES = 64 << 20  # of single-precision chunks that a worker keeps
SPREAD = 4.0  # deviations of a coordinate that most vectors lie within


class Blocks:
    """The rotation, its blocks with their shares of the squared distance, and their grids."""

    def __init__(self, dim: int, rows: int, cosine: float, block_dims: int, cell_rows: int, seed: int):
        rng = np.random.default_rng(seed)
        self.rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
        self.blocks = [(int(b[0]), int(b[-1]) + 1) for b in np.array_split(np.arange(dim), max(1, round(dim / block_dims)))]
        self.cosine = cosine
        # a little above the share: rounding cannot put a linked pair over it in every block
        self.shares = [(2 - 2 * cosine) * (b - a) / dim + NEAR for a, b in self.blocks]
        self.width = [2 * sqrt(s) for s in self.shares]  # of a cell: twice the range
        self.digits = 2 * ceil(1 / min(self.width)) + 6  # cell numbers of a coordinate
        fit = int(62 * log(2) / log(self.digits))  # coordinates whose numbers fit in one code
        self.grid = []
        for (a, b), width in zip(self.blocks, self.width, strict=True):
            # coordinates of unit vectors have a mean square of 1 / dim
            cells = max(1.5, SPREAD / sqrt(dim) / width)
            self.grid.append(min(b - a, fit, max(1, ceil(log(max(1.0, rows / cell_rows)) / log(cells)))))

    def unit(self, x: np.ndarray) -> np.ndarray:
        """Unit vectors. Here and in the rotation sums run in a fixed order, whatever other
        rows there are: every task computes the same numbers for a vector."""
        x = x / np.abs(x).max(axis=1, keepdims=True)
        return x / np.sqrt(_products(x, x))[:, None]

    def rotated(self, unit: np.ndarray) -> np.ndarray:
        out = np.zeros_like(unit)
        for k in range(unit.shape[1]):
            out += unit[:, k, None] * self.rotation[k]
        return out

    def cells(self, x: np.ndarray, block: int, guests: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(row, cell, home)``: the cells of a block that each rotated vector's range reaches,
        or without ``guests`` the one that it lies in."""
        a, _ = self.blocks[block]
        width, limit = self.width[block], self.shares[block] + NEAR
        row = np.arange(len(x))
        code, gap = np.zeros(len(x), dtype=np.int64), np.zeros(len(x))
        home = np.ones(len(x), dtype=bool)
        for k in range(a, a + self.grid[block]):
            at = np.floor(x[row, k] / width)
            inside = x[row, k] - at * width
            parts = []
            moves = ((-1, inside), (0, np.zeros(len(row))), (1, width - inside))
            for move, more in moves if guests else moves[1:2]:
                far = gap + more * more
                near = far <= limit
                digit = at[near].astype(np.int64) + move + self.digits // 2
                parts.append((row[near], code[near] * self.digits + digit, far[near], home[near] & (move == 0)))
            row, code, gap, home = (np.concatenate(p) for p in zip(*parts, strict=True))
        return row, code, home


    def in_order(self, x: np.ndarray) -> np.ndarray:
        """The rotated vectors' places, those of a cell of the first block together, and so on."""
        return np.lexsort([self.cells(x, block, guests=False)[1] for block in range(len(self.blocks))][::-1])

    def apart(self, a: np.ndarray, b: np.ndarray) -> bool:
        """Whether two boxes (least and greatest rotated coordinates) are further apart than the
        share in every block."""
        gap = np.maximum(0, np.maximum(a[0] - b[1], b[0] - a[1]))
        return all((gap[i:j] ** 2).sum() > share + NEAR for (i, j), share in zip(self.blocks, self.shares, strict=True))


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of paired rows, summed in a fixed order."""
    out = np.zeros(len(a))
    for k in range(a.shape[1]):
        out += a[:, k] * b[:, k]
    return out


class Chunk:
    """Vectors as they came, and as unit vectors in single precision."""

    def __init__(self, blocks: Blocks, raw: np.ndarray, single: np.ndarray | None = None):
        self.blocks, self.raw = blocks, raw
        self.single = blocks.unit(raw.astype(float)).astype(np.float32) if single is None else single

    def links(self, other: Chunk) -> Iterator[tuple[slice, slice, np.ndarray]]:
        """Tiles of the two chunks and which of their pairs link, where some do. A tile is met by
        one matrix product; what its rounding leaves open is decided pair by pair."""
        limit = self.blocks.cosine
        slack = max(COARSE, (self.raw.shape[1] + 8) * 2.0**-23)
        for i in (slice(at, at + TILE) for at in range(0, len(self.raw), TILE)):
            for j in (slice(at, at + WIDE) for at in range(0, len(other.raw), WIDE)):
                cosine = self.single[i] @ other.single[j].T
                if cosine.max() < limit - slack:
                    continue
                found = cosine >= limit - slack
                p, q = np.nonzero(found & (cosine <= limit + slack))
                for at in range(0, len(p), 16_384):
                    r, c = p[at : at + 16_384], q[at : at + 16_384]
                    found[r, c] = self._exact(other, r + i.start, c + j.start)
                if found.any():
                    yield i, j, found

    def _exact(self, other: Chunk, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Whether pairs link, by double-precision cosines in a fixed order of operations."""
        a, b = (self.blocks.unit(m.astype(float)) for m in (self.raw[p], other.raw[q]))
        return _products(a, b) >= self.blocks.cosine


def _merge(label: np.ndarray, left: np.ndarray, right: np.ndarray, found: np.ndarray) -> None:
    """Give all places that a tile links the same ``label``: the least of theirs."""
    for r in np.flatnonzero(found.any(axis=1)).tolist():
        met, own = label[right[found[r]]], label[left[r]]
        if (met != own).any():
            merged = np.unique(np.append(met, own))
            label[np.isin(label, merged)] = merged[0]


def _inside(chunk: Chunk, copies: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For one chunk: the vectors' numbers of links, and the first vector that each one reaches."""
    place = np.arange(len(copies))
    label, links = place.copy(), np.zeros(len(copies))
    for i, j, found in chunk.links(chunk):
        found &= place[i][:, None] != place[j][None, :]  # a vector does not link with itself
        links[i] += found @ copies[j].astype(float)
        _merge(label, place[i], place[j], found)
    return links.astype(np.int64), label


def _classes(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, DataFrame, int, int]:
    """All rows as ``(id, k1, k2)`` (keys NULL where the vector takes no part); one row per
    distinct vector, ``(k1, k2, id, copies, vec)`` with its smallest id; the dimensions and the
    rows that take part. Single-precision vectors stay so: they are doubled where they are used."""
    v = F.col("vec")
    kind = vectors.schema[vector_col].dataType
    kind = "array<float>" if isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType) else "array<double>"
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast(kind).alias("vec"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    valid = F.coalesce(F.col("id").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))
    common = rows.where(valid).groupBy(F.size(v).alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    dim, n = (common["d"], common["n"]) if common else (0, 0)
    valid = valid & (F.size(v) == dim)
    # two 64-bit hashes stand for a vector
    keyed = rows.select(
        "id",
        F.when(valid, F.xxhash64(v)).alias("k1"),
        F.when(valid, F.xxhash64(F.lit("vector"), v)).alias("k2"),
        "vec",
    )
    classes = (
        keyed.where("k1 IS NOT NULL").groupBy("k1", "k2")
        .agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"), F.min("vec").alias("vec"))
    )
    return keyed.drop("vec"), classes, dim, n


COLUMNS = ("id", "k1", "k2", "copies", "links", "root")  # of the vectors of a chunk, as arrays


def _chunks(classes: DataFrame, blocks: Blocks, dim: int, chunk_rows: int) -> DataFrame:
    """The distinct vectors as written chunks: the number of the ``first`` vector (numbers go on
    from it), the arrays of COLUMNS with links and roots inside the chunk, the ``box`` of the
    rotated vectors, and ``vec`` with all vectors."""
    shared = classes.sparkSession.sparkContext.broadcast(blocks)
    kind = "<f4" if classes.schema["vec"].dataType.elementType == FloatType() else "<f8"

    def chunk(first: int, columns: list[np.ndarray], raw: np.ndarray, turned: np.ndarray) -> pa.RecordBatch:
        links, root = _inside(Chunk(shared.value, raw), columns[-1])
        box = np.stack((turned.min(axis=0), turned.max(axis=0)))
        return pa.RecordBatch.from_arrays(
            [pa.array([first], pa.int64())] + [pa.array([c], pa.list_(pa.int64())) for c in (*columns, links, root)]
            + [pa.array([x.tobytes()], pa.binary()) for x in (box, raw)],
            ["first", *COLUMNS, "box", "vec"],
        )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, rows, parts = TaskContext.get().partitionId() << 20, 0, []

        def ordered() -> Iterator[tuple[list[np.ndarray], np.ndarray, np.ndarray]]:
            *columns, raw = (np.concatenate(c) for c in zip(*parts, strict=True))
            turned = shared.value.rotated(shared.value.unit(raw.astype(float)))
            order = shared.value.in_order(turned)
            for at in range(0, len(order), chunk_rows):
                own = order[at : at + chunk_rows]
                yield [c[own] for c in columns], raw[own], turned[own]

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal made, rows, parts
            for columns, raw, turned in ordered():
                yield chunk(made * chunk_rows, columns, raw, turned)
                made += 1
            rows, parts = 0, []

        for whole in batches:
            for at in range(0, whole.num_rows, chunk_rows):
                batch = whole.slice(at, chunk_rows)
                own = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "k1", "k2", "copies")]
                parts.append((*own, batch.column("vec").flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, dim)))
                rows += batch.num_rows
                if rows >= WINDOW * chunk_rows:
                    yield from close()
        if rows:
            yield from close()

    shape = "first bigint, " + ", ".join(f"{c} array<bigint>" for c in COLUMNS) + ", box binary, vec binary"
    packed = bounded_batches(classes.select("id", "k1", "k2", "copies", "vec")).mapInArrow(pack, shape)
    return stored(packed, "dedup-chunks", maxRecordsPerFile=max(1, FILE_BYTES // (chunk_rows * (dim * int(kind[-1]) + 48))))


def _links(chunks: DataFrame, blocks: Blocks) -> DataFrame:
    """Rows ``(num, links, other)`` of all pairs of chunks: the ``links`` of ``num`` with the vectors
    of other chunks, and with 0 links the edges ``(num, other)`` of a forest over the roots."""
    shared = chunks.sparkSession.sparkContext.broadcast(blocks)
    dim = len(blocks.rotation)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, np.ndarray] = {}
        links: dict[int, np.ndarray] = {}

        def side(batch: pa.RecordBatch, row: int, name: str) -> tuple[int, np.ndarray, np.ndarray, Chunk]:
            first = batch.column(f"{name}_first")[row].as_py()
            copies, root = (batch.column(f"{name}_{c}")[row].values.to_numpy() for c in ("copies", "root"))
            data = batch.column(f"{name}_vec")[row].as_buffer()
            raw = np.frombuffer(data, f"<f{data.size // (dim * len(copies))}").reshape(-1, dim)
            made = Chunk(shared.value, raw, kept.pop(first, None))
            kept[first] = made.single
            while sum(x.nbytes for x in kept.values()) > KEPT_BYTES and len(kept) > 2:
                del kept[next(iter(kept))]  # the one met longest ago
            return first, copies, root, made

        def out(num: np.ndarray, count: np.ndarray, other: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (num, count, other)], ["num", "links", "other"])

        for batch in batches:
            for row in range(batch.num_rows):
                boxes = [np.frombuffer(batch.column(f"{n}_box")[row].as_buffer()).reshape(2, dim) for n in "ab"]
                if shared.value.apart(*boxes):
                    continue
                first_a, copies_a, root_a, a = side(batch, row, "a")
                first_b, copies_b, root_b, b = side(batch, row, "b")
                roots = np.concatenate((root_a, len(root_a) + root_b))
                label, place_a = roots.copy(), np.arange(len(root_a))
                place_b = len(root_a) + np.arange(len(root_b))
                for i, j, found in a.links(b):
                    for first, n, at, sums in (
                        (first_a, len(root_a), i, found @ copies_b[j].astype(float)),
                        (first_b, len(root_b), j, copies_a[i].astype(float) @ found),
                    ):
                        links.setdefault(first, np.zeros(n))[at] += sums
                    _merge(label, place_a[i], place_b[j], found)
                tied = np.unique(roots[label != roots])
                if len(tied):
                    num = np.concatenate((first_a + place_a, first_b + np.arange(len(root_b))))
                    yield out(num[tied], np.zeros(len(tied)), num[label[tied]])
            del batch  # before the next pair is read
        for first, sums in links.items():
            some = np.flatnonzero(sums)
            yield out(first + some, sums[some], first + some)

    columns = ("first", "copies", "root", "box", "vec")
    a, b = (chunks.select(*[F.col(c).alias(f"{name}_{c}") for c in columns]) for name in "ab")
    pairs = a.hint("shuffle_replicate_nl").join(b, F.col("a_first") < F.col("b_first"))
    return stored(bounded_batches(pairs).mapInArrow(run, "num bigint, links bigint, other bigint"), "dedup-links")


def near_duplicates(
    vectors: DataFrame,
    cosine: float = 0.9,
    block_dims: int = 8,
    cell_rows: int = 32_768,
    chunk_rows: int = 8192,
    seed: int = 42,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """Links between vectors of at least the given ``cosine`` (above 0, at most 1), in double
    precision: one row per row of ``vectors`` with the id, ``n_links`` (other vectors linked
    directly), ``component_id`` (smallest id reached over links, its own included) and ``kept``
    (the id is that of its component).

    Vectors that are NULL, zero, hold NULL or non-finite components, or differ in length from
    most others link with nothing. Every row is a vector of its own: repeated rows link with
    each other, and an id with several vectors is answered for each. A row with a NULL id takes
    no part: no links, NULL component, kept. Ids are integers; other columns are not read; an
    empty table gives no rows.

    Chunks hold ``chunk_rows`` vectors, or fewer where that gives too few chunks for all cores.
    """
    if not 0 < cosine <= 1:
        raise ValueError("cosine must be above 0 and at most 1")
    rows, distinct, dim, n = _classes(vectors, id_col, vector_col)
    result = [F.col("id").alias(id_col), "n_links", "component_id", (F.col("id").eqNullSafe(F.col("component_id"))).alias("kept")]
    alone = rows.where("k1 IS NULL").select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    if not n:
        return alone.select(*result)
    blocks = Blocks(dim, n, cosine, block_dims, cell_rows, seed)
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    # the written chunks fix each distinct vector's number
    chunks = _chunks(distinct, blocks, dim, min(chunk_rows, max(1024, -(-n // (4 * cores)))))
    classes = chunks.select("first", F.posexplode(F.arrays_zip(*COLUMNS)).alias("place", "c")).select(
        (F.col("first") + F.col("place")).alias("num"), (F.col("first") + F.col("c.root")).alias("other"),
        *[f"c.{c}" for c in COLUMNS if c != "root"],
    )
    found = _links(chunks, blocks)
    counts = found.where("links > 0").groupBy("num").agg(F.sum("links").alias("more"))
    edges = found.where("num != other").select("num", "other").unionByName(classes.where("num != other").select("num", "other"))
    roots = components(edges.select(F.col("num").alias("a"), F.col("other").alias("b")))
    classes = classes.drop("other").withColumnRenamed("links", "inside")
    rooted = (
        classes.join(roots.withColumnRenamed("id", "num"), "num", "left")
        .withColumn("root", F.coalesce("root", "num")).join(counts, "num", "left")
        .withColumn("links", F.nullif(F.col("inside") + F.coalesce("more", F.lit(0)), F.lit(0))).drop("inside", "more")
    )
    rooted = stored(rooted, "dedup-rooted")
    least = rooted.groupBy("root").agg(F.min("id").alias("component_id"), F.count(F.lit(1)).alias("members"))
    # a vector without links is its own component: nothing to join
    linked = rooted.where("links > 0").join(least.where("members > 1"), "root")
    info = stored(
        linked.unionByName(
            rooted.where("links IS NULL").withColumns({"component_id": F.col("id"), "members": F.lit(1).cast("bigint")})
        ).select("k1", "k2", "copies", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"),
        "dedup-info",
    )
    # vectors with more than 1/1024 of all rows: at most 1024, so they can be broadcast
    hot = info.where(F.col("copies") * 1024 > n).drop("copies")
    part = rows.where("k1 IS NOT NULL")
    keys = ["k1", "k2"]
    cold = part.join(F.broadcast(hot), keys, "left_anti").join(info.drop("copies"), keys)
    joined = part.join(F.broadcast(hot), keys).unionByName(cold)
    return joined.select("id", "n_links", "component_id").unionByName(alone).select(*result)
