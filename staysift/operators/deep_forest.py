"""Random forests of deep trees.

Spark's learner sums a histogram over all features for every node of a level and reads all rows
once for each group of nodes that fits its memory: a forest of deep trees has so many nodes that
it reads the rows thousands of times. Here a tree is grown by one task that holds its rows in
bins, and by several tasks where there are more rows than one may hold:

* rows are binned as Spark does (at most 32 bins, quantiles of a sample of 10,000 rows) and written
  in blocks; only bins other than that of the value 0 are kept, so one-hot features cost nothing;
* while a node has more rows than a task may hold, all trees' histograms of such nodes are summed
  over the blocks, a level per job; what is left of a tree is dealt over tasks of bounded rows;
* a task reads the blocks one by one, draws their bootstrap weights (Poisson, from the seed, the
  tree and the block, so that every reading draws the same), keeps the rows that come to its nodes
  and grows them level by level.

As in Spark's learner a split minimises the weighted variance over all features, needs a gain and
``min_leaf`` rows on each side, and a leaf predicts its mean; the draws are not Spark's. Grown trees
are written, never collected: scoring reads them one by one for each block of rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staysift.session import bounded_batches, written

MAX_BINS, SAMPLE_ROWS = 32, 10_000  # as Spark's learner has them
BLOCK_ROWS = 65_536  # at most; Arrow batches are mostly smaller
FILE_BLOCKS, FILE_TREES = 64, 4  # a file is read as a whole
TASK_BYTES = 128 << 20  # of the rows that one task holds
CELLS = 1 << 20  # of the histograms summed at once
PART_ROWS = 1 << 16  # rows added to a histogram at once
GAIN = 1e-11  # least gain, as a share of the node's sum of squares


@dataclass
class Bins:
    """Thresholds of each feature (a value is in the bin of the first one that is not below it). The
    bins of all features have one numbering: those of feature f begin at ``offset[f]``."""

    thresholds: list[np.ndarray]

    def __post_init__(self) -> None:
        size = np.array([len(t) + 1 for t in self.thresholds], dtype=np.int64)
        self.offset = np.concatenate(([0], np.cumsum(size)))
        self.zero = np.array([np.searchsorted(t, 0.0) for t in self.thresholds], dtype=np.int64)
        self.count = int(self.offset[-1])
        self.feature = np.repeat(np.arange(len(size)), size)
        last = np.zeros(self.count, dtype=bool)
        last[self.offset[1:] - 1] = True
        self.splits = np.flatnonzero(~last)  # a split sends a bin and those before it to the left
        self.kind = np.uint16 if self.count < 65_535 else np.uint32

    def coded(self, row: np.ndarray, feature: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
        """One line per row: its bins, but for those of the value 0, filled up with ``count``."""
        order = np.argsort(feature, kind="stable")
        row, feature, value = row[order], feature[order], value[order]
        ends = np.searchsorted(feature, np.arange(len(self.thresholds) + 1))
        bin_of = np.empty(len(row), dtype=np.int64)
        for f in np.flatnonzero(np.diff(ends)).tolist():
            part = slice(ends[f], ends[f + 1])
            bin_of[part] = np.searchsorted(self.thresholds[f], value[part])
        some = bin_of != self.zero[feature]
        row, code = row[some], (self.offset[feature] + bin_of)[some]
        order = np.argsort(row, kind="stable")
        row, code = row[order], code[order]
        each = np.bincount(row, minlength=n)
        out = np.full((n, max(1, int(each.max(initial=0)))), self.count, dtype=self.kind)
        out[row, np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each)] = code
        return out

    def left(self, codes: np.ndarray, split: np.ndarray) -> np.ndarray:
        """Whether each row goes to the left at its split (a bin's number)."""
        f = self.feature[split]
        low, high = self.offset[f], self.offset[f + 1]
        has = (codes >= low[:, None]) & (codes < high[:, None])
        beyond = (has & (codes > split[:, None])).any(axis=1)
        return np.where(has.any(axis=1), ~beyond, low + self.zero[f] <= split)


def find_thresholds(values: np.ndarray, zeros: int) -> np.ndarray:
    """Thresholds of one feature from a sample, ``zeros`` of which are not in ``values``."""
    found, counts = np.unique(np.append(values, 0.0) if zeros else values, return_counts=True)
    if zeros:
        counts[np.searchsorted(found, 0.0)] += zeros - 1
    middle = (found[:-1] + found[1:]) / 2
    if len(middle) < MAX_BINS:
        return middle
    stride = counts.sum() / MAX_BINS
    ahead = np.cumsum(counts)
    chosen, target = [], stride
    for i in range(1, len(found)):
        if abs(ahead[i - 1] - target) < abs(ahead[i] - target):
            chosen.append(middle[i - 1])
            target += stride
    return np.array(chosen)


@dataclass
class Tree:
    """Nodes in arrays: the ``split`` (-1: a leaf), the number of the left child (the right one
    follows it), the ``value`` and the levels that may grow below it (``rest``)."""

    split: np.ndarray
    child: np.ndarray
    value: np.ndarray
    rest: np.ndarray

    @staticmethod
    def root(max_depth: int) -> Tree:
        return Tree(np.array([-1]), np.array([0]), np.zeros(1), np.array([max_depth]))

    def grow(self, nodes: np.ndarray, splits: np.ndarray) -> np.ndarray:
        """Split leaves; the numbers of the left children."""
        child = len(self.split) + 2 * np.arange(len(nodes))
        self.split[nodes], self.child[nodes] = splits, child
        more = 2 * len(nodes)
        self.split = np.append(self.split, np.full(more, -1))
        self.child = np.append(self.child, np.zeros(more, dtype=np.int64))
        self.value = np.append(self.value, np.zeros(more))
        self.rest = np.append(self.rest, np.repeat(self.rest[nodes] - 1, 2))
        return child

    def leaves(self, codes: np.ndarray, bins: Bins) -> np.ndarray:
        """The leaf that each row comes to."""
        at = np.zeros(len(codes), dtype=np.int64)
        rows = np.arange(len(codes))
        while len(rows := rows[self.split[at[rows]] >= 0]):
            node = at[rows]
            at[rows] = self.child[node] + ~bins.left(codes[rows], self.split[node])
        return at

    KINDS = ("<i4", "<i4", "<f8", "<i4")

    def to_bytes(self) -> list[bytes]:
        return [x.astype(k).tobytes() for x, k in zip((self.split, self.child, self.value, self.rest), self.KINDS, strict=True)]

    @staticmethod
    def from_bytes(parts: list[bytes]) -> Tree:
        return Tree(*(np.frombuffer(p, k).astype(k.replace("i4", "i8")) for p, k in zip(parts, Tree.KINDS, strict=True)))


def add_histogram(out: np.ndarray, node: np.ndarray, codes: np.ndarray, w: np.ndarray, wy: np.ndarray) -> None:
    """Add weights and weighted labels of rows to ``out[:, node, bin]``."""
    for at in range(0, len(node), PART_ROWS):
        part = slice(at, at + PART_ROWS)
        key = (codes[part] + (node[part] * out.shape[2])[:, None]).ravel()
        for k, x in enumerate((w, wy)):
            out[k] += np.bincount(key, np.repeat(x[part], codes.shape[1]), out[k].size).reshape(out.shape[1:])


def best_splits(hist: np.ndarray, w: np.ndarray, s: np.ndarray, bins: Bins, min_leaf: int) -> tuple[np.ndarray, np.ndarray]:
    """``(split, gain)`` of each node from its histograms (without the bins of 0) and sums."""
    sides = []
    for x, total in zip(hist, (w, s), strict=True):
        x = x[:, : bins.count]
        x[:, bins.offset[:-1] + bins.zero] = total[:, None] - np.add.reduceat(x, bins.offset[:-1], axis=1)
        # a feature's bins add up to the node's total
        sides.append(np.cumsum(x, axis=1)[:, bins.splits] - total[:, None] * bins.feature[bins.splits])
    wl, sl = sides
    wr, sr = w[:, None] - wl, s[:, None] - sl
    with np.errstate(divide="ignore", invalid="ignore"):
        score = np.where((wl > min_leaf - 0.5) & (wr > min_leaf - 0.5), sl * sl / wl + sr * sr / wr, -np.inf)
    best = score.argmax(axis=1) if score.shape[1] else np.zeros(len(w), dtype=np.int64)
    if not score.shape[1]:
        return best, np.full(len(w), -np.inf)
    return bins.splits[best], score[np.arange(len(w)), best] - s * s / w


def grow_below(tree: Tree, roots: np.ndarray, node: np.ndarray, codes: np.ndarray, y: np.ndarray, w: np.ndarray,
               bins: Bins, min_leaf: int, importance: np.ndarray) -> None:
    """Grow ``tree`` below its leaves ``roots``; ``node`` is the place among them of each row."""
    active, stride = roots, bins.count + 1
    rows = np.argsort(node, kind="stable")
    node = node[rows]
    while len(active):
        wr, yr = w[rows], y[rows]
        sums = [np.bincount(node, x, len(active)) for x in (wr, wr * yr, wr * yr * yr)]
        tree.value[active] = np.divide(sums[1], sums[0], out=np.zeros(len(active)), where=sums[0] > 0)
        spread = sums[2] - sums[1] * tree.value[active]
        open_ = (spread > GAIN * sums[2]) & (sums[0] >= 2 * min_leaf) & (tree.rest[active] > 0)
        keep, place = open_[node], np.cumsum(open_) - 1
        rows, node, active, wr, yr = rows[keep], place[node[keep]], active[open_], wr[keep], yr[keep]
        sums = [x[open_] for x in sums]
        if not len(active):
            return
        split, gain = np.zeros(len(active), dtype=np.int64), np.zeros(len(active))
        ends = np.searchsorted(node, np.arange(len(active) + 1))
        step = max(1, CELLS // stride)
        for a in range(0, len(active), step):
            b = min(len(active), a + step)
            part, hist = slice(ends[a], ends[b]), np.zeros((2, b - a, stride))
            add_histogram(hist, node[part] - a, codes[rows[part]], wr[part], wr[part] * yr[part])
            split[a:b], gain[a:b] = best_splits(hist, sums[0][a:b], sums[1][a:b], bins, min_leaf)
        ok = gain > GAIN * sums[2]
        np.add.at(importance, bins.feature[split[ok]], gain[ok])
        children = tree.grow(active[ok], split[ok])
        keep, place = ok[node], np.cumsum(ok) - 1
        rows, node = rows[keep], node[keep]
        right = np.empty(len(rows), dtype=bool)
        for at in range(0, len(rows), PART_ROWS):
            part = slice(at, at + PART_ROWS)
            right[part] = ~bins.left(codes[rows[part]], split[node[part]])
        node = 2 * place[node] + right
        active = np.column_stack((children, children + 1)).ravel()
        order = np.argsort(node, kind="stable")
        rows, node = rows[order], node[order]


def _entries(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, feature, value)`` of an array of unwrapped vectors, sparse and dense ones mixed."""
    kind = vectors.field("type").to_numpy(zero_copy_only=False)
    indices, values = vectors.field("indices"), vectors.field("values")
    each = pc.list_value_length(values).to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(each)), each)
    value = values.flatten().to_numpy(zero_copy_only=False)
    feature = np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each)  # of dense vectors
    sparse = (kind == 0)[row]
    feature[sparse] = indices.flatten().to_numpy(zero_copy_only=False)
    return row, feature, value


def _sampled_bins(vectors: DataFrame, rows: int, seed: int) -> Bins:
    """Thresholds from a sample of bounded rows."""
    sample = vectors if rows <= SAMPLE_ROWS else vectors.sample(fraction=min(1.0, 1.02 * SAMPLE_ROWS / rows), seed=seed)
    table = sample.toArrow()
    column = table.column(0).combine_chunks()
    row, feature, value = _entries(column)
    first = column[0].as_py()
    width = first["size"] if first["type"] == 0 else len(first["values"])
    order = np.argsort(feature, kind="stable")
    feature, value = feature[order], value[order]
    ends = np.searchsorted(feature, np.arange(width + 1))
    return Bins([find_thresholds(value[a:b], table.num_rows - (b - a)) for a, b in zip(ends[:-1], ends[1:], strict=True)])


def _blocks(df: DataFrame, bins, features: str, label: str | None, tag: str) -> DataFrame:
    """Written blocks of rows: number, lines and bins a line, ``codes``, labels (if any), and the
    other columns as an Arrow stream."""
    others = [c for c in df.columns if c != features]
    source = df.select(F.unwrap_udt(features).alias("__v"), *others)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = TaskContext.get().partitionId() << 20
        known = bins.value
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK_ROWS):
                batch = whole.slice(at, BLOCK_ROWS)
                codes = known.coded(*_entries(batch.column(0)), batch.num_rows)
                rest = b""
                if label is None:
                    kept = pa.RecordBatch.from_arrays(batch.columns[1:], others)
                    sink = pa.BufferOutputStream()
                    with pa.ipc.new_stream(sink, kept.schema) as writer:
                        writer.write_batch(kept)
                    rest = sink.getvalue().to_pybytes()
                y = b"" if label is None else batch.column(1 + others.index(label)).to_numpy(zero_copy_only=False).astype("<f8").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([made], pa.int64()), pa.array([batch.num_rows], pa.int64())]
                    + [pa.array([x], pa.binary()) for x in (codes.tobytes(), y, rest)],
                    ["block", "n", "codes", "y", "others"],
                )
                made += 1

    return written(bounded_batches(source).mapInArrow(run, "block bigint, n bigint, codes binary, y binary, others binary"), tag, maxRecordsPerFile=FILE_BLOCKS)


def _block(batch: pa.RecordBatch, row: int, bins: Bins) -> tuple[int, np.ndarray, np.ndarray]:
    number, n = batch.column("block")[row].as_py(), batch.column("n")[row].as_py()
    codes = np.frombuffer(batch.column("codes")[row].as_buffer(), bins.kind).reshape(n, -1)
    return number, codes, np.frombuffer(batch.column("y")[row].as_buffer(), "<f8")


def _weights(seed: int, tree: int, block: int, n: int) -> np.ndarray:
    return np.random.default_rng([seed, tree, block]).poisson(1.0, n).astype(float)


def _met(blocks: DataFrame, others: DataFrame, tasks: int) -> DataFrame:
    """Every block with every row of ``others``; a task has all or its share of the blocks, one by one."""
    return bounded_batches(blocks.coalesce(tasks).hint("shuffle_replicate_nl").crossJoin(others))


TREE = "tree int, split binary, child binary, value binary, rest binary, nodes array<bigint>"


def _dealt(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """A partition for each of the ``rows`` of TREE."""
    return spark.createDataFrame(spark.sparkContext.parallelize(rows, len(rows)), TREE)


def _row(tree: int, top: Tree, nodes: np.ndarray) -> tuple:
    return (tree, *map(bytearray, top.to_bytes()), [int(x) for x in nodes])


def _tree(batch: pa.RecordBatch, row: int) -> tuple[int, Tree, np.ndarray]:
    parts = [batch.column(c)[row].as_py() for c in ("split", "child", "value", "rest")]
    return batch.column("tree")[row].as_py(), Tree.from_bytes(parts), batch.column("nodes")[row].values.to_numpy()


def _tops(blocks: DataFrame, bins, trees: int, max_depth: int, min_leaf: int, seed: int, rows: int, limit: int):
    """The trees down to nodes of at most ``limit`` rows: ``(tops, sizes, importance)``; sizes are the
    weights of the leaves by tree and node."""
    spark = blocks.sparkSession
    tops = [Tree.root(max_depth) for _ in range(trees)]
    sizes = [{0: float(rows)} for _ in range(trees)]
    importance = np.zeros((trees, len(bins.value.thresholds)))
    large = {t: [0] for t in range(trees)} if rows > limit and max_depth else {}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, found = bins.value, {}
        for batch in batches:
            for row in range(batch.num_rows):
                number, codes, y = _block(batch, row, known)
                tree, top, nodes = _tree(batch, row)
                w = _weights(seed, tree, number, len(y))
                place = np.full(len(top.split), -1)
                place[nodes] = np.arange(len(nodes))
                node = place[top.leaves(codes, known)]
                some = np.flatnonzero((node >= 0) & (w > 0))
                hist, sums = found.setdefault(tree, (np.zeros((2, len(nodes), known.count + 1)), np.zeros((3, len(nodes)))))
                node, w, y = node[some], w[some], y[some]
                add_histogram(hist, node, codes[some], w, w * y)
                sums += [np.bincount(node, x, len(nodes)) for x in (w, w * y, w * y * y)]
        for tree, (hist, sums) in found.items():
            for k in range(sums.shape[1]):
                parts = [np.ascontiguousarray(x).tobytes() for x in (hist[:, k], sums[:, k])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([tree], pa.int32()), pa.array([k], pa.int32()), *[pa.array([p], pa.binary()) for p in parts]],
                    ["tree", "k", "hist", "sums"],
                )

    def choose(table: pa.Table) -> pa.Table:
        hist, sums = (sum(np.frombuffer(x, "<f8") for x in table[c].to_pylist()) for c in ("hist", "sums"))
        w, s, q = sums[:, None]
        split, gain = best_splits(hist.reshape(2, 1, -1).copy(), w, s, bins.value, min_leaf)
        hist = hist.reshape(2, -1)
        f = bins.value.feature[split[0]]
        low, high = bins.value.offset[f], bins.value.offset[f + 1]
        left = hist[0, low : split[0] + 1].sum()
        if low + bins.value.zero[f] <= split[0]:
            left += w[0] - hist[0, low:high].sum()
        ok = bool(gain[0] > GAIN * q[0])
        return pa.table({"tree": table["tree"][:1], "k": table["k"][:1], "ok": [ok], "split": split, "gain": gain, "left": [left], "w": w})

    while large:
        open_ = _dealt(spark, [_row(t, tops[t], np.array(nodes)) for t, nodes in large.items()])
        share = max(1, -(-4 * spark.sparkContext.defaultParallelism // len(large)))
        sums = _met(blocks, open_, share).mapInArrow(count, "tree int, k int, hist binary, sums binary")
        shape = "tree int, k int, ok boolean, split bigint, gain double, left double, w double"
        chosen = sums.groupBy("tree", "k").applyInArrow(choose, shape).collect()
        nodes_of, large = large, {}
        for r in sorted(chosen, key=lambda r: (r["tree"], r["k"])):
            tree, node = r["tree"], nodes_of[r["tree"]][r["k"]]
            if not r["ok"]:
                continue
            (child,) = tops[tree].grow(np.array([node]), np.array([r["split"]])).tolist()
            importance[tree, bins.value.feature[r["split"]]] += r["gain"]
            del sizes[tree][node]
            for own, weight in ((child, r["left"]), (child + 1, r["w"] - r["left"])):
                sizes[tree][own] = weight
                if weight > limit and tops[tree].rest[own] > 0:
                    large.setdefault(tree, []).append(own)
    return tops, sizes, importance


class _Writer:
    """Saves a forest as Spark's models are saved."""

    def __init__(self, forest: DeepForest):
        self.forest, self.mode = forest, "error"

    def overwrite(self) -> _Writer:
        self.mode = "overwrite"
        return self

    def save(self, path: str) -> None:
        own = self.forest
        facts = {
            "thresholds": [t.tolist() for t in own.bins.thresholds], "trees": own.numTrees, "features": own.features,
            "importances": own.featureImportances.toArray().tolist(),
        }
        facts = own.pieces.sparkSession.createDataFrame([(json.dumps(facts),)], "value string")
        facts.coalesce(1).write.mode(self.mode).text(f"{path}/forest")
        own.pieces.write.mode(self.mode).parquet(f"{path}/trees")


class DeepForest:
    """A grown forest: written pieces of trees, of which a row's values in all pieces add up."""

    def __init__(self, pieces: DataFrame, bins: Bins, trees: int, features: str, importance: np.ndarray):
        self.pieces, self.bins, self.numTrees, self.features = pieces, bins, trees, features
        self.featureImportances = DenseVector(importance)

    def write(self) -> _Writer:
        return _Writer(self)

    @staticmethod
    def load(spark: SparkSession, path: str) -> DeepForest:
        facts = json.loads(spark.read.text(f"{path}/forest").first().value)
        bins = Bins([np.array(t) for t in facts["thresholds"]])
        return DeepForest(spark.read.parquet(f"{path}/trees"), bins, facts["trees"], facts["features"], np.array(facts["importances"]))

    def transform(self, df: DataFrame) -> DataFrame:
        """The columns of ``df`` without the features, and ``prediction``."""
        shared = df.sparkSession.sparkContext.broadcast(self.bins)
        blocks = _blocks(df, shared, self.features, None, "forest-rows")
        trees = self.numTrees
        kept = df.drop(self.features).schema

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known, sums, others = shared.value, {}, {}
            for batch in batches:
                for row in range(batch.num_rows):
                    number, codes, _ = _block(batch, row, known)
                    tree = _tree(batch, row)[1]
                    if number not in sums:
                        sums[number] = np.zeros(len(codes))
                        others[number] = batch.column("others")[row].as_py()
                    sums[number] += tree.value[tree.leaves(codes, known)]
            for number, total in sums.items():
                rows = pa.ipc.open_stream(others[number]).read_all().combine_chunks().to_batches()[0]
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(total / trees)], [*rows.schema.names, "prediction"])

        # the pieces are read one by one for the blocks of a task
        pairs = self.pieces.coalesce(1).hint("shuffle_replicate_nl").crossJoin(blocks)
        return bounded_batches(pairs).mapInArrow(run, kept.add("prediction", "double"))


def fit(
    train: DataFrame, num_trees: int = 100, max_depth: int = 20, seed: int = 42, min_leaf: int = 1,
    features: str = "features", label: str = "label", task_bytes: int | None = None,
) -> DeepForest:
    """Grow a forest on ``train``: bootstrapped rows, all features in every split."""
    spark = train.sparkSession
    rows = train.count()
    bins = _sampled_bins(train.select(F.unwrap_udt(features)), rows, seed)
    shared = spark.sparkContext.broadcast(bins)
    blocks = _blocks(train.select(features, label), shared, features, label, "forest-train")
    width = blocks.agg(F.max(F.octet_length("codes") / F.col("n"))).first()[0]
    limit = max(1, int((task_bytes or TASK_BYTES) // (width + 40)))
    tops, sizes, importance = _tops(blocks, shared, num_trees, max_depth, min_leaf, seed, rows, limit)
    tasks = []
    for tree in range(num_trees):
        group, held = [], 0.0
        for node, size in sizes[tree].items():
            if group and held + size > limit:
                tasks.append(_row(tree, tops[tree], group))
                group, held = [], 0.0
            group, held = [*group, node], held + size
        tasks.append(_row(tree, tops[tree], group))

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held, met = shared.value, {}, {}
        for batch in batches:
            for row in range(batch.num_rows):
                number, codes, y = _block(batch, row, known)
                tree, top, nodes = _tree(batch, row)
                key = (tree, int(nodes[0]))
                met.setdefault(key, (top, nodes))
                w = _weights(seed, tree, number, len(y))
                place = np.full(len(top.split), -1)
                place[nodes] = np.arange(len(nodes))
                node = place[top.leaves(codes, known)]
                some = np.flatnonzero((node >= 0) & (w > 0))
                held.setdefault(key, []).append((node[some].astype(np.int32), codes[some], y[some], w[some].astype(np.float32)))
            del batch
        for key, (top, nodes) in met.items():
            parts = held.pop(key)
            node, y, w = (np.concatenate([p[i] for p in parts]) for i in (0, 2, 3))
            codes = np.full((len(y), max(p[1].shape[1] for p in parts)), known.count, dtype=known.kind)
            at = 0
            for _, part, _, _ in parts:
                codes[at : at + len(part), : part.shape[1]] = part
                at += len(part)
            del parts
            own = np.zeros(len(known.thresholds))
            top.value[:] = 0  # what comes to other leaves is answered by other pieces
            grow_below(top, nodes, node.astype(np.int64), codes, y, w.astype(float), known, min_leaf, own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([key[0]], pa.int32()), *[pa.array([x], pa.binary()) for x in top.to_bytes()],
                 pa.array([nodes], pa.list_(pa.int64())), pa.array([own], pa.list_(pa.float64()))],
                ["tree", "split", "child", "value", "rest", "nodes", "gains"],
            )

    pieces = written(_met(blocks, _dealt(spark, tasks), 1).mapInArrow(grow, TREE + ", gains array<double>"), "forest-trees", maxRecordsPerFile=FILE_TREES)
    gains = pieces.select("tree", F.posexplode("gains").alias("f", "g")).groupBy("tree", "f").agg(F.sum("g").alias("g"))
    for r in gains.where("g > 0").collect():
        importance[r["tree"], r["f"]] += r["g"]
    total = importance.sum(axis=1, keepdims=True)
    each = np.divide(importance, total, out=np.zeros_like(importance), where=total > 0).sum(axis=0)
    return DeepForest(pieces.drop("gains"), bins, num_trees, features, each / max(each.sum(), 1e-300))
