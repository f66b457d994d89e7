"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from staysift.session import bounded_batches, ensure_checkpoint_dir


def stored(df: DataFrame, name: str, **options) -> DataFrame:
    """Write ``df`` as Parquet (with the writer's ``options``) into the shared scratch folder and
    read it back.

    Used where several jobs need the same rows: later jobs, and tasks retried after
    a lost executor, re-read the files instead of replaying what made them.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_stored(df: DataFrame) -> None:
    """Delete the scratch table that ``df`` (from :func:`stored`) reads."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


class BoundedCache:
    """Values by key for a bounded number of bytes: when the young generation is full it
    becomes the old one, and what is met again moves back to the young one."""

    ENTRY = 180  # bytes of an entry besides its key and value

    def __init__(self, max_bytes: int):
        self.max_bytes = max_bytes
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.size = 0

    def many(self, keys: list[str], make: Callable[[list[str]], list[bytes]]) -> list[bytes]:
        """The value of each key (distinct keys); ``make`` gives those of unknown keys."""
        values = list(map(self.young.get, keys))
        absent = [i for i, v in enumerate(values) if v is None]
        for i in absent:
            values[i] = self.old.get(keys[i])
        unknown = [i for i in absent if values[i] is None]
        for i, v in zip(unknown, make([keys[i] for i in unknown]), strict=True):
            values[i] = v
        for i in absent:
            self.size += self.ENTRY + 2 * len(keys[i]) + len(values[i])
            if self.size > self.max_bytes:
                self.young, self.old, self.size = {}, self.young, 0
            self.young[keys[i]] = values[i]
        return values


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column | str) -> Column:
    """True where crc32(doc_id as text) mod 5 is 0 (a NULL id counts as held out)."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(col.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def ranked_in_groups(
    df: DataFrame, groups: list[str], key: str, out: str, total: int, rows_per_slice: int = 100_000
) -> DataFrame:
    """0-based rank ``out`` of each row in its group (non-null columns ``groups``) in the
    order of ``key``, a uniform 64-bit hash column (ties in any order).

    No task sorts a whole group: the hash range is cut into equal slices, enough of them
    that a slice of all ``total`` rows is small, and slice counts give the offsets.
    """
    slices = max(1, -(-total // rows_per_slice))
    top = F.shiftrightunsigned(F.col(key), 33)  # 31 bits, non-negative
    cut = df.withColumn("__slice", F.shiftright(top * F.lit(slices).cast("long"), 31))
    by = [*groups, "__slice"]
    ahead = Window.partitionBy(*groups).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut.groupBy(*by).agg(F.count(F.lit(1)).alias("__n"))
    offsets = offsets.select(*by, F.coalesce(F.sum("__n").over(ahead), F.lit(0)).alias("__before"))
    inside = F.row_number().over(Window.partitionBy(*by).orderBy(key)) - 1
    ranked = cut.withColumn("__in", inside).join(offsets, by)
    return ranked.withColumn(out, (F.col("__in") + F.col("__before")).cast("long")).drop("__in", "__before", "__slice")


def text_blocks(batches: Iterator[pa.RecordBatch], text: int, max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches into slices of about ``max_bytes`` of text (one row at least)."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def rows_where(docs: DataFrame, text_col: str, decide: Callable[[list[str | None]], np.ndarray]) -> DataFrame:
    """The rows of ``docs``, all columns, whose text ``decide`` is true for. Only the text goes to
    the Python workers and one boolean comes back, so whole rows never leave the JVM."""

    def run(texts: pa.Array) -> pa.Array:
        blocks = text_blocks(iter([pa.RecordBatch.from_arrays([texts], ["text"])]), 0)
        return pa.concat_arrays([pa.array([], pa.bool_()), *[pa.array(decide(b.column(0).to_pylist()), pa.bool_()) for b in blocks]])

    chosen = F.arrow_udf(run, "boolean")
    return bounded_batches(docs).where(chosen(F.col(text_col).cast("string")))


# A space before white space, or at the end: the splitting pattern may then run a
# match across the space (fixed set: Unicode white space and the separators 1C-1F).
_JOINED_SPACES = (
    " [\\x09-\\x0d\\x1c-\\x20\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}"
    "\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]| $"
)


def text_units(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Cut texts (no nulls) before each single space into units whose split by the
    byte-level pattern does not depend on their neighbours.

    Where a space is followed by a non-space, the pattern always begins a match at
    that space and no match runs over it, so ``" word"`` can be split on its own. A
    text with other spaces is one unit. Returns the distinct units, the unit of each
    position (an index), and the position where each text begins (one more at the end).
    """
    texts = texts.cast(pa.string())
    joined = pc.match_substring_regex(texts, pattern=_JOINED_SPACES).to_numpy(zero_copy_only=False)
    lists = pc.split_pattern(texts, pattern=" ")
    offsets = lists.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    coded = lists.flatten().dictionary_encode()
    words = coded.dictionary.to_pylist()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    units = [" " + w for w in words]
    empty = len(units)
    units.append("")
    firsts: dict[str, int] = {}
    heads = codes[offsets[:-1]].tolist()
    for row, at in enumerate(offsets[:-1].tolist()):
        if joined[row]:
            codes[at : offsets[row + 1]] = empty
            codes[at] = len(units)
            units.append(texts[row].as_py())
        else:
            word = words[heads[row]]
            if word not in firsts:
                firsts[word] = len(units)
                units.append(word)
            codes[at] = firsts[word]
    return units, codes, offsets


def one_word(unit: str) -> bool:
    """Whether a unit is surely one match of the pattern: Latin letters, after a space
    or not (``isalpha`` is the letter categories, that is ``\\p{L}``)."""
    return unit[1:].isalpha() and (unit[0] == " " or unit[0].isalpha()) and max(unit) < "\u0250"


def gathered(values: list[bytes], codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenate the ids (little-endian unsigned 32-bit) of each position's unit;
    returns all ids and the first id's place of each text (one more at the end)."""
    flat = np.frombuffer(b"".join(values), dtype="<u4")
    sizes = np.fromiter(map(len, values), dtype=np.int64, count=len(values)) // 4
    begins = np.cumsum(sizes) - sizes
    each = sizes[codes]
    ends = np.cumsum(each)
    total = int(ends[-1]) if len(ends) else 0
    places = np.repeat(begins[codes] - (ends - each), each) + np.arange(total)
    bounds = np.concatenate(([0], ends))[offsets]
    return flat[places], bounds
