"""Toxicity by compression distance.

Zstandard dictionaries are trained on ordinary and on toxic text (small and larger
ones: a small one holds only the surest words, a larger one rarer ones as well). A
window of a document is compressed with the ordinary dictionary alone and with a toxic
one added; the bytes that the latter saves measure how close the window is to toxic text. Window
savings, cut at thresholds, are calibrated to a probability on labelled documents that
took no part in the training of the dictionaries.

Toxic documents are mostly ordinary text, so the toxic dictionary is trained on what
is left of them without the words that ordinary documents use about as often.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from staysift.llm.common import remove_stored, stored, text_blocks
from staysift.llm.labelled import fit_logistic, labelled_rows, predict_logistic, with_prior

WINDOW = 96  # bytes, cut at a space where there is one in the window's second half
ORDINARY_BYTES, TOXIC_BYTES = 16_384, (512, 1_024, 2_048)  # dictionary sizes
THRESHOLDS = (0, 1, 2, 3, 5)  # bytes saved by a window
PIECE, PIECES = 256, 24  # training text of an ordinary document: bytes of a piece, most pieces
_WORD = re.compile(rb"[a-z\x80-\xff]+")


@dataclass
class ToxicityModel:
    ordinary: bytes
    toxic: list[bytes]
    logistic: tuple[np.ndarray, np.ndarray, np.ndarray] | None
    base_rate: float

    def compressors(self) -> list[zstandard.ZstdCompressor]:
        """With the ordinary dictionary, then with each toxic one added. The toxic part comes
        first: offsets into the ordinary part stay the same."""
        return [_compressor(t + self.ordinary) for t in (b"", *self.toxic)]

    def score(self, features: np.ndarray) -> np.ndarray:
        if self.logistic is None:
            return np.full(len(features), self.base_rate)
        return predict_logistic(self.logistic, features)


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    params = zstandard.ZstdCompressionParameters(
        format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_checksum=0, write_dict_id=0,
        strategy=zstandard.STRATEGY_LAZY, min_match=4, window_log=17, hash_log=15, chain_log=15, search_log=6,
        target_length=32,
    )
    if not content:
        return zstandard.ZstdCompressor(compression_params=params)
    known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    known.precompute_compress(compression_params=params)
    return zstandard.ZstdCompressor(dict_data=known, compression_params=params)


def windows(text: str) -> list[bytes]:
    """The whole lower-cased text as consecutive windows (one empty window if empty)."""
    data = text.lower().encode()
    out, at = [], 0
    while at < len(data):
        end = at + WINDOW
        if end < len(data):
            space = data.rfind(b" ", at + WINDOW // 2, end)
            end = space if space > 0 else end
        out.append(data[at:end])
        at = end
    return out or [b""]


def window_features(text: str, plain: zstandard.ZstdCompressor, *added: zstandard.ZstdCompressor) -> list[float]:
    parts = windows(text)
    alone = np.array([len(plain.compress(w)) for w in parts], dtype=float)
    out = [float(np.log(len(parts)))]
    for compressor in added:
        saved = alone - [len(compressor.compress(w)) for w in parts]
        top = np.sort(saved)[::-1][:3]
        out += [float(saved.mean()), float(top[0]), float(top.mean())]
        out += [float(np.maximum(saved - t, 0).mean()) for t in THRESHOLDS]
        out += [float(np.log1p((saved > t).sum())) for t in THRESHOLDS]
    return out


def _trained(size: int, samples: list[bytes]) -> bytes:
    """A dictionary's content; too little text to train on is its own dictionary."""
    cut = [s[i : i + PIECE] for s in samples for i in range(0, len(s), PIECE)]
    try:
        return zstandard.train_dictionary(size, cut).as_bytes()
    except zstandard.ZstdError:
        return b"".join(cut)[:size]


def spread(data: bytes) -> bytes:
    """Whole pieces of a text, evenly spread from its first to its last: all, up to ``PIECES``."""
    n = -(-len(data) // PIECE)
    if n <= PIECES:
        return data
    return b"".join(data[i * PIECE : (i + 1) * PIECE] for i in np.linspace(0, n - 1, PIECES).round().astype(int).tolist())


def fit_sample(rows: DataFrame, share: float) -> ToxicityModel:
    """Train the dictionaries on three in five of the documents ``rows`` (id, text, label),
    calibrate on the rest (to the ``share`` of toxic ones among all labelled).

    Tasks read the whole texts. The driver gets the ids and labels, the marked words of
    toxic documents, spread pieces of ordinary ones, and the features of calibration.
    """
    rows = stored(rows.select("id", "text", "label").repartition(16, "id"), "toxicity-sample")
    known = rows.select("id", "label").toPandas().sort_values("id")
    first = np.arange(len(known)) % 5 < 3
    toxic = known["label"].to_numpy(dtype=int)
    train = set(known["id"][first].tolist())
    n_toxic, n_plain = max(1, int(toxic[first].sum())), max(1, int((1 - toxic[first]).sum()))
    least = max(3, n_toxic // 200)

    def documents(batches: Iterator[pa.RecordBatch], wanted: bool) -> Iterator[tuple]:
        for block in text_blocks(batches, 1):
            for row in zip(*(c.to_pylist() for c in block.columns), strict=True):
                if (row[0] in train) == wanted:
                    yield row

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = (Counter(), Counter())
        for _, text, y in documents(batches, True):
            seen[y].update(set(_WORD.findall(text.lower().encode())))
        words = list(seen[0] | seen[1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(words, pa.binary()), *(pa.array([c[w] for w in words], pa.int64()) for c in seen)],
            ["word", "plain", "toxic"],
        )

    marked = {
        bytes(r["word"]): r["toxic"]
        for r in rows.mapInArrow(count, "word binary, plain bigint, toxic bigint")
        .groupBy("word").agg(F.sum("plain").alias("plain"), F.sum("toxic").alias("toxic"))
        .where((F.col("toxic") >= least) & (F.col("toxic") / n_toxic > 8 * (F.col("plain") + 0.5) / n_plain))
        .collect()
    }

    def taken(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, text, y in documents(batches, True):
            data = text.lower().encode()
            if y:
                # the commonest first: the same neighbours make the segments that training picks
                words = sorted({w for w in _WORD.findall(data) if w in marked}, key=lambda w: (-marked[w], w))
                data = b" " + b" ".join(words) + b" " if words else b""
            else:
                data = spread(data)
            yield pa.RecordBatch.from_arrays(
                [pa.array([key], id_type), pa.array([y], pa.int32()), pa.array([data], pa.binary())], ["id", "label", "data"]
            )

    kind = rows.schema["id"].dataType.simpleString()
    id_type = to_arrow_type(rows.schema["id"].dataType)
    parts = sorted(rows.mapInArrow(taken, f"id {kind}, label int, data binary").collect(), key=lambda r: r["id"])
    plain = [bytes(r["data"]) for r in parts if not r["label"]]
    left = [bytes(r["data"]) for r in parts if r["label"] and r["data"]]
    model = ToxicityModel(_trained(ORDINARY_BYTES, plain), [_trained(n, left) for n in TOXIC_BYTES], None, share)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = model.compressors()
        for key, text, y in documents(batches, False):
            yield pa.RecordBatch.from_arrays(
                [pa.array([key], id_type), pa.array([y], pa.int32()),
                 pa.array([window_features(text, *tools)], pa.list_(pa.float64()))], ["id", "label", "x"],
            )

    rest = toxic[~first]
    if len(rest) and 0 < rest.sum() < len(rest):
        parts = sorted(rows.mapInArrow(measured, f"id {kind}, label int, x array<double>").collect(), key=lambda r: r["id"])
        y = np.array([r["label"] for r in parts])
        model.logistic = with_prior(fit_logistic(np.array([r["x"] for r in parts]), y.astype(float)), y, share)
    remove_stored(rows)
    return model


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    training_docs: DataFrame | None = None,
    per_class: int = 3000,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Score every whole text of ``docs``: id, ``score`` (0 to 1), ``predicted`` (score >= 0.5).

    The model is fitted on at most ``per_class`` whole training documents of each class
    (see :func:`labelled_rows`). A NULL or empty text is
    scored as one empty window; without labels of both classes the score is the base rate
    of toxic ones (0.5 without any). NULL ids and repeated rows are kept; other columns are not
    read; an empty table gives no rows.
    """
    rows, share = labelled_rows(
        docs if training_docs is None else training_docs, labels, "toxic", per_class, id_col, text_col
    )
    model = fit_sample(rows, share)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = model.compressors()
        for block in text_blocks(batches, 1):
            features = [window_features(t or "", *tools) for t in block.column(1).to_pylist()]
            scores = model.score(np.array(features))
            yield pa.RecordBatch.from_arrays([block.column(0), pa.array(scores)], ["id", "score"])

    kind = source.schema["id"].dataType.simpleString()
    out = source.mapInArrow(run, f"id {kind}, score double")
    return out.select(F.col("id").alias(id_col), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
