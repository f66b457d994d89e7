"""Document quality from line labels: a linear-chain conditional random field.

Every line of a document is good or bad. A line's features are its own statistics and
those of its neighbours; transitions tie adjacent labels. Forward-backward gives each
line's marginal, and the length-weighted mean of the marginals, calibrated on the
training documents, is the document's score.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass
from math import exp, log, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staysift.llm.common import bounded_batches, rows_where, text_blocks
from staysift.llm.labelled import fit_logistic, labelled_rows, predict_logistic, with_prior

_UPPER = string.ascii_uppercase.encode()
_DIGIT = string.digits.encode()
_POINT = b".,;:'\"-?()"
_SIGN = bytes(set(string.punctuation.encode()) - set(_POINT))
_SPACE = string.whitespace.encode()


def line_statistics(lines: list[str]) -> np.ndarray:
    """Statistics of each line, all near 0 to 1: no row depends on lines outside the text."""
    rows = []
    seen: set[str] = set()
    for line in lines:
        data = line.encode()
        size = max(1, len(data) - _count(data, _SPACE))
        words = line.split()
        n = max(1, len(words))
        rows.append(
            (
                _count(data, _UPPER) / size,
                min(1.0, 4 * _count(data, _SIGN) / size),
                min(1.0, 4 * _count(data, _POINT) / size),
                _count(data, _DIGIT) / size,
                len(set(words)) / n if words else 0.0,
                log1p(len(words)) / 6,
                min(2.0, size / n / 8),
                sum(len(w) == 1 for w in words) / n,
                sum(len(w) <= 3 for w in words) / n,
                float(line in seen and bool(words)),
                float(data.rstrip()[-1:] in (b".", b"?", b"!", b":")),
                float(not words),
            )
        )
        seen.add(line)
    return np.array(rows)


def _count(data: bytes, kind: bytes) -> int:
    return len(data) - len(data.translate(None, kind))


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Features (a row per line: own statistics, both neighbours', the document's mean
    of repeated lines, position ends, a constant) and line lengths."""
    lines = text.split("\n")
    own = line_statistics(lines)
    none = np.zeros((1, own.shape[1]))
    before, after = np.vstack((none, own[:-1])), np.vstack((own[1:], none))
    ends = np.zeros((len(lines), 2))
    ends[0, 0] = ends[-1, 1] = 1
    x = np.hstack((own, before, after, ends, np.ones((len(lines), 1))))
    return x, np.array([len(line) for line in lines], dtype=float)


def marginals(emission: list[float], transition: np.ndarray) -> list[float]:
    """P(good) of each line by forward-backward. ``emission`` is each line's score of
    good less that of bad; ``transition[a][b]`` the score of label b after a."""
    t00, t01, t10, t11 = (exp(v) for v in transition.ravel())
    n = len(emission)
    forward = []
    a0 = a1 = 0.5
    for i, e in enumerate(emission):
        if i:
            a0, a1 = a0 * t00 + a1 * t10, a0 * t01 + a1 * t11
        g = exp(max(-30.0, min(30.0, e)))
        a1 *= g
        total = a0 + a1
        a0, a1 = a0 / total, a1 / total
        forward.append((a0, a1, g))
    out = [0.0] * n
    b0 = b1 = 1.0
    for i in range(n - 1, -1, -1):
        a0, a1, g = forward[i]
        p0, p1 = a0 * b0, a1 * b1
        out[i] = p1 / (p0 + p1)
        b0, b1 = t00 * b0 + t01 * g * b1, t10 * b0 + t11 * g * b1
        total = b0 + b1
        b0, b1 = b0 / total, b1 / total
    return out


@dataclass
class QualityModel:
    weights: np.ndarray | None
    transition: np.ndarray
    logistic: tuple[np.ndarray, np.ndarray, np.ndarray] | None
    base_rate: float

    def line_marginals(self, text: str) -> tuple[list[float], np.ndarray]:
        x, lengths = line_features(text)
        return marginals((x @ self.weights).tolist(), self.transition), lengths

    def raw(self, text: str) -> float:
        """Length-weighted mean of the lines' marginals, as log odds."""
        p, lengths = self.line_marginals(text)
        total = lengths.sum()
        mean = float(np.dot(p, lengths) / total) if total else float(np.mean(p))
        mean = min(1 - 1e-6, max(1e-6, mean))
        return log(mean / (1 - mean))

    def score(self, texts: list[str]) -> np.ndarray:
        if self.weights is None or self.logistic is None:
            return np.full(len(texts), self.base_rate)
        return predict_logistic(self.logistic, np.array([[self.raw(t)] for t in texts]))


def fit_chain(
    docs: list[np.ndarray], good: np.ndarray, rounds: int = 300, l2: float = 1e-3, rate: float = 0.1
) -> tuple[np.ndarray, np.ndarray]:
    """Maximum likelihood of the line labels (each line has its document's label) by
    full-batch gradient steps with adaptive rates; forward-backward runs over all documents
    at once, line by line. Returns emission weights and transition scores."""
    longest = max(len(d) for d in docs)
    n, k = len(docs), docs[0].shape[1]
    x = np.zeros((longest, n, k), dtype=np.float32)
    live = np.zeros((longest, n))
    for j, d in enumerate(docs):
        x[: len(d), j], live[: len(d), j] = d, 1
    w, t = np.zeros(k), np.zeros((2, 2))
    y = good.astype(float)
    lines, pairs = live.sum(), max(1.0, live[1:].sum())
    moment = [np.zeros(k + 4), np.zeros(k + 4)]
    for step in range(1, rounds + 1):
        g = np.exp(np.clip(x @ w, -30, 30))
        e = np.stack((np.ones_like(g), g), axis=-1)
        m = np.exp(t)
        alpha = np.empty_like(e)
        a = np.full((n, 2), 0.5)
        for i in range(longest):
            moved = (a @ m if i else a) * e[i]
            moved /= moved.sum(axis=1, keepdims=True)
            a = np.where(live[i][:, None] > 0, moved, a)
            alpha[i] = a
        b = np.ones((n, 2))
        expected_pairs = np.zeros((2, 2))
        p_good = np.empty((longest, n))
        for i in range(longest - 1, -1, -1):
            both = alpha[i] * b
            p_good[i] = both[:, 1] / both.sum(axis=1)
            if i:
                right = e[i] * b
                joint = alpha[i - 1][:, :, None] * m * right[:, None, :]
                joint /= joint.sum(axis=(1, 2), keepdims=True)
                expected_pairs += (joint * live[i][:, None, None]).sum(axis=0)
                back = right @ m.T
                back /= back.sum(axis=1, keepdims=True)
                b = np.where(live[i][:, None] > 0, back, b)
        own_pairs = live[1:].sum(axis=0)
        observed = np.diag([own_pairs[y == 0].sum(), own_pairs[y == 1].sum()])
        grad_w = np.tensordot(((y - p_good) * live).astype(np.float32), x, axes=2) / lines - l2 * w
        grad_t = (observed - expected_pairs) / pairs - l2 * t
        grad = np.concatenate((grad_w, grad_t.ravel()))
        moment[0] = 0.9 * moment[0] + 0.1 * grad
        moment[1] = 0.99 * moment[1] + 0.01 * grad**2
        move = rate * (moment[0] / (1 - 0.9**step)) / (np.sqrt(moment[1] / (1 - 0.99**step)) + 1e-8)
        w, t = w + move[:k], t + move[k:].reshape(2, 2)
    return w, t


def fit(texts: list[str], good: np.ndarray, share: float, chain_lines: int = 100) -> QualityModel:
    """Fit the chain, then the calibration of the document score (to the ``share`` of good
    documents among all labelled). All lines take part; a training document of more than
    ``chain_lines`` lines is several chains, so that only the transitions between these are not learnt."""
    if not len(good) or good.min() == good.max():
        return QualityModel(None, np.zeros((2, 2)), None, share)
    chains, of = [], []
    for text, label in zip(texts, good, strict=True):
        x = line_features(text)[0]
        for at in range(0, len(x), chain_lines):
            chains.append(x[at : at + chain_lines])
            of.append(label)
    weights, transition = fit_chain(chains, np.array(of))
    model = QualityModel(weights, transition, None, share)
    raw = np.array([[model.raw(t)] for t in texts])
    model.logistic = with_prior(fit_logistic(raw, good.astype(float), l2=1e-4), good, share)
    return model


def fit_sample(docs: DataFrame, labels: DataFrame, per_class: int = 600, id_col: str = "doc_id", text_col: str = "text") -> QualityModel:
    """Fit on a bounded sample of whole training documents (see :func:`labelled_rows`)."""
    rows, share = labelled_rows(bounded_batches(docs), labels, "quality", per_class, id_col, text_col)
    sample = rows.toPandas().sort_values("id").reset_index(drop=True)
    return fit(sample["text"].tolist(), sample["label"].to_numpy(dtype=int), share)


def keep_good(docs: DataFrame, model: QualityModel, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose score reaches ``threshold``: a map."""
    return rows_where(docs, text_col, lambda texts: model.score([t or "" for t in texts]) >= threshold)


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    training_docs: DataFrame | None = None,
    per_class: int = 600,
    threshold: float = 0.3,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Score every whole text of ``docs``: id, ``score`` (0 to 1), ``predicted``
    (``score >= threshold``).

    The model is fitted on at most ``per_class`` whole training documents of each class. A NULL or empty text is one empty line; without labels
    of both classes the score is the base rate (0.5 without any). NULL ids and repeated
    rows are kept; other columns are not read; an empty table gives no rows.
    """
    model = fit_sample(docs if training_docs is None else training_docs, labels, per_class, id_col, text_col)
    source = bounded_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, 1):
            scores = model.score([t or "" for t in block.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([block.column(0), pa.array(scores)], ["id", "score"])

    kind = source.schema["id"].dataType.simpleString()
    out = source.mapInArrow(run, f"id {kind}, score double")
    return out.select(
        F.col("id").alias(id_col), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
