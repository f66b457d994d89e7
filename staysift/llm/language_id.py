"""Language identification as a mixture: which languages a text holds, and how much of each.

Every language has likelihoods of byte trigrams (hashed to a fixed number of bins).
Expectation-maximisation estimates the proportions of the languages in a document; the
set of languages is then chosen forward, from the single most likely language on, by
penalised likelihood: a language joins if it raises the log-likelihood by more than the
penalty. A background component, flatter than any language, takes the text that belongs to none:
other languages and letter noise lower the share of the languages that are known.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staysift.llm.common import bounded_batches, held_out, rows_where, text_blocks

BINS = 1 << 16
MAX_LANGUAGES = 1000  # of the training rows; more is an error, not a cut
UNDETERMINED = "und"

# bytes that are no letters count as spaces; bytes from 128 on belong to letters
_LETTERS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def trigram_bins(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Bins of the text's byte trigrams and how often each occurs. The lower-cased text is
    read as bytes between two spaces; trigrams with a run of spaces are left out."""
    data = np.frombuffer((" " + text.lower() + " ").encode().translate(_LETTERS), dtype=np.uint8).astype(np.uint32)
    if len(data) < 3:
        return np.empty(0, np.int64), np.empty(0)
    a, b, c = data[:-2], data[1:-1], data[2:]
    keep = ~((b == 32) & ((a == 32) | (c == 32)))
    code = ((a << 16 | b << 8 | c)[keep] * np.uint32(2654435761)) >> np.uint32(16)
    counts = np.bincount(code, minlength=BINS)
    found = np.flatnonzero(counts)
    return found, counts[found].astype(float)


@dataclass
class LanguageModel:
    names: list[str]
    log_p: np.ndarray  # bins x languages, then the background
    penalty: float
    p: np.ndarray | None = None

    def proportions(self, p: np.ndarray, n: np.ndarray, rounds: int = 40) -> tuple[np.ndarray, float]:
        """EM: the languages' proportions and the log-likelihood they reach."""
        total = n.sum()
        share = np.full(p.shape[1], 1 / p.shape[1])
        for _ in range(rounds):
            mix = p @ share
            new = share * ((n / mix) @ p) / total
            done = np.abs(new - share).max() < 1e-4
            share = new
            if done:
                break
        return share, float(n @ np.log(p @ share))

    def languages(self, text: str) -> dict[str, float]:
        """The text's languages with their proportions (empty: no letter, or no model); what is
        left of 1 is background."""
        if not self.names or not any(c.isalpha() for c in text):
            return {}
        bins, n = trigram_bins(text)
        if not len(bins):
            return {}
        if self.p is None:
            self.p = np.exp(self.log_p)
        p = self.p[bins]
        full, _ = self.proportions(p, n)
        alone = n @ self.log_p[bins]
        chosen = [int(alone[: len(self.names)].argmax())]
        share, best = np.ones(1), float(alone[chosen[0]])
        penalty = self.penalty * np.log(max(2.0, n.sum()))
        for other in np.argsort(-full, kind="stable").tolist():
            if other in chosen:
                continue
            tried, reached = self.proportions(p[:, [*chosen, other]], n)
            if reached - best <= penalty:
                break
            chosen, share, best = [*chosen, other], tried, reached
        found = sorted(zip(chosen, share, strict=True), key=lambda x: (-x[1], x[0]))
        return {self.names[k]: float(s) for k, s in found if k < len(self.names)}

    def predict(self, text: str | None) -> tuple[str, float, list[str]]:
        found = self.languages(text or "")
        if not found:
            return UNDETERMINED, 0.0, []
        first = next(iter(found))
        return first, min(1.0, max(0.0, found[first])), list(found)


def training_sample(docs: DataFrame, sample_docs: int, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """About ``sample_docs`` training documents, spread evenly over the languages (a
    language with fewer gives all it has): rows of ``lang`` and whole ``text``. Held-out ids
    and NULL texts or languages take no part; a repeated id counts once, by its least text."""
    known = docs.select(
        F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")
    ).where(~held_out("id") & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages in {lang_col}")
    each = max(1, sample_docs // max(1, len(sizes)))
    # a document is taken where its id's hash, as a share of its range, is below the rate
    share = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / float(1 << 30)
    rate = F.lit(0.0)
    for r in sizes:
        rate = F.when(F.col("lang") == r["lang"], F.lit(min(1.0, 1.2 * each / r["n"]))).otherwise(rate)
    return known.where(share < rate).groupBy("id", "lang").agg(F.min("text").alias("text")).select("lang", "text")


def count_trigrams(sample: DataFrame) -> dict[str, np.ndarray]:
    """Bin counts of each language over whole texts, counted in the tasks; the numbers that
    reach the driver are at most the bins of each language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for block in text_blocks(batches, 1):
            for lang, text in zip(block.column(0).to_pylist(), block.column(1).to_pylist(), strict=True):
                bins, n = trigram_bins(text)
                totals.setdefault(lang, np.zeros(BINS))[bins] += n
        for lang, counts in totals.items():
            met = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(met), pa.string()), pa.array(met.astype(np.int32)), pa.array(counts[met])], ["lang", "bin", "n"]
            )

    counted = sample.select("lang", "text").mapInArrow(run, "lang string, bin int, n double")
    found: dict[str, np.ndarray] = {}
    for lang, rows in counted.groupBy("lang", "bin").agg(F.sum("n").alias("n")).toPandas().groupby("lang"):
        found[lang] = np.zeros(BINS)
        found[lang][rows["bin"].to_numpy()] = rows["n"].to_numpy()
    return found


def fit(found: dict[str, np.ndarray], penalty: float) -> LanguageModel:
    """Likelihoods from each language's bin counts. The background spreads the square roots of
    the counts of all languages together: common trigrams stay commoner, none is rare."""
    names = sorted(found)
    if not names:
        return LanguageModel([], np.zeros((BINS, 1), dtype=np.float32), penalty)
    smooth = np.column_stack([found[n] + 0.1 for n in names] + [np.sqrt(sum(found.values()) + 1)])
    return LanguageModel(names, np.log(smooth / smooth.sum(axis=0)).astype(np.float32), penalty)


def fit_sample(
    docs: DataFrame,
    sample_docs: int = 4000,
    penalty: float = 4.0,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> LanguageModel:
    """Fit on a bounded sample of training documents (see :func:`training_sample`)."""
    sample = training_sample(bounded_batches(docs), sample_docs, id_col, text_col, lang_col)
    return fit(count_trigrams(sample), penalty)


def keep_identified(docs: DataFrame, model: LanguageModel, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, of which one language makes up at least the
    share ``least``: a map. Rows without a determinable language, and those that are mostly
    background, go."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def identified(texts: list[str | None]) -> np.ndarray:
        found = [shared.value.predict(t) for t in texts]
        return np.array([lang != UNDETERMINED and score >= least for lang, score, _ in found], dtype=bool)

    return rows_where(docs, text_col, identified)


def identify_languages(
    docs: DataFrame,
    training_docs: DataFrame | None = None,
    sample_docs: int = 4000,
    penalty: float = 4.0,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """The languages of every whole text: id, ``lang_pred`` (the largest proportion),
    ``score`` (that proportion, 0 to 1), ``languages`` (the chosen set, largest first).

    The model is fitted on about ``sample_docs`` whole training documents. A text that fits no
    language well still gets the likeliest one, with a low score. A NULL text, one without a letter, or any text when there is nothing
    to learn from is ``und`` with score 0. NULL ids and repeated rows are kept; other columns
    are not read; an empty table gives no rows.
    """
    model = fit_sample(
        docs if training_docs is None else training_docs, sample_docs, penalty, id_col, text_col, lang_col
    )
    shared = docs.sparkSession.sparkContext.broadcast(model)
    source = bounded_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for block in text_blocks(batches, 1):
            found = [known.predict(t) for t in block.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    block.column(0),
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                    pa.array([f[2] for f in found], pa.list_(pa.string())),
                ],
                ["id", "lang_pred", "score", "languages"],
            )

    kind = source.schema["id"].dataType.simpleString()
    out = source.mapInArrow(run, f"id {kind}, lang_pred string, score double, languages array<string>")
    return out.withColumnRenamed("id", id_col)
