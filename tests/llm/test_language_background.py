"""Language identification: whole training texts, the background component, the chosen set."""

import itertools
import random

import numpy as np

from staysift.llm import language_id as L
from staysift.llm import quality_crf

SF = "/root/testdata/sf0.01"


def test_foreign_text_and_letter_noise_are_background(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = L.fit_sample(docs)
    rng = random.Random(1)
    noise = " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(200))
    polish = "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem. " * 3
    odd = spark.createDataFrame(
        [(-1, noise, "en", "s", 1), (-2, polish, "en", "s", 1), (-3, None, "en", "s", 1), (-4, "12 34", "en", "s", 1)], docs.schema
    )
    kept = {r["doc_id"] for r in L.keep_identified(docs.union(odd), model).select("doc_id").collect()}
    assert not kept & {-1, -2, -3, -4}
    assert len(kept) == docs.select("doc_id").distinct().count()  # clean documents stay
    found = L.identify_languages(odd, training_docs=docs).collect()
    assert all(r["lang_pred"] in model.names and r["score"] < 0.2 for r in found if r["doc_id"] in (-1, -2))


def test_training_reads_whole_texts(spark):
    """What tells the languages apart stands behind 30,000 equal characters."""
    rows = [(k, "zz " * 10_000 + ("alpha " if k % 2 else "omega ") * 40, "aa" if k % 2 else "oo", "s", 1) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars int")
    model = L.fit_sample(docs)
    assert model.predict("omega omega")[0] == "oo" and model.predict("alpha alpha")[0] == "aa"


def test_repeated_training_id_counts_once(spark):
    rows = [(1, "only once " * 5, "en")] * 500 + [(2, "zwei worte " * 5, "de"), (3, "drei worte " * 5, "de")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    sample = L.training_sample(docs, 100, "doc_id", "text", "lang")
    assert sample.where("lang = 'en'").count() <= 1


def test_chosen_set_against_all_subsets():
    """Forward choice finds the best penalised set among all subsets that hold a language."""
    rng = np.random.default_rng(5)
    texts = {"a": "kalo mira toso ", "b": "wuff grau blod ", "c": "xixi yoyo zuzu "}
    counts = {}
    for name, text in texts.items():
        counts[name] = np.zeros(L.BINS)
        bins, n = L.trigram_bins(text * 50)
        counts[name][bins] += n
    model = L.fit(counts, 4.0)
    for mix in (("a",), ("a", "b"), ("a", "b", "c"), ("b", "c")):
        words = [w for name in mix for w in texts[name].split() for _ in range(8)]
        rng.shuffle(words)
        bins, n = L.trigram_bins(" ".join(words))
        p, penalty = np.exp(model.log_p[bins]), 4.0 * np.log(n.sum())
        best = max(
            (s for k in range(1, 5) for s in itertools.combinations(range(4), k) if set(s) & {0, 1, 2}),
            key=lambda s: model.proportions(p[:, list(s)], n, 500)[1] - penalty * (len(s) - 1),
        )
        assert set(model.languages(" ".join(words))) == {model.names[k] for k in best if k < 3} == set(mix)


def test_quality_score_against_enumerated_labels():
    """The document score from all label sequences of the lines, weighted by their lengths."""
    rng = np.random.default_rng(2)
    texts = ["Good line here.\n$$ %% 12 ##\n\nAnother fine line of words.", "x\n\ny ; z", "one"]
    k = quality_crf.line_features(texts[0])[0].shape[1]
    model = quality_crf.QualityModel(rng.normal(size=k), rng.normal(size=(2, 2)), None, 0.5)
    for text in texts:
        x, lengths = quality_crf.line_features(text)
        e = x @ model.weights
        total, good = 0.0, np.zeros(len(e))
        for labels in itertools.product((0, 1), repeat=len(e)):
            score = sum(v for v, y in zip(e, labels, strict=True) if y) + sum(model.transition[a][b] for a, b in itertools.pairwise(labels))
            total += np.exp(score)
            good += np.exp(score) * np.array(labels)
        mean = float(good / total @ lengths / lengths.sum())
        assert np.isclose(model.raw(text), np.log(mean / (1 - mean)))


def test_long_training_documents_are_whole_chains():
    lines = ["A good line of words number seven."] * 250 + ["$$$$ 1111 ####"] * 250
    texts = ["\n".join(lines[:250]), "\n".join(lines[250:])] * 3
    model = quality_crf.fit(texts, np.array([1, 0] * 3), 0.5, chain_lines=100)
    good, bad = model.score(["A good line of words number nine.", "%%%% 2222 $$$$"])
    assert good > 0.7 and bad < 0.3
