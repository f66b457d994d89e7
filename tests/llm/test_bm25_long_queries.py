"""BM25 of long or many queries: block-wise scoring against the pruned search and brute force."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import DataFrame

from staysift.llm import bm25


def texts(rng, n, longest):
    words = [f"w{i}" for i in range(400)]
    weights = [1 / (i + 1) for i in range(400)]
    return [" ".join(rng.choices(words, weights, k=rng.randint(0, longest))) for _ in range(n)]


@pytest.mark.parametrize("share", [0.0, 0.05, 2.0])
def test_long_search_equals_pruned_search(monkeypatch, share):
    monkeypatch.setattr(bm25, "DENSE_SHARE", share)
    monkeypatch.setattr(bm25, "TILE_QUERIES", 7)
    rng = random.Random(3)
    rows = texts(rng, 900, 120)
    rows += rows[:40] + ["w1 w2 " * 30] * 25 + ["only here", ""]
    counts = [bm25.term_counts(t) for t in rows]
    shard = bm25.Shard.from_bytes(bm25.Shard.build(counts).to_bytes())
    ids = np.array(rng.sample(range(10_000), len(rows)))
    known = np.array([rng.random() > 0.05 for _ in rows])
    terms = np.unique(np.concatenate([c[0] for c in counts] + [np.array([1, 2], np.uint64)]))
    df = np.zeros(len(terms))
    for h, _ in counts:
        df[np.searchsorted(terms, h)] += 1
    idf = np.log(1 + (len(rows) - df + 0.5) / (df + 0.5))
    asked = {i: np.searchsorted(terms, h) for i, (h, _) in enumerate(counts) if i % 5 == 0 and len(h)}
    asked[5000] = np.append(asked[0], np.searchsorted(terms, np.array([1, 2], np.uint64)))  # two absent terms
    mean = float(shard.lengths.mean())
    found = {i: (docs, scores) for i, docs, scores in shard.search_long(terms, idf, asked, mean, 10, ids, known)}
    assert found.keys() == asked.keys()
    for i, places in asked.items():
        docs, scores = shard.search(terms[places], idf[places], mean, 10 + int((~known).sum()), ids)
        docs, scores = docs[known[docs]], scores[known[docs]]
        order = np.lexsort((ids[docs], -scores.round(9)))[:10]  # other sums of equal scores differ in the last bits
        assert found[i][0].tolist() == docs[order].tolist()
        assert np.allclose(found[i][1], scores[order], rtol=0, atol=1e-9)


def test_many_queries_stay_off_the_driver(spark, monkeypatch):
    """Several blocks of queries against several shards, no query or term collected."""
    rng = random.Random(5)
    rows = list(enumerate(texts(rng, 300, 150))) + [(None, "w1 w2 w3"), (7, "w9 w9 w3"), (900, None)]
    rows += [(1000 + i, rows[3][1]) for i in range(15)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    monkeypatch.setattr(bm25, "SHARD_DOCS", 40)
    monkeypatch.setattr(bm25, "BLOCK_QUERIES", 16)
    monkeypatch.setattr(bm25, "LONG_TERMS", 20)
    index = bm25.build_index(docs)
    queries = docs.where("doc_id % 4 = 0 OR doc_id IS NULL").selectExpr("doc_id AS query_id", "text")

    def refuse(*_):
        raise AssertionError("the queries are collected")

    with monkeypatch.context() as m:
        m.setattr(DataFrame, "toPandas", refuse)
        m.setattr(DataFrame, "collect", refuse)
        found = bm25.search(index, queries, k=6)
    got = {}
    for r in found.orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["doc_id"], r["score"]))
    counts = [Counter((t or "").split()) for _, t in rows]
    mean = sum(sum(c.values()) for c in counts) / len(rows)
    df = Counter(w for c in counts for w in c)
    asked = {d: t for d, t in rows if d is not None and d % 4 == 0 and t}
    assert got.keys() == asked.keys()
    for q, text in asked.items():
        scores = []
        for (d, _), c in zip(rows, counts, strict=True):
            norm = 1.2 * (0.25 + 0.75 * sum(c.values()) / mean)
            s = sum(np.log(1 + (len(rows) - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * 2.2 / (c[w] + norm) for w in set(text.split()) if w in c)
            if s > 0 and d is not None:
                scores.append((-round(s, 9), d))
        want = sorted(scores)[:6]
        assert [r for r, _, _ in got[q]] == list(range(1, len(want) + 1))
        assert [d for _, d, _ in got[q]] == [d for _, d in want]
        assert np.allclose([s for _, _, s in got[q]], [-s for s, _ in want], rtol=0, atol=1e-8)


def test_a_task_gives_the_best_of_all_its_shards(spark, monkeypatch):
    """Rows out of the search and files read at once do not grow with the shards."""
    rng = random.Random(9)
    docs = spark.createDataFrame(list(enumerate(texts(rng, 400, 60))), "doc_id bigint, text string").repartition(2)
    monkeypatch.setattr(bm25, "SHARD_DOCS", 5)
    index = bm25.build_index(docs)
    assert index.count() == len(index.inputFiles()) == 80
    queries = docs.where("doc_id % 10 = 0").selectExpr("doc_id AS query_id", "text")
    want = sorted(tuple(r) for r in bm25.search(index, queries, k=4).collect())
    monkeypatch.setattr(bm25, "TASK_SHARDS", 1)
    assert sorted(tuple(r) for r in bm25.search(index, queries, k=4).collect()) == want
    found = [np.array([1, 1, 0, 1, 0]), np.array([5, 3, 9, 4, 8]), np.array([1.0, 1.0, 2.0, 3.0, 2.0])]
    assert [c.tolist() for c in bm25._best(found, 2)] == [[0, 0, 1, 1], [8, 9, 4, 3], [2.0, 2.0, 3.0, 1.0]]


def test_shards_are_stored_in_few_bytes():
    """Every array comes back, whatever its greatest value needs."""
    rng = random.Random(4)
    for rows in ([], [""], ["a"], texts(rng, 300, 90), ["w " * 70_000, "w x", *texts(rng, 200, 9)]):
        counts = [bm25.term_counts(t) for t in rows] or [bm25.term_counts("")]
        made = bm25.Shard.build(counts)
        parts = made.to_bytes()
        back = bm25.Shard.from_bytes(parts)
        for name in made.__dataclass_fields__:
            assert np.array_equal(getattr(made, name), getattr(back, name)), name
    assert len(parts[2]) <= 2 * len(made.docs)
