"""The dealt operators against brute force, the libraries or held-out labels, and their
edge cases: nulls, empty and very long texts, ties, repeated rows, empty tables, extra
columns with clashing names."""

import base64
import hashlib
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F

os.environ["TOKENIZERS_PARALLELISM"] = "false"

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, id string, score double, shard int, "
    "slot string, length string, n int, token string, h int, rank int"
)


@pytest.fixture(scope="module")
def rng():
    return random.Random(7)


def as_docs(spark, rows):
    """Rows of (doc_id, text[, lang]) with extra columns that clash with working names."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", None, None, "x", 0.5, 3, "s", "l", 1, "t", 2, 9) for r in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


WORDS = "the of and river stone winter garden letter copper signal harbor meadow thunder ribbon".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 400)) * (rng.random() < 0.4) for _ in range(n))


@pytest.fixture(scope="module")
def odd_rows(rng):
    long = prose(rng, 4000)
    return [
        (1, None), (2, ""), (3, "   "), (4, "\n\n"), (5, "one"), (6, "two words"), (7, long), (8, long), (8, long),
        (None, "no id here"), (None, None), (9, "é" * 3000), (10, "x" * 20000), (11, " lead and trail "),
        (12, "tab\tand  double  spaces \n next"), (13, "<|endoftext|> in <|endoftext|>text"), (14, "日本語 テキスト 🙂"),
        (15, "\x1c\x85 odd spaces"), (16, "a" * 5000),
    ]


def test_token_counts_equal_the_library(spark, odd_rows):
    from tokenizers import Tokenizer

    from staysift.llm.token_count import count_tokens

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    got = count_tokens(as_docs(spark, odd_rows), path).collect()
    want = Counter()
    for key, text in odd_rows:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        want[key, len((text or "").encode()), n, n > 512] += 1
    assert Counter(tuple(r) for r in got) == want


def test_round_trip_equals_tiktoken(spark, odd_rows):
    import tiktoken

    from staysift.llm.bpe_codec import decode, encode, round_trip_digest

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs = as_docs(spark, odd_rows)
    want = Counter()
    for key, text in odd_rows:
        ids = np.array(library.encode_ordinary(text or ""), dtype="<u4")
        want[key, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in round_trip_digest(docs, path).collect()) == want
    back = decode(encode(docs, path), path).collect()
    assert Counter((r[0], bytes(r[1])) for r in back) == Counter((k, (t or "").encode()) for k, t in odd_rows)


def test_tokenizers_on_random_text():
    """Units, heap counts and tree encodings against both libraries on mixed fragments."""
    import pyarrow as pa
    import tiktoken
    from tokenizers import Tokenizer

    from staysift.llm.bpe_codec import Codec
    from staysift.llm.common import gathered, text_units
    from staysift.llm.token_count import PairCounter

    rng = random.Random(3)
    parts = ["a", "the ", " ", "  ", "\n", " \n", "\t", "é", "ß", "'s", "'re", "123", " 12", "!!", "<|endoftext|>", "語",
             "\x1c", "\x85", "\xa0", " ", "ǅ", "½", "🙂", "́", "\r\n", "\x0b", "aaaaaaaaaaaaaaaaaaaaa"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    texts += ["ab" * 4000, "".join(rng.choice("abcdehinorst") for _ in range(5000))]
    json_path, rank_path = (public_tokenizers.path(p) for p in ("byte_bpe_50k.json", "byte_bpe_multi_50k.tiktoken"))
    units, codes, offsets = text_units(pa.array(texts))
    counter, codec = PairCounter(json_path), Codec(rank_path, public_tokenizers.PATTERN)
    each = np.array([counter.text(u) for u in units])
    library = Tokenizer.from_file(json_path)
    assert np.add.reduceat(each[codes], offsets[:-1]).tolist() == [
        len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)
    ]
    ids, bounds = gathered([codec.encode(u) if u else b"" for u in units], codes, offsets)
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    for text, a, b in zip(texts, bounds[:-1], bounds[1:], strict=True):
        assert ids[a:b].tolist() == other.encode_ordinary(text)
        assert codec.decode(ids[a:b]) == text.encode()
    # joining encodings of any two halves is encoding the whole
    for _ in range(200):
        data = "".join(rng.choice("abcdehinorst ") for _ in range(rng.randint(2, 60))).encode()
        cut = rng.randint(0, len(data))
        assert codec.join(codec.merge(data[:cut]), codec.merge(data[cut:])) == codec.merge(data)


def test_packing_plan_places_every_piece():
    from staysift.llm.packing import packing_plan

    rng = random.Random(0)
    for _ in range(200):
        capacity = rng.choice([1, 6, 10, 30, 100])
        histogram = {rng.randint(1, capacity): rng.randint(0, 50) for _ in range(rng.randint(0, 30))}
        placed, content = Counter(), {}
        for length, rank, count, first, each, offset in packing_plan(histogram, capacity):
            assert rank == placed[length]
            placed[length] += count
            for i in range(count):
                content.setdefault(first + i // each, []).append((offset + i % each * length, length))
        assert placed == Counter({n: c for n, c in histogram.items() if c})
        for rows in content.values():
            end = 0
            for offset, length in sorted(rows):
                assert offset == end
                end += length
            assert end <= capacity
        if content:
            total = sum(n * c for n, c in histogram.items())
            over_half = sum(c for n, c in histogram.items() if 2 * n > capacity)  # each needs a bin
            assert len(content) <= 1.5 * max(total / capacity, over_half) + 2
            large = [n for n, c in histogram.items() for _ in range(c) if 3 * n > capacity]
            for rows in content.values():
                assert sum(3 * n > capacity for _, n in rows) <= 2
            assert len(content) >= (len(large) + 1) // 2


def test_packing_cuts_and_fills(spark, odd_rows):
    from tokenizers import Tokenizer

    from staysift.llm.packing import pack

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    got = pack(as_docs(spark, odd_rows), path, 64, 2).toPandas()
    want = Counter()
    for key, text in odd_rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")
        start, stop, piece = 0, len(ids) % 64 or 64, 0
        while start < len(ids):
            want[key, piece, start, stop - start, zlib.crc32(ids[start:stop].tobytes())] += 1
            start, stop, piece = stop, stop + 64, piece + 1
    key = [None if pd.isna(k) else int(k) for k in got["doc_id"]]
    rest = got[["piece", "start", "length", "ids_crc32"]].itertuples(index=False)
    assert Counter((k, *map(int, r)) for k, r in zip(key, rest, strict=True)) == want
    got = got.sort_values(["sequence_id", "offset"])
    assert (got["offset"] == got.groupby("sequence_id")["length"].cumsum() - got["length"]).all()
    assert got.groupby("sequence_id")["length"].sum().max() <= 64
    assert got["sequence_id"].nunique() <= 1.1 * got["length"].sum() / 64 + 1


def test_shards_are_exact_and_mixed(spark, odd_rows):
    from staysift.llm.sharding import communication_matrix, draw_hypergeometric, shuffle_into_shards

    sizes, targets = [70, 0, 5, 25], [34, 33, 33]
    matrix = np.array(communication_matrix(sizes, targets, 1))
    assert matrix.sum(axis=1).tolist() == sizes and matrix.sum(axis=0).tolist() == targets
    draw = random.Random(5)
    draws = [draw_hypergeometric(draw, 30, 70, 20) for _ in range(20000)]
    assert abs(np.mean(draws) - 6) < 0.05 and abs(np.var(draws) - 20 * 0.3 * 0.7 * 80 / 99) < 0.15
    rows = odd_rows + [(i, f"row {i}") for i in range(100, 1100)]
    got = shuffle_into_shards(as_docs(spark, rows).withColumn("part", F.lit(1)), 7, rows_per_slice=50).toPandas()
    assert len(got) == len(rows) and got["shard"].nunique() == 7
    counts = got.groupby("shard")["slot"].agg(["count", "max", "nunique"])
    assert counts["count"].max() - counts["count"].min() <= 1
    assert ((counts["max"] + 1 == counts["count"]) & (counts["nunique"] == counts["count"])).all()
    neighbours = got[got["doc_id"] >= 100].sort_values("doc_id")["shard"].to_numpy()
    assert 0.05 < (neighbours[1:] == neighbours[:-1]).mean() < 0.25  # 1/7 when well mixed
    again = shuffle_into_shards(as_docs(spark, rows).limit(0), 7)
    assert again.count() == 0
    few = shuffle_into_shards(as_docs(spark, rows[:3]), 7).toPandas()
    assert sorted(few["slot"]) == [0, 0, 0] and few["shard"].nunique() == 3


def brute_components(rows, size, percent):
    sets, parent = {}, {}
    for key, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        k = min(size, len(words))
        sets[key, text] = frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) if words else frozenset()
        parent[key] = key

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    items = sorted((i for i in sets.items() if i[0][0] is not None), key=lambda i: i[0][0])
    for i, ((a, _), s) in enumerate(items):
        for (b, _), t in items[:i]:
            both = len(s & t)
            if both and 100 * both >= percent * (len(s) + len(t) - both):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {k: len(s) for k, s in sets.items()}, {k: find(k) for k in parent}


@pytest.mark.parametrize(("size", "percent"), [(3, 90), (5, 80)])
def test_jaccard_components_equal_brute_force(spark, odd_rows, size, percent, monkeypatch):
    from staysift.llm import ngram_join

    monkeypatch.setattr(ngram_join, "LIST_ROWS", 5)  # long lists are salted
    rng = random.Random(11)
    rows = list(odd_rows)
    for base in range(12):
        text = prose(rng, rng.choice([4, 12, 40, 120, 300])).split()
        for copy in range(12):
            words = list(text)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5])):
                words[rng.randrange(len(words))] = "edit" + str(rng.randint(0, 10**6))
            rows.append((1000 + base * 100 + copy, " ".join(words).upper() if copy == 3 else " ".join(words)))
    got = ngram_join.jaccard_components(as_docs(spark, rows), size, percent).collect()
    sizes, roots = brute_components(rows, size, percent)
    assert len(got) == len(rows)
    of = {}
    for key, text in rows:
        of.setdefault(key, set()).add(sizes[key, text])
    for r in got:
        assert r["n_shingles"] in of[r["doc_id"]]
        if r["doc_id"] is not None:
            assert r["component_id"] == roots[r["doc_id"]], r
    kept = ngram_join.keep_one_each(as_docs(spark, rows), size, percent)
    assert kept.columns == as_docs(spark, rows).columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(set(v for k, v in roots.items() if k is not None))
    assert ids.count(None) == 2
    empty = as_docs(spark, rows).limit(0)
    assert ngram_join.jaccard_components(empty).count() == 0


def test_components_of_a_chain(spark):
    from staysift.llm.ngram_join import components

    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 100)], "a bigint, b bigint")
    got = {r["id"]: r["root"] for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 101: 100}


def auc(score, y):
    ranks = pd.Series(score).rank().to_numpy()
    n1 = y.sum()
    return (ranks[y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(y) - n1))


def held_out_scores(spark, query, label, sf="/root/testdata/sf0.1"):
    from staysift.llm.queries import REGISTRY

    got = REGISTRY[query](spark, sf).toPandas()
    labels = pd.read_parquet(f"{sf}/labels.parquet")
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert got["score"].between(0, 1).all()
    own = got[got["held_out"]].merge(labels, on="doc_id")
    assert all(zlib.crc32(str(i).encode()) % 5 == 0 for i in own["doc_id"])
    return own["score"].to_numpy(), own["predicted"].to_numpy(), own[label].to_numpy()


def test_quality_on_held_out_labels(spark):
    score, predicted, y = held_out_scores(spark, "op9_crf_quality", "quality")
    assert auc(score, y) > 0.98
    assert (predicted == (score >= 0.3)).all() and (predicted == y).mean() > 0.97


def test_toxicity_on_held_out_labels(spark):
    score, predicted, y = held_out_scores(spark, "op8_compression_toxicity", "toxic")
    assert auc(score, y) > 0.88
    assert (predicted == (score >= 0.5)).all()
    assert y[predicted == 1].mean() > 0.7 and predicted[y == 0].mean() < 0.05


def test_classifiers_take_odd_rows(spark, odd_rows):
    from staysift.llm.quality_crf import fit_sample, keep_good, score_quality
    from staysift.llm.toxicity import score_toxicity

    bad = [(i, "BUY!! NOW!! $$$ ### " * 20) for i in range(100, 140)]
    good = [(i, "The river meets the stone in winter.\nA letter from the garden.") for i in range(200, 240)]
    docs = as_docs(spark, odd_rows + bad + good)
    label = [(i, 0, 1) for i, _ in bad] + [(i, 1, 0) for i, _ in good] + [(None, 1, 1), (1, None, None), (201, 1, 0)]
    labels = spark.createDataFrame(label, "doc_id bigint, quality int, toxic int")
    for out, low, high in ((score_quality(docs, labels), 110, 210), (score_toxicity(docs, labels), 210, 110)):
        got = out.toPandas()
        assert len(got) == len(odd_rows) + 80 and got["score"].between(0, 1).all()
        by = got.dropna().drop_duplicates("doc_id").set_index("doc_id")["score"]
        assert by[low] < by[high]
    model = fit_sample(docs, labels)
    kept = keep_good(docs, model)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} >= {i for i, _ in good}
    none = labels.limit(0)
    assert {r["score"] for r in score_quality(docs, none).collect()} == {0.5}
    assert {r["score"] for r in score_toxicity(docs, none).collect()} == {0.5}
    assert score_quality(docs.limit(0), labels, docs).count() == 0
    assert score_toxicity(docs.limit(0), labels, docs).count() == 0


def test_chain_marginals_equal_enumeration():
    from itertools import product

    from staysift.llm.quality_crf import marginals

    rng = np.random.default_rng(2)
    for n in (1, 2, 5):
        emission, t = rng.normal(size=n), rng.normal(size=(2, 2))
        weight, good = 0.0, np.zeros(n)
        for labels in product((0, 1), repeat=n):
            w = np.exp(sum(e for e, y in zip(emission, labels) if y) + sum(t[a, b] for a, b in zip(labels, labels[1:])))
            weight += w
            good += w * np.array(labels)
        assert np.allclose(marginals(emission.tolist(), t), good / weight)


def test_language_mixture(spark, odd_rows):
    from staysift.llm.language_id import fit_sample, identify_languages, keep_identified
    from staysift.llm.queries import REGISTRY

    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = REGISTRY["op5_language_mixture"](spark, sf).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    own = got[got["held_out"]]
    assert (own["lang_pred"] == own["lang"]).mean() > 0.98 and got["score"].between(0, 1).all()
    model = fit_sample(docs)
    sample = {r["lang"]: r["text"] for r in docs.where("length(text) > 1500").groupBy("lang").agg(F.min("text").alias("text")).collect()}
    mixed = sample["de"][:1200] + "\n" + sample["es"][:600]
    found = model.languages(mixed)
    assert set(found) == {"de", "es"} and found["de"] > found["es"] > 0.15
    # EM raises the likelihood to that of the best mixture on a grid
    from staysift.llm.language_id import trigram_bins

    bins, n = trigram_bins(mixed)
    pair = np.exp(model.log_p[bins])[:, [model.names.index("de"), model.names.index("es")]]
    share, reached = model.proportions(pair, n, rounds=500)
    grid = [float(n @ np.log(pair @ np.array([a, 1 - a]))) for a in np.linspace(0.01, 0.99, 99)]
    assert reached >= max(grid) - 0.05
    odd = as_docs(spark, odd_rows + [(70, "12 34 !!")])
    rows = identify_languages(odd, docs).collect()
    assert len(rows) == len(odd_rows) + 1
    for r in rows:
        text = dict((k, t) for k, t in odd_rows + [(70, "12 34 !!")] if k is not None).get(r["doc_id"])
        if r["doc_id"] is not None:
            assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in text or ""))
    kept = keep_identified(odd, model)
    assert kept.columns == odd.columns
    assert {1, 2, 3, 4, 70}.isdisjoint(r["doc_id"] for r in kept.collect())
    assert {r["lang_pred"] for r in identify_languages(odd, docs.limit(0)).collect()} == {"und"}
    assert identify_languages(odd.limit(0), docs).count() == 0


def test_neighbours(spark):
    from staysift.llm.ann import search

    rng = np.random.default_rng(4)
    x = rng.normal(size=(6000, 24)) * rng.uniform(0.5, 2, size=(6000, 1))
    x[3000:3400] = x[3000]  # one very common vector
    rows = [(i, v.tolist(), "x") for i, v in enumerate(x)]
    odd = [(9001, None), (9002, [0.0] * 24), (9003, [float("nan")] * 24), (9004, [None, *[1.0] * 23]),
           (9005, [float("inf"), *[1.0] * 23]), (None, [1.0] * 24), (9006, [1.0] * 5), (9007, [])]
    table = spark.createDataFrame(rows + [(*o, "y") for o in odd], "vec_id bigint, embedding array<double>, score string")
    got = search(table, table.where("vec_id % 20 = 0"), k=20, rows_per_block=1000, rows_per_bucket=500).toPandas()
    assert got["query_id"].nunique() == 300 and set(got.groupby("query_id").size()) == {20}
    hits = 0
    for q, own in got.groupby("query_id"):
        s = x @ x[q]
        s[q] = -np.inf
        assert np.allclose(own.sort_values("rank")["score"], s[own.sort_values("rank")["vec_id"]], atol=1e-9)
        hits += len(set(np.lexsort((np.arange(len(s)), -s))[:20]) & set(own["vec_id"]))
    assert hits / (300 * 20) >= 0.9
    few = spark.createDataFrame(rows[:5], "vec_id bigint, embedding array<double>, score string")
    got = search(few, few, k=20).toPandas()
    assert len(got) == 20 and set(got.groupby("query_id").size()) == {4}
    assert search(few.limit(1), few.limit(1)).count() == 0
    assert search(few.limit(0), few).count() == 0


def test_bm25_equals_brute_force(spark, odd_rows, monkeypatch):
    from staysift.llm import bm25

    monkeypatch.setattr(bm25, "SHARD_DOCS", 150)
    monkeypatch.setattr(bm25, "BLOCK_DOCS", 8)
    rng = random.Random(9)
    rows = [(i, prose(rng, rng.randint(1, 60))) for i in range(500, 1100)]
    rows += odd_rows + rows[:3] + [(2000 + i, "stone river") for i in range(30)]
    asked = [(1, "stone river winter"), (2, rows[5][1]), (3, "absentword"), (4, None), (5, ""), (None, "stone"), (6, prose(rng, 40))]
    docs = as_docs(spark, rows)
    queries = spark.createDataFrame([(*a, "x") for a in asked], "query_id bigint, text string, score string")
    got = bm25.search(bm25.build_index(docs), queries, k=10).toPandas()
    terms = [Counter(bm25._TERM.findall((t or "").lower())) for _, t in rows]
    mean = sum(sum(c.values()) for c in terms) / len(rows)
    df = Counter(w for c in terms for w in c)
    for key, text in asked:
        want = []
        for (doc, _), c in zip(rows, terms, strict=True):
            s = sum(
                np.log(1 + (len(rows) - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * 2.2
                / (c[w] + 1.2 * (0.25 + 0.75 * sum(c.values()) / mean))
                for w in set(bm25._TERM.findall((text or "").lower())) if w in c
            )
            if s > 0 and doc is not None:
                want.append((-round(s, 9), doc))
        want = sorted(want)[:10] if key is not None else []
        own = got[got["query_id"] == key].sort_values("rank") if key is not None else got[got["query_id"].isna()]
        assert [(-round(s, 9), d) for s, d in zip(own["score"], own["doc_id"], strict=True)] == want
    assert bm25.search(bm25.build_index(docs.limit(0)), queries).count() == 0
    assert bm25.search(bm25.build_index(docs), queries.limit(0)).count() == 0


def test_sample_scan_bounds():
    """The adaptive prefix asks for more matches only where postings are long."""
    from staysift.llm.ngram_join import MAX_MATCHES, choose_matches

    assert choose_matches(np.ones(20), 5) == 1
    assert choose_matches(np.full(20, 1000.0), 5) == MAX_MATCHES
    assert choose_matches(np.ones(5), 5) == 1
