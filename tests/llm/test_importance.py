"""Importance resampling against a brute-force version."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from staysift.llm import importance

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text):
    words = WORD.findall((text or "").translate(LOWER))
    runs = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return words, [zlib.crc32(r.encode()) % 10_000 for r in runs]


def brute(docs, target):
    """The contract, read literally: rows of (doc_id, n_features, weight, score, rank)."""
    read = [(k, *features(t)) for k, t in docs]
    s, t = Counter(b for _, _, f in read for b in f), Counter(b for x in target for b in features(x)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [
        math.floor(1000 * math.log((t[b] + 1) * (big_s + 10_000) / ((s[b] + 1) * (big_t + 10_000)))) for b in range(10_000)
    ]
    rows = []
    for k, words, found in read:
        weight = sum(gain[b] for b in found)
        h = int(hashlib.sha256(f"42:{'' if k is None else k}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([k, len(found), weight, score, None, len(words) >= 20])
    able = sorted((r for r in rows if r[5]), key=lambda r: (-r[3], r[0] is None, r[0]))
    for rank, r in enumerate(able[: 5 * len(able) // 100], start=1):
        r[4] = rank
    return Counter(tuple(r[:5]) for r in rows)


def prose(rng, n):
    words = "The of AND river Stone winter garden letter copper été straße 語語 signal x1 42".split()
    return rng.choice([" ", ", ", "\n", "--"]).join(rng.choice(words) + rng.choice(["", "s", "ed"]) for _ in range(n))


def test_equals_brute_force(spark):
    rng = random.Random(5)
    docs = [(k, prose(rng, rng.randint(0, 120))) for k in range(400)]
    docs += [(1000, None), (1001, ""), (1002, "\x00 \x7f--"), (1003, "w" * 5000 + " end " + "é" * 900), (1004, prose(rng, 30_000))]
    docs += [(None, prose(rng, 50)), (None, None)] + [(2000 + k, docs[7][1]) for k in range(30)]
    target = [prose(rng, 60).replace("river", "harbor") for _ in range(20)] + [None, ""]
    full = [(k, t, 1, 2, "w", 3) for k, t in docs]
    frame = spark.createDataFrame(full, "doc_id bigint, text string, rank int, n_words int, weight string, row int").repartition(3)
    wanted = spark.createDataFrame([(t, 1) for t in target], "text string, id int")
    got = importance.resample(frame, wanted)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert {t.dataType.simpleString() for t in got.schema} == {"bigint"}
    assert Counter(tuple(r) for r in got.collect()) == brute(docs, target)
    assert importance.resample(frame.limit(0), wanted).count() == 0
    nothing = importance.resample(frame.where("doc_id < 10"), wanted.limit(0))
    assert Counter(tuple(r) for r in nothing.collect()) == brute(docs[:10], [])


def test_whole_table_equals_brute_force(spark):
    from staysift.llm.queries import REGISTRY

    sf = "/root/testdata/sf0.01"
    docs = pd.read_parquet(f"{sf}/documents.parquet")
    docs = [(int(k), t) for k, t in zip(docs["doc_id"], docs["text"], strict=True)]
    target = pd.read_parquet(f"{sf}/benchmark.parquet")["text"].tolist()
    got = REGISTRY["op13_importance_resampling"](spark, sf).collect()
    assert Counter(tuple(r) for r in got) == brute(docs, target)


def test_long_texts_in_parts(monkeypatch):
    rng = random.Random(2)
    texts = [prose(rng, 700), None, prose(rng, 5), "", prose(rng, 300), "x" * 400]
    whole = [Counter(features(t)[1]) for t in texts]
    for size in (40, 333, 1 << 20):
        monkeypatch.setattr(importance, "BLOCK_BYTES", size)
        found = [Counter() for _ in texts]
        words = np.zeros(len(texts), dtype=int)
        for rows, buckets, word_rows in importance._feature_parts(texts, 10_000):
            for r, b in zip(rows.tolist(), buckets.tolist(), strict=True):
                found[r][b] += 1
            words += np.bincount(word_rows, minlength=len(texts))
        assert found == whole
        assert words.tolist() == [len(features(t)[0]) for t in texts]


def test_checksums_of_joined_strings():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 7, 255, 256, 257, 5000):
        a, b = rng.bytes(9), rng.bytes(n)
        joined = importance.shifted(np.array([zlib.crc32(a)], dtype=np.uint32), np.array([n])) ^ np.uint32(zlib.crc32(b))
        assert joined[0] == zlib.crc32(a + b)


@pytest.mark.parametrize("wanted", [1, 2, 29, 30, 31, 57, 90, 99, 100])
def test_draw_among_ties(spark, monkeypatch, wanted):
    """Scores tied in groups, ids repeated and NULL: the draw has exact size and order."""
    monkeypatch.setattr(importance, "RANGE_ROWS", 20)
    monkeypatch.setattr(importance, "PROBES", 3)
    rows = [(None if k % 13 == 0 else k % 40 - 5, [-(10**9), 5, 5, 10**12][k % 4], k) for k in range(100)]
    frame = spark.createDataFrame(rows, "id bigint, score bigint, row bigint").repartition(4)
    ranked, drawn = importance.draw_highest(frame, wanted)
    want = sorted(rows, key=lambda r: (-r[1], r[0] is None, r[0] or 0, r[2]))[:wanted]
    got = ranked.orderBy("rank").collect()
    assert [(r["id"], r["score"], r["row"], r["rank"]) for r in got] == [(*r, i) for i, r in enumerate(want, start=1)]
    assert frame.where(drawn).count() == wanted
    assert frame.where(~F.coalesce(drawn, F.lit(False))).count() == 100 - wanted
