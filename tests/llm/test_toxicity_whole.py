"""Training and calibration of the toxicity score read whole texts."""

import random
import zlib

from staysift.llm import toxicity


def test_passages_behind_a_long_beginning_are_learned(spark):
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(3, 9))) for _ in range(400)]
    nasty = ["".join(rng.choices("qrstuvwxyz", k=8)) for _ in range(12)]
    rows = []
    for i in range(240):
        text = " ".join(rng.choices(words, k=1200))
        assert len(text) > 6000
        rows.append((i, text + " " + " ".join(rng.choices(nasty if i % 2 else words, k=80)), i % 2))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id bigint, toxic int")
    score = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(docs, labels).collect()}
    held = [i for i in score if zlib.crc32(str(i).encode()) % 5 == 0]
    toxic, clean = ([score[i] for i in held if i % 2 == v] for v in (1, 0))
    assert len(toxic) > 10 and len(clean) > 10
    assert min(toxic) > 0.5 > max(clean)


def test_spread_reaches_both_ends():
    data = bytes(range(256)) * 100
    assert toxicity.spread(data[:5000]) == data[:5000]
    data = b"a" * 256 + b"b" * 256 * 98 + b"c" * 100
    got = toxicity.spread(data)
    assert got.startswith(b"a" * 256) and got.endswith(b"c" * 100) and len(got) == 256 * 23 + 100
