"""The fill-in-middle operator against a plain version, and its boundary sets."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from staysift.llm.fill_in_middle import (
    ArrayContainer,
    BitmapContainer,
    BoundarySet,
    RunContainer,
    check_marks,
    fill_in_middle,
    line_ends,
    restored,
)


def plain_version(key, text):
    """The contract, read literally."""
    text = text or ""
    h = hashlib.sha256(f"7:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, _, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(lines)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")):
        return key, n, "plain", None, None, text
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(lines[:low]), "".join(lines[low:high]), "".join(lines[high:])
    form = "spm" if h4 % 100 < 50 else "psm"
    out = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return key, n, form, len(p), len(m), out


ROWS = [
    (1, None), (2, ""), (3, "\n"), (4, "\n\n\n"), (5, "one line"), (6, "a\nb\nc"), (7, "a\nb\nc\n"), (7, "a\nb\nc\n"),
    (None, "x\ny\n"), (None, None), (8, "has <P> inside\nand more"), (9, "ends in <\nS>\n<"), (10, "é\n語語\n🙂🙂\r\nz\n" * 50),
    (11, "word " * 40_000), (12, "\n" * 70_000), (13, "ab\n" * 60_000 + "é"), (14, "\x00\n\x85 x\x0b\n"),
    *[(100 + k, f"line {k}\n" * (k % 9) + "tail" * (k % 2)) for k in range(60)],
]


def test_equals_the_plain_version(spark):
    rows = [(k, t, 1, "f", 2, 3, "o") for k, t in ROWS]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n int, form string, h1 int, id int, output string").repartition(3)
    moved = fill_in_middle(docs)
    assert Counter(tuple(r) for r in moved.collect()) == Counter(plain_version(*r) for r in ROWS)
    back = moved.select("doc_id", restored(F.col("output"), F.col("form")).alias("t")).collect()
    assert Counter(tuple(r) for r in back) == Counter((k, t or "") for k, t in ROWS)
    assert fill_in_middle(docs.limit(0)).count() == 0
    assert {r["form"] for r in fill_in_middle(docs, rate=0).select("form").collect()} == {"plain"}


@pytest.mark.parametrize("kind", ["spread", "dense", "runs", "mixed"])
def test_select_finds_each_boundary(kind):
    rng = np.random.default_rng(3)
    offsets = {
        "spread": np.unique(rng.integers(1, 1 << 20, 3000)),
        "dense": np.unique(rng.integers(1, 1 << 17, 60_000)),
        "runs": np.concatenate([np.arange(a, a + 2500) for a in range(1, 300_000, 7001)]),
        "mixed": np.unique(np.concatenate((np.arange(5, 9000), rng.integers(1 << 16, 1 << 17, 20_000), [1 << 21, (1 << 21) + 9]))),
    }[kind]
    bounds = BoundarySet(offsets)
    assert len(bounds) == len(offsets)
    at = np.unique(np.concatenate((rng.integers(0, len(offsets), 500), [0, len(offsets) - 1])))
    assert [bounds.select(int(k)) for k in at] == offsets[at].tolist()
    kinds = {type(c) for c in bounds.containers}
    want = {"spread": {ArrayContainer}, "dense": {BitmapContainer}, "runs": {RunContainer}}
    assert kinds == want.get(kind, {ArrayContainer, BitmapContainer, RunContainer})


def test_line_ends():
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice("ab\n\né語🙂 ") for _ in range(rng.randint(0, 30)))
        want = np.cumsum([len(x) for x in re.findall(r"[^\n]*\n|[^\n]+", text)])
        assert line_ends(text).tolist() == want.tolist()


@pytest.mark.parametrize("marks", [("", "a", "b"), ("<P>", "<P>", "<M>"), ("<P>", "x<P>y", "<M>"), ("ab", "bc", "d"), ("aba", "x", "y")])
def test_ambiguous_marks_are_refused(marks):
    with pytest.raises(ValueError):
        check_marks(marks)
