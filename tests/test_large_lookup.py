"""Frequent-key summaries, bucketed lookups and the stream against a lookup that is not broadcast."""

import os
import random
import tempfile
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from staysift.operators import bucketed, enrich
from staysift.operators.heavy_hitters import KeySummary, summarise_keys
from staysift.plans import fixtures as fx
from staysift.sources import sinks
from staysift.streaming import enrich_stream as es


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 30), max_size=60), max_size=8), st.integers(1, 12))
def test_summary_bounds(parts, capacity):
    """Bounds hold whatever the parts; no key above the error is missed; the error is bounded."""
    merged, true = KeySummary(capacity), Counter()
    for part in parts:
        counts = Counter((str(k),) for k in part)
        true += counts
        one = KeySummary(capacity).merge(KeySummary(capacity, dict(counts), len(part)))
        merged = KeySummary.from_json(merged.merge(one).to_json())
    assert merged.rows == sum(true.values()) and len(merged.counts) <= capacity
    assert merged.error * (capacity + 1) <= merged.rows
    for key, n in true.items():
        held = merged.counts.get(key, 0)
        assert held <= n <= held + merged.error
    wanted = [k for k, n in true.items() if n >= 0.3 * merged.rows and n > merged.error]
    assert set(wanted) <= set(merged.above(0.3))


def test_summary_of_a_table(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["DE", None]), "hot") for _ in range(4000)] + [(str(k), "x") for k in range(6000)] + [(None, None)] * 900
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "a string, b string").repartition(7)
    found = summarise_keys(df, ["a", "b"], 50)
    assert found.rows == 10_900
    true = Counter(rows)
    assert set(found.above(0.05)) >= {("DE", "hot"), (None, "hot"), (None, None)}
    for key, n in found.counts.items():
        assert n <= true[key] <= n + found.error
    assert summarise_keys(df.limit(0), ["a", "b"]).above(0.1) == []


def left_and_lookup(spark):
    rng = random.Random(3)
    keys = [("DE", "city 1"), ("DE", ""), (None, ""), (None, None), ("", None)] + [("FR", f"c{k}") for k in range(200)]
    left = [(k, *rng.choice(keys[:4] if k % 3 else keys)) for k in range(3000)]
    right = [(a, b, float(k)) for k, (a, b) in enumerate(keys) if k != 2 and k % 5 != 3]
    return (
        spark.createDataFrame(left, "row int, k1 string, k2 string"),
        spark.createDataFrame(right, "k1 string, k2 string, value double"),
    )


@pytest.mark.parametrize("hot", [(), ((None, ""), (None, None), ("DE", "city 1"), ("no", "such"))])
def test_bucketed_join_equals_the_plain_one(spark, hot):
    left, right = left_and_lookup(spark)
    path = tempfile.mkdtemp(prefix="staysift-test-")
    bucketed.write_lookup(right, ["k1", "k2"], ["value"], path, 4)
    lookup = bucketed.open_lookup(spark, path)
    got = bucketed.bucketed_left_join(left, lookup, hot)
    want = enrich.null_safe_left_join(left, right, ["k1", "k2"], ["value"])
    assert got.columns == want.columns
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_only_the_left_side_is_shuffled(spark):
    left, right = left_and_lookup(spark)
    lookup = bucketed.write_lookup(right, ["k1", "k2"], ["value"], tempfile.mkdtemp(prefix="staysift-test-"), 4)
    plan = bucketed.bucketed_left_join(left, lookup)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    assert plan.count("Exchange hashpartitioning") == 1


def test_lookup_must_be_unique(spark):
    df = spark.createDataFrame([(None, "a", 1.0), (None, "a", 2.0)], "k1 string, k2 string, value double")
    with pytest.raises(ValueError, match="unique"):
        bucketed.write_lookup(df, ["k1", "k2"], ["value"], tempfile.mkdtemp(prefix="staysift-test-"), 2)


def test_hot_keys_of_a_stream_run_no_action(spark):
    stream = spark.readStream.format("rate").load().select(F.lit("x").alias("k1"), F.lit(None).cast("string").alias("k2"))
    cond = enrich.detect_hot_keys(stream, ["k1", "k2"])
    assert stream.where(cond).isStreaming


@pytest.fixture(scope="module")
def landed(spark):
    """Listings in three files, the cleaned gazetteer, country names, and the batch result."""
    sf = "/root/testdata/sf0.001"
    raw, dim = fx.listings_raw(spark, sf), fx.country_dim(spark, sf)
    landing = os.path.join(tempfile.mkdtemp(prefix="staysift-test-"), "landing")
    sinks.write_table(raw.repartition(3), landing, "parquet")
    gazetteer = enrich.clean_gazetteer(fx.gazetteer_raw(spark, sf), dim)
    want = es.finalize_joined(enrich.attach_population(enrich.clean_listings(raw, dim), gazetteer))
    return landing, raw.schema, gazetteer, dim, want.collect()


@pytest.mark.parametrize("limit", [0, -1, 10**9])
def test_stream_against_any_size_of_lookup(spark, landed, limit):
    landing, schema, gazetteer, dim, want = landed
    base = tempfile.mkdtemp(prefix="staysift-test-")
    for _ in range(2):  # a second start from the checkpoint finds nothing new
        es.enrich_stream(
            spark, landing, schema, gazetteer, dim, f"{base}/out", f"{base}/ckpt", max_files_per_trigger=1,
            broadcast_max_rows=limit,
        ).awaitTermination()
    got = es.read_enriched(spark, f"{base}/out")
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want))


def test_a_repeated_batch_replaces_its_rows(spark, landed):
    """The last batch's commit is lost, as when the driver dies after the write."""
    landing, schema, gazetteer, dim, want = landed
    base = tempfile.mkdtemp(prefix="staysift-test-")
    lookup = bucketed.write_lookup(es.population_lookup(gazetteer), es.KEYS, es.ATTRS, f"{base}/lookup", 3)
    run = lambda: es.enrich_stream(
        spark, landing, schema, None, dim, f"{base}/out", f"{base}/ckpt", max_files_per_trigger=1, lookup=lookup
    ).awaitTermination()
    run()
    last = max(int(f) for f in os.listdir(f"{base}/ckpt/commits") if f.isdigit())
    before = es.HotKeyState(spark, f"{base}/ckpt", 1000).before(last + 1)
    for f in (f"{last}", f".{last}.crc"):
        if os.path.exists(f"{base}/ckpt/commits/{f}"):
            os.remove(f"{base}/ckpt/commits/{f}")
    run()
    got = es.read_enriched(spark, f"{base}/out")
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want))
    after = es.HotKeyState(spark, f"{base}/ckpt", 1000).before(last + 1)
    assert after == before and after.rows == len(want)
