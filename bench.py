"""Benchmark: wall seconds per headline query (median of warm runs).

Runs on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` and prints one JSON line. Each query is executed in full
through the ``noop`` sink (every row computed, nothing collected).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    # cleaning and enrichment (full pipeline from the raw tables)
    "null_safe_left_join",
    "keyword_hits",
    "poi_count",
    "dedupe_keep_max",
    "csv_roundtrip",
    "stream_enrich",
    # profile / explore (read the written joined table)
    "mean_by_label",
    "city_stats",
    "correlation_matrix",
    "missing_profile",
    "box_summary_lineitem",
    # statistics
    "mann_whitney",
    "ols_simple",
    "regplot_band",
    # sampling, features, models
    "exact_sample",
    "stratified_split",
    "metrics_by_bucket",
    "feature_matrix",
    "permutation_test",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from pyspark import __version__ as spark_version

    from staysift.plans.queries import REGISTRY
    from staysift.session import build_session

    shuffle_partitions = max(8, cpus * 2)
    extra = {}
    if os.environ.get("BENCH_EVENT_LOG"):  # stage/task times for later analysis
        import tempfile

        extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": tempfile.mkdtemp(prefix="bench-events-")}
    spark = build_session(
        "staysift-bench", master=f"local[{cpus}]", shuffle_partitions=shuffle_partitions, extra_conf=extra
    )
    names = only or HEADLINE
    timings: dict[str, float] = {}
    for name in names:
        fn = REGISTRY[name]
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
        samples = []
        for _ in range(runs):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - t0)
        timings[name] = round(statistics.median(samples), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
        "spark": spark_version,
        "shuffle_partitions": shuffle_partitions,
        "runs": runs,
    }
    spark.stop()
    print(json.dumps(out))


if __name__ == "__main__":
    main()
