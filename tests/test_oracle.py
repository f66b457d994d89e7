"""A sample of registered queries against their DuckDB oracle (the full set runs
in tools/oracle_check.py and in the driver's correctness gate)."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E

SAMPLE = ["star_label_parse", "poi_count", "country_lookup", "dedupe_keep_max", "null_safe_left_join",
          "mean_by_label", "box_summary", "mann_whitney", "exact_sample", "permutation_test", "csv_roundtrip"]
SMALL = "/root/testdata/sf0.001"


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = []
    for r in rows:
        out.append(tuple(("nan" if isinstance(r[i], float) and math.isnan(r[i]) else
                          round(r[i], 6) if isinstance(r[i], float) else r[i]) for i in order))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("nation", "customer", "orders", "lineitem", "events", "documents", "labels", "part", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SMALL, t)}.parquet')")
    return con


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    orows = cur.fetchall()
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _norm(rows, df.columns) == _norm(orows, ocols)
