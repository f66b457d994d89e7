"""BM25 with whole documents as queries, against its DuckDB oracle."""

import duckdb

SF = "/root/testdata/sf0.01"


def test_documents_with_ids_divisible_by_20_are_answered(spark):
    import __spark_entry__ as entry

    name = "bm25_document_queries"
    got = entry.queries()[name](spark, SF).select("query_id", "rank", "doc_id", "score").collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    want = con.execute(f"SELECT query_id, rank, doc_id, score FROM ({entry.oracle_sql()[name]})").fetchall()
    asked = con.execute("SELECT count(*) FROM documents WHERE doc_id % 20 = 0 AND text <> ''").fetchone()[0]
    assert len({r["query_id"] for r in got}) == asked > 40
    key = lambda r: (r[0], r[1], r[2])
    assert sorted(key(r) for r in got) == sorted(key(r) for r in want)
    scores = {key(r): r[3] for r in want}
    assert all(abs(r["score"] - scores[key(r)]) < 2e-6 for r in got)
