"""The pipeline against a brute-force version, and the registered queries."""

import os
import sys

import numpy as np
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
SF = "/root/testdata/sf0.001"


def test_pipeline_equals_brute_force(spark):
    import corpus_pipeline
    from test_operators_llm import brute_components

    from staysift.llm import language_id, quality_crf

    got = corpus_pipeline.run(spark, SF).toPandas()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.toPandas()
    model = quality_crf.fit_sample(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    rows = rows[model.score(rows["text"].tolist()) >= 0.3]
    known = language_id.fit_sample(spark.createDataFrame(rows, docs.schema))
    found = [known.predict(t) for t in rows["text"]]
    rows = rows[[lang != "und" and score >= 0.5 for lang, score, _ in found]]
    _, roots = brute_components(list(zip(rows["doc_id"].tolist(), rows["text"], strict=True)), 5, 80)
    rows = rows[[roots[i] == i for i in rows["doc_id"]]]
    assert set(got["doc_id"]) == set(rows["doc_id"])
    got = got.sort_values(["sequence_id", "offset"])
    ends = got.groupby("sequence_id")["length"].cumsum()
    assert (got["offset"] == ends - got["length"]).all() and ends.max() <= 1024
    labels = pd.read_parquet(f"{SF}/labels.parquet").merge(docs.toPandas(), on="doc_id")
    labelled = labels[labels["quality"] == 1]
    first = labelled.drop_duplicates("text")
    assert np.isin(first["doc_id"], got["doc_id"]).mean() > 0.8  # clean documents stay, but for near copies


def test_stages_keep_the_columns(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.schema.simpleString() == docs.schema.simpleString()


def test_stages_take_odd_rows(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame(
        [(900001, None, None, None, None), (None, None, None, None, None), (900002, "", "en", "s", 0), (900002, "", "en", "s", 0),
         (900003, "long " * 30000, "en", "s", 1)],
        docs.schema,
    )
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.union(odd), SF).count() > 0, name
        assert stage(spark, docs.limit(0), SF).count() == 0, name


def test_each_operator_has_its_query():
    import __spark_entry__ as entry

    names = entry.queries()
    for n in range(1, 14):
        assert sum(k.startswith(f"op{n}_") for k in names) == 1
    assert "pipeline" in names
