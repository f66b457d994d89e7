"""The rows and bytes of one task stay bounded as tables grow."""

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from staysift.operators import features, models
from staysift.plans import fixtures as fx
from staysift.plans import queries as Q
from staysift.session import materialize, tasks_of


def test_many_rows_are_dealt_over_more_tasks_than_cores(spark):
    df = spark.range(0, 1000, 1, 2)
    assert tasks_of(df, 1000, 500) is df
    dealt = tasks_of(df, 1000, 50)
    assert dealt.rdd.getNumPartitions() == 20 and dealt.agg(F.sum("id")).first()[0] == 499_500
    assert tasks_of(spark.range(0, 1000, 1, 30), 1000, 50).rdd.getNumPartitions() == 30


def test_listings_are_parsed_in_tasks_of_bounded_rows(spark, sf_dir, monkeypatch):
    few = fx.listings_raw(spark, sf_dir)
    want = few.agg(F.count("*"), F.sum(F.xxhash64(*few.columns).cast("decimal(38,0)"))).first()
    monkeypatch.setattr(fx, "LISTINGS_PER_TASK", 1000)
    many = fx.listings_raw(spark, sf_dir)
    assert many.agg(F.count("*"), F.sum(F.xxhash64(*many.columns).cast("decimal(38,0)"))).first() == want
    assert many.rdd.getNumPartitions() >= 15


def test_matrices_come_in_partitions_of_bounded_rows(spark, sf_dir, monkeypatch):
    want = Q._matrices(spark, sf_dir)
    monkeypatch.setattr(features, "ROWS_PER_TASK", 500)
    got = Q._matrices(spark, sf_dir)
    for a, b in ((want.train, got.train), (want.test, got.test)):
        assert b.rdd.getNumPartitions() >= -(-(want.train.count() + want.test.count()) // 500) > 8
        assert a.select("HotelCode", "label").exceptAll(b.select("HotelCode", "label")).count() == 0
        assert a.count() == b.count()


@pytest.mark.parametrize("name,params", [("rf", {"n_estimators": 2, "max_depth": 2}), ("xgb", {"n_estimators": 2, "max_depth": 2})])
def test_tree_learners_get_partitions_of_bounded_bytes(spark, monkeypatch, name, params):
    rows = spark.range(0, 2000, 1, 1).select(F.col("id").cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("label"))
    train = materialize(VectorAssembler(inputCols=["a", "label"], outputCol="features").transform(rows).select("features", "label"))
    monkeypatch.setattr(models, "TREE_TASK_BYTES", 800)
    assert models.bounded_tasks(train).rdd.getNumPartitions() == 20
    fitted = []
    make = models.make_estimator
    monkeypatch.setattr(models, "make_estimator", lambda n, df, *more: fitted.append(df.rdd.getNumPartitions()) or make(n, df, *more))
    models.train_regressor(train, train, name, params)
    assert fitted == [20]


def test_a_landed_file_is_parsed_on_all_cores(spark, tmp_path):
    from staysift.streaming.enrich_stream import _listing_stream

    path = str(tmp_path / "landing")
    spark.range(10).coalesce(1).write.parquet(path)
    stream = _listing_stream(spark, path, spark.range(1).schema, "parquet", 1)
    cores = spark.sparkContext.defaultParallelism
    assert f"Repartition {cores}, true" in stream._jdf.queryExecution().logical().toString()


def test_many_listings_land_in_more_files(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(Q, "LANDED_FILE_ROWS", 1000)
    landed = []
    write = Q.sinks.write_table
    monkeypatch.setattr(Q.sinks, "write_table", lambda df, *a, **k: landed.append(df.rdd.getNumPartitions()) or write(df, *a, **k))
    got = Q.q_stream_enrich(spark, sf_dir)
    assert landed == [8, 8]
    want = Q.REGISTRY["null_safe_left_join"](spark, sf_dir)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
