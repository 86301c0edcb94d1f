"""Streaming ingest restarts exactly-once; readers and writers round-trip."""

import uuid

from pyspark.sql import functions as F

from tablesmith.session import stage_path
from tablesmith.sources import io
from tablesmith.streaming.ingest import run_ingest
from tests.conftest import SF_SMALL

SCHEMA = "_id string, doc_id bigint, text string, lang string, source string, n_chars bigint"


def test_stream_restart_is_exactly_once(spark):
    base = stage_path(spark, f"stream-test-{uuid.uuid4().hex[:8]}")
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    io.export_documents(docs.filter(F.col("lang") == "en"), base + "/landing/batch=1", "doc_id")
    run_ingest(spark, base + "/landing/*", SCHEMA, base + "/table", base + "/ckpt")
    first = spark.read.parquet(base + "/table").count()
    # restart with nothing new: no duplicates
    run_ingest(spark, base + "/landing/*", SCHEMA, base + "/table", base + "/ckpt")
    assert spark.read.parquet(base + "/table").count() == first
    # a new batch lands: only it is appended
    io.export_documents(docs.filter(F.col("lang") != "en"), base + "/landing/batch=2", "doc_id")
    run_ingest(spark, base + "/landing/*", SCHEMA, base + "/table", base + "/ckpt")
    out = spark.read.parquet(base + "/table")
    assert out.count() == docs.count()
    assert out.select("doc_id").distinct().count() == docs.count()


def test_union_by_name_fills_missing(spark):
    a = spark.createDataFrame([(1, "x")], "k long, a string")
    b = spark.createDataFrame([(2.5, 2)], "b double, k long")
    out = {r["k"]: (r["a"], r["b"]) for r in io.union_by_name(a, b).collect()}
    assert out == {1: ("x", None), 2: (None, 2.5)}


def test_preprocessor_save_load(spark):
    from tablesmith.operators import prep as P
    df = spark.createDataFrame([(1.0, "a"), (None, "b"), (3.0, None), (5.0, "b")], "x double, c string")
    m = P.fit_preprocessor(df, ["x"], ["c"])
    assert m.modes == {"c": "b"} and m.categories == {"c": ["a", "b"]} and m.medians == {"x": 3.0}
    path = stage_path(spark, f"prep-{uuid.uuid4().hex[:8]}")
    m.save(spark, path)
    m2 = P.PreprocessorModel.load(spark, path)
    assert m2.feature_names() == ["num__x", "cat__c_a", "cat__c_b"]
    assert m2.transform(df).collect() == m.transform(df).collect()
