"""Publishing by version and pointer, numbers claimed once, records counted by the write."""

import json
import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tablesmith.operators import models as M
from tablesmith.operators import validate as V
from tablesmith.sources import ingest, io, versions

SCHEMA = {"a": {"type": "integer", "constraints": {"min": 0, "max": 100}}}


def table(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "a int")


def rows(df):
    return sorted(r["a"] for r in df.collect())


def test_readers_keep_the_old_version_when_a_write_fails(spark, tmp_path):
    root, status = str(tmp_path / "t"), str(tmp_path / "s")
    V.publish_validated(table(spark, 1, 2), SCHEMA, root, status)
    opened = versions.read_published(spark, root)
    broken = spark.range(40).repartition(4).select(
        F.when(F.col("id") < 39, F.col("id")).otherwise(F.raise_error(F.lit("lost midway")).cast("long")).cast("int").alias("a"))
    with pytest.raises(Exception, match="lost midway"):
        versions.publish(broken, root)
    assert rows(versions.read_published(spark, root)) == [1, 2] == rows(opened)
    V.publish_validated(table(spark, 3), SCHEMA, root, status)
    assert rows(versions.read_published(spark, root)) == [3] and rows(opened) == [1, 2]


def test_a_closed_gate_keeps_the_old_version(spark, tmp_path):
    root, status = str(tmp_path / "t"), str(tmp_path / "s")
    V.publish_validated(table(spark, 1, 2), SCHEMA, root, status)
    found = V.publish_validated(table(spark, 1, 1000), SCHEMA, root, status)
    assert [r["valid"] for r in found.collect()] == [False]
    assert rows(versions.read_published(spark, root)) == [1, 2]


def test_old_versions_go(spark, tmp_path):
    root = str(tmp_path / "t")
    made = [versions.publish(table(spark, k), root) for k in range(4)]
    left = sorted(n for n in os.listdir(root) if n.startswith("version-"))
    assert left == sorted(os.path.basename(m) for m in made[-2:])
    assert versions.current_version(spark, root).endswith(os.path.basename(made[-1]))
    assert not [n for n in os.listdir(root) if n.startswith(".version")]


def test_nothing_published(spark, tmp_path):
    assert versions.current_version(spark, str(tmp_path / "none")) is None
    with pytest.raises(FileNotFoundError):
        versions.read_published(spark, str(tmp_path / "none"))


def test_an_empty_table_can_be_published(spark, tmp_path):
    versions.publish(table(spark), str(tmp_path / "t"))
    assert rows(versions.read_published(spark, str(tmp_path / "t"))) == []


def test_concurrent_claims_differ(spark, tmp_path):
    with ThreadPoolExecutor(10) as pool:
        got = list(pool.map(lambda _: versions.claim_number(spark, str(tmp_path / "n")), range(40)))
    assert sorted(got) == list(range(1, 41))
    assert versions.claim_number(spark, str(tmp_path / "n"), at_least=100) == 100


def test_ten_concurrent_logs_have_ten_runs(spark, tmp_path):
    path = str(tmp_path / "log")
    with ThreadPoolExecutor(10) as pool:
        list(pool.map(lambda k: io.log_metrics(spark, path, {"a": float(k), "b": 0.0}), range(10)))
    found = io.read_metrics(spark, path).groupBy("run").agg(F.count("*").alias("n"), F.count_if(F.col("metric") == "a").alias("a"))
    assert sorted((r["run"], r["n"], r["a"]) for r in found.collect()) == [(k, 2, 1) for k in range(1, 11)]


def test_a_log_without_markers_goes_on(spark, tmp_path):
    path = str(tmp_path / "log")
    spark.createDataFrame([(7, "t", "metric", "a", 1.0)], "run int, logged_at string, kind string, metric string, value double") \
        .write.parquet(path)
    assert {r["run"] for r in io.log_metrics(spark, path, {"a": 1.0}).collect()} == {7, 8}


def test_the_write_counts_its_records(spark, tmp_path, monkeypatch):
    source = tmp_path / "in"
    source.mkdir()
    (source / "d.json").write_text("\n".join(json.dumps({"_id": k, "a": k, "b": "x" * (k % 3)}) for k in range(50)))
    read = []
    plain = type(spark.read).parquet
    monkeypatch.setattr(type(spark.read), "parquet", lambda self, *p, **o: read.append(p) or plain(self, *p, **o))
    audit = ingest.ingest(spark, str(source), str(tmp_path / "out"), str(tmp_path / "audit"), schema="a int, b string", clean=False)
    assert [r["total_records"] for r in audit.collect()] == [50]
    assert read == [(str(tmp_path / "audit"),)]  # the written table isn't read
    assert plain(spark.read, str(tmp_path / "out")).count() == 50
    fitted = M.fit("logistic", spark.createDataFrame([(0, Vectors.dense(0.0)), (1, Vectors.dense(1.0))], ["label", "features"]))
    assert fitted.transform(spark.createDataFrame([(Vectors.dense(1.0),)], ["features"])).count() == 1
