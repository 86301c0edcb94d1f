"""The document data source: ranges, batches, pushed filters, against the plain reading of every line."""

import json

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablesmith.sources import documents as D

SCHEMA = "_id string, k bigint, word string, score double"


@pytest.fixture(scope="module")
def collection(tmp_path_factory):
    root = tmp_path_factory.mktemp("collection")
    docs = [{"_id": str(k), "k": k, "word": ["é" * (k % 50), "b\n ", None][k % 3], "score": k / 4, "other": [k]}
            for k in range(997)]
    docs[5].pop("word")
    docs[6]["k"] = None
    for part in range(3):
        rows = docs[part::3]
        body = "\n".join(json.dumps(d, ensure_ascii=part == 0) for d in rows) + ("\n\n" if part else "")
        (root / f"part-{part}.json").write_bytes(body.encode())
    (root / "_SUCCESS").write_text("")
    (root / "empty.json").write_text("")
    return str(root), docs


def expected(docs):
    return sorted(((d["k"], d.get("word"), d["score"]) for d in docs), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("split", [1, 37, 1_000, 10 ** 9])
def test_each_document_comes_once(spark, collection, split):
    path, docs = collection
    reader = D.DocumentReader(StructType.fromDDL(SCHEMA), {"path": path, "batchSize": "7", "splitBytes": str(split)})
    rows = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    assert sorted(((r["k"], r["word"], r["score"]) for r in rows), key=repr) == expected(docs)


def test_scan_in_several_partitions(spark, collection):
    path, docs = collection
    df = D.scan_documents(spark, "file:" + path, SCHEMA, batch_size=50, split_bytes=5_000)
    assert df.columns == ["k", "word", "score"] and got(df) == expected(docs)
    assert df.select(F.spark_partition_id().alias("p")).distinct().count() > 3


def test_batches_have_the_stated_size(spark, collection):
    path, _ = collection
    reader = D.DocumentReader(StructType.fromDDL(SCHEMA), {"path": path + "/part-1.json", "batchSize": "100"})
    (part,) = reader.partitions()
    sizes = [b.num_rows for b in reader.read(part)]
    assert sizes == [100, 100, 100, 32] and all(isinstance(b, pa.RecordBatch) for b in reader.read(part))
    assert [len(run) for run in D.batches_of([b"x" * 10] * 5, 100, 20)] == [2, 2, 1]


@pytest.mark.parametrize("condition, left_to_spark", [
    ("k >= 500", False), ("k < 20 AND word IS NOT NULL", False), ("word IN ('éé', 'none')", False),
    ("word IS NULL", False), ("k = 7 OR k = 9", True), ("score > 3", True), ("k > 3 AND length(word) = 2", True)])
def test_filters_are_applied_in_the_source(spark, collection, condition, left_to_spark):
    path, docs = collection
    df = D.scan_documents(spark, path, SCHEMA).filter(condition)
    plain = spark.createDataFrame([(d["k"], d.get("word"), d["score"]) for d in docs], "k long, word string, score double")
    assert got(df) == got(plain.filter(condition))
    assert ("Filter (" in df._jdf.queryExecution().executedPlan().toString()) == left_to_spark


def test_an_empty_collection_and_a_missing_one(spark, tmp_path):
    (tmp_path / "none.json").write_text("")
    assert D.scan_documents(spark, str(tmp_path), SCHEMA).count() == 0
    with pytest.raises(Exception, match="FileNotFound|nothing_here"):
        D.scan_documents(spark, str(tmp_path / "nothing_here"), SCHEMA).count()
    with pytest.raises(Exception, match="needs a schema"):
        spark.read.format("documents").load(str(tmp_path)).count()
