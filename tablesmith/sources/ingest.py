"""Batch ingestion (stage A): read a document collection, clean it, write parquet, append an audit record."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tablesmith.operators.clean import clean_table
from tablesmith.sources import io


def ingest(spark: SparkSession, source_path: str, output_path: str, audit_path: str,
           source_name: str = "documents", schema=None, clean: bool = True) -> DataFrame:
    """Read -> (clean) -> parquet -> audit. Returns the audit table (all records so far). The records are counted by
    the write itself; the written table isn't read again."""
    start = datetime.now(timezone.utc)
    # a session that has observed a query can't be serialized any more, but MLlib's fitted models hold theirs and are
    # sent to the executors: the observation has a session of its own
    df = io.read_documents(spark.newSession(), source_path, schema)
    if clean:
        df = clean_table(df)
    seen = Observation()
    io.write_parquet(df.observe(seen, F.count(F.lit(1)).alias("records")), output_path)
    total = seen.get["records"]
    end = datetime.now(timezone.utc)
    io.append_table(io.audit_record(spark, start, end, total, source_name, output_path), audit_path)
    return spark.read.parquet(audit_path)
