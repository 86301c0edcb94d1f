"""Readers and writers (S1-S11). All paths are on shared storage (the cluster's checkpoint folder in the plans)."""

from __future__ import annotations

import functools
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesmith.sources.versions import claim_number


def read_documents(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
                   id_field: str = "_id") -> DataFrame:
    """A document collection stored as JSON lines, every field but the store's id. Give ``schema`` on large
    inputs (inference is a full extra pass)."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.json(path)
    return df.drop(id_field)


def export_documents(df: DataFrame, path: str, id_col: str, id_field: str = "_id") -> None:
    """Write a table as a document collection (JSON lines with a string id), e.g. a landing folder."""
    df.withColumn(id_field, F.col(id_col).cast("string")).write.mode("overwrite").json(path)


def union_by_name(*batches: DataFrame) -> DataFrame:
    """Append batches; columns matched by name, absent ones NULL."""
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), batches)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """S3: CSV with a header; pass ``schema`` (else types are inferred with an extra pass)."""
    r = spark.read.option("header", True)
    r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
    return r.csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header."""
    df.write.mode("overwrite").option("header", True).csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """S4."""
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    """Parquet; S6 writes one keyed table partitioned by the split column instead of six files."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """E.g. a validation status table."""
    df.write.mode(mode).json(path)


def audit_record(spark: SparkSession, start: datetime, end: datetime, total_records, source: str,
                 output_path: str) -> DataFrame:
    """One-row ingestion audit (start, end, duration, records, source, output path). ``total_records`` may
    be a Column (e.g. a scalar subquery) so the count stays a Spark aggregate."""
    rec = F.lit(total_records) if not hasattr(total_records, "_jc") else total_records
    return spark.range(1).select(
        F.lit(start.isoformat()).alias("start_time"), F.lit(end.isoformat()).alias("end_time"),
        F.lit((end - start).total_seconds()).alias("duration_seconds"), rec.cast("long").alias("total_records"),
        F.lit(source).alias("data_source"), F.lit(output_path).alias("output_path"))


def append_table(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, in whatever file system it names; a fault of the storage is raised."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def log_metrics(spark: SparkSession, path: str, metrics: dict, settings: dict | None = None) -> DataFrame:
    """Append one row per metric, and per run setting (e.g. the threshold), under a run number of its own;
    returns the log table. The number is claimed by a marker beside the log (``versions.claim_number``), so that
    evaluations that log at the same time get different ones; it is above all runs in the log. A number whose job is
    lost before it writes stays unused."""
    last = read_metrics(spark, path).agg(F.max("run")).first()[0] if path_exists(spark, path) else 0
    run = claim_number(spark, f"{path.rstrip('/')}_runs", int(last or 0) + 1)
    now = datetime.now(timezone.utc).isoformat()
    named = [("metric", k, v) for k, v in metrics.items()] + [("setting", k, v) for k, v in (settings or {}).items()]
    rows = [(run, now, kind, k, float(v)) for kind, k, v in named]
    spark.createDataFrame(rows, "run int, logged_at string, kind string, metric string, value double") \
        .write.parquet(f"{path.rstrip('/')}/run-{run}")
    return read_metrics(spark, path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The metrics log: every run is a folder of its own, so that runs that are written at once don't meet."""
    return spark.read.option("recursiveFileLookup", True).parquet(path)
