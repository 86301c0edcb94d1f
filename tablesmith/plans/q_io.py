"""Plans for sources and sinks (S1-S11) and the streaming ingest; each writes below the shared checkpoint
folder and reads back what it wrote."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablesmith.operators import validate as V
from tablesmith.plans import q_eval as E
from tablesmith.plans import sqlparts as Q
from tablesmith.plans import tables as TB
from tablesmith.plans.catalog import register
from tablesmith.plans.catalog import REGISTRY
from tablesmith.plans.q_profile import BOOKINGS_SCHEMA
from tablesmith.sources import documents, io
from tablesmith.sources.ingest import ingest
from tablesmith.streaming.ingest import run_ingest

DOC_SQL = "SELECT doc_id, text, lang, source, n_chars FROM documents"
DOC_SCHEMA = "_id string, doc_id bigint, text string, lang string, source string, n_chars bigint"


@register("scan_documents", DOC_SQL)
def scan_documents(spark, sf_dir):
    path = TB.scratch(spark, "documents-json")
    io.export_documents(TB.table(spark, sf_dir, "documents"), path, "doc_id")
    return io.read_documents(spark, path)  # schema inferred, as from schemaless documents


@register("document_store_scan", DOC_SQL)
def document_store_scan(spark, sf_dir):
    """The whole collection through the data source ``documents``, in batches of 1,000."""
    path = TB.scratch(spark, "documents-store")
    io.export_documents(TB.table(spark, sf_dir, "documents"), path, "doc_id")
    return documents.scan_documents(spark, path, DOC_SCHEMA)


@register("union_by_name", """
SELECT o_orderkey, o_totalprice, o_orderstatus, NULL::VARCHAR AS o_orderpriority FROM orders WHERE o_orderstatus = 'F'
UNION ALL
SELECT o_orderkey, NULL::DOUBLE, o_orderstatus, o_orderpriority FROM orders WHERE o_orderstatus <> 'F'""")
def union_by_name(spark, sf_dir):
    o = TB.table(spark, sf_dir, "orders")
    a = o.filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_totalprice", "o_orderstatus")
    b = o.filter(F.col("o_orderstatus") != "F").select("o_orderpriority", "o_orderstatus", "o_orderkey")
    return io.union_by_name(a, b)


@register("csv_roundtrip", Q.with_(Q.BOOKINGS) + "SELECT * FROM bookings")
def csv_roundtrip(spark, sf_dir):
    b = TB.bookings(spark, sf_dir)
    path = TB.scratch(spark, "bookings-csv")
    io.write_csv(b, path)
    return io.read_csv(spark, path, b.schema)


@register("parquet_roundtrip", Q.with_(Q.RAW) + "SELECT * FROM raw")
def parquet_roundtrip(spark, sf_dir):
    path = TB.scratch(spark, "bookings-parquet")
    io.write_parquet(TB.bookings_raw(spark, sf_dir), path)
    return io.read_parquet(spark, path)


@register("split_sink", Q.with_(Q.BOOKINGS, Q.split_cte()) + """
SELECT split, o_orderstatus, count(*) AS n_rows, round(sum(o_totalprice), 2) AS total_price
FROM split GROUP BY split, o_orderstatus""")
def split_sink(spark, sf_dir):
    path = TB.scratch(spark, "split-sink")
    io.write_parquet(TB.bookings_split(spark, sf_dir), path, partition_by=["split"])
    back = io.read_parquet(spark, path)  # partition column restored from the folder names
    return back.groupBy("split", "o_orderstatus").agg(F.count(F.lit(1)).alias("n_rows"),
                                                      F.round(F.sum("o_totalprice"), 2).alias("total_price"))


@register("validation_status_json", REGISTRY["validate_schema"][1])
def validation_status_json(spark, sf_dir):
    path = TB.scratch(spark, "validation-status")
    io.write_json(V.validate_schema(TB.bookings(spark, sf_dir), BOOKINGS_SCHEMA), path)
    return spark.read.json(path)


@register("ingest_audit", """
SELECT count(*) AS total_records, 'documents' AS data_source, true AS duration_ok, true AS path_ok FROM documents""")
def ingest_audit(spark, sf_dir):
    src, out = TB.scratch(spark, "landing"), TB.scratch(spark, "ingested")
    io.export_documents(TB.table(spark, sf_dir, "documents"), src, "doc_id")
    audit = ingest(spark, src, out, TB.scratch(spark, "audit"), schema=DOC_SCHEMA)
    began, ended = F.col("start_time").cast("timestamp"), F.col("end_time").cast("timestamp")
    return audit.select("total_records", "data_source",
                        ((F.col("duration_seconds") >= 0) & (began <= ended)).alias("duration_ok"),
                        (F.col("output_path") == out).alias("path_ok"))


LOGGED = (0.6, 0.65)


def _log_sql():
    parts = []
    for run, t in enumerate(LOGGED, 1):
        row = f"(SELECT * FROM ({E.sweep_sql([t])}), ({E.AUC_SQL}))"
        parts += [f"SELECT CAST({run} AS INTEGER) AS run, '{k}' AS kind, '{m}' AS metric, round({m}, 6) AS value FROM {row}"
                  for k, m in [("metric", x) for x in ("accuracy", "precision", "recall", "f1", "roc_auc")]
                  + [("setting", "threshold")]]
    return E.S + " UNION ALL ".join(parts)


@register("metrics_log", _log_sql())
def metrics_log(spark, sf_dir):
    from tablesmith.operators import evaluate as EV
    path = TB.scratch(spark, "metrics")
    scored = TB.scored_documents(spark, sf_dir)
    for t in LOGGED:
        row = EV.eval_threshold(scored, t).first().asDict()
        row.pop("threshold")
        io.log_metrics(spark, path, row, {"threshold": t})
    return io.read_metrics(spark, path).select("run", "kind", "metric", F.round("value", 6).alias("value"))


@register("stream_ingest", DOC_SQL)
def stream_ingest(spark, sf_dir):
    landing = TB.scratch(spark, "stream-landing")
    docs = TB.table(spark, sf_dir, "documents")
    # two landed batches
    io.export_documents(docs.filter(F.col("lang") == "en"), landing + "/batch=1", "doc_id")
    io.export_documents(docs.filter(~F.col("lang").eqNullSafe("en")), landing + "/batch=2", "doc_id")
    table = TB.scratch(spark, "stream-table")
    run_ingest(spark, landing + "/*", DOC_SCHEMA, table, TB.scratch(spark, "stream-ckpt"))
    return spark.read.parquet(table).drop("_ingested_at")
