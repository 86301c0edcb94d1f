"""Plan-shape guards for scale: no all-pairs joins anywhere, pruning reaches the scan."""

import pytest

import __spark_entry__ as E
from tablesmith.plans import catalog, tables
from tests.conftest import SF_SMALL

# plans that train models, write or stream are checked by the rows-only tests
SKIP = {"cross_validate", "overfit_gap", "cross_validate_gbt", "model_logistic", "model_tree", "model_forest",
        "model_gbt", "score_probability", "feature_importance", "model_roundtrip", "pipeline_model_roundtrip", "metrics_log", "ingest_audit",
        "stream_ingest", "logistic_score_equations", "evaluate_model", "evaluate_model_counts"}


def _plan(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - SKIP))
def test_no_all_pairs_join(spark, name):
    p = _plan(spark, name)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_scan_reads_only_needed_columns(spark):
    df = tables.scored_documents(spark, SF_SMALL).groupBy("label", "score").count()
    p = df._jdf.queryExecution().executedPlan().toString()
    docs = [line for line in p.splitlines() if "documents.parquet" in line]
    assert docs and all("text:" not in line for line in docs)


def test_filter_pushed_to_scan(spark):
    p = _plan(spark, "remove_rows_anti")
    scans = [line for line in p.splitlines() if "orders.parquet" in line and "PushedFilters" in line]
    assert any("o_totalprice" in line.split("PushedFilters")[1] for line in scans)


@pytest.mark.parametrize("name, scans", [("drift_table", 2), ("clean_table", 2)])
def test_few_passes_over_the_input(spark, name, scans, monkeypatch):
    """The query's own scans of its big table, and the jobs that fit its literals, read it at most so often."""
    p = _plan(spark, name)
    assert p.count("orders.parquet") + p.count("Scan ExistingRDD") <= 2 * scans
