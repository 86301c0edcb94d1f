"""The corpus queries' plans: no all-pairs joins, only the needed columns, no Python where it isn't asked for."""

import pytest

from tablesmith.llm import queries as Q
from tests.conftest import SF_SMALL


def plan(spark, name):
    return Q.QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_no_all_pairs_join(spark, name):
    p = plan(spark, name)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_sharding_runs_no_python(spark):
    assert not any(w in plan(spark, "op3_sharding") for w in ("Python", "Pandas", "Arrow"))


def test_only_needed_columns_are_read(spark):
    p = plan(spark, "op1_token_counts")
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in p
