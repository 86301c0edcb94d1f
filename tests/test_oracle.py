"""Every plan with an oracle: Spark result == DuckDB result (columns, row count, values) on driver tables."""

import pytest

import __spark_entry__ as E
from tablesmith.plans import catalog
from tests.compare import compare, duck
from tests.conftest import SF_SMALL

NAMES = sorted(catalog.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_plan_has_a_callable():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_plan_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SF_SMALL).toPandas()
    want = con.execute(E.oracle_sql()[name]).fetchdf()
    assert compare(got, want) == []


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 6
    assert df.columns == ["column", "kind", "method", "score", "threshold", "drifted"]
