"""Rank and category association against plain computations; the estimate before exact distinct counts."""

import numpy as np
import pandas as pd
import pytest

from tablesmith.operators import clean as C
from tablesmith.operators import profile as PR


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(3)
    n = 3_000
    x = rng.lognormal(0, 3, n).round(1)
    x[: n // 3] = 0.0  # a third of the rows share a value
    y = -x ** 3 + rng.normal(0, 1, n).round(0)
    z = rng.integers(0, 3, n).astype(float)
    z[5:50] = np.nan
    return pd.DataFrame({"x": x, "y y": y, "z": z, "c": 1.0})


def test_rank_correlation(spark, frame):
    got = {(r["col_a"], r["col_b"]): r["rho"] for r in PR.rank_correlation(spark.createDataFrame(frame)).collect()}
    want = frame.dropna().rank().corr()
    assert len(got) == 16
    for (a, b), rho in got.items():
        assert rho is None if "c" in (a, b) else rho == pytest.approx(want.loc[a, b], abs=1e-9)


def test_rank_correlation_of_signed_zeros_and_no_rows(spark):
    df = spark.createDataFrame([(0.0, 1), (-0.0, 2), (1.0, 3)], "a double, b int")
    got = {(r["col_a"], r["col_b"]): r["rho"] for r in PR.rank_correlation(df).collect()}
    assert got["a", "b"] == pytest.approx(pd.DataFrame({"a": [0, 0, 1], "b": [1, 2, 3]}).rank().corr().loc["a", "b"])
    assert [r["rho"] for r in PR.rank_correlation(df.limit(0)).collect()] == [None] * 4


def test_category_association(spark):
    rng = np.random.default_rng(4)
    a = rng.choice(["p", "q", "r"], 2_000)
    pdf = pd.DataFrame({"a": a, "b": np.where(rng.random(2_000) < 0.7, a, "s"), "c": rng.choice([1, 2], 2_000), "one": "k"})
    pdf.loc[:99, "b"] = None
    got = {(r["col_a"], r["col_b"]): r for r in PR.category_association(spark.createDataFrame(pdf), list(pdf)).collect()}
    assert set(got) == {("a", "b"), ("a", "c"), ("a", "one"), ("b", "c"), ("b", "one"), ("c", "one")}
    for (p, q), r in got.items():
        table = pd.crosstab(pdf[p], pdf[q]).to_numpy(float)
        n = table.sum()
        expected = table.sum(1, keepdims=True) * table.sum(0, keepdims=True) / n
        chi2 = ((table - expected) ** 2 / expected).sum()
        assert r["n_rows"] == n and r["chi2"] == pytest.approx(chi2, abs=1e-6)
        free = min(table.shape) - 1
        assert r["cramers_v"] is None if not free else r["cramers_v"] == pytest.approx((chi2 / n / free) ** 0.5, abs=1e-9)
    assert PR.category_association(spark.createDataFrame(pdf).limit(0), ["a", "b"]).count() == 0


def test_only_columns_near_the_row_count_are_counted(spark, monkeypatch):
    n = 20_000
    df = spark.range(n).selectExpr("id AS k", "id % 19999 AS nearly", "id % 100 AS few", "CAST(id AS string) AS s",
                                   "nullif(id, 7) AS gap", "1 AS one")
    counted, plain = [], C.value_groups
    monkeypatch.setattr(C, "value_groups", lambda d, cols: counted.append(cols) or plain(d, cols))
    assert C.unique_columns(df) == ["k", "s"]
    assert counted == [["k", "nearly", "s"]]
    assert C.unique_columns(df.limit(1)) == ["k", "nearly", "few", "s", "gap", "one"]


def test_duplicates_with_signed_zeros_and_missing_values(spark):
    nan = float("nan")
    rows = [(0.0, "a"), (-0.0, "a"), (None, "a"), (None, "a"), (nan, None), (nan, None), (nan, None), (1.0, "a"), (1.0, "b")]
    df = spark.createDataFrame(rows, "`x.y` double, s string")
    assert PR.duplicate_count(df).first()[0] == 4
    assert PR.duplicate_count(df.selectExpr("CAST(`x.y` AS float) AS f", "s")).first()[0] == 4
    assert PR.duplicate_count(df.limit(0)).first()[0] == 0
