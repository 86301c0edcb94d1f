"""Property checks (few examples: each one runs Spark jobs)."""

from collections import Counter

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from tablesmith.functions import cumulative as CU
from tablesmith.functions import stats as S
from tablesmith.operators import clean as C
from tablesmith.operators import drift as D
from tablesmith.operators import evaluate as EV
from tablesmith.operators import profile as PR
from tablesmith.operators import split as SP
from tablesmith.plans import q_prep

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=300), st.sampled_from([0.0, 0.33, 0.5, 0.9, 1.0]))
def test_exact_quantile_matches_numpy(spark, values, prob):
    long = spark.createDataFrame(pd.DataFrame({"value": [float(v) for v in values]}))
    got = CU.exact_quantiles(long, [], [prob], buckets=4).first()["quantile"]
    assert abs(got - np.quantile(np.array(values, dtype=float), prob)) < 1e-9


@SETTINGS
@given(st.lists(st.sampled_from("abc"), min_size=1, max_size=200))
def test_split_parts_add_up(spark, classes):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(classes)], "key long, t string")
    out = SP.stratified_split(df, "key", "t", digits=1).groupBy("t", "split").count().toPandas()
    for c in set(classes):
        n = classes.count(c)
        parts = dict(zip(out[out["t"] == c]["split"], out[out["t"] == c]["count"]))
        assert sum(parts.values()) == n
        assert parts.get("train", 0) == int(np.floor(0.7 * n + 0.5 + 1e-9))


@pytest.mark.parametrize("values", ["lognormal", "outlier", "infinite"])
def test_buckets_are_even_whatever_the_values(spark, values):
    rng = np.random.default_rng(3)
    x = np.unique(rng.lognormal(0, 3, 20_000))
    if values == "outlier":
        x[-1] = 1e300
    if values == "infinite":
        x[0], x[-1] = -np.inf, np.inf
    dealt, _ = CU.bucketed(spark.createDataFrame(pd.DataFrame({"value": x})), [], "value", buckets=50)
    sizes = [r["count"] for r in dealt.groupBy("_bkt").count().collect()]
    assert max(sizes) <= 2 * len(x) / 50
    lows = [(r["_bkt"], r["lo"], r["hi"]) for r in dealt.groupBy("_bkt").agg(
        F.min("value").alias("lo"), F.max("value").alias("hi")).orderBy("_bkt").collect()]
    assert all(a[2] < b[1] for a, b in zip(lows, lows[1:]))


def test_running_totals_keep_a_null_group(spark):
    rows = [(g, float(v), 1) for g in ("a", None) for v in range(50)]
    df = spark.createDataFrame(rows, "g string, value double, n long")
    got = CU.running_totals(df, ["g"], "value", ["n"], buckets=7).collect()
    assert sorted((str(r["g"]), r["value"], r["cum_n"]) for r in got) == sorted((str(g), v, v + 1) for g, v, _ in rows)
    q = CU.exact_quantiles(df, ["g"], [0.5], buckets=7).collect()
    assert {r["g"]: r["quantile"] for r in q} == {"a": 24.5, None: 24.5}


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 20)), st.one_of(st.none(), st.sampled_from("ab"))),
                max_size=120))
def test_no_row_is_lost_by_a_split(spark, rows):
    df = spark.createDataFrame(rows, "key long, t string")
    for out in (SP.stratified_split(df, "key", "t", digits=1), SP.stratified_folds(df, "key", "t", 3, digits=1)):
        got = Counter((r["key"], r["t"]) for r in out.collect())
        assert got == Counter(rows)
    parts = SP.stratified_split(df, "key", "t", digits=1).groupBy("t", "split").count().collect()
    for t in {t for _, t in rows}:
        n = sum(1 for _, u in rows if u == t)
        assert sum(r["count"] for r in parts if r["t"] == t and r["split"] == "train") == int(np.floor(0.7 * n + 0.5 + 1e-9))


def test_names_with_quotes_and_dots(spark):
    df = spark.createDataFrame([(1.0, "x", 3), (None, "y", 4), (2.0, "x", 3)], "`it's` double, `a.b` string, `c``d` int")
    assert {r["column"]: r["n_distinct"] for r in C.distinct_counts(df).collect()} == {"it's": 2, "a.b": 2, "c`d": 2}
    assert {r["column"]: r["n_missing"] for r in PR.missing_values(df).collect()} == {"it's": 1, "a.b": 0, "c`d": 0}
    assert {r["column"]: r["non_null"] for r in PR.table_info(df).collect()} == {"it's": 2, "a.b": 3, "c`d": 3}
    assert PR.describe_numeric(df).count() == 2 and PR.profile_numeric(df).count() == 2
    assert PR.profile_categorical(df, ["a.b"]).first()["top"] == "x"
    assert PR.correlation_matrix(df).count() == 4 and PR.duplicate_count(df).first()[0] == 0
    assert C.clean_table(df).count() == 2 and C.fill_median(df, ["it's"]).filter(F.col("`it's`").isNull()).count() == 0
    tagged = D.tag_samples(df, df, df.columns)
    assert D.drift_table_tagged(tagged, ["it's", "c`d"], ["a.b"]).count() == 3


def test_infinite_values_do_not_hide_drift(spark):
    rng = np.random.default_rng(5)
    ref, cur = rng.normal(0, 1, 500), rng.normal(3, 1, 500)
    cur[0], cur[1] = np.inf, -np.inf
    t = D.tag_samples(*[spark.createDataFrame(pd.DataFrame({"x": x})) for x in (ref, cur)], ["x"])
    assert D.method_table_tagged(t, ["x"], "psi").first()["statistic"] > 1
    assert D.method_table_tagged(t, ["x"], "wasserstein_norm").first()["statistic"] > 1
    aside = {r["_side"]: (r["n_missing"], r["n_infinite"]) for r in D.set_aside(t, ["x"]).collect()}
    assert aside == {0: (0, 0), 1: (0, 2)}


def test_counts_above_two_to_the_63(spark):
    bins = spark.createDataFrame([("c", "a", 4_000_000_000, 4_000_100_000), ("c", "b", 4_000_000_000, 3_999_900_000)],
                                 "column string, bin string, n_ref long, n_cur long")
    m = D.share_measures(bins).first()
    assert m["chisquare"] > 0 and m["n_ref"] == 8_000_000_000
    f = S.fisher_table(bins).first()
    assert abs(f["p_value"] - S.chi2_sf(m["chisquare"], 1)) < 1e-4 and f["statistic"] < 1


def test_tails_converge_or_say_so():
    assert abs(S.chi2_sf(1e8, 1e8) - 0.5) < 1e-4
    for dof in (19_999, 20_001):  # the series and the limit meet
        assert abs(S.chi2_sf(dof + 300, dof) - 0.0673) < 1e-3
    assert abs(S.chi2_sf(20_300, 20_000) - S.chi2_sf(20_300.0001, 20_000.0001)) < 1e-5
    assert abs(S.t_two_sided(1.5, 9.9e6) - S.t_two_sided(1.5, 1.1e7)) < 1e-6
    assert abs(S.fisher_two_sided(100, 0, 0, 100) / 2.208760693e-59 - 1) < 1e-6


def test_curves_refuse_rows_without_a_label(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.2), (None, 0.5)], "label int, score double")
    with pytest.raises(ValueError):
        EV.roc_auc(df)


def test_a_split_does_not_gather_a_class_in_one_task(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
            "spark.sql.shuffle.partitions": "64"}
    before = {k: spark.conf.get(k) for k in conf}
    rows = [(i, "a" if i % 10 else None) for i in range(20_000)] + [(None, "a")] * 3 + [(7, "b")] * 5
    df = spark.createDataFrame(rows, "key long, t string")
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = SP.stratified_split(df, "key", "t").withColumn("task", F.spark_partition_id()).toPandas()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert out.groupby("task").size().max() < len(rows) / 8
    assert out.groupby(["t", "split"], dropna=False).size().sum() == len(rows)
    assert (out[out["t"] == "a"]["split"] == "train").sum() == int(np.floor(0.7 * 18_003 + 0.5))


def test_sparse_parts_of_one_class_spread_over_the_tasks(spark, tmp_path):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
            "spark.sql.shuffle.partitions": "32"}
    before = {k: spark.conf.get(k) for k in conf}
    n = 4_000
    spark.createDataFrame([(i, 1, i % 50, i % 7, "N") for i in range(n)], "l_orderkey long, l_linenumber int, "
                          "l_partkey long, l_suppkey long, l_returnflag string").write.parquet(f"{tmp_path}/lineitem.parquet")
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        _, train = q_prep._parts(spark, str(tmp_path))
        tasks = [r["count"] for r in train.groupBy(F.spark_partition_id()).count().collect()]
        got = q_prep.one_hot_sparse(spark, str(tmp_path)).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(tasks) == round(0.7 * n) and max(tasks) < n / 8
    want = {str(v): k for k, v in enumerate(sorted(map(str, range(50))))}
    assert len(got) == n and all((r["size"], r.first_one, r.last_one) == (57, want[str(r.l_orderkey % 50)], 50 + r.l_orderkey % 7)
                                 for r in got)
