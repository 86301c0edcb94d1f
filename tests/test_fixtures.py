"""Hand-made frames (nulls, NaN, inf, ties, constant/unique columns, tiny classes) against brute force."""

import hashlib
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tablesmith.functions import cumulative as CU
from tablesmith.operators import clean as C
from tablesmith.operators import drift as D
from tablesmith.operators import evaluate as EV
from tablesmith.operators import prep as P
from tablesmith.operators import profile as PR
from tablesmith.operators import split as SP
from tablesmith.operators import validate as V

NAN, INF = float("nan"), float("inf")


@pytest.fixture(scope="module")
def mess(spark):
    rows = [(1, 1, None, 1.0, "a"), (2, 1, None, NAN, "b"), (3, 1, None, INF, None),
            (4, 1, None, -INF, "a"), (5, 1, None, None, "c"), (6, 1, None, 2.0, "d")]
    return spark.createDataFrame(rows, "id long, const int, allnull double, x double, cat string")


def test_constant_and_unique(mess):
    assert C.constant_columns(mess) == ["const"]
    assert C.unique_columns(C.drop_constant_columns(mess)) == ["id"]
    nd = {r["column"]: r["n_distinct"] for r in C.distinct_counts(mess).collect()}
    assert nd == {"id": 6, "const": 1, "allnull": 0, "x": 4, "cat": 4}


def test_clean_order(mess):
    # the all-null column stays (0 distinct values), so every row has a missing value
    assert C.clean_table(mess).count() == 0
    out = C.clean_table(mess.drop("allnull")).toPandas()
    assert list(out.columns) == ["x", "cat"] and sorted(out["x"].tolist()) == [1.0, 2.0]


def test_inf_and_missing(mess):
    x = C.inf_to_null(mess).select("x").toPandas()["x"]
    assert x.isna().sum() == 4
    mv = {r["column"]: r["n_missing"] for r in PR.missing_values(mess).collect()}
    assert mv == {"id": 0, "const": 0, "allnull": 6, "x": 2, "cat": 1}


def test_repair_rate_median_before_abs(spark):
    df = spark.createDataFrame([(1, 0.0), (2, None), (3, -5.0), (4, 10.0), (5, 20.0)], "k int, r double")
    out = {r["k"]: r["r"] for r in C.repair_rate(df, "r").collect()}
    assert out == {1: 10.0, 2: 10.0, 3: 5.0, 4: 10.0, 5: 20.0}


def test_fences_strict(spark):
    vals = [0.0, 10.0, 10.0, 10.0, 20.0, 20.0, 20.0, 30.0, 30.0, 100.0, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "k int, v double")
    arr = np.array([v for v in vals if v is not None])
    lo, hi = np.quantile(arr, 0.25), np.quantile(arr, 0.75)
    f_lo, f_hi = lo - 1.5 * (hi - lo), hi + 1.5 * (hi - lo)
    kept = C.remove_outliers(df, ["v"], 0.25, 0.75).toPandas()
    want = [v for v in vals if v is None or (f_lo <= v <= f_hi)]
    assert sorted(kept["v"].fillna(-1).tolist()) == sorted([-1 if v is None else v for v in want])
    rep = C.outlier_report(df, ["v"], 0.25, 0.75).first()
    assert (rep["rows_before"], rep["rows_after"]) == (len(vals), len(want))


def test_validation_first_failure(spark):
    df = spark.createDataFrame(
        [(1, 1, "x", "a", 5, 1, 3), (2, 2, "y", None, 50, None, 4)],
        "undeclared int, wrongtype int, badenum string, nullenum string, outrange int, nullrange int, minonly int")
    schema = {"wrongtype": {"type": "float"},
              "badenum": {"type": "string", "constraints": {"enum": ["x"]}},
              "nullenum": {"type": "string", "constraints": {"enum": ["a"]}},
              "outrange": {"type": "integer", "constraints": {"min": 0, "max": 10}},
              "nullrange": {"type": "integer", "constraints": {"min": 0, "max": 10}},
              "minonly": {"type": "integer", "constraints": {"min": 100}}}
    st = {r["column"]: r["status"] for r in V.validate_schema(df, schema).collect()}
    assert st == {"undeclared": "Column missing in schema", "wrongtype": "Incorrect dtype: expected float, got int",
                  "badenum": "Invalid categorical values", "nullenum": "Invalid categorical values",
                  "outrange": "Out of range: [0, 10]", "nullrange": "Out of range: [0, 10]", "minonly": "Valid"}
    assert V.validated_table(df, schema).count() == 0
    assert V.validated_table(df.select("minonly"), {"minonly": {"type": "integer"}}).count() == 2


def _md5_rank(keys, seed):
    return sorted(keys, key=lambda k: hashlib.md5(f"{k}:{seed}".encode()).hexdigest())


def test_split_small_classes(spark):
    sizes = {"a": 1, "b": 2, "c": 7, "d": 100}
    rows, k = [], 0
    for cls, n in sizes.items():
        for _ in range(n):
            rows.append((k, cls))
            k += 1
    df = spark.createDataFrame(rows, "key long, t string")
    got = {r["key"]: r["split"] for r in SP.stratified_split(df, "key", "t", digits=1).collect()}
    for cls, n in sizes.items():
        keys = _md5_rank([r[0] for r in rows if r[1] == cls], 42)
        c1 = int(math.floor(0.7 * n + 0.5 + 1e-9))
        c2 = int(math.floor(0.85 * n + 0.5 + 1e-9))
        want = {kk: ("train" if i < c1 else "val" if i < c2 else "test") for i, kk in enumerate(keys)}
        assert {kk: got[kk] for kk in keys} == want
    folds = SP.stratified_folds(df, "key", "t", k=10, digits=1).groupBy("t", "fold").count().toPandas()
    for cls, g in folds.groupby("t"):
        assert g["count"].max() - (g["count"].min() if len(g) == 10 else 0) <= 1


def test_running_totals_two_level(spark):
    rng = np.random.default_rng(1)
    vals = np.round(rng.lognormal(3, 1.5, 3000), 1)
    vals[:1000] = 7.0  # a hot value: a third of the rows
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 3000).astype(str), "v": vals})
    long = spark.createDataFrame(pdf).withColumnRenamed("v", "value")
    dv = CU.distinct_value_counts(long, ["g"])
    rt = CU.running_totals(dv, ["g"], "value", ["n"], with_next=True, buckets=12).toPandas()
    for g, part in pdf.groupby("g"):
        vc = part["v"].value_counts().sort_index()
        got = rt[rt["g"] == g].sort_values("value")
        assert got["cum_n"].tolist() == vc.cumsum().tolist()
        assert got["_next"].tolist()[:-1] == vc.index.tolist()[1:]
    q = CU.exact_quantiles(long, ["g"], [0.0, 0.1, 0.5, 0.77, 1.0], buckets=8).toPandas()
    for _, r in q.iterrows():
        want = np.quantile(pdf[pdf["g"] == r["g"]]["v"].to_numpy(), r["prob"])
        assert abs(r["quantile"] - want) < 1e-9


def _drift(spark, a, b, method, kind="num"):
    ref = spark.createDataFrame(pd.DataFrame({"x": a}))
    cur = spark.createDataFrame(pd.DataFrame({"x": b}))
    return D.method_table(ref, cur, ["x"], method, kind).first()["statistic"]


def test_drift_identical_is_zero(spark):
    a = np.random.default_rng(2).normal(0, 1, 500).round(2)
    for m in ["psi", "kl_div", "jensenshannon", "tvd", "ks", "wasserstein", "cramer_von_mises", "chisquare",
              "g_test", "mmd", "z", "t_test"]:
        assert abs(_drift(spark, a, a, m)) < 1e-9, m


def test_drift_brute_force(spark):
    rng = np.random.default_rng(3)
    a = rng.integers(0, 40, 300).astype(float)
    b = rng.integers(5, 45, 200).astype(float)
    z = np.unique(np.concatenate([a, b]))
    fa = np.array([(a <= v).mean() for v in z])
    fb = np.array([(b <= v).mean() for v in z])
    assert abs(_drift(spark, a, b, "ks") - np.abs(fa - fb).max()) < 1e-12
    w = np.sum(np.abs(fa - fb)[:-1] * np.diff(z)) / max(a.std(), 0.001)
    assert abs(_drift(spark, a, b, "wasserstein_norm") - w) < 1e-9
    n, m = len(a), len(b)
    N = n + m
    l = np.array([(a == v).sum() + (b == v).sum() for v in z])
    cvm = n * m / N ** 2 * np.sum(l * (fa - fb) ** 2)
    assert abs(_drift(spark, a, b, "cramer_von_mises") - cvm) < 1e-9
    # Anderson-Darling k-sample with midranks, written out term by term
    total = 0.0
    for s, ni in ((a, n), (b, m)):
        inner = 0.0
        for j, v in enumerate(z):
            lj = l[j]
            bj = (np.concatenate([a, b]) <= v).sum() - lj / 2
            mij = (s <= v).sum() - (s == v).sum() / 2
            den = bj * (N - bj) - N * lj / 4
            if den > 0:
                inner += lj * (N * mij - ni * bj) ** 2 / den
        total += inner / ni
    assert abs(_drift(spark, a, b, "anderson") - (N - 1) / N ** 2 * total) < 1e-6
    t_want = (a.mean() - b.mean()) / math.sqrt(((n - 1) * a.var(ddof=1) + (m - 1) * b.var(ddof=1)) / (n + m - 2)
                                               * (1 / n + 1 / m))
    assert abs(_drift(spark, a, b, "t_test") - t_want) < 1e-9


def test_share_measures_symmetry_and_shift(spark):
    a = ["x"] * 50 + ["y"] * 30 + ["z"] * 20
    b = ["x"] * 20 + ["y"] * 30 + ["w"] * 50
    p = {"x": .5, "y": .3, "z": .2, "w": 0.0}
    q = {"x": .2, "y": .3, "z": 0.0, "w": .5}
    ff = lambda v: v if v > 0 else 1e-4
    psi = sum((ff(q[k]) - ff(p[k])) * math.log(ff(q[k]) / ff(p[k])) for k in p)
    assert abs(_drift(spark, a, b, "psi", "cat") - psi) < 1e-12
    assert abs(_drift(spark, a, b, "tvd", "cat") - 0.5 * sum(abs(p[k] - q[k]) for k in p)) < 1e-12
    js_ab, js_ba = _drift(spark, a, b, "jensenshannon", "cat"), _drift(spark, b, a, "jensenshannon", "cat")
    assert abs(js_ab - js_ba) < 1e-12 and js_ab > 0.1


def test_drift_table_detects_shift(spark):
    rng = np.random.default_rng(4)
    ref = spark.createDataFrame(pd.DataFrame({"v": rng.normal(100, 10, 2000), "c": rng.choice(list("ab"), 2000)}))
    cur = spark.createDataFrame(pd.DataFrame({"v": rng.normal(100, 10, 2000) * 1.2, "c": rng.choice(list("ab"), 2000)}))
    t = {r["column"]: r["drifted"] for r in D.drift_table(ref, cur, ["v"], ["c"]).collect()}
    assert t == {"v": True, "c": False}
    s = D.drift_summary(D.drift_table(ref, cur, ["v"], ["c"])).first()
    assert s["n_drifted"] == 1 and s["dataset_drift"]


def test_encode_unseen_and_null(spark):
    train = spark.createDataFrame([("a",), ("b",), ("b",)], "c string")
    apply = spark.createDataFrame([(1, "a"), (2, "z"), (3, None)], "k int, c string")
    oh = {r["k"]: (r["c_a"], r["c_b"]) for r in P.one_hot(train, apply, ["c"]).collect()}
    assert oh == {1: (1.0, 0.0), 2: (0.0, 0.0), 3: (0.0, 0.0)}
    df = P.one_hot(train, apply, ["c"], drop_first=True)
    assert df.columns == ["k", "c_b"]
    le = {r["k"]: r["c"] for r in P.label_encode(train, apply, ["c"]).collect()}
    assert le == {1: 0, 2: None, 3: None}
    mode = {r["k"]: r["c"] for r in P.impute_mode(train, apply, ["c"]).collect()}
    assert mode[3] == "b"


def test_scale_population_std_and_constant(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0), (6.0, 5.0)], "x double, k double")
    out = P.standard_scale(df, df, ["x", "k"]).toPandas()
    x = np.array([1, 2, 3, 6.0])
    assert np.allclose(out["x"], (x - x.mean()) / x.std())
    assert out["k"].tolist() == [0.0] * 4


def _auc_brute(lab, sc):
    pos = [s for l, s in zip(lab, sc) if l == 1]
    neg = [s for l, s in zip(lab, sc) if l != 1]
    tot = sum((1.0 if p > n else 0.5 if p == n else 0.0) for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


def test_scores_auc_and_pr(spark):
    rng = np.random.default_rng(5)
    lab = rng.integers(0, 2, 400).tolist()
    sc = (np.round(rng.uniform(0, 1, 400), 1) * 0.5 + np.array(lab) * 0.3).round(2).tolist()  # many ties
    df = spark.createDataFrame(list(zip(lab, sc)), "label int, score double")
    auc = EV.roc_auc(df).first()[0]
    assert abs(auc - _auc_brute(lab, sc)) < 1e-12
    neg = EV.roc_auc(df.withColumn("score", -F.col("score"))).first()[0]
    assert abs(neg - (1 - auc)) < 1e-12
    # precision-recall trapezoid from (recall 0, precision 1)
    pts = [(1.0, 0.0)]
    for t in sorted(set(sc), reverse=True):
        tp = sum(1 for l, s in zip(lab, sc) if s >= t and l == 1)
        fp = sum(1 for l, s in zip(lab, sc) if s >= t and l != 1)
        pts.append((tp / (tp + fp), tp / sum(lab)))
    want = sum((pts[i][1] - pts[i - 1][1]) * (pts[i][0] + pts[i - 1][0]) / 2 for i in range(1, len(pts)))
    assert abs(EV.pr_auc(df).first()[0] - want) < 1e-12


def test_perfect_inverted_one_class(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.8), (0, 0.2), (0, 0.1)], "label int, score double")
    assert EV.roc_auc(df).first()[0] == 1.0
    inv = df.withColumn("score", 1 - F.col("score"))
    assert EV.roc_auc(inv).first()[0] == 0.0
    one = df.filter(F.col("label") == 1)
    assert EV.roc_auc(one).first()[0] is None


def test_classification_report_manual(spark):
    lab = [0, 0, 1, 1, 1, 2, 2]
    pre = [0, 1, 1, 1, 0, 2, 1]
    df = spark.createDataFrame(list(zip(lab, pre)), "label int, prediction int")
    rep = {r["cls"]: r for r in EV.classification_report(df).collect()}
    for c in (0, 1, 2):
        tp = sum(1 for a, b in zip(lab, pre) if a == b == c)
        p = tp / sum(1 for b in pre if b == c)
        r = tp / sum(1 for a in lab if a == c)
        assert abs(rep[str(c)]["precision"] - p) < 1e-12 and abs(rep[str(c)]["recall"] - r) < 1e-12
    assert abs(rep["accuracy"]["f1"] - 4 / 7) < 1e-12


def test_p_values():
    from tablesmith.functions import stats as S
    assert abs(S.chi2_sf(3.841458820694124, 1) - 0.05) < 1e-9
    assert abs(S.t_two_sided(2.228138851986274, 10) - 0.05) < 1e-9
    assert abs(S.normal_two_sided(1.959963984540054) - 0.05) < 1e-12
    assert abs(S.fisher_two_sided(8, 2, 1, 5) - 0.03496503496503495) < 1e-12


def test_approximate_quantiles_option(spark):
    rng = np.random.default_rng(6)
    vals = rng.normal(50, 10, 5000)
    df = spark.createDataFrame(pd.DataFrame({"v": vals}))
    q = {r["prob"]: r["quantile"] for r in C.column_quantiles(df, ["v"], [0.1, 0.5, 0.9], exact=False).collect()}
    for p, v in q.items():
        # rank error of percentile_approx(accuracy 1e5) is at most n / 1e5 rows
        assert abs((vals <= v).mean() - p) <= 2 / len(vals) + 1e-5


def test_degenerate_samples_do_not_fail(spark):
    # constant columns (zero variance), a column empty in the reference, one-class labels
    ref = spark.createDataFrame([(1.0, None), (1.0, None), (1.0, None)], "c double, e double")
    cur = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "c double, e double")
    for m in ["psi", "kl_div", "jensenshannon", "tvd", "chisquare", "g_test", "ks", "wasserstein_norm", "anderson",
              "cramer_von_mises", "z", "t_test", "mmd"]:
        rows = D.method_table(ref, cur, ["c", "e"], m).collect()
        assert {r["column"] for r in rows} <= {"c", "e"}
    one = spark.createDataFrame([(1, 0.5), (1, 0.7)], "label int, score double")
    assert EV.pr_auc(one).first()[0] is not None
    assert EV.pr_auc(one.withColumn("label", F.lit(0))).first()[0] is None


def test_drift_by_tests(spark):
    # KS p-value for numeric, chi-square p-value for categorical columns
    from tablesmith.functions import stats as S
    rng = np.random.default_rng(7)
    a, b = rng.integers(0, 30, 200).astype(float), rng.integers(3, 33, 150).astype(float)
    ca, cb = rng.choice(list("xyz"), 200, p=[.5, .3, .2]), rng.choice(list("xyz"), 150, p=[.3, .3, .4])
    ref = spark.createDataFrame(pd.DataFrame({"v": a, "c": ca}))
    cur = spark.createDataFrame(pd.DataFrame({"v": b, "c": cb}))
    out = {r["column"]: r for r in D.column_drift_tagged(
        D.tag_samples(ref, cur, ["v", "c"]), ["v"], ["c"], "ks", "chisquare").collect()}
    z = np.unique(np.concatenate([a, b]))
    d = np.abs(np.array([(a <= v).mean() for v in z]) - np.array([(b <= v).mean() for v in z])).max()
    assert out["v"]["method"] == "ks" and abs(out["v"]["score"] - S.ks_two_sample_p(d, 200, 150)) < 1e-12
    cats = sorted(set(ca) | set(cb))
    obs = np.array([[np.sum(ca == k) for k in cats], [np.sum(cb == k) for k in cats]], dtype=float)
    exp_ = obs.sum(1, keepdims=True) * obs.sum(0, keepdims=True) / obs.sum()
    chi = ((obs - exp_) ** 2 / exp_).sum()
    assert out["c"]["method"] == "chisquare" and abs(out["c"]["score"] - S.chi2_sf(chi, len(cats) - 1)) < 1e-12
    assert out["c"]["drifted"] == (out["c"]["score"] < 0.05)
