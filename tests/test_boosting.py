"""Boosted trees against a plain numpy version, ordered statistics against a loop, saving, awkward rows."""

import hashlib
import math
import random

import numpy as np
import pytest

from tablesmith.operators import boosting as B

P = B.BoostingParams(trees=4, depth=3, bins=8, rate=0.5)


def frame(spark, n=400, seed=1):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        x, c = rng.gauss(0, 1), rng.choice(["a", "b", "b", "b", None])
        y = None if k % 50 == 0 else int(x + (c == "a") + rng.gauss(0, 0.7) > 0.3)
        rows.append((k, y, None if k % 7 == 0 else x, float("nan") if k % 11 == 0 else float(k % 3), c, 5.0))
    return spark.createDataFrame(rows, "id long, y int, x double, z double, c string, same double"), rows


def plain_statistics(rows, column, params):
    known = [r for r in rows if r[1] is not None]
    prior = sum(r[1] for r in known) / len(known)
    seen, out = {}, {}
    for r in sorted(known, key=lambda r: hashlib.md5(f"{r[0]}:{params.seed}".encode()).hexdigest()):
        total, n = seen.get(r[column], (0, 0))
        out[r[0]] = (total + params.prior_weight * prior) / (n + params.prior_weight)
        seen[r[column]] = total + r[1], n + 1
    return out, prior, seen


def plain_fit(values, y, params):
    """values: list of feature columns with nan for missing; returns trees as {node: (feature, bin, left, gain, weight)}."""
    cuts = []
    for v in values:
        some = v[~np.isnan(v)]
        cuts.append(sorted({float(np.quantile(some, k / params.bins)) for k in range(1, params.bins)}))
    bins = [np.where(np.isnan(v), -1, [sum(c < x for c in k) for x in v]) for v, k in zip(values, cuts)]
    margin, trees = np.full(len(y), math.log(params.base / (1 - params.base))), []
    score = lambda g, h: g * g / (h + params.l2)
    for _ in range(params.trees):
        p = 1 / (1 + np.exp(-margin))
        g, h, tree = p - y, p * (1 - p), {}

        def grow(number, here, depth):
            G, H = g[here].sum(), h[here].sum()
            best = None
            if depth < params.depth:
                for f, b in enumerate(bins):
                    for t in sorted(set(b[here]) - {-1}):
                        for left in (False, True):
                            goes = np.where(b < 0, left, b <= t) & here
                            hl = h[goes].sum()
                            if hl < params.least_hessian or H - hl < params.least_hessian:
                                continue
                            gain = (score(g[goes].sum(), hl) + score(G - g[goes].sum(), H - hl) - score(G, H)) / 2
                            if gain > 1e-12 and (best is None or gain > best[0] + 1e-9):
                                best = gain, f, t, left, goes
            tree[number] = (*(best[1:4] if best else (None, None, False)), best and best[0], -G / (H + params.l2))
            if best:
                grow(2 * number, best[4], depth + 1)
                grow(2 * number + 1, here & ~best[4], depth + 1)
            else:
                margin[here] += params.rate * -G / (H + params.l2)
        grow(1, np.ones(len(y), dtype=bool), 0)
        trees.append(tree)
    return cuts, trees, 1 / (1 + np.exp(-margin))


def test_trees_equal_the_plain_version(spark):
    df, rows = frame(spark)
    model = B.fit_boosted_trees(df, "id", "y", ["x", "z", "same"], ["c"], P)
    known = [r for r in rows if r[1] is not None]
    stats, prior, seen = plain_statistics(rows, 4, P)
    number = lambda v: math.nan if v is None else v
    columns = [np.array([number(r[i]) for r in known]) for i in (2, 3, 5)] + [np.array([stats[r[0]] for r in known])]
    cuts, trees, _ = plain_fit(columns, np.array([r[1] for r in known], dtype=float), P)
    for a, b in zip(model.cuts, cuts):
        assert np.allclose(a, b)
    assert len(model.trees) == len(trees)
    for got, want in zip(model.trees, trees):
        assert sorted(got) == sorted(want)
        for k, node in got.items():
            f, t, left, gain, weight = want[k]
            assert (node.feature, node.bin, node.missing_left) == (f, t, left)
            assert abs(node.weight - weight) < 1e-9 and (gain is None or abs(node.gain - gain) < 1e-9)
    assert model.prior == prior
    encodings = {(r["feature"], r["category"]): (r["sum"], r["n"]) for r in model.encodings.collect()}
    assert encodings == {(0, "missing" if c is None else "=" + c): v for c, v in seen.items()}


def test_scores_learn_and_survive_saving(spark, tmp_path):
    df, rows = frame(spark)
    model = B.fit_boosted_trees(df, "id", "y", ["x", "z"], ["c"], P)
    odd = spark.createDataFrame([(900, None, None, None, "unseen", None), (901, 1, float("inf"), -1.0, "a", None)], df.schema)
    scored = model.transform(df.unionByName(odd), "p")
    assert scored.columns == [*df.columns, "p"]
    p = {r["id"]: r["p"] for r in scored.collect()}
    assert len(p) == len(rows) + 2 and all(0 < v < 1 for v in p.values())
    loss = -np.mean([math.log(p[r[0]] if r[1] else 1 - p[r[0]]) for r in rows if r[1] is not None])
    assert loss < 0.6
    model.save(str(tmp_path / "m"))
    again = B.BoostedTrees.load(spark, str(tmp_path / "m"))
    assert {r["id"]: r["p"] for r in again.transform(df, "p").collect()} == {k: v for k, v in p.items() if k < 900}
    assert again.importance() == model.importance() and model.importance()["x"] > model.importance()["z"]


def test_no_rows_and_one_class(spark):
    df, _ = frame(spark, 60)
    none = B.fit_boosted_trees(df.limit(0), "id", "y", ["x"], ["c"], P)
    assert none.trees == [] and {r["p"] for r in none.transform(df, "p").collect()} == {0.5}
    ones = B.fit_boosted_trees(df.filter("y = 1"), "id", "y", ["x"], ["c"], P)
    assert all(len(t) == 1 for t in ones.trees) and ones.trees[0][1].weight > 0
    assert all(r["p"] > 0.5 for r in ones.transform(df, "p").collect())


def test_a_level_is_one_aggregate_without_joins(spark):
    df, _ = frame(spark)
    rows = df.selectExpr("1 as _at", "0.5 - y as _g", "0.25 as _h", "cast(z as int) as _b0", "1 as _b1")
    plan = B.histogram(rows, 2)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("gain", [0.0, 1e9])
def test_least_gain_stops_splits(spark, gain):
    df, _ = frame(spark)
    model = B.fit_boosted_trees(df, "id", "y", ["x"], [], B.BoostingParams(trees=1, depth=2, least_gain=gain))
    assert (len(model.trees[0]) == 1) == (gain > 1)
