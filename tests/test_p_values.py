"""p-values of the Anderson-Darling, Cramer-von Mises and MMD tests: published points, brute force, null and shift."""

import itertools
import math
import random

import numpy as np
import pytest

from tablesmith.functions import stats as S
from tablesmith.operators import drift as D


def test_harmonic_sums_join_smoothly():
    for power in (1, 2):
        exact = math.fsum(1 / i ** power for i in range(1, 12_001))
        assert abs(S.harmonic(12_000, power) - exact) < 1e-12


def test_anderson_sigma_by_the_double_sum():
    for n, m in ((3, 4), (20, 7), (150, 90)):
        total, k = n + m, 2
        hh, h = 1 / n + 1 / m, sum(1 / i for i in range(1, total))
        g = sum(1 / ((total - i) * j) for i in range(1, total - 1) for j in range(i + 1, total))
        a = (4 * g - 6) * (k - 1) + (10 - 6 * g) * hh
        b = (2 * g - 4) * k ** 2 + 8 * h * k + (2 * g - 14 * h - 4) * hh - 8 * h + 4 * g - 6
        c = (6 * h + 2 * g - 2) * k ** 2 + (4 * h - 4 * g + 6) * k + (2 * h - 6) * hh + 4 * h
        d = (2 * h + 6) * k ** 2 - 4 * h * k
        want = math.sqrt((a * total ** 3 + b * total ** 2 + c * total + d) / ((total - 1) * (total - 2) * (total - 3)))
        assert abs(S.anderson_sigma(n, m) - want) < 1e-12
    assert 0.75 < S.anderson_sigma(1e10, 2e10) < 0.77  # limit: 2 (pi^2 - 9) / 3 is the variance
    assert abs(S.anderson_sigma(1e10, 2e10) ** 2 - 2 * (math.pi ** 2 - 9) / 3) < 1e-6
    assert math.isnan(S.anderson_p(1.0, 1, 1))


def test_anderson_p_at_the_published_points():
    n, m = 500, 700
    for level, point in zip(S.ANDERSON_LEVELS, S.ANDERSON_POINTS):
        assert abs(S.anderson_p(1 + point * S.anderson_sigma(n, m), n, m) / level - 1) < 0.06
    assert S.anderson_p(40.0, n, m) == 0.001 and S.anderson_p(0.2, n, m) == 0.25


@pytest.mark.parametrize("point, level", [(0.11888, 0.5), (0.34730, 0.1), (0.46136, 0.05), (0.74346, 0.01), (1.16786, 0.001)])
def test_cvm_limit_at_the_published_points(point, level):
    assert abs(S.cvm_sf(point) - level) < 2e-5


def test_cvm_limit_ends():
    assert S.cvm_sf(0.0) == 1.0 and S.cvm_sf(1e-3) > 0.999999 and S.cvm_sf(11.9) < 1e-12 and S.cvm_sf(1e6) == 0.0


def test_cvm_moments_over_all_deals_with_ties(spark):
    values = [1, 1, 1, 2, 3, 3, 5, 8]
    n, size = 3, 8

    def statistic(chosen):
        ref = [values[i] for i in chosen]
        cur = [values[i] for i in range(size) if i not in chosen]
        return n * 5 / size ** 2 * sum((sum(x <= v for x in ref) / n - sum(x <= v for x in cur) / 5) ** 2 for v in values)

    every = [statistic(c) for c in itertools.combinations(range(size), n)]
    mean, variance = np.mean(every), np.var(every)
    rows = [("v", int(i not in (0, 3, 6)), float(v)) for i, v in enumerate(values)]
    got = D.cumulative_measures(spark.createDataFrame(rows, "column string, _side int, value double"), cvm_test=True).first()
    want = statistic((0, 3, 6))
    assert abs(got["cramer_von_mises"] - want) < 1e-12
    assert abs(got["cvm_scaled"] - (1 / 6 + (want - mean) / math.sqrt(45 * variance))) < 1e-9


def sides(spark, shift, seed, n=3000):
    rng = random.Random(seed)
    rows = [(k, k % 2, rng.gauss(0, 1) + shift * (k % 2), float(rng.randrange(4)), 7.0) for k in range(n)]
    return D.resampling_blocks(spark.createDataFrame(rows, "key long, _side int, x double, few double, same double"), ["key"])


@pytest.mark.parametrize("method", ["anderson", "cramer_von_mises", "mmd"])
def test_null_and_shift_are_told_apart(spark, method):
    p = {}
    for shift in (0.0, 0.3):
        found = D.method_table_tagged(sides(spark, shift, 11), ["x", "few", "same"], method).collect()
        p[shift] = {r["column"]: r["p_value"] for r in found}
    assert p[0.0]["x"] > 0.05 and p[0.3]["x"] < 0.01
    assert p[0.0]["few"] > 0.05 and p[0.3]["few"] > 0.05
    assert p[0.3]["same"] is None or p[0.3]["same"] > 0.05


def test_mmd_p_values_are_spread_under_no_drift(spark):
    from functools import reduce
    tagged = [sides(spark, 0.0, s, 600).selectExpr("_side", "_block", f"x as x{s}", "key") for s in range(12)]
    wide = reduce(lambda a, b: a.join(b, ["key", "_side", "_block"]), tagged)
    p = [r["p_value"] for r in D.method_table_tagged(wide, [f"x{s}" for s in range(12)], "mmd").collect()]
    assert len(p) == 12 and sum(x < 0.05 for x in p) <= 3 and sum(x > 0.5 for x in p) >= 2


def test_one_empty_side_has_no_p_value(spark):
    one = sides(spark, 0.0, 3).filter("_side = 0")
    for method in ("anderson", "cramer_von_mises", "mmd"):
        assert [r["p_value"] for r in D.method_table_tagged(one, ["x"], method).collect()] in ([None], [])
