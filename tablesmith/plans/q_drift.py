"""Plans for drift (D1-D17): train vs test of the stratified split of ``bookings``, the test part with a planted
shift in some columns, so that every method has columns that drift and columns that don't."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from tablesmith.functions import stats as S
from tablesmith.functions.columns import round_doubles
from tablesmith.operators import drift as D
from tablesmith.plans import sqlparts as Q
from tablesmith.plans import tables as TB
from tablesmith.plans.catalog import register

NUM = TB.NUMERIC
CAT = TB.CATEGORICAL
BY_VALUE = ("o_year",)  # few values: a bin for each


def _tagged(spark, sf_dir, cols):
    return D.side_split(TB.planted_shift(TB.bookings_split(spark, sf_dir)), "split", "train", "test", cols)


BASE = [Q.BOOKINGS, Q.split_cte(), Q.tagged_cte()]


def _method_plan(method, cols, kind):
    def plan(spark, sf_dir):
        res = D.method_table_tagged(_tagged(spark, sf_dir, cols), cols, method, kind, BY_VALUE)
        return round_doubles(res.select("column", "method", "statistic", "n_ref", "n_cur"))
    return plan


def _share_sql(method, kind):
    if kind == "num":
        ctes = BASE + [Q.nlong_cte(NUM), Q.numeric_bins_cte(), Q.share_measures_cte("nbins", "sm")]
    else:
        ctes = BASE + [Q.clong_cte(CAT), Q.categorical_bins_cte(), Q.share_measures_cte("cbins", "sm")]
    return Q.with_(*ctes) + (f"SELECT \"column\", '{method}' AS method, round({method}, 6) AS statistic, "
                             "n_ref, n_cur FROM sm")


def _cum_sql(method):
    ctes = BASE + [Q.nlong_cte(NUM), Q.cumulative_cte()]
    return Q.with_(*ctes) + (f"SELECT \"column\", '{method}' AS method, round({method}, 6) AS statistic, "
                             "n_ref, n_cur FROM cum")


for _name, _method, _kind in [("drift_psi", "psi", "num"), ("drift_kl", "kl_div", "num"),
                              ("drift_js", "jensenshannon", "cat"), ("drift_tvd", "tvd", "cat")]:
    register(_name, _share_sql(_method, _kind))(_method_plan(_method, NUM if _kind == "num" else CAT, _kind))


def _method_plan_p(method):
    def plan(spark, sf_dir):
        res = D.method_table_tagged(_tagged(spark, sf_dir, CAT), CAT, method, "cat")
        return round_doubles(res.select("column", "method", "statistic", "p_value", "dof", "n_ref", "n_cur"))
    return plan


def _even_chi2_p(stat):
    """Chi-square survival for even degrees of freedom in closed form, exp(-x/2) sum_{i<dof/2} (x/2)^i / i!; odd
    ones would need erfc, absent in DuckDB, but beyond 20 times dof the value is below 1e-6 for any dof."""
    return (f"CASE WHEN dof % 2 = 0 THEN exp(-{stat} / 2) * list_sum(list_transform(range(0, CAST(dof / 2 AS BIGINT)),"
            f" lambda i: ({stat} / 2) ^ i / exp(lgamma(i + 1)))) WHEN {stat} > 20 * dof THEN 0.0 END")


def _chi2_p_sql(method):
    ctes = BASE + [Q.clong_cte(CAT), Q.categorical_bins_cte(), Q.share_measures_cte("cbins", "sm")]
    p = _even_chi2_p(method)
    return Q.with_(*ctes) + (f"SELECT \"column\", '{method}' AS method, round({method}, 6) AS statistic, "
                             f"round({p}, 6) AS p_value, dof, n_ref, n_cur FROM sm")


register("drift_chisquare", _chi2_p_sql("chisquare"))(_method_plan_p("chisquare"))
register("drift_g", _chi2_p_sql("g_test"))(_method_plan_p("g_test"))

register("drift_wasserstein", _cum_sql("wasserstein_norm"))(_method_plan("wasserstein_norm", NUM, "num"))


def _tested(res):
    return round_doubles(res.select("column", "method", "statistic", "p_value",
                                    (F.col("p_value") < D.P_THRESHOLD).alias("drifted"), "n_ref", "n_cur"))


def _verdict_sql(method, statistic, p, source):
    return (f"SELECT \"column\", '{method}' AS method, round({statistic}, 6) AS statistic, round({p}, 6) AS p_value, "
            f"{p} < 0.05 AS drifted, n_ref, n_cur FROM {source}")


def _anderson_sql():
    """The variance with its sums over all rows' numbers, and the parabola through the published points."""
    a, b, c = S.anderson_curve()
    low, high = S.ANDERSON_LEVELS[-1], S.ANDERSON_LEVELS[0]
    return Q.with_(*BASE, Q.nlong_cte(NUM), Q.cumulative_cte(), """sizes AS (
  SELECT "column", CAST(n_ref + n_cur AS BIGINT) AS n, 1.0 / n_ref + 1.0 / n_cur AS hh FROM cum),
one AS (SELECT "column", n, hh, list_sum(list_transform(range(1, n), lambda i: 1.0::DOUBLE / i)) AS h FROM sizes),
harmonics AS (
  SELECT o."column", n, hh, h, sum((h - partial) / (n - i)) AS g
  FROM one o, LATERAL (SELECT i, sum(1.0::DOUBLE / i) OVER (ORDER BY i) AS partial FROM range(1, o.n) t(i)) p
  WHERE i <= n - 2 GROUP BY o."column", n, hh, h),
coefficients AS (
  SELECT *, (4 * g - 6) + (10 - 6 * g) * hh AS a3, (8 * g - 16) + 16 * h + (2 * g - 14 * h - 4) * hh - 8 * h + 4 * g - 6 AS a2,
         (24 * h + 8 * g - 8) + (8 * h - 8 * g + 12) + (2 * h - 6) * hh + 4 * h AS a1, (8 * h + 24) - 8 * h AS a0
  FROM harmonics),
standard AS (
  SELECT cum.*, (anderson - 1) / sqrt((a3 * n ^ 3 + a2 * n ^ 2 + a1 * n + a0) / ((n - 1.0) * (n - 2.0) * (n - 3.0))) AS x
  FROM cum JOIN coefficients USING ("column")),""" + f"""
tested AS (
  SELECT *, CASE WHEN x >= {S.ANDERSON_POINTS[-1]!r} THEN {low} WHEN x <= {S.ANDERSON_POINTS[0]!r} THEN {high}
            ELSE least(greatest(exp({a!r} + {b!r} * x + {c!r} * x * x), {low}), {high}) END AS p FROM standard)""") + \
        _verdict_sql("anderson", "anderson", "p", "tested")


@register("drift_anderson", _anderson_sql())
def drift_anderson(spark, sf_dir):
    return _tested(D.method_table_tagged(_tagged(spark, sf_dir, NUM), NUM, "anderson"))


def _cvm_sql():
    """Exact mean and variance by summing over all values, the limiting tail by the same series and quadrature."""
    return Q.with_(*BASE, Q.nlong_cte(NUM), Q.cumulative_cte(), f"""w AS (
  SELECT "column", value, CAST(l AS DOUBLE) AS l, CAST(cum_r + cum_c AS DOUBLE) AS u, n, tot_ref AS k, tot_cur AS m FROM cum_t),
before AS (
  SELECT *, coalesce(sum(l * u) OVER o, 0) AS p1, coalesce(sum(l * u * u) OVER o, 0) AS p2 FROM w
  WINDOW o AS (PARTITION BY "column" ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
central AS (
  SELECT *, u * (n - u) * k * m AS s, u * (n - u) * k * m / (n * n * (n - 1)) AS m2 FROM before),
fourth AS (
  SELECT *, m2 * (n - 2 * k) * (n - 2 * u) / (n * (n - 2)) AS m3, k * u / n AS e,
         3 * m2 * m2 + ((n - 1) * n * n * (n * (n + 1) - 6 * k * m - 6 * u * (n - u)) + 6 * s * (5 * n - 6)) * s
           / ((n - 2) * (n - 3) * n ^ 4 * (n - 1) ^ 2) AS m4 FROM central),
moments AS (
  SELECT "column", sum(l * m2) AS mean, any_value(k * m) AS km,
         sum(l * (l * m4 + CASE WHEN u > l THEN 2 * (m4 * p2 / (u * u)
               + (e * (u - e) * m2 + (u - 2 * e) * m3 - m4) * (u * p1 - p2) / (u * u * (u - 1))) ELSE 0 END)) AS square
  FROM fourth GROUP BY "column"),
scaled AS (
  SELECT cum.*, 1.0 / 6 + (cramer_von_mises - mean / km) / (sqrt(45 * (square - mean * mean)) / km) AS x
  FROM cum JOIN moments USING ("column")),
terms AS (
  SELECT "column", x, j, (4 * j + 1) ^ 2 / (16 * x) AS q, acosh(1 + 50 / ((4 * j + 1) ^ 2 / (16 * x))) / {S.CVM_POINTS} AS step
  FROM scaled, range({S.CVM_TERMS}) t(j) WHERE x > 0 AND x <= {S.CVM_LARGEST}),
series AS (
  SELECT "column", sum(exp(lgamma(j + 0.5) - lgamma(j + 1) - 2 * q) * sqrt(4 * j + 1) * step * list_sum(list_transform(
           range({S.CVM_POINTS} + 1), lambda i: (CASE WHEN i IN (0, {S.CVM_POINTS}) THEN 0.5 ELSE 1 END)
             * exp(-q * (cosh(i * step) - 1)) * cosh(i * step / 4)))) / (pi() ^ 1.5 * sqrt(any_value(x))) AS f
  FROM terms GROUP BY "column"),
tested AS (
  SELECT scaled.*, CASE WHEN x <= 0 THEN 1.0 WHEN x > {S.CVM_LARGEST} THEN 0.0 ELSE least(greatest(1 - f, 0.0), 1.0) END AS p
  FROM scaled LEFT JOIN series USING ("column"))""") + _verdict_sql("cramer_von_mises", "cramer_von_mises", "p", "tested")


@register("drift_cvm", _cvm_sql())
def drift_cvm(spark, sf_dir):
    return _tested(D.method_table_tagged(_tagged(spark, sf_dir, NUM), NUM, "cramer_von_mises"))

# KS with its p-value: the asymptotic Kolmogorov series is expressible in SQL (list lambdas)
KS_P_SQL = """CASE WHEN lam <= 0 THEN 1.0
  WHEN lam < 1.18 THEN greatest(0.0, least(1.0, 1 - sqrt(2 * pi()) / lam *
        list_sum(list_transform(range(1, 50), lambda k: exp(-((2 * k - 1) ^ 2) * pi() ^ 2 / (8 * lam * lam))))))
  ELSE greatest(0.0, least(1.0, 2 * list_sum(list_transform(range(1, 101),
        lambda k: (CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END) * exp(-2 * k * k * lam * lam))))) END"""


@register("drift_ks", Q.with_(*BASE, Q.nlong_cte(NUM), Q.cumulative_cte(),
                              "ksl AS (SELECT *, sqrt(n_ref * n_cur / (n_ref + n_cur)) * ks AS lam FROM cum)") +
          f"""SELECT "column", 'ks' AS method, round(ks, 6) AS statistic, round({KS_P_SQL}, 6) AS p_value, n_ref, n_cur
FROM ksl""")
def drift_ks(spark, sf_dir):
    res = D.method_table_tagged(_tagged(spark, sf_dir, NUM), NUM, "ks", "num")
    return round_doubles(res.select("column", "method", "statistic", "p_value", "n_ref", "n_cur"))


MOMENTS_SQL = Q.with_(*BASE, Q.nlong_cte(NUM), """mom AS (
  SELECT "column",
         CAST(sum(CASE WHEN _side = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS n0,
         CAST(sum(CASE WHEN _side = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS n1,
         avg(CASE WHEN _side = 0 THEN value END) AS m0, avg(CASE WHEN _side = 1 THEN value END) AS m1,
         var_samp(CASE WHEN _side = 0 THEN value END) AS v0, var_samp(CASE WHEN _side = 1 THEN value END) AS v1,
         sum(CASE WHEN value NOT IN (0.0, 1.0) THEN 1 ELSE 0 END) AS nonbinary
  FROM nlong GROUP BY "column")""")


@register("drift_z", MOMENTS_SQL + """
SELECT "column", 'z' AS method,
       round(CASE WHEN nonbinary = 0
                  THEN (m0 - m1) / sqrt(((m0 * n0 + m1 * n1) / (n0 + n1)) * (1 - (m0 * n0 + m1 * n1) / (n0 + n1))
                                        * (1 / n0 + 1 / n1))
                  ELSE (m0 - m1) / sqrt(v0 / n0 + v1 / n1) END, 6) AS statistic,
       CAST(n0 AS BIGINT) AS n_ref, CAST(n1 AS BIGINT) AS n_cur
FROM mom""")
def drift_z(spark, sf_dir):
    return _method_plan("z", NUM, "num")(spark, sf_dir)


@register("drift_t", MOMENTS_SQL + """
SELECT "column", 't_test' AS method,
       round((m0 - m1) / sqrt(((n0 - 1) * v0 + (n1 - 1) * v1) / (n0 + n1 - 2) * (1 / n0 + 1 / n1)), 6) AS statistic,
       CAST(n0 AS BIGINT) AS n_ref, CAST(n1 AS BIGINT) AS n_cur
FROM mom""")
def drift_t(spark, sf_dir):
    return _method_plan("t_test", NUM, "num")(spark, sf_dir)


def _mmd_sql():
    """Feature sums per block of rows (by the md5 of the key), the statistic and its replicates from these."""
    w, b = D.mmd_weights()
    dims = range(D.MMD_FEATURES)
    scale2 = 2.0 / D.MMD_FEATURES
    features = ", ".join(f"sum(cos({w[d]!r} * value / _sigma + {b[d]!r})) AS s{d}" for d in dims)
    plain = " + ".join(f"(r.s{d} / r.n - c.s{d} / c.n) ^ 2" for d in dims)
    centred = " + ".join(f"((r.s{d} / r.n - tr.s{d} / tr.n) - (c.s{d} / c.n - tc.s{d} / tc.n)) ^ 2" for d in dims)
    sums = ", ".join(f"sum(s{d}) AS s{d}" for d in dims)
    weighed = ", ".join(f"sum(wt * s{d}) AS s{d}" for d in dims)
    weight = " + ".join(f"CAST(u >= {step!r} AS INTEGER)" for step in D.POISSON_STEPS)
    unpivot = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in NUM)
    return Q.with_(*BASE, f"""nlong AS (
  SELECT "column", _side, _block, value FROM (UNPIVOT (
    SELECT _side, CAST('0x' || substr(md5(CAST({TB.KEY} AS VARCHAR)), 1, 2) AS INTEGER) AS _block, {unpivot} FROM tagged)
    ON {", ".join(NUM)} INTO NAME "column" VALUE value) WHERE value IS NOT NULL AND isfinite(value)),
med AS (SELECT "column", quantile_cont(value, 0.5) AS _med FROM nlong GROUP BY "column"),
mad AS (SELECT l."column", quantile_cont(abs(value - _med), 0.5) AS _mad
  FROM nlong l JOIN med m ON l."column" = m."column" GROUP BY l."column"),
blocks AS MATERIALIZED (SELECT "column", _side, _block, CAST(count(*) AS DOUBLE) AS n, {features}
  FROM (SELECT l.*, CASE WHEN _mad > 0 THEN _mad ELSE 1.0 END AS _sigma
        FROM nlong l JOIN mad m ON l."column" = m."column") GROUP BY 1, 2, 3),
total AS (SELECT "column", _side, sum(n) AS n, {sums} FROM blocks GROUP BY 1, 2),
observed AS (SELECT r."column", ({plain}) * {scale2!r} AS mmd, CAST(r.n AS BIGINT) AS n_ref, CAST(c.n AS BIGINT) AS n_cur
  FROM total r JOIN total c ON r."column" = c."column" AND r._side = 0 AND c._side = 1),
drawn AS (SELECT rep, _side, _block, CAST('0x' || substr(md5(rep || '|' || _side || '|' || _block), 1, 8) AS BIGINT)
              / CAST(4294967296 AS DOUBLE) AS u
  FROM range(1, {D.MMD_REPLICATES + 1}) r(rep), range(2) s(_side), range({D.MMD_BLOCKS}) k(_block)),
resampled AS MATERIALIZED (SELECT "column", b._side, rep, sum(wt * n) AS n, {weighed}
  FROM blocks b JOIN (SELECT *, {weight} AS wt FROM drawn) d ON b._side = d._side AND b._block = d._block GROUP BY 1, 2, 3),
null_values AS (SELECT r."column", r.rep, ({centred}) * {scale2!r} AS mmd
  FROM resampled r JOIN resampled c ON r."column" = c."column" AND r.rep = c.rep AND r._side = 0 AND c._side = 1
  JOIN total tr ON tr."column" = r."column" AND tr._side = 0 JOIN total tc ON tc."column" = r."column" AND tc._side = 1),
tested AS (SELECT o."column", any_value(o.mmd) AS mmd, any_value(n_ref) AS n_ref, any_value(n_cur) AS n_cur,
       (1.0 + count(*) FILTER (WHERE v.mmd >= o.mmd)) / (count(v.mmd) + 1) AS p
  FROM observed o JOIN null_values v ON o."column" = v."column" GROUP BY 1)""") + _verdict_sql("mmd", "mmd", "p", "tested")


@register("drift_mmd", _mmd_sql())
def drift_mmd(spark, sf_dir):
    split = D.resampling_blocks(TB.planted_shift(TB.bookings_split(spark, sf_dir)), [TB.KEY])
    return _tested(D.method_table_tagged(D.side_split(split, "split", "train", "test", [*NUM, D.BLOCK]), NUM, "mmd"))


def _fisher_sql(col):
    return Q.with_(*BASE, f"""fb AS (
  SELECT CAST({col} AS VARCHAR) AS bin, count(*) FILTER (WHERE _side = 0) AS n_ref,
         count(*) FILTER (WHERE _side = 1) AS n_cur
  FROM tagged WHERE {col} IS NOT NULL GROUP BY 1),
t AS (
  SELECT min_by(n_ref, bin) AS a, max_by(n_ref, bin) AS b, min_by(n_cur, bin) AS c, max_by(n_cur, bin) AS d,
         sum(n_ref) AS n_ref, sum(n_cur) AS n_cur FROM fb),
m AS (SELECT *, a + b AS r1, c + d AS r2, a + c AS c1, a + b + c + d AS n FROM t),
h AS (
  SELECT m.*, x,
         lgamma(r1 + 1) + lgamma(r2 + 1) + lgamma(c1 + 1) + lgamma(n - c1 + 1) - lgamma(n + 1)
         - (lgamma(x + 1) + lgamma(r1 - x + 1) + lgamma(c1 - x + 1) + lgamma(r2 - c1 + x + 1)) AS lp
  FROM m, range(CAST(greatest(0, c1 - r2) AS BIGINT), CAST(least(r1, c1) + 1 AS BIGINT)) AS g(x)),
o AS (SELECT lp AS lp_obs FROM h WHERE x = a)""") + f"""
SELECT '{col}' AS "column", 'fisher_exact' AS method, round(CAST(a * d AS DOUBLE) / (b * c), 6) AS statistic,
       round(least(1.0, sum(CASE WHEN lp <= lp_obs + 1e-7 THEN exp(lp) ELSE 0 END)), 6) AS p_value,
       CAST(n_ref AS BIGINT) AS n_ref, CAST(n_cur AS BIGINT) AS n_cur
FROM h, o GROUP BY a, b, c, d, n_ref, n_cur"""


FISHER_COLS = ["is_filled", "is_filled_shifted"]


@register("drift_fisher", " UNION ALL ".join(f"(SELECT * FROM ({_fisher_sql(c)}))" for c in FISHER_COLS))
def drift_fisher(spark, sf_dir):
    res = D.method_table_tagged(_tagged(spark, sf_dir, FISHER_COLS), FISHER_COLS, "fisher_exact", "cat")
    return round_doubles(res.select("column", "method", "statistic", "p_value", "n_ref", "n_cur"))


DRIFT_TABLE_SQL = Q.with_(*BASE, Q.nlong_cte(NUM), Q.numeric_bins_cte(), Q.share_measures_cte("nbins", "smn"),
                          Q.clong_cte(CAT), Q.categorical_bins_cte(), Q.share_measures_cte("cbins", "smc"),
                          """dt AS (
  SELECT "column", 'num' AS kind, 'psi' AS method, psi AS score FROM smn
  UNION ALL SELECT "column", 'cat', 'jensenshannon', jensenshannon FROM smc)""")


@register("drift_table", DRIFT_TABLE_SQL +
          "SELECT \"column\", kind, method, round(score, 6) AS score, 0.1 AS threshold, score >= 0.1 AS drifted FROM dt")
def drift_table(spark, sf_dir):
    tagged = _tagged(spark, sf_dir, NUM + CAT)
    return round_doubles(D.drift_table_tagged(tagged, NUM, CAT, by_value=BY_VALUE))


@register("drift_summary", DRIFT_TABLE_SQL + """
SELECT count(*) AS n_columns, CAST(sum(CAST(score >= 0.1 AS INTEGER)) AS BIGINT) AS n_drifted,
       round(sum(CAST(score >= 0.1 AS INTEGER)) / count(*), 6) AS share_drifted,
       sum(CAST(score >= 0.1 AS INTEGER)) / count(*) >= 0.5 AS dataset_drift
FROM dt""")
def drift_summary(spark, sf_dir):
    tagged = _tagged(spark, sf_dir, NUM + CAT)
    return round_doubles(D.drift_summary(D.drift_table_tagged(tagged, NUM, CAT, by_value=BY_VALUE)))


KS_P_SQL_LAM = re.sub(r"\blam\b", "(sqrt(n_ref * n_cur / (n_ref + n_cur)) * ks)", KS_P_SQL)


def _columns_sql(src_ctes, num_cols, cat_cols, num_method="wasserstein", cat_method="jensenshannon", target=None):
    """D16 in SQL; chi-square p-values by the closed form for even degrees of freedom."""
    parts, ctes = [], list(src_ctes)
    if num_cols:
        ctes += [Q.nlong_cte(num_cols), Q.cumulative_cte(), f"ksl AS (SELECT *, {KS_P_SQL_LAM} AS ks_p FROM cum)"]
        score, drifted, threshold = {"wasserstein": ("wasserstein_norm", "wasserstein_norm >= 0.1", 0.1),
                                     "ks": ("ks_p", "ks_p < 0.05", 0.05)}[num_method]
        parts.append(f"""SELECT "column", 'num' AS kind, '{num_method}' AS method, round({score}, 6) AS score,
       CAST({threshold} AS DOUBLE) AS threshold, {drifted} AS drifted FROM ksl""")
    if cat_cols:
        ctes += [Q.clong_cte(cat_cols), Q.categorical_bins_cte(), Q.share_measures_cte("cbins", "smc"),
                 f"smp AS (SELECT *, {_even_chi2_p('chisquare')} AS chi_p FROM smc)"]
        score, drifted, threshold = {"jensenshannon": ("jensenshannon", "jensenshannon >= 0.1", 0.1),
                                     "chisquare": ("chi_p", "chi_p < 0.05", 0.05)}[cat_method]
        kind = f"CASE WHEN \"column\" = '{target}' THEN 'target' ELSE 'cat' END"
        parts.append(f"""SELECT "column", {kind} AS kind, '{cat_method}' AS method, round({score}, 6) AS score,
       CAST({threshold} AS DOUBLE) AS threshold, {drifted} AS drifted FROM smp""")
    return Q.with_(*ctes) + "\nUNION ALL\n".join(parts)


@register("drift_columns", _columns_sql(BASE, NUM, CAT))
def drift_columns(spark, sf_dir):
    tagged = _tagged(spark, sf_dir, NUM + CAT)
    return round_doubles(D.column_drift_tagged(tagged, NUM, CAT))


@register("drift_columns_tests", _columns_sql(BASE, NUM, CAT, "ks", "chisquare"))
def drift_columns_tests(spark, sf_dir):
    tagged = _tagged(spark, sf_dir, NUM + CAT)
    return round_doubles(D.column_drift_tagged(tagged, NUM, CAT, "ks", "chisquare"))


SIDES = [Q.BOOKINGS, Q.sides_cte()]


def _by_date(spark, sf_dir, cols):
    return D.side_split(TB.bookings_by_date(spark, sf_dir), "_side", 0, 1, cols)


@register("drift_target", Q.with_(*SIDES, "tagged AS (SELECT * FROM sides)")[:-1] + ",\n" +
          _columns_sql([], [], ["o_orderstatus"], target="o_orderstatus").removeprefix("WITH "))
def drift_target(spark, sf_dir):
    # J1, then D16 on the target alone
    return round_doubles(D.column_drift_tagged(_by_date(spark, sf_dir, [TB.TARGET]), [], [TB.TARGET],
                                               kinds={TB.TARGET: "target"}))


REPORT_NUM = ["o_totalprice", "c_acctbal", "c_nationkey"]


@register("drift_report", Q.with_(*SIDES, "tagged AS (SELECT * FROM sides)")[:-1] + ",\n" +
          _columns_sql([], REPORT_NUM, CAT + ["o_orderstatus"], target="o_orderstatus").removeprefix("WITH "))
def drift_report(spark, sf_dir):
    """One report of numeric, categorical and target columns over features joined with the target."""
    tagged = _by_date(spark, sf_dir, REPORT_NUM + CAT + [TB.TARGET])
    return round_doubles(D.column_drift_tagged(tagged, REPORT_NUM, CAT + [TB.TARGET], kinds={TB.TARGET: "target"}))


def _infinite_sql():
    ctes = [Q.RAW, Q.split_cte(src="raw"), """tagged AS (
  SELECT *, CASE WHEN split = 'train' THEN 0 ELSE 1 END AS _side FROM split WHERE split IN ('train', 'test'))""",
            Q.nlong_cte(["balance_score"]), Q.numeric_bins_cte(by_value=()), Q.share_measures_cte("nbins", "sm"),
            """aside AS (
  SELECT count(*) FILTER (WHERE balance_score IS NULL OR isnan(balance_score)) AS n_missing,
         count(*) FILTER (WHERE isinf(balance_score)) AS n_infinite FROM tagged)"""]
    return Q.with_(*ctes) + """SELECT "column", 'psi' AS method, round(psi * 1000, 6) AS statistic_e3, n_ref, n_cur,
       n_missing, n_infinite FROM sm, aside"""


@register("drift_infinite", _infinite_sql())
def drift_infinite(spark, sf_dir):
    """PSI of a column with infinite values: they are set aside and counted, the bins keep their width."""
    from tablesmith.operators.split import stratified_split
    split = stratified_split(TB.bookings_raw(spark, sf_dir), TB.KEY, TB.TARGET, (0.7, 0.15, 0.15), TB.SEED)
    tagged = D.side_split(split.checkpoint(eager=True), "split", "train", "test", ["balance_score"])
    aside = D.set_aside(tagged, ["balance_score"]).groupBy("column").agg(
        F.sum("n_missing").alias("n_missing"), F.sum("n_infinite").alias("n_infinite"))
    res = D.method_table_tagged(tagged, ["balance_score"], "psi").join(aside, "column")
    return round_doubles(res.select("column", "method", (F.col("statistic") * 1000).alias("statistic_e3"), "n_ref",
                                    "n_cur", "n_missing", "n_infinite"))
