"""Drift between a reference and a current sample.

Formulas are pinned here (the reference hands them to an external library): see the README. Every method is a
per-column aggregate over one of three shapes, each built in one pass over all columns:

* bin table ``(column, bin, n_ref, n_cur)`` -> PSI, KL, Jensen-Shannon, TVD, chi-square, G-test, Fisher;
* distinct-value table ``(column, value, r, c)`` + two-level running totals -> KS, Wasserstein, Anderson-Darling,
  Cramer-von Mises;
* moments per (column, sample) -> z-test, t-test; random Fourier features -> MMD.

The two samples are one DataFrame with a ``_side`` column (0 reference, 1 current); values are unpivoted to
long form, so all columns share a single scan, shuffle and aggregate. NULL and NaN are dropped per column.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesmith.functions import stats as S
from tablesmith.functions.columns import clean_value, quote, safe_div
from tablesmith.functions.cumulative import exact_quantiles, running_totals

# Fixed values of the pinned definitions.
SHARE_FLOOR = 1e-4           # an empty bin's share in PSI and KL
SCORE_THRESHOLD = 0.1
P_THRESHOLD = 0.05
SHARE_THRESHOLD = 0.5
WASSERSTEIN_STD_FLOOR = 0.001
MMD_FEATURES = 32
MMD_SEED = 7
MMD_BLOCKS = 256             # blocks of rows that the bootstrap resamples
MMD_REPLICATES = 200
# exp(-1) times the partial sums of 1 / i!: a uniform number's weight is how many of these it passes (Poisson, mean 1)
POISSON_STEPS = tuple(math.exp(-1) * sum(1 / math.factorial(i) for i in range(k + 1)) for k in range(8))


#: Column of ``resampling_blocks``.
BLOCK = "_block"


def resampling_blocks(df: DataFrame, key: list[str]) -> DataFrame:
    """``df`` with a block number from the first two hex digits of the md5 of the ``key`` columns (null as a word of
    its own): rows are dealt into MMD_BLOCKS blocks without regard to their values, the same in every run."""
    text = F.concat_ws("|", *[F.coalesce(F.col(quote(c)).cast("string"), F.lit("null")) for c in key])
    return df.withColumn(BLOCK, F.conv(F.substring(F.md5(text), 1, 2), 16, 10).cast("int"))


def tag_samples(reference: DataFrame, current: DataFrame, cols: list[str]) -> DataFrame:
    """One DataFrame of both samples with ``_side`` 0 (reference) / 1 (current); no shuffle (a union)."""
    names = [quote(c) for c in cols]
    r = reference.select(*names).withColumn("_side", F.lit(0))
    c = current.select(*names).withColumn("_side", F.lit(1))
    return r.unionByName(c)


def side_split(df: DataFrame, side_col: str, reference_value, current_value, cols: list[str]) -> DataFrame:
    """Tag rows of one table holding both samples (e.g. a split column)."""
    side = F.when(F.col(side_col) == F.lit(reference_value), 0).otherwise(1)
    return (df.filter(F.col(side_col).isin(reference_value, current_value))
            .select(*[quote(c) for c in cols], side.alias("_side")))


def numeric_long(tagged: DataFrame, cols: list[str]) -> DataFrame:
    """(column, _side, value double) without NULL, NaN and +-inf (as P5: inf is missing). One infinite value would
    otherwise stretch the bins over everything; ``set_aside`` counts what is left out."""
    if not cols:
        return tagged.sparkSession.createDataFrame([], "column string, _side int, value double")
    tags = [c for c in ("_side", BLOCK) if c in tagged.columns]
    wide = tagged.select(*tags, *[clean_value(tagged, c).cast("double").alias(c) for c in cols])
    long = wide.unpivot(tags, [quote(c) for c in cols], "column", "value")
    return long.filter(F.col("value").isNotNull() & (F.abs("value") < float("inf")))


def set_aside(tagged: DataFrame, cols: list[str]) -> DataFrame:
    """(column, _side, n_missing, n_infinite) of the values that ``numeric_long`` leaves out, in one pass."""
    wide = tagged.select("_side", *[F.col(quote(c)).cast("double").alias(c) for c in cols])
    v = F.col("value")
    return wide.unpivot(["_side"], [quote(c) for c in cols], "column", "value").groupBy("column", "_side").agg(
        F.count_if(v.isNull() | F.isnan(v)).alias("n_missing"), F.count_if(F.abs(v) == float("inf")).alias("n_infinite"))


def categorical_long(tagged: DataFrame, cols: list[str]) -> DataFrame:
    """(column, _side, value string) without NULL."""
    if not cols:
        return tagged.sparkSession.createDataFrame([], "column string, _side int, value string")
    wide = tagged.select("_side", *[F.col(quote(c)).cast("string").alias(c) for c in cols])
    long = wide.unpivot(["_side"], [quote(c) for c in cols], "column", "value")
    return long.filter(F.col("value").isNotNull())


def _side_counts(long: DataFrame) -> list[Column]:
    return [F.sum(F.when(F.col("_side") == 0, 1).otherwise(0)).cast("long").alias("n_ref"),
            F.sum(F.when(F.col("_side") == 1, 1).otherwise(0)).cast("long").alias("n_cur")]


def numeric_bins(nlong: DataFrame, by_value: tuple[str, ...] = ()) -> DataFrame:
    """(column, bin, n_ref, n_cur): ``ceil(log2(N))+1`` equal-width bins over the combined [min, max] (last bin
    closed); the columns named in ``by_value`` have a bin per value instead.

    The ranges are fitted first, one row per column, and applied as literals: two passes, no join."""
    fitted = nlong.groupBy("column").agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"),
                                         F.max("value").alias("hi")).collect()
    idx = F.lit(None).cast("double")
    v = F.col("value")
    for r in fitted:
        k = (r["n"] - 1).bit_length() + 1  # ceil(log2(N)) is the bit length of N - 1
        w = (r["hi"] - r["lo"]) / k
        equal = F.least(F.floor((v - F.lit(r["lo"])) / F.lit(w)), F.lit(k - 1)).cast("double") if w else F.lit(None)
        idx = F.when(F.col("column") == r["column"], v if r["column"] in by_value else equal.cast("double")).otherwise(idx)
    binned = nlong.withColumn("bin", idx)
    return binned.groupBy("column", "bin").agg(*_side_counts(binned))


def categorical_bins(clong: DataFrame) -> DataFrame:
    return clong.groupBy("column", F.col("value").alias("bin")).agg(*_side_counts(clong))


def share_measures(bins: DataFrame) -> DataFrame:
    """Per column: psi, kl_div, jensenshannon, tvd, chisquare, g_test, dof, n_ref, n_cur, n_bins."""
    # totals as doubles: the products below pass 2**63 from about 3e9 rows a side
    tot = bins.groupBy("column").agg(F.sum("n_ref").cast("double").alias("tot_ref"),
                                     F.sum("n_cur").cast("double").alias("tot_cur"),
                                     F.count(F.lit(1)).alias("n_bins"))
    j = bins.join(F.broadcast(tot), "column")
    p = safe_div(F.col("n_ref"), F.col("tot_ref"))
    q = safe_div(F.col("n_cur"), F.col("tot_cur"))
    pf = F.when(p == 0, SHARE_FLOOR).otherwise(p)
    qf = F.when(q == 0, SHARE_FLOOR).otherwise(q)
    m = (p + q) / 2
    n = F.col("tot_ref") + F.col("tot_cur")
    e_ref = F.col("tot_ref") * (F.col("n_ref") + F.col("n_cur")) / n
    e_cur = F.col("tot_cur") * (F.col("n_ref") + F.col("n_cur")) / n
    g_ref = F.when(F.col("n_ref") > 0, F.col("n_ref") * F.log(safe_div(F.col("n_ref"), e_ref))).otherwise(0.0)
    g_cur = F.when(F.col("n_cur") > 0, F.col("n_cur") * F.log(safe_div(F.col("n_cur"), e_cur))).otherwise(0.0)
    js_p = F.when(p > 0, p * F.log(safe_div(p, m))).otherwise(0.0)
    js_q = F.when(q > 0, q * F.log(safe_div(q, m))).otherwise(0.0)
    return j.groupBy("column").agg(
        F.first("tot_ref").cast("long").alias("n_ref"), F.first("tot_cur").cast("long").alias("n_cur"),
        F.first("n_bins").alias("n_bins"),
        F.sum((qf - pf) * F.log(safe_div(qf, pf))).alias("psi"),
        F.sum(pf * F.log(safe_div(pf, qf))).alias("kl_div"),
        F.sqrt(F.greatest(F.lit(0.0), 0.5 * F.sum(js_p) + 0.5 * F.sum(js_q))).alias("jensenshannon"),
        (0.5 * F.sum(F.abs(p - q))).alias("tvd"),
        F.sum(safe_div((F.col("n_ref") - e_ref) ** 2, e_ref) + safe_div((F.col("n_cur") - e_cur) ** 2, e_cur))
        .alias("chisquare"),
        (2 * F.sum(g_ref + g_cur)).alias("g_test"),
        (F.count(F.lit(1)) - 1).alias("dof"))


def value_table(nlong: DataFrame) -> DataFrame:
    """(column, value, r, c): rows per distinct value and sample (partial aggregate)."""
    return nlong.groupBy("column", "value").agg(
        F.sum(F.when(F.col("_side") == 0, 1).otherwise(0)).cast("long").alias("r"),
        F.sum(F.when(F.col("_side") == 1, 1).otherwise(0)).cast("long").alias("c"))


def cvm_moments(totals: DataFrame) -> DataFrame:
    """(column, tot_ref, tot_cur, _mean, _square) from ``totals`` (value table with cum_r, cum_c, tot_ref, tot_cur): each value's part of the Cramer-von Mises
    statistic's mean and second moment when the rows are dealt to the samples at random, ties as they are.

    The statistic is a sum over values of l X^2 / (n m): X is the count of the first sample among the L smallest of
    all rows less its mean. X is hypergeometric, and given X at a later value the earlier ones are so again; so the
    expected products are central moments of the later value times running totals of l L and l L^2.
    """
    n, m = F.col("tot_ref"), F.col("tot_cur")
    size = n + m
    own = (F.col("r") + F.col("c")).cast("double")
    upto = (F.col("cum_r") + F.col("cum_c")).cast("double")
    weighed = totals.withColumns({"_own": own, "_upto": upto, "_once": own * upto, "_twice": own * upto * upto})
    x = running_totals(weighed, ["column"], "value", ["_once", "_twice"])
    before, before2 = F.col("cum__once") - F.col("_once"), F.col("cum__twice") - F.col("_twice")
    own, upto = F.col("_own"), F.col("_upto")
    spread = upto * (size - upto) * n * m
    second = safe_div(spread, size * size * (size - 1))
    third = second * safe_div((size - 2 * n) * (size - 2 * upto), size * (size - 2))
    excess = safe_div(((size - 1) * size * size * (size * (size + 1) - 6 * n * m - 6 * upto * (size - upto))
                       + 6 * spread * (5 * size - 6)) * spread,
                      (size - 2) * (size - 3) * size ** 4 * (size - 1) ** 2)
    fourth = 3 * second * second + excess
    mean = n * upto / size
    mixed = mean * (upto - mean) * second + (upto - 2 * mean) * third - fourth  # of X^2 times R (L - R)
    earlier = F.when(upto > own, fourth * safe_div(before2, upto * upto)
                     + mixed * safe_div(upto * before - before2, upto * upto * (upto - 1))).otherwise(0.0)
    return x.select("column", "tot_ref", "tot_cur", (own * second).alias("_mean"),
                    (own * (own * fourth + 2 * earlier)).alias("_square"))


def cumulative_measures(nlong: DataFrame, cvm_test: bool = False) -> DataFrame:
    """Per column: ks, wasserstein, wasserstein_norm, anderson (A2akN, midranks), cramer_von_mises; with ``cvm_test``
    also cvm_scaled, the last one with the mean and variance of its limiting distribution (null without variance)."""
    vt = value_table(nlong)
    rt = running_totals(vt, ["column"], "value", ["r", "c"], with_next=True)
    mom = nlong.groupBy("column").agg(
        F.sum(F.when(F.col("_side") == 0, 1).otherwise(0)).cast("double").alias("tot_ref"),
        F.sum(F.when(F.col("_side") == 1, 1).otherwise(0)).cast("double").alias("tot_cur"),
        F.stddev_pop(F.when(F.col("_side") == 0, F.col("value"))).alias("std_ref"))
    j = rt.join(F.broadcast(mom), "column")
    nr, nc = F.col("tot_ref"), F.col("tot_cur")
    n = nr + nc
    fr = safe_div(F.col("cum_r"), nr)
    fc = safe_div(F.col("cum_c"), nc)
    dist = F.abs(fr - fc)
    step = F.coalesce(F.col("_next") - F.col("value"), F.lit(0.0))
    l_j = F.col("r") + F.col("c")
    ba = F.col("cum_r") + F.col("cum_c") - l_j / 2
    mr = F.col("cum_r") - F.col("r") / 2
    mc = F.col("cum_c") - F.col("c") / 2
    den = ba * (n - ba) - n * l_j / 4
    ad = F.when(den > 0, l_j * (safe_div((n * mr - nr * ba) ** 2, nr) + safe_div((n * mc - nc * ba) ** 2, nc)) / den)
    agg = j.groupBy("column").agg(
        F.first(nr).alias("tot_ref"), F.first(nc).alias("tot_cur"), F.first("std_ref").alias("std_ref"),
        F.max(dist).alias("ks"), F.sum(dist * step).alias("wasserstein"),
        F.sum(l_j * (fr - fc) ** 2).alias("_cvm"), F.sum(ad).alias("_ad"))
    n2 = F.col("tot_ref") + F.col("tot_cur")
    found = agg.select(
        "column", F.col("tot_ref").cast("long").alias("n_ref"), F.col("tot_cur").cast("long").alias("n_cur"), "ks",
        "wasserstein",
        (F.col("wasserstein") / F.greatest(F.col("std_ref"), F.lit(WASSERSTEIN_STD_FLOOR))).alias("wasserstein_norm"),
        ((n2 - 1) / (n2 * n2) * F.col("_ad")).alias("anderson"),
        (F.col("tot_ref") * F.col("tot_cur") / (n2 * n2) * F.col("_cvm")).alias("cramer_von_mises"))
    if not cvm_test:
        return found
    expected = cvm_moments(j.drop("_next", "std_ref")).groupBy("column").agg(
        F.sum("_mean").alias("_mean"), F.sum("_square").alias("_square"), F.first(nr * nc).alias("_nm"))
    variance = F.col("_square") - F.col("_mean") ** 2
    scaled = 1 / 6 + safe_div(F.col("cramer_von_mises") - safe_div(F.col("_mean"), F.col("_nm")),
                              safe_div(F.sqrt(45 * F.when(variance > 0, variance)), F.col("_nm")))
    return found.join(F.broadcast(expected), "column").withColumn("cvm_scaled", scaled).select(*found.columns, "cvm_scaled")


def moment_measures(nlong: DataFrame) -> DataFrame:
    """Per column: z (two-proportion pooled form on 0/1 columns, Welch-type form otherwise) and pooled t."""
    g = nlong.groupBy("column").agg(
        *[F.sum(F.when(F.col("_side") == s, 1).otherwise(0)).cast("double").alias(f"n{s}") for s in (0, 1)],
        *[F.avg(F.when(F.col("_side") == s, F.col("value"))).alias(f"m{s}") for s in (0, 1)],
        *[F.var_samp(F.when(F.col("_side") == s, F.col("value"))).alias(f"v{s}") for s in (0, 1)],
        F.sum(F.when(~F.col("value").isin(0.0, 1.0), 1).otherwise(0)).alias("_nonbinary"))
    n0, n1, m0, m1, v0, v1 = (F.col(c) for c in ("n0", "n1", "m0", "m1", "v0", "v1"))
    one = F.lit(1.0)
    pooled_p = safe_div(m0 * n0 + m1 * n1, n0 + n1)
    z_prop = safe_div(m0 - m1, F.sqrt(pooled_p * (1 - pooled_p) * (safe_div(one, n0) + safe_div(one, n1))))
    z_mean = safe_div(m0 - m1, F.sqrt(safe_div(v0, n0) + safe_div(v1, n1)))
    dof = n0 + n1 - 2
    sp2 = safe_div((n0 - 1) * v0 + (n1 - 1) * v1, dof)
    t = safe_div(m0 - m1, F.sqrt(sp2 * (safe_div(one, n0) + safe_div(one, n1))))
    return g.select("column", n0.cast("long").alias("n_ref"), n1.cast("long").alias("n_cur"),
                    F.when(F.col("_nonbinary") == 0, z_prop).otherwise(z_mean).alias("z"),
                    t.alias("t_test"), dof.cast("long").alias("t_dof"))


def mmd_weights(features: int = MMD_FEATURES, seed: int = MMD_SEED):
    """Fixed random Fourier frequencies (standard normal) and phases (uniform on [0, 2pi))."""
    rng = np.random.default_rng(seed)
    w = rng.standard_normal(features)
    b = rng.uniform(0.0, 2 * math.pi, features)
    return [round(float(x), 12) for x in w], [round(float(x), 12) for x in b]


def mmd_bandwidth(nlong: DataFrame) -> dict:
    """Per column: median absolute deviation of the combined sample (exact, distributed), 1 when 0.
    One number per column is read back (schema-bounded)."""
    med = exact_quantiles(nlong, ["column"], [0.5]).select("column", F.col("quantile").alias("_med"))
    dev = nlong.join(F.broadcast(med), "column").select(
        "column", F.abs(F.col("value") - F.col("_med")).alias("value"))
    mad = exact_quantiles(dev, ["column"], [0.5]).collect()
    return {r["column"]: (r["quantile"] if r["quantile"] else 1.0) for r in mad}


def mmd_measure(nlong: DataFrame, features: int = MMD_FEATURES, seed: int = MMD_SEED,
                sigma: dict | None = None) -> DataFrame:
    """Per column: squared MMD of random Fourier features of an RBF kernel (Rahimi & Recht 2007).

    Width = median absolute deviation of the combined sample (``mmd_bandwidth``). Linear time: one sum per
    feature and (column, sample) in a single partial aggregate instead of all pairs.
    """
    blocks = mmd_blocks(nlong, features, seed, sigma)
    return _mmd_of(blocks.groupBy("column", "_side").agg(*[F.sum(c).alias(c) for c in _mmd_sums(features)]),
                   features, ["column"]).withColumnRenamed("_mmd", "mmd")


def _mmd_sums(features: int) -> list[str]:
    return ["_n", *(f"_s{d}" for d in range(features))]


def mmd_blocks(nlong: DataFrame, features: int = MMD_FEATURES, seed: int = MMD_SEED, sigma: dict | None = None) -> DataFrame:
    """(column, _side, _block, _n, _s0, ...): counts and feature sums of each block of rows, the one aggregate over
    the data from which both the statistic and its bootstrap come. Rows without a block are dealt by a hash of the
    value."""
    sigma = sigma if sigma is not None else mmd_bandwidth(nlong)
    w, b = mmd_weights(features, seed)
    sig = F.coalesce(*[F.when(F.col("column") == F.lit(c), F.lit(float(v))) for c, v in sigma.items()],
                     F.lit(1.0))
    block = F.col(BLOCK) if BLOCK in nlong.columns else F.pmod(F.xxhash64("value"), F.lit(MMD_BLOCKS)).cast("int")
    x = nlong.select("column", "_side", block.alias(BLOCK), (F.col("value") / sig).alias("_x"))
    return x.groupBy("column", "_side", BLOCK).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(F.cos(F.lit(w[d]) * F.col("_x") + F.lit(b[d]))).alias(f"_s{d}") for d in range(features)])


def _mmd_of(sums: DataFrame, features: int, keys: list[str], centre: bool = False) -> DataFrame:
    """(keys, _mmd): squared distance of the two sides' mean features; with ``centre``, of their differences from the
    means ``_c0``, ... of the same side."""
    def mean(d):
        own = safe_div(F.col(f"_s{d}"), F.col("_n").cast("double"))
        return own - F.col(f"_c{d}") if centre else own
    side = lambda d, s: F.sum(F.when(F.col("_side") == s, mean(d)))
    g = sums.groupBy(*keys).agg(*[(side(d, 0) - side(d, 1)).alias(f"_d{d}") for d in range(features)])
    scale = math.sqrt(2.0 / features)
    return g.select(*keys, sum(((F.col(f"_d{d}") * scale) ** 2 for d in range(features)), F.lit(0.0)).alias("_mmd"))


def mmd_test(nlong: DataFrame, features: int = MMD_FEATURES, seed: int = MMD_SEED, replicates: int = MMD_REPLICATES,
             sigma: dict | None = None) -> DataFrame:
    """Per column: mmd, p_value, n_ref, n_cur.

    The p-value is that of a Poisson bootstrap over the blocks of ``mmd_blocks``: in each replicate every block of a
    sample counts as often as a Poisson number says (from the md5 of replicate, side and block, so reruns agree), and
    the distance of the resampled means, each less its sample's own, is one value under no drift. Resampling blocks
    in place of rows costs no further pass: the replicates see blocks x columns rows, whatever the data's size.
    """
    blocks = mmd_blocks(nlong, features, seed, sigma).checkpoint(eager=True)  # at most 2 x MMD_BLOCKS rows a column
    names = _mmd_sums(features)
    total = blocks.groupBy("column", "_side").agg(*[F.sum(c).alias(c) for c in names])
    observed = _mmd_of(total, features, ["column"]).withColumnRenamed("_mmd", "mmd")
    centres = total.select("column", "_side", *[safe_div(F.col(f"_s{d}"), F.col("_n").cast("double")).alias(f"_c{d}")
                                                for d in range(features)])
    drawn = F.conv(F.substring(F.md5(F.concat_ws("|", "_rep", "_side", BLOCK)), 1, 8), 16, 10).cast("double") / 2.0 ** 32
    weight = sum((F.when(F.col("_u") >= step, 1).otherwise(0) for step in POISSON_STEPS), F.lit(0))
    resampled = (blocks.withColumn("_rep", F.explode(F.sequence(F.lit(1), F.lit(replicates))))
                 .withColumn("_u", drawn).withColumn("_w", weight).groupBy("column", "_side", "_rep")
                 .agg(*[F.sum(F.col("_w") * F.col(c)).alias(c) for c in names]))
    null = _mmd_of(resampled.join(F.broadcast(centres), ["column", "_side"]), features, ["column", "_rep"], centre=True)
    above = (null.join(F.broadcast(observed), "column").groupBy("column")
             .agg(F.count_if(F.col("_mmd") >= F.col("mmd")).alias("_above"), F.count("_mmd").alias("_reps")))
    sizes = total.groupBy("column").agg(*[F.coalesce(F.sum(F.when(F.col("_side") == s, F.col("_n"))), F.lit(0)).alias(n)
                                          for s, n in ((0, "n_ref"), (1, "n_cur"))])
    p = F.when(F.col("mmd").isNotNull(), (F.col("_above") + 1) / (F.col("_reps") + 1))
    return observed.join(above, "column").join(sizes, "column").select("column", "mmd", p.alias("p_value"), "n_ref", "n_cur")


# ---------------------------------------------------------------- per-method report tables

def _with_p(df: DataFrame, method: str) -> DataFrame:
    return S.add_p_value(df, method)


def method_table(reference: DataFrame, current: DataFrame, cols: list[str], method: str,
                 kind: str = "num", by_value: tuple[str, ...] = ()) -> DataFrame:
    """One row per column for one named method: (column, method, statistic, p_value, n_ref, n_cur)."""
    tagged = tag_samples(reference, current, cols)
    return method_table_tagged(tagged, cols, method, kind, by_value)


def method_table_tagged(tagged: DataFrame, cols: list[str], method: str, kind: str = "num",
                        by_value: tuple[str, ...] = ()) -> DataFrame:
    if method in ("psi", "kl_div", "jensenshannon", "tvd", "chisquare", "g_test", "fisher_exact"):
        bins = numeric_bins(numeric_long(tagged, cols), by_value) if kind == "num" else categorical_bins(
            categorical_long(tagged, cols))
        sm = share_measures(bins)
        stat_col = {"fisher_exact": "n_bins"}.get(method, method)
        res = sm.select("column", F.lit(method).alias("method"), F.col(stat_col).cast("double").alias("statistic"),
                        "n_ref", "n_cur", "dof")
        if method == "fisher_exact":
            res = S.fisher_table(bins)
    elif method in ("ks", "wasserstein", "wasserstein_norm", "anderson", "cramer_von_mises"):
        cm = cumulative_measures(numeric_long(tagged, cols), cvm_test=method == "cramer_von_mises")
        scaled = [F.col("cvm_scaled").alias("scaled")] if method == "cramer_von_mises" else []
        res = cm.select("column", F.lit(method).alias("method"), F.col(method).alias("statistic"),
                        "n_ref", "n_cur", F.lit(None).cast("long").alias("dof"), *scaled)
    elif method in ("z", "t_test"):
        mm = moment_measures(numeric_long(tagged, cols))
        res = mm.select("column", F.lit(method).alias("method"), F.col(method).alias("statistic"), "n_ref", "n_cur",
                        (F.col("t_dof") if method == "t_test" else F.lit(None).cast("long")).alias("dof"))
    elif method == "mmd":
        res = mmd_test(numeric_long(tagged, cols)).select(
            "column", F.lit(method).alias("method"), F.col("mmd").alias("statistic"), "p_value", "n_ref", "n_cur",
            F.lit(None).cast("long").alias("dof"))
    else:
        raise ValueError(f"unknown drift method {method!r}")
    return _with_p(res, method)


def drift_table(reference: DataFrame, current: DataFrame, numeric: list[str], categorical: list[str],
                num_method: str = "psi", cat_method: str = "jensenshannon",
                threshold: float = SCORE_THRESHOLD, by_value: tuple[str, ...] = ()) -> DataFrame:
    """One row per feature: column, kind, method, score, threshold, drifted (score >= threshold)."""
    tagged = tag_samples(reference, current, numeric + categorical)
    return drift_table_tagged(tagged, numeric, categorical, num_method, cat_method, threshold, by_value)


def drift_table_tagged(tagged: DataFrame, numeric: list[str], categorical: list[str],
                       num_method: str = "psi", cat_method: str = "jensenshannon",
                       threshold: float = SCORE_THRESHOLD, by_value: tuple[str, ...] = ()) -> DataFrame:
    parts = []
    if numeric:
        sm = share_measures(numeric_bins(numeric_long(tagged, numeric), by_value))
        parts.append(sm.select("column", F.lit("num").alias("kind"), F.lit(num_method).alias("method"),
                               F.col(num_method).alias("score")))
    if categorical:
        sm = share_measures(categorical_bins(categorical_long(tagged, categorical)))
        parts.append(sm.select("column", F.lit("cat").alias("kind"), F.lit(cat_method).alias("method"),
                               F.col(cat_method).alias("score")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("column", "kind", "method", "score", F.lit(float(threshold)).alias("threshold"),
                      (F.col("score") >= threshold).alias("drifted"))


def drift_summary(table: DataFrame, share_threshold: float = SHARE_THRESHOLD) -> DataFrame:
    """Share of drifted columns and the dataset verdict (share >= share_threshold)."""
    g = table.agg(F.count(F.lit(1)).alias("n_columns"),
                  F.sum(F.col("drifted").cast("int")).cast("long").alias("n_drifted"))
    share = F.col("n_drifted") / F.col("n_columns")
    return g.select("n_columns", "n_drifted", share.alias("share_drifted"),
                    (share >= share_threshold).alias("dataset_drift"))


def column_drift_tagged(tagged: DataFrame, numeric: list[str], categorical: list[str],
                        num_method: str = "wasserstein", cat_method: str = "jensenshannon",
                        kinds: dict[str, str] | None = None) -> DataFrame:
    """Drift per column by a distance (drifted from SCORE_THRESHOLD up) or a test's p-value (drifted below
    P_THRESHOLD): numeric columns by ``wasserstein`` (normed) or ``ks``, categorical ones by ``jensenshannon`` or
    ``chisquare``. The caller names the methods; they don't depend on the number of rows. ``kinds`` renames the
    kind of single columns in the result (e.g. the target's)."""
    if num_method not in ("wasserstein", "ks") or cat_method not in ("jensenshannon", "chisquare"):
        raise ValueError(f"unknown drift method {num_method!r} or {cat_method!r}")
    parts = []
    if numeric:
        cm = cumulative_measures(numeric_long(tagged, numeric))
        if num_method == "ks":
            cm = S.add_p_value(cm.withColumn("statistic", F.col("ks")), "ks").withColumn("score", F.col("p_value"))
        else:
            cm = cm.withColumn("score", F.col("wasserstein_norm"))
        parts.append(cm.select("column", F.lit("num").alias("kind"), F.lit(num_method).alias("method"), "score",
                               F.lit(num_method == "ks").alias("_test")))
    if categorical:
        sm = share_measures(categorical_bins(categorical_long(tagged, categorical)))
        if cat_method == "chisquare":
            sm = S.add_p_value(sm.withColumn("statistic", F.col("chisquare")), "chisquare")
            sm = sm.withColumn("score", F.col("p_value"))
        else:
            sm = sm.withColumn("score", F.col("jensenshannon"))
        parts.append(sm.select("column", F.lit("cat").alias("kind"), F.lit(cat_method).alias("method"), "score",
                               F.lit(cat_method == "chisquare").alias("_test")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    kind = F.col("kind")
    for c, k in (kinds or {}).items():
        kind = F.when(F.col("column") == c, k).otherwise(kind)
    return out.select(
        "column", kind.alias("kind"), "method", "score",
        F.when(F.col("_test"), P_THRESHOLD).otherwise(SCORE_THRESHOLD).alias("threshold"),
        F.when(F.col("_test"), F.col("score") < P_THRESHOLD).otherwise(F.col("score") >= SCORE_THRESHOLD)
        .alias("drifted"))
