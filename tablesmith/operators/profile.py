"""Aggregations and profiling (A1-A13). Every profile is one pass (or one pass per shape) over all columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablesmith.functions.columns import clean_value, is_missing, numeric_columns, quote, safe_div
from tablesmith.functions.cumulative import running_totals
from tablesmith.operators.clean import column_quantiles, distinct_counts, value_groups  # noqa: F401  (A1 lives in clean)


def _stack(wide: DataFrame, cols: list[str], fields: list[str], keep: list[str] | None = None) -> DataFrame:
    """One-row wide aggregate with fields ``{field}__{i}`` -> one row per column."""
    rows = F.array(*[F.struct(F.lit(c).alias("column"), *[F.col(f"{f}__{i}").alias(f) for f in fields])
                     for i, c in enumerate(cols)])
    return wide.select(*(keep or []), F.inline(rows))


def _long(df: DataFrame, values: dict[str, Column], value: str = "value") -> DataFrame:
    """(column, value), a row per input row and column, in one pass; names may hold any character."""
    return df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), v.alias(value)) for c, v in values.items()])))


def class_balance(df: DataFrame, col: str) -> DataFrame:
    """A2: frequency and share (percent, one decimal as printed) of each non-null value."""
    base = df.filter(F.col(col).isNotNull())
    g = base.groupBy(col).agg(F.count(F.lit(1)).alias("n_rows"))
    total = base.agg(F.count(F.lit(1)).alias("_n")).scalar()
    share = F.col("n_rows") / total
    return g.select(col, "n_rows", share.alias("share"), F.round(share * 100, 1).alias("pct"))


def missing_values(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """A3: missing count and percent per column (NaN counts as missing)."""
    cols = cols or df.columns
    wide = df.agg(F.count(F.lit(1)).alias("_n"),
                  *[F.count_if(is_missing(df, c)).alias(f"n_missing__{i}") for i, c in enumerate(cols)])
    out = _stack(wide, cols, ["n_missing"], ["_n"])
    return out.select("column", "n_missing", (safe_div(F.col("n_missing") * 100.0, F.col("_n"))).alias("pct_missing"))


def duplicate_count(df: DataFrame) -> DataFrame:
    """A4: rows equal to an earlier row (NULLs equal): sum(count - 1) over groups of identical rows.

    A 64-bit hash of each row is counted first (8 bytes to shuffle, combined map-side); only rows whose hash
    occurs more than once are then compared in full, again combined map-side."""
    cols = [F.col(quote(c)) for c in df.columns]
    often = (df.groupBy(F.xxhash64(*cols).alias("_hash")).agg(F.count(F.lit(1)).alias("_n"))
             .filter(F.col("_n") > 1).select("_hash"))
    g = (df.withColumn("_hash", F.xxhash64(*cols)).join(often, "_hash", "left_semi")
         .groupBy(*cols).agg(F.count(F.lit(1)).alias("_c")))
    return g.agg(F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).cast("long").alias("n_duplicates"))


def _num_long(df: DataFrame, cols: list[str]) -> DataFrame:
    return _long(df, {c: clean_value(df, c).cast("double") for c in cols})


def describe_numeric(df: DataFrame, cols: list[str] | None = None, exact: bool = True) -> DataFrame:
    """A5: count, mean, sample std, min, 25/50/75 %, max per numeric column (exact quantiles)."""
    cols = cols or numeric_columns(df)
    long = _num_long(df, cols)
    m = long.groupBy("column").agg(F.count("value").alias("count"), F.avg("value").alias("mean"),
                                   F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
                                   F.max("value").alias("max"))
    q = column_quantiles(df, cols, [0.25, 0.5, 0.75], exact)
    qw = q.groupBy("column").agg(*[F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(n)
                                   for p, n in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))])
    return m.join(qw, "column", "left").select("column", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct values (NULL listed)."""
    return df.select(col).distinct()


def table_info(df: DataFrame) -> DataFrame:
    """Column, dtype, non-null count (one aggregate)."""
    cols = df.columns
    wide = df.agg(*[F.count_if(~is_missing(df, c)).alias(f"non_null__{i}") for i, c in enumerate(cols)])
    out = _stack(wide, cols, ["non_null"])
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    dtype = F.coalesce(*[F.when(F.col("column") == c, F.lit(t)) for c, t in types.items()])
    return out.select("column", dtype.alias("dtype"), "non_null")


def table_shape(df: DataFrame) -> DataFrame:
    """(rows, columns)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def histogram(df: DataFrame, col: str, bins: int = 5) -> DataFrame:
    """A10: equal-width bins over [min, max], bin 1..bins, the last bin closed. +-inf is missing, as in P5."""
    v = clean_value(df, col).cast("double")
    base = df.select(v.alias("x")).filter(F.col("x").isNotNull() & (F.abs("x") < float("inf")))
    mm = base.agg(F.min("x").alias("lo"), F.max("x").alias("hi")).first()  # fitted range: two numbers
    if mm["lo"] is None:
        return base.sparkSession.createDataFrame([], "bin int, lower double, upper double, n_rows bigint")
    lo, hi = F.lit(float(mm["lo"])), F.lit(float(mm["hi"]))
    w = (hi - lo) / bins
    idx = F.when(w > 0, F.least(F.floor((F.col("x") - lo) / w) + 1, F.lit(bins))).otherwise(1)
    g = base.groupBy(idx.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n_rows"))
    return g.select("bin", (lo + (F.col("bin") - 1) * w).alias("lower"), (lo + F.col("bin") * w).alias("upper"),
                    "n_rows")


def box_stats(df: DataFrame, cols: list[str] | None = None, k: float = 1.5, exact: bool = True) -> DataFrame:
    """q1, median, q3 and whiskers at the furthest points within k*IQR, plus points beyond."""
    cols = cols or numeric_columns(df)
    q = column_quantiles(df, cols, [0.25, 0.5, 0.75], exact)
    qw = q.groupBy("column").agg(*[F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(n)
                                   for p, n in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))])
    long = _num_long(df, cols).filter(F.col("value").isNotNull())
    j = long.join(F.broadcast(qw), "column")  # one row per column
    iqr = F.col("q3") - F.col("q1")
    lo, hi = F.col("q1") - k * iqr, F.col("q3") + k * iqr
    v = F.col("value")
    return j.groupBy("column").agg(
        F.first("q1").alias("q1"), F.first("median").alias("median"), F.first("q3").alias("q3"),
        F.min(F.when(v >= lo, v)).alias("whisker_low"), F.max(F.when(v <= hi, v)).alias("whisker_high"),
        F.count_if((v < lo) | (v > hi)).alias("n_outliers"))


def profile_numeric(df: DataFrame, cols: list[str] | None = None, exact: bool = True) -> DataFrame:
    """A12 numeric part: count, missing, distinct, mean, std, min, max, quartiles, zeros, negatives, skewness
    (population, from moments), excess kurtosis (population)."""
    cols = cols or numeric_columns(df)
    long = _num_long(df, cols)
    v = F.col("value")
    m = long.groupBy("column").agg(
        F.count(v).alias("count"), F.count_if(v.isNull()).alias("n_missing"),
        F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
        F.min(v).alias("min"), F.max(v).alias("max"), F.count_if(v == 0).alias("n_zeros"),
        F.count_if(v < 0).alias("n_negative"), F.skewness(v).alias("skewness"), F.kurtosis(v).alias("kurtosis"))
    q = column_quantiles(df, cols, [0.25, 0.5, 0.75], exact)
    qw = q.groupBy("column").agg(*[F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(n)
                                   for p, n in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))])
    # distinct values are counted in the column's own type: as doubles, integers above 2**53 would fall together
    d = value_groups(df, cols).groupBy("column").agg(F.count(F.lit(1)).alias("n_distinct"))
    return (m.join(d, "column", "left").join(qw, "column", "left")
            .withColumn("n_distinct", F.coalesce("n_distinct", F.lit(0).cast("long"))))


def top_value_counts(long: DataFrame) -> DataFrame:
    """(column, value) -> most frequent value per column, ties to the smallest value; aggregates only (no
    window over a column's distinct values)."""
    vc = long.filter(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("_f"))
    return top_of_counts(vc)


def top_of_counts(vc: DataFrame) -> DataFrame:
    """The same from counts (column, value, _f)."""
    mx = vc.groupBy("column").agg(F.max("_f").alias("_mf"))
    # one row per column: broadcast, so a column's values are never funnelled into one join partition
    top = vc.join(F.broadcast(mx), "column").filter(F.col("_f") == F.col("_mf"))
    return top.groupBy("column").agg(F.min("value").alias("top"), F.first("_mf").alias("top_freq"))


def profile_categorical(df: DataFrame, cols: list[str]) -> DataFrame:
    """A12 categorical part: count, missing, distinct, most frequent value and its frequency."""
    long = _long(df, {c: F.col(quote(c)).cast("string") for c in cols})
    v = F.col("value")
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("_n"))
    m = counts.groupBy("column").agg(
        F.sum(F.when(v.isNotNull(), F.col("_n")).otherwise(0)).alias("count"),
        F.sum(F.when(v.isNull(), F.col("_n")).otherwise(0)).alias("n_missing"), F.count(v).alias("n_distinct"))
    return m.join(top_value_counts(long), "column", "left")


def profile_top_values(df: DataFrame, cols: list[str], k: int = 3) -> DataFrame:
    """The ``k`` most frequent non-missing values of each column, ties to the smaller (a top-k report)."""
    long = _long(df, {c: F.col(quote(c)).cast("string") for c in cols}).filter("value is not null")
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n_rows"))
    # Spark keeps k rows per column and task before the shuffle (a limit on the window's rank)
    w = Window.partitionBy("column").orderBy(F.desc("n_rows"), "value")
    return counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select(
        "column", "rank", "value", "n_rows")


def profile_dates(df: DataFrame, cols: list[str]) -> DataFrame:
    """A12 for date and time columns: count, missing, distinct, first, last and the days between."""
    long = _long(df, {c: F.col(quote(c)).cast("timestamp_ntz") for c in cols})
    v = F.col("value")
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy("column").agg(
        F.sum(F.when(v.isNotNull(), F.col("_n")).otherwise(0)).alias("count"),
        F.sum(F.when(v.isNull(), F.col("_n")).otherwise(0)).alias("n_missing"), F.count(v).alias("n_distinct"),
        F.min(v).cast("string").alias("first"), F.max(v).cast("string").alias("last"),
        F.datediff(F.max(v).cast("date"), F.min(v).cast("date")).alias("days"))


def profile_histograms(df: DataFrame, cols: list[str], bins: int = 5) -> DataFrame:
    """Equal-width histogram of each column (as A10), all in two passes: ranges, then bins."""
    long = _num_long(df, cols).filter(F.col("value").isNotNull() & (F.abs("value") < float("inf")))
    rng = long.groupBy("column").agg(F.min("value").alias("lo"), F.max("value").alias("hi")).collect()  # row a column
    v, bin_, lower, width = F.col("value"), F.lit(None).cast("int"), F.lit(0.0), F.lit(0.0)
    for r in rng:
        here, w = F.col("column") == r["column"], (r["hi"] - r["lo"]) / bins
        at = F.least(F.floor((v - F.lit(r["lo"])) / F.lit(w)) + 1, F.lit(bins)).cast("int") if w else F.lit(1)
        bin_, lower = F.when(here, at).otherwise(bin_), F.when(here, F.lit(r["lo"])).otherwise(lower)
        width = F.when(here, F.lit(w)).otherwise(width)
    g = long.groupBy("column", bin_.alias("bin")).agg(F.count(F.lit(1)).alias("n_rows"))
    return g.select("column", "bin", (lower + (F.col("bin") - 1) * width).alias("lower"),
                    (lower + F.col("bin") * width).alias("upper"), "n_rows")


def profile_table(df: DataFrame) -> DataFrame:
    """A12 table part: rows, columns, missing cells and their percent, duplicate rows."""
    cols = df.columns
    miss = sum((F.count_if(is_missing(df, c)) for c in cols), F.lit(0))
    t = df.agg(F.count(F.lit(1)).alias("n_rows"), miss.cast("long").alias("cells_missing"))
    d = duplicate_count(df)
    out = t.select("n_rows", F.lit(len(cols)).alias("n_columns"), "cells_missing",
                   safe_div(F.col("cells_missing") * 100.0, F.col("n_rows") * len(cols)).alias("pct_cells_missing"),
                   d.scalar().alias("n_duplicates"))
    return out


def correlation_matrix(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """A12 correlations: Pearson per column pair, long form (col_a, col_b, corr), one aggregate."""
    cols = cols or numeric_columns(df)
    value = {c: clean_value(df, c).cast("double") for c in cols}
    upper = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]  # symmetric: aggregate each pair once

    def corr(a: str, b: str) -> Column:
        """Over the rows that have both; NULL where one of them is constant (F.corr would divide by zero)."""
        x, y = value[a], value[b]
        spread = F.sqrt(F.var_pop(F.when(y.isNotNull(), x)) * F.var_pop(F.when(x.isNotNull(), y)))
        return safe_div(F.covar_pop(x, y), spread)

    wide = df.agg(*[corr(a, b).alias(f"corr__{i}") for i, (a, b) in enumerate(upper)])
    idx = {p: i for i, p in enumerate(upper)}
    rows = F.array(*[F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"),
                              F.col(f"corr__{idx.get((a, b), idx.get((b, a)))}").alias("corr"))
                     for a in cols for b in cols])
    return wide.select(F.inline(rows))


def rank_correlation(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """A12 correlations of ranks: Spearman's rho per column pair, long form (col_a, col_b, rho).

    Taken over the rows that have all of ``cols``; equal values share their mean rank. Ranks come from running totals
    over distinct values (two-level, no window over a column) and are joined to the distinct rows, which carry their
    counts, so a value that many rows share is one row of its column's ranks. NULL where a column is constant; an
    empty table gives NULLs."""
    cols = cols or numeric_columns(df)
    names = [f"_v{i}" for i in range(len(cols))]
    value = [(clean_value(df, c).cast("double") + F.lit(0.0)).alias(n) for c, n in zip(cols, names)]  # -0.0 is 0.0
    whole = df.select(*value).dropna().groupBy(*names).agg(F.count(F.lit(1)).alias("_n"))
    long = whole.select(F.inline(F.array(*[F.struct(F.lit(n).alias("column"), F.col(n).alias("value"), F.col("_n").alias("n"))
                                           for n in names])))
    counts = long.groupBy("column", "value").agg(F.sum("n").alias("n"))
    ranks = (running_totals(counts, ["column"], "value", ["n"])
             .select("column", "value", (F.col("cum_n") - (F.col("n") - 1) / 2.0).alias("rank")))
    rows = whole
    for i, n in enumerate(names):
        own = ranks.filter(F.col("column") == n).select(F.col("value").alias(n), F.col("rank").alias(f"_r{i}"))
        rows = rows.join(own, n).drop(n)
    middle = (whole.agg(F.sum("_n").alias("_t")).scalar() + 1) / 2.0  # the mean of any column's ranks
    rows = rows.select("_n", *[(F.col(f"_r{i}") - middle).alias(f"_r{i}") for i in range(len(cols))])
    upper = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    wide = rows.agg(*[F.sum(F.col("_n") * F.col(f"_r{i}") * F.col(f"_r{j}")).alias(f"_s{i}_{j}") for i, j in upper])

    def rho(i: int, j: int) -> Column:
        i, j = min(i, j), max(i, j)
        return safe_div(F.col(f"_s{i}_{j}"), F.sqrt(F.col(f"_s{i}_{i}")) * F.sqrt(F.col(f"_s{j}_{j}")))

    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), rho(i, j).alias("rho"))
        for i, a in enumerate(cols) for j, b in enumerate(cols)])))


def category_association(df: DataFrame, cols: list[str]) -> DataFrame:
    """A12 association of categories: (col_a, col_b, n_rows, chi2, cramers_v) per pair of columns, each pair once.

    One pass counts the cells of all pairs' contingency tables, combined map-side; a row counts for the pairs of which
    it has both values. Chi-square comes from the cells that occur: N (sum n_ij^2 / (n_i n_j) - 1). Cramer's V is
    sqrt(chi2 / (N (min(rows, columns) - 1))), NULL where a column of the pair is constant. A pair without a row that
    has both gives none."""
    text = {c: clean_value(df, c).cast("string") for c in cols}
    pairs = [F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), text[a].alias("a"), text[b].alias("b"))
             for i, a in enumerate(cols) for b in cols[i + 1:]]
    cells = (df.select(F.inline(F.array(*pairs))).filter("a is not null and b is not null")
             .groupBy("col_a", "col_b", "a", "b").agg(F.count(F.lit(1)).alias("n")))
    side = lambda v: cells.groupBy("col_a", "col_b", v).agg(F.sum("n").alias(f"n_{v}"))
    of_a, of_b = side("a"), side("b")
    kinds = lambda m, v: m.groupBy("col_a", "col_b").agg(F.count(F.lit(1)).alias(f"k_{v}"))
    share = F.col("n").cast("double") / F.col("n_a") * F.col("n") / F.col("n_b")
    sums = (cells.join(of_a, ["col_a", "col_b", "a"]).join(of_b, ["col_a", "col_b", "b"]).groupBy("col_a", "col_b")
            .agg(F.sum("n").alias("n_rows"), F.sum(share).alias("_s")))
    chi2 = F.greatest(F.col("n_rows") * (F.col("_s") - 1), F.lit(0.0))
    free = F.least("k_a", "k_b") - 1
    return (sums.join(kinds(of_a, "a"), ["col_a", "col_b"]).join(kinds(of_b, "b"), ["col_a", "col_b"])
            .select("col_a", "col_b", "n_rows", chi2.alias("chi2"),
                    F.sqrt(safe_div(chi2, F.col("n_rows") * free)).alias("cramers_v")))


def top_values(df: DataFrame, col: str, k: int = 10) -> DataFrame:
    """Most frequent values (a top-k report: the limit is the feature)."""
    g = df.groupBy(col).agg(F.count(F.lit(1)).alias("n_rows"))
    return g.orderBy(F.col("n_rows").desc(), F.col(col).asc_nulls_last()).limit(k)
