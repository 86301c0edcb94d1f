"""Projections, filters and cleaning.

Missing-value model: NaN counts as missing (pandas); every numeric operator maps NaN to NULL first. Column
decisions (constant or key-like columns) need one aggregate over the table: a single wide ``agg``, whose one
row (one value per column, bounded by the schema) is read on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesmith.functions.columns import (FLOAT_TYPES, clean_value, dtype_of, nan_to_null, numeric_columns,
                                          quote)
from tablesmith.functions.cumulative import exact_quantiles


def drop_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop named columns; absent names are ignored."""
    present = [c for c in cols if c in df.columns]
    return df.drop(*present)


def feature_target(df: DataFrame, target: str, key: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(features without the target, key + target)."""
    y_cols = ([key] if key else []) + [target]
    return df.drop(target), df.select(*y_cols)


def distinct_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """A1: exact distinct non-missing values per column plus the row count, long form
    (column, n_distinct, n_rows). Values are counted once per (column, value); no row is expanded per aggregate."""
    cols = cols or df.columns
    found = value_groups(df, cols).groupBy("column").agg(F.count(F.lit(1)).alias("n_distinct"))
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "column string")
    return names.join(found, "column", "left").select(
        "column", F.coalesce("n_distinct", F.lit(0).cast("long")).alias("n_distinct"),
        df.agg(F.count(F.lit(1))).scalar().alias("n_rows"))


def value_groups(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, value, n) of the non-missing values, each compared in its own type: integers and decimals by
    their digits, floats by their shortest form (0.0 and -0.0 are one value), others as they are cast."""
    def text(c: str) -> Column:
        v, t = clean_value(df, c), dtype_of(df, c)
        if isinstance(t, FLOAT_TYPES):
            return (v + F.lit(0).cast(t)).cast("string")
        if isinstance(t, T.TimestampType):
            return F.unix_micros(v).cast("string")
        return F.hex(v) if isinstance(t, T.BinaryType) else v.cast("string")

    pairs = F.array(*[F.struct(F.lit(c).alias("column"), text(c).alias("value")) for c in cols])
    long = df.select(F.explode(pairs).alias("p")).select("p.column", "p.value")
    return long.filter("value is not null").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


#: Relative standard error of the distinct counts that decide which columns are counted exactly.
ESTIMATE_ERROR = 0.02


def _column_summary(df: DataFrame) -> tuple[int, dict]:
    """One aggregate: row count and, per column, non-missing count, min, max and estimated distinct count."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(df.columns):
        v = clean_value(df, c)
        aggs += [F.count(v).alias(f"_c{i}"), F.min(v).alias(f"_lo{i}"), F.max(v).alias(f"_hi{i}"),
                 F.approx_count_distinct(v, ESTIMATE_ERROR).alias(f"_d{i}")]
    row = df.agg(*aggs).first()  # one row, a few values per column: schema-bounded
    return row["_n"], {c: (row[f"_c{i}"], row[f"_lo{i}"], row[f"_hi{i}"], row[f"_d{i}"]) for i, c in enumerate(df.columns)}


def _constant(summary: dict) -> list[str]:
    return [c for c, (cnt, lo, hi, _) in summary.items() if cnt > 0 and lo == hi]


def _unique(df: DataFrame, n: int, summary: dict, cols: list[str]) -> list[str]:
    """Columns without a missing value whose exact distinct count is the row count. A column whose estimate lies ten
    standard errors below the row count isn't one; only the others' values are expanded and counted."""
    if n == 0:
        return list(cols)
    cands = [c for c in cols if summary[c][0] == n and summary[c][3] >= n * (1 - 10 * ESTIMATE_ERROR)]
    if not cands:
        return []
    exact = value_groups(df, cands).groupBy("column").agg(F.count(F.lit(1)).alias("_d")).collect()  # row per column
    found = {r["column"] for r in exact if r["_d"] == n}
    return [c for c in cands if c in found]


def constant_columns(df: DataFrame) -> list[str]:
    """P3 decision: columns with exactly one distinct non-missing value (all-missing columns stay).
    Exactly one distinct value <=> at least one value and min == max: no distinct aggregation needed."""
    return _constant(_column_summary(df)[1])


def unique_columns(df: DataFrame) -> list[str]:
    """P4 decision: columns whose exact distinct non-missing count equals the row count (key-like)."""
    n, summary = _column_summary(df)
    return _unique(df, n, summary, df.columns)


def drop_constant_columns(df: DataFrame) -> DataFrame:
    return df.drop(*constant_columns(df))


def drop_unique_columns(df: DataFrame) -> DataFrame:
    return df.drop(*unique_columns(df))


def inf_to_null(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """P5: +-inf -> NULL in float columns."""
    cols = [c for c in (cols or df.columns) if isinstance(dtype_of(df, c), FLOAT_TYPES)]
    inf = float("inf")
    return df.select([F.when(~F.col(quote(c)).isin(inf, -inf), F.col(quote(c))).alias(c) if c in cols
                      else F.col(quote(c)) for c in df.columns])


def drop_null_rows(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Drop rows with any NULL or NaN."""
    present = F.lit(True)
    for c in subset or df.columns:
        present = present & F.col(quote(c)).isNotNull()
    return nan_to_null(df).filter(present)


def clean_table(df: DataFrame) -> DataFrame:
    """Constant columns, then key-like columns (counted on the remaining table), then inf -> NULL, then
    rows with any missing value. The order matters: inf counts as a value in the column decisions."""
    n, summary = _column_summary(df)  # one summary serves both decisions: dropping columns keeps all rows
    constant = _constant(summary)
    unique = _unique(df, n, summary, [c for c in df.columns if c not in constant])
    return drop_null_rows(inf_to_null(df.drop(*constant, *unique)))


def fill_constant(df: DataFrame, cols: list[str], value) -> DataFrame:
    """Missing -> constant."""
    return df.select([F.coalesce(clean_value(df, c), F.lit(value).cast(dtype_of(df, c))).alias(c) if c in cols
                      else F.col(quote(c)) for c in df.columns])


def value_to_null(df: DataFrame, cols: list[str], value) -> DataFrame:
    """A given value -> NULL."""
    return df.select([F.nullif(F.col(quote(c)), F.lit(value).cast(dtype_of(df, c))).alias(c) if c in cols
                      else F.col(quote(c)) for c in df.columns])


def column_quantiles(df: DataFrame, cols: list[str], probs: list[float], exact: bool = True) -> DataFrame:
    """Quantiles of non-missing values per column, long form (column, prob, quantile).

    Exact (distributed rank, see ``exact_quantiles``) by default; ``exact=False`` uses ``percentile_approx``.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), clean_value(df, c).cast("double").alias("value")) for c in cols])
    long = df.select(F.inline(pairs)).filter(F.col("value").isNotNull())
    if exact:
        return exact_quantiles(long, ["column"], probs)
    q = long.groupBy("column").agg(F.percentile_approx("value", probs, 100000).alias("_q"))
    return q.select("column", F.posexplode("_q").alias("_i", "quantile")).select(
        "column", F.element_at(F.array(*[F.lit(float(p)) for p in probs]), F.col("_i") + 1).alias("prob"),
        "quantile")


def fill_median(df: DataFrame, cols: list[str], exact: bool = True) -> DataFrame:
    """P10: missing -> column median of the non-missing values. The medians are fitted once (one number per
    column) and applied as literals."""
    med = {r["column"]: r["quantile"] for r in column_quantiles(df, cols, [0.5], exact).collect()}
    out = []
    for c in df.columns:
        if c in cols:
            fill = F.lit(float(med[c])) if med.get(c) is not None else F.lit(None).cast("double")
            out.append(F.coalesce(clean_value(df, c).cast("double"), fill).alias(c))
        else:
            out.append(F.col(quote(c)))
    return df.select(out)


def repair_rate(df: DataFrame, col: str, exact: bool = True) -> DataFrame:
    """NULL -> 0, 0 -> NULL, median fill, then abs. The median is taken before abs: negatives count."""
    step = fill_constant(df, [col], 0)
    step = value_to_null(step, [col], 0)
    step = fill_median(step, [col], exact)
    return step.withColumn(col, F.abs(F.col(col)))


def derived_sum(df: DataFrame, name: str, cols: list[str]) -> DataFrame:
    """A + b (+ c); NULL propagates."""
    total = F.col(cols[0])
    for c in cols[1:]:
        total = total + F.col(c)
    return df.withColumn(name, total)


def log1p_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """log(1 + x)."""
    return df.select([F.log1p(clean_value(df, c)).alias(c) if c in cols else F.col(quote(c)) for c in df.columns])


def quantile_fences(df: DataFrame, cols: list[str], lower: float = 0.5, upper: float = 0.95,
                    k: float = 1.5, exact: bool = True) -> DataFrame:
    """P14 bounds per column (long form): lo = q(lower), hi = q(upper), fences lo - k*(hi-lo), hi + k*(hi-lo)."""
    q = column_quantiles(df, cols, sorted({lower, upper}), exact)
    g = q.groupBy("column").agg(F.max(F.when(F.col("prob") == lower, F.col("quantile"))).alias("q_lower"),
                                F.max(F.when(F.col("prob") == upper, F.col("quantile"))).alias("q_upper"))
    rng = F.col("q_upper") - F.col("q_lower")
    return g.select("column", "q_lower", "q_upper", (F.col("q_lower") - k * rng).alias("fence_low"),
                    (F.col("q_upper") + k * rng).alias("fence_high"))


def outlier_flag(df: DataFrame, cols: list[str], lower: float = 0.5, upper: float = 0.95, k: float = 1.5,
                 exact: bool = True) -> Column:
    """True when ANY column is strictly outside its fences (NULL is never an outlier)."""
    # fitted once: two numbers per column, applied as literals inside the filter
    fences = {r["column"]: (r["fence_low"], r["fence_high"])
              for r in quantile_fences(df, cols, lower, upper, k, exact).collect()}
    flag = F.lit(False)
    for c in cols:
        lo, hi = fences.get(c, (None, None))
        if lo is None:
            continue  # no non-missing value: nothing is an outlier
        v = clean_value(df, c)
        flag = flag | F.coalesce((v < F.lit(float(lo))) | (v > F.lit(float(hi))), F.lit(False))
    return flag


def remove_outliers(df: DataFrame, cols: list[str] | None = None, lower: float = 0.5, upper: float = 0.95,
                    k: float = 1.5, exact: bool = True) -> DataFrame:
    """Keep rows inside the fences of every numeric column; bounds come from the unfiltered table."""
    cols = cols or numeric_columns(df)
    return df.filter(~outlier_flag(df, cols, lower, upper, k, exact))


def outlier_report(df: DataFrame, cols: list[str] | None = None, lower: float = 0.5, upper: float = 0.95,
                   k: float = 1.5, exact: bool = True) -> DataFrame:
    """Rows before, after and removed by ``remove_outliers`` (one pass with a conditional count)."""
    cols = cols or numeric_columns(df)
    flag = outlier_flag(df, cols, lower, upper, k, exact)
    g = df.agg(F.count(F.lit(1)).alias("rows_before"), F.count_if(flag).alias("rows_removed"))
    return g.select("rows_before", (F.col("rows_before") - F.col("rows_removed")).alias("rows_after"),
                    "rows_removed")


def threshold_label(df: DataFrame, prob_col: str, threshold: float, out: str = "prediction") -> DataFrame:
    """(p >= t) as 0/1."""
    return df.withColumn(out, (F.col(prob_col) >= F.lit(threshold)).cast("int"))


def select_dtype(df: DataFrame, kind: str = "number") -> DataFrame:
    """Keep columns of a dtype class ('number' or 'string')."""
    from tablesmith.functions.columns import string_columns
    cols = numeric_columns(df) if kind == "number" else string_columns(df)
    return df.select(*[quote(c) for c in cols])
