"""Preprocessing fitted on the training part and applied to every part.

``fit`` runs a few aggregates over the training rows (exact distributed medians, moments over the imputed
values, modes and category lists) and keeps the fitted values, a handful per column. ``transform`` is pure
column expressions with those values as literals: no join, no shuffle, inside whole-stage codegen.
Feature names are kept (``num__<col>``, ``cat__<col>_<category>``); ``assemble`` builds an MLlib vector.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesmith.functions.columns import clean_value, quote
from tablesmith.functions.cumulative import running_totals
from tablesmith.operators.clean import column_quantiles
from tablesmith.operators.profile import top_of_counts


def fit_medians(train: DataFrame, cols: list[str], exact: bool = True) -> dict:
    """T1 fit: median of the non-missing training values per column."""
    if not cols:
        return {}
    q = column_quantiles(train, cols, [0.5], exact).collect()  # one row per column
    return {r["column"]: r["quantile"] for r in q}


def fit_moments(train: DataFrame, cols: list[str], fill: dict | None = None) -> dict:
    """T2 fit: mean and POPULATION std of each column (after filling with ``fill``), in one aggregate."""
    fill = fill or {}
    aggs = []
    for i, c in enumerate(cols):
        v = clean_value(train, c).cast("double")
        if c in fill and fill[c] is not None:
            v = F.coalesce(v, F.lit(float(fill[c])))
        aggs += [F.avg(v).alias(f"m{i}"), F.stddev_pop(v).alias(f"s{i}")]
    row = train.agg(*aggs).collect()[0]
    return {c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(cols)}


def category_counts(train: DataFrame, cols: list[str]) -> DataFrame:
    """(column, value, n) of the non-null values as strings: one pass, counted map-side."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(quote(c)).cast("string").alias("value")) for c in cols])
    return (train.select(F.inline(pairs)).filter(F.col("value").isNotNull())
            .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))


def vocabulary(train: DataFrame, cols: list[str]) -> DataFrame:
    """(column, value, index): the training categories with their 0-based place in sorted order, a table of any
    size. The place is a two-level running count, so no column's values meet in one task."""
    counts = category_counts(train, cols).select("column", "value", F.lit(1).cast("long").alias("one"))
    return running_totals(counts, ["column"], "value", ["one"]).select(
        "column", "value", (F.col("cum_one") - 1).cast("int").alias("index"))


def fit_modes(train: DataFrame, cols: list[str]) -> dict:
    """T3 fit: most frequent non-null value, ties to the smallest (aggregates only; one row per column)."""
    if not cols:
        return {}
    counts = category_counts(train, cols).withColumnRenamed("n", "_f")
    return {r["column"]: r["top"] for r in top_of_counts(counts).collect()}


def fit_categories(train: DataFrame, cols: list[str]) -> dict:
    """Sorted training categories per column, for outputs that have a column per category: there the vocabulary is
    the schema. For vocabularies that grow with the data use ``label_encode`` and ``one_hot_sparse``, which keep it
    in a table."""
    if not cols:
        return {}
    found = category_counts(train, cols).groupBy("column").agg(F.array_sort(F.collect_list("value")).alias("cats"))
    return {c: [] for c in cols} | {r["column"]: list(r["cats"]) for r in found.collect()}


def impute_expr(df: DataFrame, c: str, value) -> Column:
    """Missing -> fitted value; numeric columns come out as double (a median need not be an integer)."""
    v = clean_value(df, c).cast("double")
    return v if value is None else F.coalesce(v, F.lit(float(value)))


def scale_expr(x: Column, mean: float, std: float) -> Column:
    """(x - mean) / std with std 0 (or undefined) treated as 1."""
    s = std if std else 1.0
    return (x.cast("double") - F.lit(float(mean if mean is not None else 0.0))) / F.lit(float(s))


def one_hot_exprs(x: Column, name: str, cats: list[str], drop_first: bool = False) -> list[Column]:
    """One 0/1 double column per category; unseen values and NULL give all zeros."""
    use = cats[1:] if drop_first else cats
    return [F.coalesce((x == F.lit(v)).cast("double"), F.lit(0.0)).alias(f"{name}_{v}") for v in use]


@dataclass
class PreprocessorModel:
    numeric: list[str]
    categorical: list[str]
    medians: dict = field(default_factory=dict)
    moments: dict = field(default_factory=dict)
    modes: dict = field(default_factory=dict)
    categories: dict = field(default_factory=dict)
    passthrough: bool = False

    def feature_names(self) -> list[str]:
        names = [f"num__{c}" for c in self.numeric]
        for c in self.categorical:
            names += [f"cat__{c}_{v}" for v in self.categories.get(c, [])]
        return names

    def feature_columns(self, df: DataFrame) -> list[Column]:
        out = []
        for c in self.numeric:
            m, s = self.moments[c]
            out.append(scale_expr(impute_expr(df, c, self.medians.get(c)), m, s).alias(f"num__{c}"))
        for c in self.categorical:
            x = F.coalesce(F.col(quote(c)).cast("string"), F.lit(self.modes.get(c)))
            out += one_hot_exprs(x, f"cat__{c}", self.categories.get(c, []))
        return out

    def transform(self, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
        """T5 (numeric block, then categorical block; other columns dropped except ``keep``) or, with
        ``passthrough``, T6 (remaining columns appended at the end)."""
        keep = list(keep or [])
        cols = [F.col(k) for k in keep] + self.feature_columns(df)
        if self.passthrough:
            used = set(self.numeric) | set(self.categorical) | set(keep)
            cols += [F.col(quote(c)) for c in df.columns if c not in used]
        return df.select(*cols)

    def with_vector(self, df: DataFrame, out: str = "features") -> DataFrame:
        """``df`` with the features as an MLlib vector; a column of that name is replaced. The feature columns pass
        under numbered names, so category values may hold any character; a missing feature is NaN."""
        start = "_f"
        while any(c.startswith(start) for c in df.columns):
            start = "_" + start
        values = [c.alias(f"{start}{i}") for i, c in enumerate(self.feature_columns(df))]
        names = [f"{start}{i}" for i in range(len(values))]
        wide = df.select(*[F.col(quote(c)) for c in df.columns if c != out], *values)
        return VectorAssembler(inputCols=names, outputCol=out, handleInvalid="keep").transform(wide).drop(*names)

    def assemble(self, df: DataFrame, keep: list[str] | None = None, out: str = "features") -> DataFrame:
        return self.with_vector(df, out).select(*(keep or []), out)

    def to_json(self) -> str:
        return json.dumps(self.__dict__)

    @classmethod
    def from_json(cls, text: str) -> "PreprocessorModel":
        d = json.loads(text)
        d["moments"] = {k: tuple(v) for k, v in d["moments"].items()}
        return cls(**d)

    def save(self, spark, path: str) -> None:
        """Write the fitted values as a one-row JSON table (shared storage, not a local file)."""
        spark.createDataFrame([(self.to_json(),)], "model string").coalesce(1).write.mode("overwrite").text(path)

    @classmethod
    def load(cls, spark, path: str) -> "PreprocessorModel":
        return cls.from_json(spark.read.text(path).first()[0])


def fit_preprocessor(train: DataFrame, numeric: list[str], categorical: list[str], passthrough: bool = False,
                     exact: bool = True, categories: dict | None = None) -> PreprocessorModel:
    """Median impute + standardise numeric, mode impute + one-hot categorical; fit on ``train`` only.
    ``categories`` names the categories of columns whose vocabulary is known; others are fitted."""
    med = fit_medians(train, numeric, exact)
    mom = fit_moments(train, numeric, med)
    # after mode imputation the categories are exactly the non-null training values: the mode is one of them
    modes = {c: None for c in categorical} | fit_modes(train, categorical)
    cats = {c: list((categories or {}).get(c, [])) for c in categorical if c in (categories or {})}
    cats |= fit_categories(train, [c for c in categorical if c not in cats])
    return PreprocessorModel(numeric, categorical, med, mom, modes, {c: cats[c] for c in categorical}, passthrough)


def impute_median(train: DataFrame, df: DataFrame, cols: list[str]) -> DataFrame:
    """Fill missing values of ``df`` with the training medians."""
    med = fit_medians(train, cols)
    return df.select([impute_expr(df, c, med.get(c)).alias(c) if c in cols else F.col(quote(c)) for c in df.columns])


def standard_scale(train: DataFrame, df: DataFrame, cols: list[str]) -> DataFrame:
    """(x - mean) / population std of the training part; std 0 -> 1."""
    mom = fit_moments(train, cols)
    return df.select([scale_expr(F.col(quote(c)), *mom[c]).alias(c) if c in cols else F.col(quote(c)) for c in df.columns])


def impute_mode(train: DataFrame, df: DataFrame, cols: list[str]) -> DataFrame:
    """Fill missing values with the training mode (ties -> smallest)."""
    modes = fit_modes(train, cols)
    return df.select([F.coalesce(F.col(quote(c)).cast("string"), F.lit(modes.get(c))).alias(c) if c in cols else F.col(quote(c))
                      for c in df.columns])


def one_hot(train: DataFrame, df: DataFrame, cols: list[str], drop_first: bool = False) -> DataFrame:
    """One-hot over the sorted training categories; unseen and NULL -> all zeros."""
    cats = fit_categories(train, cols)
    out = [F.col(quote(c)) for c in df.columns if c not in cols]
    for c in cols:
        out += one_hot_exprs(F.col(quote(c)).cast("string"), c, cats[c], drop_first)
    return df.select(*out)


def _indexed(train: DataFrame, df: DataFrame, cols: list[str]) -> tuple[DataFrame, list[str]]:
    """``df`` with the place of each of ``cols`` among the training categories (NULL if unseen or NULL): one
    equi-join per column, which Spark broadcasts while a vocabulary is small and else splits at hot values."""
    words = vocabulary(train, cols)
    names = []
    for i, c in enumerate(cols):
        v, k = f"_value_{i}", f"_index_{i}"
        mine = words.filter(F.col("column") == c).select(F.col("value").alias(v), F.col("index").alias(k))
        df = df.join(mine, F.col(quote(c)).cast("string") == F.col(v), "left").drop(v)
        names.append(k)
    return df, names


def label_encode(train: DataFrame, df: DataFrame, cols: list[str]) -> DataFrame:
    """0-based rank of the value among the sorted training categories (NULL / unseen -> NULL)."""
    out, names = _indexed(train, df, cols)
    place = dict(zip(cols, names))
    return out.select([F.col(place[c]).alias(c) if c in place else F.col(quote(c)) for c in df.columns])


def one_hot_sparse(train: DataFrame, df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    """T4 / T6 for vocabularies of any size: ``df`` without ``cols``, with ``out`` = struct(size, indices), the ones
    of the concatenated one-hot blocks in the order of ``cols``. Unseen and NULL values have no one."""
    indexed, names = _indexed(train, df, cols)
    sizes = {r["column"]: r["n"] for r in
             vocabulary(train, cols).groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}  # row per column
    start, ones = 0, []
    for c, k in zip(cols, names):
        ones.append(F.col(k) + F.lit(start))
        start += sizes.get(c, 0)
    keep = [F.col(quote(c)) for c in df.columns if c not in cols]
    return indexed.select(*keep, F.struct(F.lit(start).alias("size"),
                                          F.array_compact(F.array(*ones)).alias("indices")).alias(out))
