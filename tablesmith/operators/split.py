"""Exact stratified splitting and k-fold assignment (SP1-SP3).

Order inside a class is ``md5("<key>:<seed>")``: seeded, reproducible and independent of partitioning. A class
of ``n`` rows puts its first ``round(f1 * n)`` rows (in that order) in the first part, up to
``round((f1 + f2) * n)`` in the second and the rest in the third; class shares are kept to one row.

A window ``partitionBy(target)`` would put a whole class (half the table for a binary target) into one task.
Instead the hash's leading hex digits define buckets: per (class, bucket) counts are a small partial
aggregate, their prefix sums locate the bucket that holds each cut, and only rows of those (at most two per
class) boundary buckets are ranked by a window. Every other row is assigned by comparing its bucket. Rows find
their class's cuts by class and share (bucket modulo ``SHARES``): a join on the class alone would again put a
whole class into one task wherever Spark doesn't broadcast the cuts.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablesmith.functions.columns import quote

SPLIT_NAMES = ("train", "val", "test")
#: Parts of a class's rows, by bucket, that join with the class's cuts separately.
SHARES = 1024


def hash_order(df: DataFrame, key: str, seed: int) -> Column:
    """Seeded per-row order key: lower-case hex md5 of ``"<key>:<seed>"``. A NULL key identifies no row, so such
    rows are ordered by a hash of all their columns instead, which also spreads them over the buckets."""
    k = F.col(quote(key)).cast("string")
    content = F.xxhash64(*[F.col(quote(c)) for c in df.columns]).cast("string")
    return F.md5(F.coalesce(F.concat(k, F.lit(f":{seed}")), F.concat(F.lit("null:"), content, F.lit(f":{seed}"))))


def _bucketed(df: DataFrame, key: str, seed: int, digits: int) -> DataFrame:
    """``df`` with the bucket of its order key."""
    return df.withColumn("_b", F.conv(F.substring(hash_order(df, key, seed), 1, digits), 16, 10).cast("long"))


def _order(df: DataFrame, key: str, seed: int) -> list[Column]:
    """A row's order key, and a tie-break for rows of one key: a recompute ranks them alike (rows equal in all columns
    are interchangeable)."""
    return [hash_order(df, key, seed).alias("_h"), F.xxhash64(*[F.col(quote(c)) for c in df.columns]).alias("_tie")]


def _dec(x: float) -> Column:
    return F.lit(Decimal(str(x)))


def stratified_split(df: DataFrame, key: str, target: str, fractions=(0.7, 0.15, 0.15), seed: int = 42,
                     names=SPLIT_NAMES, split_col: str = "split", digits: int = 4) -> DataFrame:
    """Add ``split_col`` with ``names[i]`` so each class keeps its shares exactly (one row of rounding).

    ``fractions`` are the part sizes (summing to 1); the first two cuts are ``round(f1*n)`` and
    ``round((f1+f2)*n)`` with half-up rounding on exact decimals. Every input row comes out once, rows with a
    NULL or repeated key and the NULL class included. ``key`` should identify rows (a row id): equal keys share a
    hash, so they lie in one bucket.
    """
    c1 = Decimal(str(fractions[0]))
    c2 = c1 + Decimal(str(fractions[1]))
    keyed = _bucketed(df, key, seed, digits)
    t = F.col(target)
    counts = keyed.groupBy(target, "_b").agg(F.count(F.lit(1)).alias("_cnt"))
    w = Window.partitionBy(target).orderBy("_b")
    counts = counts.select(target, "_b", "_cnt",
                           (F.sum("_cnt").over(w) - F.col("_cnt")).alias("_before"),
                           F.sum("_cnt").over(Window.partitionBy(target)).alias("_n"))
    cut1 = F.round(F.lit(c1) * F.col("_n")).cast("long")
    cut2 = F.round(F.lit(c2) * F.col("_n")).cast("long")
    counts = counts.withColumn("_cut1", cut1).withColumn("_cut2", cut2)
    incl = F.col("_before") + F.col("_cnt")
    # the buckets holding each cut and the rows before them, a row per class and share that has rows
    cuts = counts.groupBy(target).agg(
        F.first("_cut1").alias("_cut1"), F.first("_cut2").alias("_cut2"),
        F.min_by(F.struct("_b", "_before"), F.when(incl >= F.col("_cut1"), F.col("_b"))).alias("_k1"),
        F.min_by(F.struct("_b", "_before"), F.when(incl >= F.col("_cut2"), F.col("_b"))).alias("_k2"),
        F.collect_set(F.col("_b") % SHARES).alias("_shares"))
    cuts = cuts.select(F.col(target).alias("_t"), F.explode("_shares").alias("_share"), "_cut1", "_cut2",
                       F.col("_k1._b").alias("_b1"), F.col("_k1._before").alias("_o1"),
                       F.col("_k2._b").alias("_b2"), F.col("_k2._before").alias("_o2"))
    # no hint: Spark broadcasts the cuts only if their measured size is small
    b = F.col("_b")
    j = keyed.join(cuts, t.eqNullSafe(F.col("_t")) & (b % SHARES == F.col("_share")))
    boundary = (b == F.col("_b1")) | (b == F.col("_b2"))
    by_bucket = (j.filter(~boundary)
                 .withColumn(split_col, F.when(b < F.col("_b1"), names[0])
                             .when(b < F.col("_b2"), names[1]).otherwise(names[2])))
    wr = Window.partitionBy("_t", "_b").orderBy("_h", "_tie")
    rank = F.when(b == F.col("_b1"), F.col("_o1")).otherwise(F.col("_o2")) + F.row_number().over(wr)
    # only these rows need their whole order key; the join's rows are alike in both branches, so they are dealt once
    by_rank = (j.filter(boundary).select("*", *_order(df, key, seed)).withColumn("_rk", rank)
               .withColumn(split_col, F.when(F.col("_rk") <= F.col("_cut1"), names[0])
                           .when(F.col("_rk") <= F.col("_cut2"), names[1]).otherwise(names[2])))
    out_cols = df.columns + [split_col]
    return by_bucket.select(out_cols).unionByName(by_rank.select(out_cols))


def class_rank(df: DataFrame, key: str, target: str, seed: int = 42, rank_col: str = "_rank",
               digits: int = 4) -> DataFrame:
    """1-based rank of each row inside its class in ``hash_order`` (two-level: bucket offsets + window)."""
    keyed = _bucketed(df, key, seed, digits).select("*", *_order(df, key, seed))
    counts = keyed.groupBy(target, "_b").agg(F.count(F.lit(1)).alias("_cnt"))
    w = Window.partitionBy(target).orderBy("_b")
    offs = counts.select(F.col(target).alias("_t"), F.col("_b").alias("_ob"),
                         (F.sum("_cnt").over(w) - F.col("_cnt")).alias("_off"))
    # classes x 16^digits rows: AQE broadcasts it when the measured size is small
    j = keyed.join(offs, F.col(target).eqNullSafe(F.col("_t")) & (F.col("_b") == F.col("_ob")))
    wr = Window.partitionBy("_t", "_b").orderBy("_h", "_tie")
    return j.withColumn(rank_col, F.col("_off") + F.row_number().over(wr)).select(*df.columns, rank_col)


def stratified_folds(df: DataFrame, key: str, target: str, k: int = 10, seed: int = 42,
                     fold_col: str = "fold", digits: int = 4) -> DataFrame:
    """Stratified k-fold: fold = (rank inside the class - 1) mod k, so class shares per fold differ by <= 1."""
    r = class_rank(df, key, target, seed, digits=digits)
    return r.withColumn(fold_col, ((F.col("_rank") - 1) % k).cast("int")).drop("_rank")


def split_balance(split_df: DataFrame, target: str, split_col: str = "split") -> DataFrame:
    """Rows and class share per split (SP3)."""
    per = split_df.groupBy(split_col, target).agg(F.count(F.lit(1)).alias("n_rows"))
    w = Window.partitionBy(split_col)
    return per.withColumn("share", F.col("n_rows") / F.sum("n_rows").over(w))
