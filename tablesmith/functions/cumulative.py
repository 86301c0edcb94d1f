"""Running totals over ordered values without a single-partition window, and exact quantiles built on them.

A window ``partitionBy(group).orderBy(value)`` puts every value of a group into one task. On large tables a
group (one column's distinct values) can hold billions of rows, so the running total is done in two levels:

1. the rows are dealt by range of (group, value) into partitions of about equal row counts, whatever the
   distribution of the values: Spark's range partitioner samples them and cuts by counts, not by width. The
   partition number is a bucket id that is monotone in the value; it is saved with the rows (a checkpoint in the
   shared folder), so that a recompute after a lost executor cannot deal them differently;
2. per (group, bucket) totals form a table with about a row per partition and group; their exclusive prefix sums
   are the bucket offsets (a window over that small table);
3. inside each (group, bucket) a window adds the running sum to the offset.

A NULL group is a group like any other: all joins are NULL-safe.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablesmith.session import ensure_checkpoint_dir


def bucketed(df: DataFrame, group_cols: list[str], order_col: str,
             buckets: int | None = None) -> tuple[DataFrame, list[str]]:
    """``df``, saved, with ``_bkt``: monotone in ``order_col`` within a group, about equally many rows in each.

    ``buckets``: how many over all groups; by default as many as Spark makes shuffle partitions. Rows that are
    equal in group and value share a bucket, so callers aggregate by value first."""
    keys = list(group_cols) or ["_g"]
    if not group_cols:
        df = df.withColumn("_g", F.lit(0))
    dealt = df.repartitionByRange(*([buckets] if buckets else []), *keys, order_col)
    ensure_checkpoint_dir(df.sparkSession)
    return dealt.withColumn("_bkt", F.spark_partition_id().cast("long")).checkpoint(eager=True), keys


def _same(left: list[str], right: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right)])


def running_totals(df: DataFrame, group_cols: list[str], order_col: str, sum_cols: list[str],
                   prefix: str = "cum_", with_next: bool = False, buckets: int | None = None) -> DataFrame:
    """Add ``cum_<c>`` (inclusive running sum of ``c`` in ascending ``order_col`` within the group) for each
    ``c`` in ``sum_cols``; with ``with_next`` also ``_next`` (the next larger ``order_col`` value of the group,
    NULL for the last). ``order_col`` must be distinct within a group (aggregate first)."""
    x, keys = bucketed(df, group_cols, order_col, buckets)
    tot_aggs = [F.sum(c).alias(f"_t_{c}") for c in sum_cols] + [F.min(order_col).alias("_bmin")]
    tot = x.groupBy(*keys, "_bkt").agg(*tot_aggs)
    wb = Window.partitionBy(*keys).orderBy("_bkt")
    marks = [f"_k_{k}" for k in keys] + ["_ob"]
    offs = tot.select(
        *[F.col(k).alias(m) for k, m in zip(keys + ["_bkt"], marks)],
        *[(F.sum(f"_t_{c}").over(wb) - F.col(f"_t_{c}")).alias(f"_o_{c}") for c in sum_cols],
        F.lead("_bmin").over(wb).alias("_nextb"))
    # about a row per partition and group; AQE decides broadcast or shuffle by its measured size
    x = x.join(offs, _same(keys + ["_bkt"], marks))
    wi = Window.partitionBy(*keys, "_bkt").orderBy(order_col)
    wr = wi.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cols = [F.col(c) for c in df.columns if c != "_g"]
    cols += [(F.col(f"_o_{c}") + F.sum(c).over(wr)).alias(f"{prefix}{c}") for c in sum_cols]
    if with_next:
        cols.append(F.coalesce(F.lead(order_col).over(wi), F.col("_nextb")).alias("_next"))
    return x.select(*cols)


def distinct_value_counts(long: DataFrame, group_cols: list[str], value_col: str = "value",
                          weight_cols: dict | None = None) -> DataFrame:
    """(group, value) -> row counts; map-side partial aggregation keeps the shuffle to distinct values."""
    if weight_cols:
        aggs = [F.sum(expr).alias(name) for name, expr in weight_cols.items()]
    else:
        aggs = [F.count(F.lit(1)).alias("n")]
    return long.groupBy(*group_cols, value_col).agg(*aggs)


def exact_quantiles(long: DataFrame, group_cols: list[str], probs: list[float], value_col: str = "value",
                    buckets: int | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation (h = (n-1)q, as ``quantile_cont`` / ``percentile``).

    ``long`` holds one row per observation (NULLs already removed). Returns (group..., prob, quantile).
    Selection, not a full sort: distinct values are counted (partial aggregate, so a value repeated in a third of
    the rows is one row), dealt into buckets by range, and per-bucket counts give each bucket's rank
    offset. Only the buckets that hold a wanted rank (at most 2 x len(probs) per group) are ranked by a window.
    """
    dv = distinct_value_counts(long, group_cols, value_col)
    x, keys = bucketed(dv, group_cols, value_col, buckets)
    tot = x.groupBy(*keys, "_bkt").agg(F.sum("n").alias("_bn"))
    wb = Window.partitionBy(*keys).orderBy("_bkt")
    tot = tot.select(*keys, "_bkt", "_bn", (F.sum("_bn").over(wb) - F.col("_bn")).alias("_off"),
                     F.sum("_bn").over(Window.partitionBy(*keys)).alias("_total"))
    # wanted 0-based ranks per (group, prob): floor and ceil of h
    h = (F.col("_total") - 1) * F.col("prob")
    wanted = (tot.select(*keys, "_bkt", "_bn", "_off", "_total",
                         F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("prob"))
              .withColumn("_h", h)
              .withColumn("_r", F.explode(F.array_distinct(F.array(F.floor("_h").cast("long"),
                                                                    F.ceil("_h").cast("long")))))
              .filter((F.col("_off") <= F.col("_r")) & (F.col("_r") < F.col("_off") + F.col("_bn")))
              .select(*[F.col(k).alias(f"_tk_{k}") for k in keys], F.col("_bkt").alias("_tb"), "_off", "prob",
                      "_h", "_r"))
    # at most 2 x len(probs) rows per group: broadcast
    tb = wanted.select(*[f"_tk_{k}" for k in keys], "_tb", "_off").distinct()
    marks = [f"_tk_{k}" for k in keys] + ["_tb"]
    sel = x.join(F.broadcast(tb), _same(keys + ["_bkt"], marks)).select(*keys, "_bkt", "_off", value_col, "n")
    wi = Window.partitionBy(*keys, "_bkt").orderBy(value_col).rowsBetween(Window.unboundedPreceding, 0)
    ranked = sel.withColumn("_hi", F.col("_off") + F.sum("n").over(wi)).withColumn("_lo", F.col("_hi") - F.col("n"))
    cond2 = _same(keys + ["_bkt"], marks) & (F.col("_lo") <= F.col("_r")) & (F.col("_r") < F.col("_hi"))
    picked = ranked.join(F.broadcast(wanted.drop("_off")), cond2).select(
        *keys, "prob", "_h", "_r", F.col(value_col).alias("_v"))
    res = picked.groupBy(*keys, "prob").agg(
        F.first("_h").alias("_h"), F.min_by("_v", "_r").alias("_vlo"), F.max_by("_v", "_r").alias("_vhi"))
    frac = F.col("_h") - F.floor("_h")
    out = res.select(*keys, "prob", (F.col("_vlo") + frac * (F.col("_vhi") - F.col("_vlo"))).alias("quantile"))
    if not group_cols:
        out = out.drop("_g")
    return out
