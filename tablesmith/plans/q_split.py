"""Plans for splitting (SP1-SP3)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tablesmith.operators import split as SP
from tablesmith.plans import sqlparts as Q
from tablesmith.plans import tables as TB
from tablesmith.plans.catalog import register
from tablesmith.functions.columns import round_doubles


@register("stratified_split", Q.with_(Q.BOOKINGS, Q.split_cte()) +
          "SELECT o_orderkey, o_orderstatus, split FROM split")
def stratified_split(spark, sf_dir):
    return TB.bookings_split(spark, sf_dir).select("o_orderkey", "o_orderstatus", "split")


@register("stratified_folds", Q.with_(Q.BOOKINGS) + """
SELECT o_orderkey, o_orderstatus,
       CAST((row_number() OVER (PARTITION BY o_orderstatus
                                ORDER BY md5(CAST(o_orderkey AS VARCHAR) || ':42')) - 1) % 10 AS INTEGER) AS fold
FROM bookings""")
def stratified_folds(spark, sf_dir):
    b = TB.bookings(spark, sf_dir)
    return SP.stratified_folds(b, TB.KEY, TB.TARGET, k=10, seed=TB.SEED).select("o_orderkey", "o_orderstatus", "fold")


@register("split_balance", Q.with_(Q.BOOKINGS, Q.split_cte()) + """
SELECT split, o_orderstatus, n_rows, round(n_rows / sum(n_rows) OVER (PARTITION BY split), 6) AS share
FROM (SELECT split, o_orderstatus, count(*) AS n_rows FROM split GROUP BY ALL)""")
def split_balance(spark, sf_dir):
    return round_doubles(SP.split_balance(TB.bookings_split(spark, sf_dir), TB.TARGET))


@register("split_null_keys", Q.with_(Q.BOOKINGS, """marked AS (
  SELECT CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderkey END AS o_orderkey,
         CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS o_orderstatus FROM bookings)""") + """
SELECT o_orderstatus, split, n_rows, n_null_keys_kept FROM (
  SELECT o_orderstatus, count(*) AS n,
         CAST(round(0.7 * count(*)) AS BIGINT) AS c1, CAST(round(0.85 * count(*)) AS BIGINT) AS c2,
         CAST(sum(count(*) FILTER (WHERE o_orderkey IS NULL)) OVER () AS BIGINT) AS n_null_keys_kept
  FROM marked GROUP BY o_orderstatus) t,
  LATERAL (VALUES ('train', c1), ('val', c2 - c1), ('test', n - c2)) AS v(split, n_rows)
WHERE n_rows > 0""")
def split_null_keys(spark, sf_dir):
    """Rows with a NULL key, and a NULL class: none is lost and each class keeps its shares."""
    b = TB.bookings(spark, sf_dir)
    marked = b.select(F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderkey")).alias("o_orderkey"),
                      F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("o_orderstatus"))
    split = SP.stratified_split(marked, TB.KEY, TB.TARGET, (0.7, 0.15, 0.15), TB.SEED)
    per = split.groupBy("o_orderstatus", "split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("o_orderkey").isNull()).alias("_nulls"))
    return per.withColumn("n_null_keys_kept", F.sum("_nulls").over(Window.partitionBy())).drop("_nulls")


@register("fold_null_keys", Q.with_(Q.BOOKINGS) + """
SELECT o_orderstatus, fold, CAST(n // 10 + CASE WHEN fold < n % 10 THEN 1 ELSE 0 END AS BIGINT) AS n_rows
FROM (SELECT o_orderstatus, count(*) AS n FROM bookings GROUP BY 1), range(10) r(f),
     LATERAL (SELECT CAST(f AS INTEGER) AS fold)
WHERE n // 10 + CASE WHEN fold < n % 10 THEN 1 ELSE 0 END > 0""")
def fold_null_keys(spark, sf_dir):
    b = TB.bookings(spark, sf_dir)
    marked = b.withColumn(TB.KEY, F.when(F.col("o_orderpriority") != "5-LOW", F.col(TB.KEY)))
    folds = SP.stratified_folds(marked, TB.KEY, TB.TARGET, k=10, seed=TB.SEED)
    return folds.groupBy("o_orderstatus", "fold").agg(F.count(F.lit(1)).alias("n_rows"))
