"""Split, drift, cleaning and AUC plans over ``lineitem``, the largest table: their time is data, not job overhead.

The lines before and from 1996-01-01 are the two samples of the drift plans; the prices of the later ones are 10 %
up, so that one column drifts.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tablesmith.functions.columns import round_doubles
from tablesmith.operators import clean as C
from tablesmith.operators import drift as D
from tablesmith.operators import evaluate as EV
from tablesmith.operators import split as SP
from tablesmith.plans import sqlparts as Q
from tablesmith.plans import tables as TB
from tablesmith.plans.catalog import register

NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
CAT = ["l_returnflag", "l_linestatus"]

LINES = """lines AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS line_id, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
         l_linestatus, l_shipdate FROM lineitem)"""
TAGGED = LINES + """,
tagged AS (
  SELECT * REPLACE (CASE WHEN l_shipdate >= DATE '1996-01-01' THEN l_extendedprice * 1.1 ELSE l_extendedprice END
                    AS l_extendedprice),
         CAST(l_shipdate >= DATE '1996-01-01' AS INTEGER) AS _side FROM lines)"""


def lines(spark, sf_dir):
    li = TB.table(spark, sf_dir, "lineitem")
    return li.select(F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("line_id"), *NUM, *CAT, "l_shipdate")


def _tagged(spark, sf_dir, cols):
    late = F.col("l_shipdate") >= F.lit("1996-01-01").cast("date")
    li = lines(spark, sf_dir).withColumns({
        "l_extendedprice": F.when(late, F.col("l_extendedprice") * 1.1).otherwise(F.col("l_extendedprice")),
        "_side": late.cast("int")})
    return D.side_split(li, "_side", 0, 1, cols)


@register("split_lines", Q.with_(LINES, Q.split_cte(src="lines", key="line_id", target="l_returnflag")) +
          "SELECT line_id, l_returnflag, split FROM split")
def split_lines(spark, sf_dir):
    li = lines(spark, sf_dir).select("line_id", "l_returnflag")
    return SP.stratified_split(li, "line_id", "l_returnflag", (0.7, 0.15, 0.15), TB.SEED)


@register("drift_table_lines", Q.with_(
    TAGGED, Q.nlong_cte(NUM), Q.numeric_bins_cte(by_value=("l_discount", "l_tax")), Q.share_measures_cte("nbins", "smn"),
    Q.clong_cte(CAT), Q.categorical_bins_cte(), Q.share_measures_cte("cbins", "smc"), """dt AS (
  SELECT "column", 'num' AS kind, 'psi' AS method, psi AS score FROM smn
  UNION ALL SELECT "column", 'cat', 'jensenshannon', jensenshannon FROM smc)""") + """
SELECT "column", kind, method, round(score, 6) AS score, 0.1 AS threshold, score >= 0.1 AS drifted FROM dt""")
def drift_table_lines(spark, sf_dir):
    tagged = _tagged(spark, sf_dir, NUM + CAT)
    return round_doubles(D.drift_table_tagged(tagged, NUM, CAT, by_value=("l_discount", "l_tax")))


@register("drift_ks_lines", Q.with_(TAGGED, Q.nlong_cte(NUM), Q.cumulative_cte()) + """
SELECT "column", 'ks' AS method, round(ks, 6) AS statistic, n_ref, n_cur FROM cum""")
def drift_ks_lines(spark, sf_dir):
    res = D.method_table_tagged(_tagged(spark, sf_dir, NUM), NUM, "ks")
    return round_doubles(res.select("column", "method", "statistic", "n_ref", "n_cur"))


RAW = """raw AS (
  SELECT l_quantity, CASE WHEN l_discount > 0 THEN l_extendedprice / l_discount ELSE 'inf'::DOUBLE END AS ratio,
         CASE WHEN l_tax > 0 THEN l_tax END AS l_tax, l_returnflag, 'sea' AS channel FROM lines)"""


@register("clean_lines", Q.with_(LINES, RAW) + """
SELECT l_quantity, round(ratio, 6) AS ratio, l_tax, l_returnflag FROM raw WHERE l_tax IS NOT NULL AND NOT isinf(ratio)""")
def clean_lines(spark, sf_dir):
    li = lines(spark, sf_dir)
    raw = li.select(
        "l_quantity",
        F.when(F.col("l_discount") > 0, F.col("l_extendedprice") / F.col("l_discount")).otherwise(float("inf")).alias("ratio"),
        F.when(F.col("l_tax") > 0, F.col("l_tax")).alias("l_tax"), "l_returnflag", F.lit("sea").alias("channel"))
    return round_doubles(C.clean_table(raw))


@register("roc_auc_lines", """
WITH scored AS (SELECT CAST(l_returnflag = 'R' AS INTEGER) AS label, l_extendedprice * (1 - l_discount) AS score FROM lineitem),
sc AS (SELECT score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label <> 1) AS neg FROM scored
       GROUP BY score),
cp AS (SELECT pos, neg, sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
              sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM sc)
SELECT round(sum(neg * (tp - pos + pos / 2.0)) / (max(P) * max(N)), 6) AS roc_auc FROM cp""")
def roc_auc_lines(spark, sf_dir):
    li = TB.table(spark, sf_dir, "lineitem")
    scored = li.select((F.col("l_returnflag") == "R").cast("int").alias("label"),
                       (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("score"))
    return round_doubles(EV.roc_auc(scored))
