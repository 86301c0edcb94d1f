"""Plans for sources-side cleaning (P1-P18) over ``bookings_raw`` / ``bookings_gappy``."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablesmith.functions.columns import round_doubles
from tablesmith.operators import clean as C
from tablesmith.plans import sqlparts as Q
from tablesmith.plans import tables as TB
from tablesmith.plans.catalog import register

RAW = Q.with_(Q.RAW)
GAPPY = Q.with_(Q.BOOKINGS_GAPPY)
NUM_ALL = TB.NUMERIC + ["is_filled"]


@register("drop_columns", RAW + "SELECT * EXCLUDE (channel) FROM raw")
def drop_columns(spark, sf_dir):
    # 'status_note' is absent: ignored
    return C.drop_columns(TB.bookings_raw(spark, sf_dir), ["channel", "status_note"])


@register("feature_target", Q.with_(Q.BOOKINGS) + "SELECT * EXCLUDE (o_orderstatus) FROM bookings")
def feature_target(spark, sf_dir):
    x, _y = C.feature_target(TB.bookings(spark, sf_dir), TB.TARGET, TB.KEY)
    return x


@register("feature_target_y", Q.with_(Q.BOOKINGS) + "SELECT o_orderkey, o_orderstatus FROM bookings")
def feature_target_y(spark, sf_dir):
    _x, y = C.feature_target(TB.bookings(spark, sf_dir), TB.TARGET, TB.KEY)
    return y


@register("drop_constant_columns", RAW + "SELECT * EXCLUDE (channel) FROM raw")
def drop_constant_columns(spark, sf_dir):
    return C.drop_constant_columns(TB.bookings_raw(spark, sf_dir))


@register("drop_unique_columns", RAW + "SELECT * EXCLUDE (channel, o_orderkey) FROM raw")
def drop_unique_columns(spark, sf_dir):
    return C.drop_unique_columns(C.drop_constant_columns(TB.bookings_raw(spark, sf_dir)))


@register("inf_to_null", RAW + """
SELECT o_orderkey, CASE WHEN isinf(balance_score) THEN NULL ELSE balance_score END AS balance_score FROM raw""")
def inf_to_null(spark, sf_dir):
    return round_doubles(C.inf_to_null(TB.bookings_raw(spark, sf_dir)).select("o_orderkey", "balance_score"))


@register("drop_null_rows", RAW + """
SELECT * FROM raw
WHERE o_totalprice IS NOT NULL AND NOT isnan(o_totalprice) AND NOT isnan(c_acctbal) AND NOT isnan(balance_score)""")
def drop_null_rows(spark, sf_dir):
    return round_doubles(C.drop_null_rows(TB.bookings_raw(spark, sf_dir)))


@register("clean_table", RAW + """
SELECT * EXCLUDE (channel, o_orderkey) FROM raw
WHERE o_totalprice IS NOT NULL AND NOT isnan(balance_score) AND NOT isinf(balance_score)""")
def clean_table(spark, sf_dir):
    return round_doubles(C.clean_table(TB.bookings_raw(spark, sf_dir)))


@register("fill_constant", GAPPY + """
SELECT o_orderkey, coalesce(o_totalprice, 0.0) AS o_totalprice, coalesce(c_acctbal, 0.0) AS c_acctbal FROM gappy""")
def fill_constant(spark, sf_dir):
    g = TB.bookings_gappy(spark, sf_dir)
    return C.fill_constant(g, ["o_totalprice", "c_acctbal"], 0).select("o_orderkey", "o_totalprice", "c_acctbal")


@register("value_to_null", Q.with_(Q.BOOKINGS) + "SELECT o_orderkey, nullif(c_nationkey, 0) AS c_nationkey FROM bookings")
def value_to_null(spark, sf_dir):
    return C.value_to_null(TB.bookings(spark, sf_dir), ["c_nationkey"], 0).select("o_orderkey", "c_nationkey")


@register("fill_median", GAPPY + """
SELECT o_orderkey,
       round(coalesce(o_totalprice, (SELECT quantile_cont(o_totalprice, 0.5) FROM gappy)), 6) AS o_totalprice,
       round(coalesce(c_acctbal, (SELECT quantile_cont(c_acctbal, 0.5) FROM gappy)), 6) AS c_acctbal
FROM gappy""")
def fill_median(spark, sf_dir):
    g = TB.bookings_gappy(spark, sf_dir)
    return round_doubles(C.fill_median(g, ["o_totalprice", "c_acctbal"]).select("o_orderkey", "o_totalprice", "c_acctbal"))


RATE = Q.with_(Q.BOOKINGS, """rate AS (
  SELECT o_orderkey, CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN NULL WHEN c_mktsegment = 'BUILDING' THEN 0.0
                          ELSE c_acctbal END AS rate FROM bookings),
step AS (SELECT o_orderkey, nullif(coalesce(rate, 0.0), 0.0) AS rate FROM rate)""")


def _rate_table(spark, sf_dir):
    b = TB.bookings(spark, sf_dir)
    r = (F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit(None).cast("double"))
         .when(F.col("c_mktsegment") == "BUILDING", F.lit(0.0)).otherwise(F.col("c_acctbal")))
    return b.select("o_orderkey", r.alias("rate"))


@register("repair_rate", RATE + """
SELECT o_orderkey, round(abs(coalesce(rate, (SELECT quantile_cont(rate, 0.5) FROM step))), 6) AS rate FROM step""")
def repair_rate(spark, sf_dir):
    return round_doubles(C.repair_rate(_rate_table(spark, sf_dir), "rate"))


@register("derived_sums", GAPPY + """
SELECT o_orderkey, round(o_totalprice + c_acctbal, 6) AS amount_total, c_nationkey + o_year + is_filled AS code_sum
FROM gappy""")
def derived_sums(spark, sf_dir):
    g = TB.bookings_gappy(spark, sf_dir)
    g = C.derived_sum(g, "amount_total", ["o_totalprice", "c_acctbal"])
    g = C.derived_sum(g, "code_sum", ["c_nationkey", "o_year", "is_filled"])
    return round_doubles(g.select("o_orderkey", "amount_total", "code_sum"))


@register("log1p_columns", Q.with_(Q.BOOKINGS) + """
SELECT o_orderkey, round(ln(1 + o_totalprice), 6) AS o_totalprice, round(ln(1 + c_nationkey), 6) AS c_nationkey
FROM bookings""")
def log1p_columns(spark, sf_dir):
    b = TB.bookings(spark, sf_dir).select("o_orderkey", "o_totalprice", "c_nationkey")
    return round_doubles(C.log1p_columns(b, ["o_totalprice", "c_nationkey"]))


# a column with a long tail: balances lie between -999.99 and 9999.99
SKEWED = Q.BOOKINGS + """,
skewed AS (SELECT *, 1000000.0 / (c_acctbal + 1000.0) AS inverse_balance FROM bookings)"""
OUT_COLS = NUM_ALL + ["inverse_balance"]


def _skewed(spark, sf_dir):
    return TB.bookings(spark, sf_dir).withColumn("inverse_balance", F.lit(1000000.0) / (F.col("c_acctbal") + 1000.0))


def _fence_sql(lower, upper):
    fences = "fq AS (" + " UNION ALL ".join(
        f"SELECT '{c}' AS col, quantile_cont({c}, {lower}) AS lo, quantile_cont({c}, {upper}) AS hi FROM skewed"
        for c in OUT_COLS) + "),\nfences AS (SELECT col, lo - 1.5 * (hi - lo) AS fl, hi + 1.5 * (hi - lo) AS fh FROM fq)"
    cond = " OR ".join(f"{c} < (SELECT fl FROM fences WHERE col = '{c}') OR {c} > (SELECT fh FROM fences WHERE col = '{c}')"
                       for c in OUT_COLS)
    return Q.with_(SKEWED, fences), cond


def _outlier_plans(suffix, lower, upper):
    fences, out = _fence_sql(lower, upper)

    @register(f"remove_outliers{suffix}", fences + f"SELECT * REPLACE (round(inverse_balance, 6) AS inverse_balance) "
                                                   f"FROM skewed WHERE NOT ({out})")
    def remove_outliers(spark, sf_dir):
        return round_doubles(C.remove_outliers(_skewed(spark, sf_dir), OUT_COLS, lower, upper))

    @register(f"outlier_report{suffix}", fences + f"""
SELECT count(*) AS rows_before, CAST(count(*) - count(*) FILTER (WHERE {out}) AS BIGINT) AS rows_after,
       CAST(count(*) FILTER (WHERE {out}) AS BIGINT) AS rows_removed
FROM skewed""")
    def outlier_report(spark, sf_dir):
        return C.outlier_report(_skewed(spark, sf_dir), OUT_COLS, lower, upper)


_outlier_plans("", 0.5, 0.95)
_outlier_plans("_quartiles", 0.25, 0.75)


@register("numeric_only", Q.with_(Q.BOOKINGS) +
          "SELECT o_orderkey, o_totalprice, c_acctbal, c_nationkey, o_year, is_filled FROM bookings")
def numeric_only(spark, sf_dir):
    return C.select_dtype(TB.bookings(spark, sf_dir), "number")


@register("threshold_label", Q.with_(Q.SCORED) + """
SELECT doc_id, label, round(score, 6) AS score, CAST(score >= 0.6 AS INTEGER) AS prediction FROM scored""")
def threshold_label(spark, sf_dir):
    s = TB.scored_documents(spark, sf_dir).select("doc_id", "label", "score")
    return round_doubles(C.threshold_label(s, "score", 0.6))


# A booking is eligible for a discount when the probability that it is honoured (label polarity is a
# parameter: here label 1 = good outcome) is at least the precision-first threshold.
@register("discount_eligible", Q.with_(Q.SCORED) + """
SELECT doc_id, round(score, 6) AS p_honour FROM scored WHERE score >= 0.7""")
def discount_eligible(spark, sf_dir):
    s = TB.scored_documents(spark, sf_dir)
    return round_doubles(C.threshold_label(s.select("doc_id", F.col("score").alias("p_honour")), "p_honour", 0.7)
                         .filter(F.col("prediction") == 1).drop("prediction"))
