"""Plans for preprocessing (T1-T9): fit on the train part of the stratified split, apply to every row."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablesmith.functions.columns import round_doubles
from tablesmith.operators import prep as P
from tablesmith.operators import split as SP
from tablesmith.plans import sqlparts as Q
from tablesmith.plans import tables as TB
from tablesmith.plans.catalog import register

GNUM = ["o_totalprice", "c_acctbal", "c_nationkey", "o_year"]
GCAT = ["o_orderpriority", "c_mktsegment"]
CATS = {"o_orderpriority": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"],
        "c_mktsegment": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]}

GS = Q.with_(Q.BOOKINGS_GAPPY, Q.split_cte(src="gappy", name="gsplit"),
             "tr AS (SELECT * FROM gsplit WHERE split = 'train')")
BS = Q.with_(Q.BOOKINGS, Q.split_cte(), "tr AS (SELECT * FROM split WHERE split = 'train')")


def _gs(spark, sf_dir):
    s = TB.gappy_split(spark, sf_dir)
    return s, TB.train_part(s)


@register("impute_median", GS + """
SELECT o_orderkey, split,
       round(coalesce(o_totalprice, (SELECT quantile_cont(o_totalprice, 0.5) FROM tr)), 6) AS o_totalprice,
       round(coalesce(c_acctbal, (SELECT quantile_cont(c_acctbal, 0.5) FROM tr)), 6) AS c_acctbal
FROM gsplit""")
def impute_median(spark, sf_dir):
    s, tr = _gs(spark, sf_dir)
    out = P.impute_median(tr, s.select("o_orderkey", "split", "o_totalprice", "c_acctbal"), ["o_totalprice", "c_acctbal"])
    return round_doubles(out)


@register("standard_scale", BS + """
SELECT o_orderkey, split,
       round((o_totalprice - (SELECT avg(o_totalprice) FROM tr)) / (SELECT stddev_pop(o_totalprice) FROM tr), 6)
         AS o_totalprice,
       round((c_acctbal - (SELECT avg(c_acctbal) FROM tr)) / (SELECT stddev_pop(c_acctbal) FROM tr), 6) AS c_acctbal
FROM split""")
def standard_scale(spark, sf_dir):
    s = TB.bookings_split(spark, sf_dir)
    out = P.standard_scale(TB.train_part(s), s.select("o_orderkey", "split", "o_totalprice", "c_acctbal"),
                           ["o_totalprice", "c_acctbal"])
    return round_doubles(out)


@register("impute_mode", GS + """
SELECT o_orderkey, split, coalesce(o_orderpriority, (SELECT o_orderpriority FROM tr WHERE o_orderpriority IS NOT NULL
       GROUP BY o_orderpriority ORDER BY count(*) DESC, o_orderpriority LIMIT 1)) AS o_orderpriority
FROM gsplit""")
def impute_mode(spark, sf_dir):
    s, tr = _gs(spark, sf_dir)
    return P.impute_mode(tr, s.select("o_orderkey", "split", "o_orderpriority"), ["o_orderpriority"])


def _onehot_sql(col, cats, src_expr):
    return ", ".join(f"CASE WHEN {src_expr} = '{v}' THEN 1.0 ELSE 0.0 END AS \"{col}_{v}\"" for v in cats)


@register("one_hot", GS + f"""
SELECT o_orderkey, split, {_onehot_sql('o_orderpriority', CATS['o_orderpriority'], 'o_orderpriority')} FROM gsplit""")
def one_hot(spark, sf_dir):
    s, tr = _gs(spark, sf_dir)
    return P.one_hot(tr, s.select("o_orderkey", "split", "o_orderpriority"), ["o_orderpriority"])


@register("one_hot_drop_first", GS + f"""
SELECT o_orderkey, split, {_onehot_sql('c_mktsegment', CATS['c_mktsegment'][1:], 'c_mktsegment')} FROM gsplit""")
def one_hot_drop_first(spark, sf_dir):
    s, tr = _gs(spark, sf_dir)
    return P.one_hot(tr, s.select("o_orderkey", "split", "c_mktsegment"), ["c_mktsegment"], drop_first=True)


@register("label_encode", GS + """
SELECT o_orderkey, split,
       CAST(list_position(['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW'], o_orderpriority) - 1 AS INTEGER)
         AS o_orderpriority,
       CAST(list_position(['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY'], c_mktsegment) - 1 AS INTEGER)
         AS c_mktsegment
FROM gsplit""")
def label_encode(spark, sf_dir):
    s, tr = _gs(spark, sf_dir)
    return P.label_encode(tr, s.select("o_orderkey", "split", "o_orderpriority", "c_mktsegment"),
                          ["o_orderpriority", "c_mktsegment"])


def _transform_sql(passthrough: bool):
    meds = ", ".join(f"quantile_cont({c}, 0.5) AS med_{c}" for c in GNUM)
    moms = ", ".join(f"avg(coalesce({c}, med_{c})) AS mu_{c}, stddev_pop(coalesce({c}, med_{c})) AS sd_{c}"
                     for c in GNUM)
    modes = ", ".join(f"(SELECT {c} FROM tr WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"
                      f" AS mode_{c}" for c in GCAT)
    nums = ", ".join(f"round((coalesce(CAST({c} AS DOUBLE), med_{c}) - mu_{c}) / "
                     f"CASE WHEN sd_{c} = 0 OR sd_{c} IS NULL THEN 1.0 ELSE sd_{c} END, 6) AS num__{c}" for c in GNUM)
    cats = ", ".join(_onehot_sql(f"cat__{c}", CATS[c], f"coalesce({c}, mode_{c})") for c in GCAT)
    tail = ", o_orderstatus, is_filled" if passthrough else ""
    return GS[:-1] + f""",
med AS (SELECT {meds} FROM tr),
mom AS (SELECT {moms} FROM tr, med),
modes AS (SELECT {modes})
SELECT o_orderkey, split, {nums}, {cats}{tail}
FROM gsplit, med, mom, modes"""


@register("transform_features", _transform_sql(False))
def transform_features(spark, sf_dir):
    s, tr = _gs(spark, sf_dir)
    model = P.fit_preprocessor(tr, GNUM, GCAT)
    return round_doubles(model.transform(s, keep=["o_orderkey", "split"]))


@register("transform_passthrough", _transform_sql(True))
def transform_passthrough(spark, sf_dir):
    s, tr = _gs(spark, sf_dir)
    model = P.fit_preprocessor(tr, GNUM, GCAT, passthrough=True)
    return round_doubles(model.transform(s, keep=["o_orderkey", "split"]))


# part and supplier keys as categories, learned from the train part of the lines' exact split
PARTS = Q.with_("""lines AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS line_id, l_returnflag, l_partkey, l_suppkey
  FROM lineitem)""", Q.split_cte(src="lines", key="line_id", target="l_returnflag"), """tr AS (
  SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS v FROM split WHERE split = 'train')""", """voc AS (
  SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS i FROM tr)""").rstrip()


def _parts(spark, sf_dir):
    li = TB.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")
    keyed = li.withColumn("line_id", F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    split = SP.stratified_split(keyed, "line_id", "l_returnflag", (0.7, 0.15, 0.15), TB.SEED).checkpoint(eager=True)
    return li.drop("l_returnflag"), TB.train_part(split).select("l_partkey", "l_suppkey")


@register("label_encode_parts", PARTS + """
SELECT l_orderkey, l_linenumber, i AS l_partkey FROM lineitem LEFT JOIN voc ON CAST(l_partkey AS VARCHAR) = v""")
def label_encode_parts(spark, sf_dir):
    li, train = _parts(spark, sf_dir)
    return P.label_encode(train, li.drop("l_suppkey"), ["l_partkey"])


@register("one_hot_sparse", PARTS + """,
trs AS (SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS v FROM split WHERE split = 'train'),
vocs AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS i FROM trs),
n AS (SELECT (SELECT count(*) FROM voc) AS np, (SELECT count(*) FROM vocs) AS ns)
SELECT l_orderkey, l_linenumber, CAST(np + ns AS INTEGER) AS size, voc.i AS first_one, CAST(np + vocs.i AS INTEGER) AS last_one
FROM lineitem LEFT JOIN voc ON CAST(l_partkey AS VARCHAR) = voc.v LEFT JOIN vocs ON CAST(l_suppkey AS VARCHAR) = vocs.v, n""")
def one_hot_sparse(spark, sf_dir):
    li, train = _parts(spark, sf_dir)
    hot = P.one_hot_sparse(train, li, ["l_partkey", "l_suppkey"])
    parts = P.vocabulary(train, ["l_partkey"]).count()
    ones = F.col("features.indices")
    return hot.select("l_orderkey", "l_linenumber", F.col("features.size").cast("int").alias("size"),
                      F.array_min(F.filter(ones, lambda i: i < parts)).alias("first_one"),
                      F.array_max(F.filter(ones, lambda i: i >= parts)).alias("last_one"))
