"""Plans for joins (J1-J5), profiling (A1-A13) and validation (V1-V7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablesmith.functions.columns import round_doubles
from tablesmith.operators import clean as C
from tablesmith.operators import profile as PR
from tablesmith.operators import relate as R
from tablesmith.operators import validate as V
from tablesmith.plans import sqlparts as Q
from tablesmith.plans import tables as TB
from tablesmith.plans.catalog import REGISTRY, register
from tablesmith.sources.versions import publish, read_published

B = Q.with_(Q.BOOKINGS)
RAW = Q.with_(Q.RAW)
GAPPY = Q.with_(Q.BOOKINGS_GAPPY)


def _targets(spark, sf_dir):
    return TB.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")


TGT_SQL = "SELECT o_orderkey, o_orderstatus FROM orders"


@register("join_target", B + f"""
SELECT b.o_orderkey, b.o_totalprice, t.o_orderstatus FROM bookings b LEFT JOIN ({TGT_SQL}) t USING (o_orderkey)""")
def join_target(spark, sf_dir):
    x, _ = C.feature_target(TB.bookings(spark, sf_dir), TB.TARGET, TB.KEY)
    return R.join_target(x.select("o_orderkey", "o_totalprice"), _targets(spark, sf_dir), TB.KEY)


@register("pair_features_target", B + f"""
SELECT b.o_orderkey, b.o_totalprice, b.c_mktsegment, t.o_orderstatus
FROM bookings b JOIN ({TGT_SQL}) t USING (o_orderkey)""")
def pair_features_target(spark, sf_dir):
    x = TB.bookings(spark, sf_dir).select("o_orderkey", "o_totalprice", "c_mktsegment")
    return R.pair_features_target(x, _targets(spark, sf_dir), TB.KEY)


@register("concat_columns", """
SELECT coalesce(a.l_orderkey, b.o_orderkey) AS o_orderkey, a.n_lines, b.o_orderdate
FROM (SELECT l_orderkey, count(*) AS n_lines FROM lineitem GROUP BY l_orderkey) a
FULL OUTER JOIN (SELECT o_orderkey, o_orderdate FROM orders) b ON a.l_orderkey = b.o_orderkey""")
def concat_columns(spark, sf_dir):
    lines = TB.table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("n_lines"))
    return R.concat_columns(lines, TB.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), "o_orderkey")


@register("remove_rows_anti", B + """
SELECT * FROM bookings WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_totalprice > 400000)""")
def remove_rows_anti(spark, sf_dir):
    ids = TB.table(spark, sf_dir, "orders").filter(F.col("o_totalprice") > 400000)
    return R.remove_rows(TB.bookings(spark, sf_dir), ids, TB.KEY)


@register("invalid_values", GAPPY + """
SELECT DISTINCT o_orderpriority FROM gappy
WHERE o_orderpriority IS NULL OR o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')""")
def invalid_values(spark, sf_dir):
    return R.invalid_values(TB.bookings_gappy(spark, sf_dir), "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"])


RAW_COLS = ["o_orderkey", "o_totalprice", "c_acctbal", "c_nationkey", "o_year", "o_orderpriority", "c_mktsegment",
            "o_orderstatus", "is_filled", "channel", "balance_score"]
RAW_DOUBLE = {"o_totalprice", "c_acctbal", "balance_score"}
RAW_TYPES = {"o_orderkey": "bigint", "o_totalprice": "double", "c_acctbal": "double", "c_nationkey": "int",
             "o_year": "int", "o_orderpriority": "string", "c_mktsegment": "string", "o_orderstatus": "string",
             "is_filled": "int", "channel": "string", "balance_score": "double"}


def _clean_sql(c):
    return f"CASE WHEN NOT isnan({c}) THEN {c} END" if c in RAW_DOUBLE else c


def _missing_sql(c):
    return f"({c} IS NULL OR isnan({c}))" if c in RAW_DOUBLE else f"({c} IS NULL)"


@register("distinct_counts", RAW + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {_clean_sql(c)}) AS n_distinct, count(*) AS n_rows FROM raw"
    for c in RAW_COLS))
def distinct_counts(spark, sf_dir):
    return C.distinct_counts(TB.bookings_raw(spark, sf_dir))


@register("class_balance", B + """
SELECT o_orderstatus, count(*) AS n_rows, round(count(*) / sum(count(*)) OVER (), 6) AS share,
       round(100.0 * count(*) / sum(count(*)) OVER (), 1) AS pct
FROM bookings WHERE o_orderstatus IS NOT NULL GROUP BY o_orderstatus""")
def class_balance(spark, sf_dir):
    return round_doubles(PR.class_balance(TB.bookings(spark, sf_dir), TB.TARGET))


@register("missing_values", RAW + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {_missing_sql(c)}) AS n_missing, "
    f"round(count(*) FILTER (WHERE {_missing_sql(c)}) * 100.0 / count(*), 6) AS pct_missing FROM raw" for c in RAW_COLS))
def missing_values(spark, sf_dir):
    return round_doubles(PR.missing_values(TB.bookings_raw(spark, sf_dir)))


# the bookings with those of one priority delivered twice
TWICE = B[:-1] + """,
twice AS (SELECT * FROM bookings UNION ALL SELECT * FROM bookings WHERE o_orderpriority = '1-URGENT')
"""


@register("duplicate_count", TWICE + """
SELECT CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM twice)) AS BIGINT) AS n_duplicates FROM twice""")
def duplicate_count(spark, sf_dir):
    b = TB.bookings(spark, sf_dir)
    return PR.duplicate_count(b.unionByName(b.filter(F.col("o_orderpriority") == "1-URGENT")))


GNUM = ["o_totalprice", "c_acctbal", "c_nationkey", "o_year"]


def _describe_sql():
    parts = [f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 6) AS mean,
       round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS min,
       round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50,
       round(quantile_cont({c}, 0.75), 6) AS q75, round(max({c}), 6) AS max FROM gappy""" for c in GNUM]
    return GAPPY + " UNION ALL ".join(parts)


@register("describe_numeric", _describe_sql())
def describe_numeric(spark, sf_dir):
    return round_doubles(PR.describe_numeric(TB.bookings_gappy(spark, sf_dir), GNUM))


@register("distinct_values", GAPPY + "SELECT DISTINCT o_orderpriority FROM gappy")
def distinct_values(spark, sf_dir):
    return PR.distinct_values(TB.bookings_gappy(spark, sf_dir), "o_orderpriority")


LCOLS = ["l_quantity", "l_extendedprice", "l_discount"]
PROBS = [0.1, 0.25, 0.5, 0.75, 0.9]


@register("quantiles", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {p} AS prob, round(quantile_cont({c}, {p}), 6) AS quantile FROM lineitem"
    for c in LCOLS for p in PROBS))
def quantiles(spark, sf_dir):
    li = TB.table(spark, sf_dir, "lineitem")
    return round_doubles(C.column_quantiles(li, LCOLS, PROBS))


@register("table_info", RAW + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{RAW_TYPES[c]}' AS dtype, count(*) FILTER (WHERE NOT {_missing_sql(c)}) AS non_null FROM raw"
    for c in RAW_COLS))
def table_info(spark, sf_dir):
    return PR.table_info(TB.bookings_raw(spark, sf_dir))


@register("table_shape", "SELECT count(*) AS n_rows, 11 AS n_columns FROM lineitem")
def table_shape(spark, sf_dir):
    return PR.table_shape(TB.table(spark, sf_dir, "lineitem"))


@register("histogram", """
WITH mm AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
h AS (SELECT CAST(least(floor((l_extendedprice - lo) / ((hi - lo) / 5)) + 1, 5) AS INTEGER) AS bin
      FROM lineitem, mm WHERE l_extendedprice IS NOT NULL)
SELECT bin, round(lo + (bin - 1) * ((hi - lo) / 5), 6) AS lower, round(lo + bin * ((hi - lo) / 5), 6) AS upper,
       count(*) AS n_rows
FROM h, mm GROUP BY bin, lo, hi""")
def histogram(spark, sf_dir):
    return round_doubles(PR.histogram(TB.table(spark, sf_dir, "lineitem"), "l_extendedprice", 5))


@register("histogram_infinite", RAW.rstrip() + """,
f AS (SELECT balance_score AS x FROM raw WHERE balance_score IS NOT NULL AND isfinite(balance_score)),
mm AS (SELECT min(x) AS lo, max(x) AS hi FROM f),
h AS (SELECT CAST(least(floor((x - lo) / ((hi - lo) / 5)) + 1, 5) AS INTEGER) AS bin FROM f, mm)
SELECT bin, round(lo + (bin - 1) * ((hi - lo) / 5), 6) AS lower, round(lo + bin * ((hi - lo) / 5), 6) AS upper,
       count(*) AS n_rows
FROM h, mm GROUP BY bin, lo, hi""")
def histogram_infinite(spark, sf_dir):
    return round_doubles(PR.histogram(TB.bookings_raw(spark, sf_dir), "balance_score", 5))


@register("profile_large_ids", B + """
SELECT 'id' AS "column", count(*) AS count, count(DISTINCT o_orderkey + 9007199254740992) AS n_distinct FROM bookings""")
def profile_large_ids(spark, sf_dir):
    """Distinct ids above 2**53, where neighbouring integers are one double."""
    ids = TB.bookings(spark, sf_dir).select((F.col("o_orderkey") + F.lit(9007199254740992)).alias("id"))
    return PR.profile_numeric(ids, ["id"]).select("column", "count", "n_distinct")


@register("profile_top_values", GAPPY + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", CAST(row_number() OVER (ORDER BY n_rows DESC, value) AS INTEGER) AS rank, value, n_rows
FROM (SELECT CAST({c} AS VARCHAR) AS value, count(*) AS n_rows FROM gappy WHERE {c} IS NOT NULL GROUP BY 1)
QUALIFY rank <= 3""" for c in ["o_orderpriority", "c_nationkey", "o_year"]))
def profile_top_values(spark, sf_dir):
    return PR.profile_top_values(TB.bookings_gappy(spark, sf_dir), ["o_orderpriority", "c_nationkey", "o_year"], 3)


@register("profile_dates", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS count, count(*) FILTER (WHERE {c} IS NULL) AS n_missing,
       count(DISTINCT {c}) AS n_distinct, strftime(min({c}), '%Y-%m-%d %H:%M:%S') AS first,
       strftime(max({c}), '%Y-%m-%d %H:%M:%S') AS last,
       CAST(date_diff('day', CAST(min({c}) AS DATE), CAST(max({c}) AS DATE)) AS INTEGER) AS days FROM {t}"""
    for c, t in (("o_orderdate", "orders"),)))
def profile_dates(spark, sf_dir):
    return PR.profile_dates(TB.table(spark, sf_dir, "orders"), ["o_orderdate"])


def _histograms_sql():
    parts = []
    for c in LCOLS:
        parts.append(f"""SELECT '{c}' AS "column", bin, round(lo + (bin - 1) * ((hi - lo) / 5), 6) AS lower,
       round(lo + bin * ((hi - lo) / 5), 6) AS upper, count(*) AS n_rows
FROM (SELECT CAST(least(floor(({c} - lo) / ((hi - lo) / 5)) + 1, 5) AS INTEGER) AS bin, lo, hi
      FROM lineitem, (SELECT min({c}) AS lo, max({c}) AS hi FROM lineitem))
GROUP BY bin, lo, hi""")
    return " UNION ALL ".join(parts)


@register("profile_histograms", _histograms_sql())
def profile_histograms(spark, sf_dir):
    return round_doubles(PR.profile_histograms(TB.table(spark, sf_dir, "lineitem"), LCOLS, 5))


def _box_sql():
    parts = []
    for c in LCOLS:
        parts.append(f"""SELECT '{c}' AS "column", round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       round(min(CASE WHEN {c} >= q1 - 1.5 * (q3 - q1) THEN {c} END), 6) AS whisker_low,
       round(max(CASE WHEN {c} <= q3 + 1.5 * (q3 - q1) THEN {c} END), 6) AS whisker_high,
       count(*) FILTER (WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS n_outliers
FROM lineitem, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS median,
                       quantile_cont({c}, 0.75) AS q3 FROM lineitem) q
GROUP BY q1, median, q3""")
    return " UNION ALL ".join(parts)


@register("box_stats", _box_sql())
def box_stats(spark, sf_dir):
    return round_doubles(PR.box_stats(TB.table(spark, sf_dir, "lineitem"), LCOLS))


def _profile_num_sql():
    parts = []
    for c in GNUM:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(f"""SELECT '{c}' AS "column", count({x}) AS count, count(*) FILTER (WHERE {x} IS NULL) AS n_missing,
       count(DISTINCT {x}) AS n_distinct, round(avg({x}), 6) AS mean, round(stddev_samp({x}), 6) AS std,
       round(min({x}), 6) AS min, round(max({x}), 6) AS max, count(*) FILTER (WHERE {x} = 0) AS n_zeros,
       count(*) FILTER (WHERE {x} < 0) AS n_negative,
       round(avg(power({x} - mu, 3)) / power(avg(power({x} - mu, 2)), 1.5), 6) AS skewness,
       round(kurtosis_pop({x}), 6) AS kurtosis,
       round(quantile_cont({x}, 0.25), 6) AS q25, round(quantile_cont({x}, 0.5), 6) AS q50,
       round(quantile_cont({x}, 0.75), 6) AS q75
FROM gappy, (SELECT avg({x}) AS mu FROM gappy) m""")
    return GAPPY + " UNION ALL ".join(parts)


@register("profile_numeric", _profile_num_sql())
def profile_numeric(spark, sf_dir):
    return round_doubles(PR.profile_numeric(TB.bookings_gappy(spark, sf_dir), GNUM))


GCAT = ["o_orderpriority", "c_mktsegment", "o_orderstatus"]


def _profile_cat_sql():
    parts = []
    for c in GCAT:
        parts.append(f"""SELECT '{c}' AS "column", count({c}) AS count, count(*) FILTER (WHERE {c} IS NULL) AS n_missing,
       count(DISTINCT {c}) AS n_distinct,
       (SELECT {c} FROM gappy WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS top,
       (SELECT count(*) FROM gappy WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS top_freq
FROM gappy""")
    return GAPPY + " UNION ALL ".join(parts)


@register("profile_categorical", _profile_cat_sql())
def profile_categorical(spark, sf_dir):
    return PR.profile_categorical(TB.bookings_gappy(spark, sf_dir), GCAT)


@register("profile_table", RAW + f"""
SELECT count(*) AS n_rows, {len(RAW_COLS)} AS n_columns,
       CAST({' + '.join(f'count(*) FILTER (WHERE {_missing_sql(c)})' for c in RAW_COLS)} AS BIGINT) AS cells_missing,
       round(({' + '.join(f'count(*) FILTER (WHERE {_missing_sql(c)})' for c in RAW_COLS)}) * 100.0 / (count(*) * {len(RAW_COLS)}), 6)
         AS pct_cells_missing,
       (SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) FROM (SELECT count(*) AS c FROM raw GROUP BY o_orderkey, o_totalprice, c_acctbal, c_nationkey, o_year, o_orderpriority, c_mktsegment, o_orderstatus, is_filled, channel, balance_score)) AS n_duplicates
FROM raw""")
def profile_table(spark, sf_dir):
    return round_doubles(PR.profile_table(TB.bookings_raw(spark, sf_dir)))


CCOLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("correlation_matrix", " UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS corr FROM lineitem"
    for a in CCOLS for b in CCOLS))
def correlation_matrix(spark, sf_dir):
    return round_doubles(PR.correlation_matrix(TB.table(spark, sf_dir, "lineitem"), CCOLS))


RANKED = "WITH r AS (SELECT " + ", ".join(
    f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS {c}" for c in CCOLS) + " FROM lineitem)"


@register("rank_correlation", RANKED + " UNION ALL ".join(
    f" SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS rho FROM r" for a in CCOLS for b in CCOLS))
def rank_correlation(spark, sf_dir):
    return round_doubles(PR.rank_correlation(TB.table(spark, sf_dir, "lineitem"), CCOLS))


ACOLS = ["o_orderpriority", "c_mktsegment", "o_orderstatus", "o_year"]


def _association_sql(a, b):
    return f"""SELECT '{a}' AS col_a, '{b}' AS col_b, CAST(sum(n) AS BIGINT) AS n_rows, round(any_value(chi2), 6) AS chi2,
  round(sqrt(any_value(chi2) / (sum(n) * (least(count(DISTINCT x), count(DISTINCT y)) - 1))), 6) AS cramers_v
FROM (SELECT *, sum((n - e) * (n - e) / e) OVER () AS chi2 FROM (
  SELECT x, y, coalesce(n, 0) AS n, nx * ny / t AS e
  FROM (SELECT {a} AS x, count(*)::DOUBLE AS nx FROM g WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY 1)
  CROSS JOIN (SELECT {b} AS y, count(*) AS ny FROM g WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY 1)
  CROSS JOIN (SELECT count(*) AS t FROM g WHERE {a} IS NOT NULL AND {b} IS NOT NULL)
  LEFT JOIN (SELECT {a} AS x, {b} AS y, count(*) AS n FROM g GROUP BY 1, 2) USING (x, y)))"""


@register("category_association", GAPPY + "SELECT * FROM (" + " UNION ALL ".join(
    _association_sql(a, b).replace(" g ", " gappy ") for i, a in enumerate(ACOLS) for b in ACOLS[i + 1:]) + ")")
def category_association(spark, sf_dir):
    return round_doubles(PR.category_association(TB.bookings_gappy(spark, sf_dir), ACOLS))


@register("top_values", """
SELECT l_partkey, count(*) AS n_rows FROM lineitem GROUP BY l_partkey ORDER BY n_rows DESC, l_partkey LIMIT 10""")
def top_values(spark, sf_dir):
    return PR.top_values(TB.table(spark, sf_dir, "lineitem"), "l_partkey", 10)


# ---------------------------------------------------------------- validation

# Declared schema of the bookings table (test fixture; mirrors the shape of a declared schema file).
BOOKINGS_SCHEMA = {
    "o_orderkey": {"type": "integer"},
    "o_totalprice": {"type": "float", "constraints": {"min": 0, "max": 500000}},
    "c_acctbal": {"type": "float", "constraints": {"min": -999.99, "max": 9000}},
    "o_year": {"type": "integer", "constraints": {"min": 1995, "max": 2001}},
    "o_orderpriority": {"type": "string",
                        "constraints": {"enum": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]}},
    "c_mktsegment": {"type": "string", "constraints": {"enum": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"]}},
    "o_orderstatus": {"type": "string", "constraints": {"enum": ["F", "O", "P"], "min": "F"}},
    "is_filled": {"type": "float"},
}
GOOD_SCHEMA = dict(BOOKINGS_SCHEMA, c_acctbal={"type": "float", "constraints": {"min": -999.99, "max": 9999.99}},
                   c_mktsegment={"type": "string"}, is_filled={"type": "integer", "constraints": {"min": 0, "max": 1}},
                   c_nationkey={"type": "integer", "constraints": {"min": 0, "max": 24}})


@register("validate_schema", B + """
SELECT 'o_orderkey' AS "column", 'Valid' AS status, true AS valid
UNION ALL SELECT 'o_totalprice', CASE WHEN count(*) FILTER (WHERE NOT coalesce(o_totalprice BETWEEN 0 AND 500000, false)) > 0
  THEN 'Out of range: [0, 500000]' ELSE 'Valid' END, count(*) FILTER (WHERE NOT coalesce(o_totalprice BETWEEN 0 AND 500000, false)) = 0 FROM bookings
UNION ALL SELECT 'c_acctbal', CASE WHEN count(*) FILTER (WHERE NOT coalesce(c_acctbal BETWEEN -999.99 AND 9000, false)) > 0
  THEN 'Out of range: [-999.99, 9000]' ELSE 'Valid' END, count(*) FILTER (WHERE NOT coalesce(c_acctbal BETWEEN -999.99 AND 9000, false)) = 0 FROM bookings
UNION ALL SELECT 'c_nationkey', 'Column missing in schema', false
UNION ALL SELECT 'o_year', CASE WHEN count(*) FILTER (WHERE NOT coalesce(o_year BETWEEN 1995 AND 2001, false)) > 0
  THEN 'Out of range: [1995, 2001]' ELSE 'Valid' END, count(*) FILTER (WHERE NOT coalesce(o_year BETWEEN 1995 AND 2001, false)) = 0 FROM bookings
UNION ALL SELECT 'o_orderpriority', CASE WHEN count(*) FILTER (WHERE o_orderpriority IS NULL OR o_orderpriority NOT IN
  ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')) > 0 THEN 'Invalid categorical values' ELSE 'Valid' END,
  count(*) FILTER (WHERE o_orderpriority IS NULL OR o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')) = 0
  FROM bookings
UNION ALL SELECT 'c_mktsegment', CASE WHEN count(*) FILTER (WHERE c_mktsegment IS NULL OR c_mktsegment NOT IN
  ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD')) > 0 THEN 'Invalid categorical values' ELSE 'Valid' END,
  count(*) FILTER (WHERE c_mktsegment IS NULL OR c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD')) = 0 FROM bookings
UNION ALL SELECT 'o_orderstatus', CASE WHEN count(*) FILTER (WHERE o_orderstatus IS NULL OR o_orderstatus NOT IN ('F', 'O', 'P')) > 0
  THEN 'Invalid categorical values' ELSE 'Valid' END,
  count(*) FILTER (WHERE o_orderstatus IS NULL OR o_orderstatus NOT IN ('F', 'O', 'P')) = 0 FROM bookings
UNION ALL SELECT 'is_filled', 'Incorrect dtype: expected float, got int', false""")
def validate_schema(spark, sf_dir):
    return V.validate_schema(TB.bookings(spark, sf_dir), BOOKINGS_SCHEMA)


@register("validate_enum", B + """
SELECT count(*) FILTER (WHERE c_mktsegment IS NULL OR c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD'))
         AS n_invalid, 'c_mktsegment' AS "column" FROM bookings""")
def validate_enum(spark, sf_dir):
    return V.count_invalid_enum(TB.bookings(spark, sf_dir), "c_mktsegment",
                                ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"])


@register("validate_range", GAPPY + """
SELECT count(*) FILTER (WHERE NOT coalesce(c_acctbal >= 0 AND c_acctbal <= 9000, false)) AS n_out_of_range, 'c_acctbal' AS "column"
FROM gappy""")
def validate_range(spark, sf_dir):
    return V.count_out_of_range(TB.bookings_gappy(spark, sf_dir), "c_acctbal", 0, 9000)


@register("validated_table", B + """
SELECT * FROM bookings
WHERE (SELECT count(*) FILTER (WHERE NOT coalesce(o_totalprice BETWEEN 0 AND 500000, false)) = 0
          AND count(*) FILTER (WHERE NOT coalesce(c_acctbal BETWEEN -999.99 AND 9999.99, false)) = 0
          AND count(*) FILTER (WHERE NOT coalesce(o_year BETWEEN 1995 AND 2001, false)) = 0
          AND count(*) FILTER (WHERE NOT coalesce(c_nationkey BETWEEN 0 AND 24, false)) = 0
          AND count(*) FILTER (WHERE NOT coalesce(is_filled BETWEEN 0 AND 1, false)) = 0
          AND count(*) FILTER (WHERE o_orderpriority IS NULL OR o_orderpriority NOT IN
                       ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')) = 0
          AND count(*) FILTER (WHERE o_orderstatus IS NULL OR o_orderstatus NOT IN ('F', 'O', 'P')) = 0 FROM bookings)""")
def validated_table(spark, sf_dir):
    return V.validated_table(TB.bookings(spark, sf_dir), GOOD_SCHEMA)


@register("check_target", """SELECT 'is_filled' AS target, 'int' AS dtype, true AS valid""")
def check_target(spark, sf_dir):
    return V.check_target(TB.bookings(spark, sf_dir), "is_filled")


_ENUMS = {c: spec["constraints"]["enum"] for c, spec in BOOKINGS_SCHEMA.items() if "enum" in spec.get("constraints", {})}


def _invalid_sql():
    parts = []
    for c, allowed in _ENUMS.items():
        listed = ", ".join(f"'{v}'" for v in allowed)
        parts.append(f"""SELECT '{c}' AS "column", {c} AS value, count(*) AS n_rows FROM gappy
WHERE {c} IS NULL OR {c} NOT IN ({listed}) GROUP BY {c}""")
    return GAPPY + " UNION ALL ".join(parts)


@register("invalid_value_report", _invalid_sql())
def invalid_value_report(spark, sf_dir):
    return V.invalid_value_report(TB.bookings_gappy(spark, sf_dir), BOOKINGS_SCHEMA)


def _published(spark, sf_dir, schema):
    """What lies at the table's place after publishing behind the gate: rows of the bookings, or those before."""
    table, status = TB.scratch(spark, "published"), TB.scratch(spark, "status")
    b = TB.bookings(spark, sf_dir)
    publish(b.filter(F.col(TB.TARGET) == "F"), table)  # what was published before
    V.publish_validated(b, schema, table, status)
    n_bad = spark.read.json(status).agg(F.count_if(~F.col("valid"))).scalar()
    return read_published(spark, table).groupBy().agg(F.count(F.lit(1)).alias("n_rows"),
                                                   F.sum(F.col(TB.KEY)).alias("key_sum")).withColumn("n_bad", n_bad)


@register("publish_validated", B + """
SELECT count(*) AS n_rows, CAST(sum(o_orderkey) AS BIGINT) AS key_sum, CAST(0 AS BIGINT) AS n_bad FROM bookings""")
def publish_validated(spark, sf_dir):
    return _published(spark, sf_dir, GOOD_SCHEMA)


@register("publish_validated_closed", f"""
SELECT (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS n_rows,
       (SELECT CAST(sum(o_orderkey) AS BIGINT) FROM orders WHERE o_orderstatus = 'F') AS key_sum,
       count(*) FILTER (WHERE NOT valid) AS n_bad
FROM ({REGISTRY["validate_schema"][1]})""")
def publish_validated_closed(spark, sf_dir):
    return _published(spark, sf_dir, BOOKINGS_SCHEMA)
