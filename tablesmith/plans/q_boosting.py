"""Plans for boosted trees (M4): will a booking be filled? Bookings with missing values, all rows and columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablesmith.functions.columns import round_doubles
from tablesmith.operators import boosting as B
from tablesmith.plans import sqlparts as Q
from tablesmith.plans import tables as TB
from tablesmith.plans.catalog import register

PARAMS = B.BoostingParams(trees=1, depth=3)
FEATURES = [*TB.NUMERIC, *TB.CATEGORICAL]


def _level_sql(level: int) -> str:
    """Histogram, best splits and the rows' places after one level, from the places before it."""
    place = "1" if level == 0 else f"place{level - 1}.at"
    source = "binned b" if level == 0 else f"binned b JOIN place{level - 1} USING (o_orderkey)"
    part = lambda g, h: f"{g} * {g} / ({h} + {PARAMS.l2})"
    sides = f"""
hist{level} AS MATERIALIZED (SELECT {place} AS node, feature, bin, CAST(sum({PARAMS.base} - y) AS DOUBLE) AS g,
    CAST(count(*) * {PARAMS.base * (1 - PARAMS.base)} AS DOUBLE) AS h, count(*) AS n
  FROM {source} WHERE {place} >= {2 ** level} GROUP BY 1, 2, 3),
node{level} AS MATERIALIZED (SELECT node, sum(g) AS g, sum(h) AS h, CAST(sum(n) AS BIGINT) AS n FROM hist{level} WHERE feature = 0 GROUP BY node)"""
    if level == PARAMS.depth:
        return sides + f""",
split{level} AS (SELECT node, 0 AS feature, 0 AS bin, false AS missing_left, 0.0 AS gain FROM node{level} WHERE false)"""
    return sides + f""",
upto{level} AS (SELECT *, sum(g) OVER w AS gt, sum(h) OVER w AS ht, max(bin) OVER w AS last,
    coalesce(sum(g) FILTER (WHERE bin < 0) OVER w, 0) AS g0, coalesce(sum(h) FILTER (WHERE bin < 0) OVER w, 0) AS h0,
    coalesce(sum(g) FILTER (WHERE bin >= 0) OVER u, 0) AS gl, coalesce(sum(h) FILTER (WHERE bin >= 0) OVER u, 0) AS hl
  FROM hist{level} WINDOW w AS (PARTITION BY node, feature), u AS (PARTITION BY node, feature ORDER BY bin)),
side{level} AS (SELECT node, feature, bin, missing_left, gt, ht, gl + CASE WHEN missing_left THEN g0 ELSE 0 END AS gl,
    hl + CASE WHEN missing_left THEN h0 ELSE 0 END AS hl
  FROM upto{level}, (VALUES (false), (true)) m(missing_left) WHERE bin >= 0 AND (bin < last OR h0 > 0)),
gain{level} AS (SELECT *, ({part("gl", "hl")} + {part("(gt - gl)", "(ht - hl)")} - {part("gt", "ht")}) / 2 - {PARAMS.least_gain} AS gain
  FROM side{level} WHERE hl >= {PARAMS.least_hessian} AND ht - hl >= {PARAMS.least_hessian}),
split{level} AS MATERIALIZED (SELECT node, feature, bin, missing_left, gain FROM gain{level} WHERE gain > 0
  QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, feature, bin, missing_left) = 1),
place{level} AS MATERIALIZED (SELECT b.o_orderkey, 2 * s.node + CASE WHEN CASE WHEN b.bin < 0 THEN s.missing_left ELSE b.bin <= s.bin END
    THEN 0 ELSE 1 END AS at
  FROM {source} JOIN split{level} s ON s.node = {place} AND s.feature = b.feature)"""


def _first_tree_sql() -> str:
    numbers = ", ".join(f"CAST({c} AS DOUBLE) AS f{i}" for i, c in enumerate(TB.NUMERIC))
    k = len(TB.NUMERIC)
    shares = ", ".join(
        f"""(coalesce(sum(is_filled) OVER o{i}, 0) + {PARAMS.prior_weight} * prior) / (count(*) OVER o{i} + {PARAMS.prior_weight}) AS f{k + i}"""
        for i in range(len(TB.CATEGORICAL)))
    windows = ", ".join(
        f"""o{i} AS (PARTITION BY {c} ORDER BY md5(CAST(o_orderkey AS VARCHAR) || ':{PARAMS.seed}')
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""" for i, c in enumerate(TB.CATEGORICAL))
    columns = ", ".join(f"f{i}" for i in range(len(FEATURES)))
    names = ", ".join(f"'{n}'" for n in FEATURES)
    probs = ", ".join(f"{j}/{PARAMS.bins}.0::DOUBLE" for j in range(1, PARAMS.bins))
    levels = ",".join(_level_sql(level) for level in range(PARAMS.depth + 1))
    every = " UNION ALL ".join(
        f"SELECT n.node, feature, bin, missing_left, gain, g, h, n FROM node{v} n LEFT JOIN split{v} s ON n.node = s.node"
        for v in range(PARAMS.depth + 1))
    return Q.with_(Q.BOOKINGS_GAPPY, f"""vals AS (
  SELECT o_orderkey, is_filled AS y, {numbers}, {shares}
  FROM gappy, (SELECT avg(is_filled) AS prior FROM gappy) WINDOW {windows}),
long AS (SELECT o_orderkey, y, CAST(substr(name, 2) AS INTEGER) AS feature, value
  FROM vals UNPIVOT INCLUDE NULLS (value FOR name IN ({columns}))),
cuts AS (SELECT feature, list_sort(list_distinct(quantile_cont(value, [{probs}]))) AS cuts FROM long
  WHERE value IS NOT NULL GROUP BY feature),
binned AS MATERIALIZED (SELECT o_orderkey, y, l.feature, CASE WHEN value IS NULL THEN -1
    ELSE len(list_filter(c.cuts, lambda x: x < value)) END AS bin
  FROM long l JOIN cuts c ON l.feature = c.feature)""", levels.strip()) + f"""
SELECT CAST(node AS BIGINT) AS node, CASE WHEN t.feature IS NOT NULL THEN list_extract([{names}], t.feature + 1) END AS feature,
       round(list_extract(c.cuts, t.bin + 1), 6) AS threshold, coalesce(missing_left, false) AS missing_left, round(gain, 6) AS gain,
       round(-g / (h + {PARAMS.l2}), 6) AS weight, h AS hessian, n
FROM ({every}) t LEFT JOIN cuts c ON t.feature = c.feature"""


TREE = "node bigint, feature string, threshold double, missing_left boolean, gain double, weight double, hessian double, n bigint"


@register("boosted_first_tree", _first_tree_sql())
def boosted_first_tree(spark, sf_dir):
    """The first tree of second-order boosting, node by node: split, gain, leaf weight."""
    model = B.fit_boosted_trees(TB.bookings_gappy(spark, sf_dir), TB.KEY, TB.BINARY_TARGET, TB.NUMERIC, TB.CATEGORICAL, PARAMS)
    return round_doubles(spark.createDataFrame(B.tree_table(model), TREE))


@register("boosted_scores", Q.with_(Q.BOOKINGS_GAPPY) + """
SELECT o_orderkey, is_filled, true AS in_range, true AS better FROM gappy""")
def boosted_scores(spark, sf_dir):
    """Scores of eight trees for every booking, and whether their log-loss over all bookings is below the first tree's."""
    gappy = TB.bookings_gappy(spark, sf_dir)
    model = B.fit_boosted_trees(gappy, TB.KEY, TB.BINARY_TARGET, TB.NUMERIC, TB.CATEGORICAL, B.BoostingParams(trees=8))
    one = B.BoostedTrees(model.numeric, model.categorical, model.params, model.cuts, model.prior, model.encodings, model.trees[:1])
    scored = one.transform(model.transform(gappy, "p"), "p1")
    y = F.col(TB.BINARY_TARGET)
    loss = lambda p: F.avg(-y * F.log(p) - (1 - y) * F.log(1 - F.col(p)))
    better = scored.agg((loss("p") < loss("p1")).alias("better"))
    return scored.select(TB.KEY, TB.BINARY_TARGET, F.col("p").between(0, 1).alias("in_range"), better.scalar().alias("better"))
