"""SQL text for the oracle side (DuckDB), mirroring ``tables`` and the operators' pinned formulas."""

from __future__ import annotations

NUMERIC = ["o_totalprice", "c_acctbal", "c_nationkey", "o_year"]
CATEGORICAL = ["o_orderpriority", "c_mktsegment"]

BOOKINGS = """bookings AS (
  SELECT o_orderkey, o_totalprice, c_acctbal, c_nationkey, CAST(year(o_orderdate) AS INTEGER) AS o_year,
         o_orderpriority, c_mktsegment, o_orderstatus, CAST(o_orderstatus = 'F' AS INTEGER) AS is_filled
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

BOOKINGS_GAPPY = BOOKINGS + """,
gappy AS (
  SELECT o_orderkey,
         CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice END AS o_totalprice,
         CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal,
         c_nationkey, o_year,
         CASE WHEN c_mktsegment <> 'AUTOMOBILE' THEN o_orderpriority END AS o_orderpriority,
         c_mktsegment, o_orderstatus, is_filled
  FROM bookings)"""


def split_cte(src: str = "bookings", key: str = "o_orderkey", target: str = "o_orderstatus", seed: int = 42,
              c1: str = "0.7", c2: str = "0.85", name: str = "split") -> str:
    return f"""{name}_rk AS (
  SELECT *, row_number() OVER (PARTITION BY {target} ORDER BY md5(CAST({key} AS VARCHAR) || ':{seed}')) AS _rk,
         count(*) OVER (PARTITION BY {target}) AS _n
  FROM {src}),
{name} AS (
  SELECT * EXCLUDE (_rk, _n),
         CASE WHEN _rk <= round({c1} * _n) THEN 'train' WHEN _rk <= round({c2} * _n) THEN 'val' ELSE 'test' END AS split
  FROM {name}_rk)"""


def tagged_cte(src: str = "split", ref: str = "train", cur: str = "test", name: str = "tagged") -> str:
    """Both sides of a split, the current one with the planted shift of ``tables.planted_shift``."""
    return f"""{name} AS (
  SELECT * REPLACE (
           CASE WHEN split = '{cur}' THEN o_totalprice * 1.2 ELSE o_totalprice END AS o_totalprice,
           CASE WHEN split = '{cur}' AND o_orderpriority = '5-LOW' THEN '6-NONE' ELSE o_orderpriority END
             AS o_orderpriority),
         CASE WHEN split = '{cur}' AND o_orderpriority = '5-LOW' THEN 1 ELSE is_filled END AS is_filled_shifted,
         CASE WHEN split = '{ref}' THEN 0 ELSE 1 END AS _side
  FROM {src} WHERE split IN ('{ref}', '{cur}'))"""


def sides_cte(name: str = "sides") -> str:
    """Bookings before and from 1995-06-17 as reference and current sample (not stratified)."""
    return f"""{name} AS (
  SELECT b.*, CAST(o_orderdate >= DATE '1995-06-17' AS INTEGER) AS _side
  FROM bookings b JOIN (SELECT o_orderkey, o_orderdate FROM orders) USING (o_orderkey))"""


def nlong_cte(cols: list[str], src: str = "tagged", name: str = "nlong") -> str:
    sel = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols)
    on = ", ".join(cols)
    return f"""{name} AS (
  SELECT "column", _side, value FROM (UNPIVOT (SELECT _side, {sel} FROM {src}) ON {on} INTO NAME "column" VALUE value)
  WHERE value IS NOT NULL AND isfinite(value))"""


def clong_cte(cols: list[str], src: str = "tagged", name: str = "clong") -> str:
    sel = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in cols)
    on = ", ".join(cols)
    return f"""{name} AS (
  SELECT "column", _side, value FROM (UNPIVOT (SELECT _side, {sel} FROM {src}) ON {on} INTO NAME "column" VALUE value)
  WHERE value IS NOT NULL)"""


def numeric_bins_cte(src: str = "nlong", name: str = "nbins", by_value: tuple[str, ...] = ("o_year",)) -> str:
    named = ", ".join(f"'{c}'" for c in ("", *by_value))
    return f"""{name}_stats AS (
  SELECT "column", min(value) AS _min, max(value) AS _max, length(bin(count(*) - 1)) + 1 AS _k
  FROM {src} GROUP BY "column"),
{name} AS (
  SELECT "column", bin, CAST(sum(CASE WHEN _side = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_ref,
         CAST(sum(CASE WHEN _side = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_cur
  FROM (SELECT l."column", l._side,
               CASE WHEN l."column" IN ({named}) THEN value
                    ELSE CAST(least(floor((value - _min) / ((_max - _min) / _k)), _k - 1) AS DOUBLE) END AS bin
        FROM {src} l JOIN {name}_stats m ON l."column" = m."column")
  GROUP BY "column", bin)"""


def categorical_bins_cte(src: str = "clong", name: str = "cbins") -> str:
    return f"""{name} AS (
  SELECT "column", value AS bin, CAST(sum(CASE WHEN _side = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_ref,
         CAST(sum(CASE WHEN _side = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_cur
  FROM {src} GROUP BY "column", value)"""


def share_measures_cte(src: str, name: str) -> str:
    return f"""{name}_j AS (
  SELECT b.*, t.tot_ref, t.tot_cur, t.n_bins, b.n_ref / t.tot_ref AS p, b.n_cur / t.tot_cur AS q,
         t.tot_ref * (b.n_ref + b.n_cur) / (t.tot_ref + t.tot_cur) AS e_ref,
         t.tot_cur * (b.n_ref + b.n_cur) / (t.tot_ref + t.tot_cur) AS e_cur
  FROM {src} b JOIN (SELECT "column", sum(n_ref) AS tot_ref, sum(n_cur) AS tot_cur, count(*) AS n_bins
                     FROM {src} GROUP BY "column") t ON b."column" = t."column"),
{name}_f AS (
  SELECT *, CASE WHEN p = 0 THEN 0.0001 ELSE p END AS pf, CASE WHEN q = 0 THEN 0.0001 ELSE q END AS qf,
         (p + q) / 2 AS m FROM {name}_j),
{name} AS (
  SELECT "column", CAST(first(tot_ref) AS BIGINT) AS n_ref, CAST(first(tot_cur) AS BIGINT) AS n_cur,
         CAST(first(n_bins) AS BIGINT) AS n_bins,
         sum((qf - pf) * ln(qf / pf)) AS psi,
         sum(pf * ln(pf / qf)) AS kl_div,
         sqrt(greatest(0.0, 0.5 * sum(CASE WHEN p > 0 THEN p * ln(p / m) ELSE 0.0 END)
                          + 0.5 * sum(CASE WHEN q > 0 THEN q * ln(q / m) ELSE 0.0 END))) AS jensenshannon,
         0.5 * sum(abs(p - q)) AS tvd,
         sum((n_ref - e_ref) ^ 2 / e_ref + (n_cur - e_cur) ^ 2 / e_cur) AS chisquare,
         2 * sum(CASE WHEN n_ref > 0 THEN n_ref * ln(n_ref / e_ref) ELSE 0.0 END
               + CASE WHEN n_cur > 0 THEN n_cur * ln(n_cur / e_cur) ELSE 0.0 END) AS g_test,
         CAST(count(*) - 1 AS BIGINT) AS dof
  FROM {name}_f GROUP BY "column")"""


def cumulative_cte(src: str = "nlong", name: str = "cum") -> str:
    return f"""{name}_v AS (
  SELECT "column", value, CAST(sum(CASE WHEN _side = 0 THEN 1 ELSE 0 END) AS BIGINT) AS r,
         CAST(sum(CASE WHEN _side = 1 THEN 1 ELSE 0 END) AS BIGINT) AS c
  FROM {src} GROUP BY "column", value),
{name}_m AS (
  SELECT "column", CAST(sum(CASE WHEN _side = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS tot_ref,
         CAST(sum(CASE WHEN _side = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS tot_cur,
         stddev_pop(CASE WHEN _side = 0 THEN value END) AS std_ref
  FROM {src} GROUP BY "column"),
{name}_r AS (
  SELECT v.*, m.tot_ref, m.tot_cur, m.std_ref,
         sum(r) OVER w AS cum_r, sum(c) OVER w AS cum_c,
         lead(value) OVER (PARTITION BY v."column" ORDER BY value) AS _next
  FROM {name}_v v JOIN {name}_m m ON v."column" = m."column"
  WINDOW w AS (PARTITION BY v."column" ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
{name}_t AS (
  SELECT *, cum_r / tot_ref AS fr, cum_c / tot_cur AS fc, r + c AS l,
         cum_r + cum_c - (r + c) / 2 AS ba, cum_r - r / 2 AS mr, cum_c - c / 2 AS mc, tot_ref + tot_cur AS n
  FROM {name}_r),
{name}_a AS (
  SELECT "column", first(tot_ref) AS tot_ref, first(tot_cur) AS tot_cur, first(std_ref) AS std_ref,
         max(abs(fr - fc)) AS ks, sum(abs(fr - fc) * coalesce(_next - value, 0.0)) AS wasserstein,
         sum(l * (fr - fc) ^ 2) AS _cvm,
         sum(CASE WHEN ba * (n - ba) - n * l / 4 > 0
                  THEN l * ((n * mr - tot_ref * ba) ^ 2 / tot_ref + (n * mc - tot_cur * ba) ^ 2 / tot_cur)
                       / (ba * (n - ba) - n * l / 4) END) AS _ad
  FROM {name}_t GROUP BY "column"),
{name} AS (
  SELECT "column", CAST(tot_ref AS BIGINT) AS n_ref, CAST(tot_cur AS BIGINT) AS n_cur, ks, wasserstein,
         wasserstein / greatest(std_ref, 0.001) AS wasserstein_norm,
         (tot_ref + tot_cur - 1) / ((tot_ref + tot_cur) * (tot_ref + tot_cur)) * _ad AS anderson,
         tot_ref * tot_cur / ((tot_ref + tot_cur) * (tot_ref + tot_cur)) * _cvm AS cramer_von_mises
  FROM {name}_a)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"

RAW = BOOKINGS + """,
raw AS (
  SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice END AS o_totalprice, c_acctbal,
         c_nationkey, o_year, o_orderpriority, c_mktsegment, o_orderstatus, is_filled, 'web' AS channel,
         CASE WHEN c_acctbal < -900 THEN '-inf'::DOUBLE WHEN c_acctbal > 9900 THEN 'inf'::DOUBLE
              WHEN c_acctbal < 0 THEN 'nan'::DOUBLE ELSE ln(1 + c_acctbal) END AS balance_score
  FROM bookings)"""

SCORED = """scored AS (
  SELECT doc_id, quality AS label, n_chars / (n_chars + 2000.0) AS score, n_chars, lang, source
  FROM labels JOIN documents USING (doc_id))"""
