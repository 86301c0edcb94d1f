"""Plans for evaluation (E1-E8) on the scored documents (label = quality)."""

from __future__ import annotations

from tablesmith.functions.columns import round_doubles
from tablesmith.operators import clean as C
from tablesmith.operators import evaluate as EV
from tablesmith.plans import sqlparts as Q
from tablesmith.plans import tables as TB
from tablesmith.plans.catalog import register

T = 0.6
SWEEP = [0.55, 0.6, 0.65, 0.7]
S = Q.with_(Q.SCORED, f"pred AS (SELECT label, CAST(score >= {T} AS INTEGER) AS prediction FROM scored)",
            """sc AS (SELECT score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label <> 1) AS neg
              FROM scored WHERE score IS NOT NULL GROUP BY score)""",
            """cp AS (SELECT score, pos, neg,
                      sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
                      sum(neg) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp,
                      sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM sc)""")


def _pred(spark, sf_dir):
    s = TB.scored_documents(spark, sf_dir)
    return C.threshold_label(s, "score", T)


@register("confusion_matrix", S + "SELECT label, prediction, count(*) AS n_rows FROM pred GROUP BY label, prediction")
def confusion_matrix(spark, sf_dir):
    return EV.confusion_matrix(_pred(spark, sf_dir))


@register("classification_report", S[:-1] + """,
cm AS (SELECT CAST(label AS VARCHAR) AS l, CAST(prediction AS VARCHAR) AS p, count(*) AS n FROM pred GROUP BY ALL),
per AS (SELECT cls, sum(support) AS support, sum(npred) AS npred, sum(tp) AS tp FROM (
          SELECT l AS cls, n AS support, 0 AS npred, CASE WHEN l = p THEN n ELSE 0 END AS tp FROM cm
          UNION ALL SELECT p, 0, n, 0 FROM cm) GROUP BY cls),
m AS (SELECT cls, CASE WHEN npred > 0 THEN tp / npred ELSE 0.0 END AS precision,
             CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall, support, tp FROM per),
f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1
      FROM m)
SELECT cls, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
       CAST(support AS BIGINT) AS support FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(tp) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM f
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
                 CAST(sum(support) AS BIGINT) FROM f
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
                 round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
                 CAST(sum(support) AS BIGINT) FROM f""")
def classification_report(spark, sf_dir):
    return round_doubles(EV.classification_report(_pred(spark, sf_dir)))


def sweep_sql(ts):
    parts = []
    for t in ts:
        tp = f"sum(CASE WHEN score >= {t} THEN pos ELSE 0 END)"
        fp = f"sum(CASE WHEN score >= {t} THEN neg ELSE 0 END)"
        parts.append(f"""SELECT {float(t)} AS threshold,
       round(({tp} + sum(neg) - {fp}) / (sum(pos) + sum(neg)), 6) AS accuracy,
       round(CASE WHEN {tp} + {fp} > 0 THEN {tp} / ({tp} + {fp}) ELSE 0.0 END, 6) AS precision,
       round(CASE WHEN sum(pos) > 0 THEN {tp} / sum(pos) ELSE 0.0 END, 6) AS recall,
       round(CASE WHEN {tp} + sum(pos) + {fp} > 0 THEN 2 * {tp} / ({tp} + sum(pos) + {fp}) ELSE 0.0 END, 6) AS f1
FROM sc""")
    return " UNION ALL ".join(parts)


AUC_SQL = "SELECT round(sum(neg * (tp - pos + pos / 2.0)) / (max(P) * max(N)), 6) AS roc_auc FROM cp"


@register("eval_threshold", S + f"SELECT * FROM ({sweep_sql([T])}), ({AUC_SQL})")
def eval_threshold(spark, sf_dir):
    return round_doubles(EV.eval_threshold(TB.scored_documents(spark, sf_dir), T))


@register("threshold_sweep", S + sweep_sql(SWEEP))
def threshold_sweep(spark, sf_dir):
    return round_doubles(EV.threshold_metrics(TB.scored_documents(spark, sf_dir), SWEEP))


@register("roc_auc", S + AUC_SQL)
def roc_auc(spark, sf_dir):
    return round_doubles(EV.roc_auc(TB.scored_documents(spark, sf_dir)))


@register("roc_curve", S + "SELECT round(score, 6) AS threshold, round(fp / N, 6) AS fpr, round(tp / P, 6) AS tpr FROM cp")
def roc_curve(spark, sf_dir):
    return round_doubles(EV.roc_curve(TB.scored_documents(spark, sf_dir)))


@register("pr_curve", S + """
SELECT round(score, 6) AS threshold, round(tp / (tp + fp), 6) AS precision, round(tp / P, 6) AS recall FROM cp""")
def pr_curve(spark, sf_dir):
    return round_doubles(EV.pr_curve(TB.scored_documents(spark, sf_dir)))


@register("pr_auc", S + """
SELECT round(sum(pos / P * (tp / (tp + fp)
                            + CASE WHEN tp - pos + fp - neg > 0 THEN (tp - pos) / (tp - pos + fp - neg) ELSE 1.0 END)
                 / 2), 6) AS pr_auc FROM cp""")
def pr_auc(spark, sf_dir):
    return round_doubles(EV.pr_auc(TB.scored_documents(spark, sf_dir)))
