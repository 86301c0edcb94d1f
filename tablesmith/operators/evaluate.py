"""Evaluation of a scored table ``(label, score)`` or ``(label, prediction)``.

Curves and AUCs come from per-score counts (a partial aggregate: one row per distinct score) and running
totals computed in two levels (``running_totals``), never from a window over all rows in one partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesmith.functions.columns import safe_div
from tablesmith.functions.cumulative import running_totals


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(label, prediction, n_rows)."""
    return df.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("n_rows"))


def _zero_div(a: Column, b: Column) -> Column:
    return F.coalesce(safe_div(a.cast("double"), b.cast("double")), F.lit(0.0))


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Per class precision, recall, F1, support; then accuracy, macro and weighted averages
    (undefined ratios count as 0). Rows: class = '<value>', 'accuracy', 'macro avg', 'weighted avg'."""
    cm = confusion_matrix(df, label, prediction).select(F.col(label).cast("string").alias("l"),
                                                         F.col(prediction).cast("string").alias("p"), "n_rows")
    parts = cm.select(F.col("l").alias("cls"), F.col("n_rows").alias("support"), F.lit(0).alias("pred"),
                      F.when(F.col("l") == F.col("p"), F.col("n_rows")).otherwise(0).alias("tp")).unionByName(
        cm.select(F.col("p").alias("cls"), F.lit(0).cast("long").alias("support"), F.col("n_rows").alias("pred"),
                  F.lit(0).cast("long").alias("tp")))
    per = parts.groupBy("cls").agg(F.sum("support").alias("support"), F.sum("pred").alias("pred"),
                                   F.sum("tp").alias("tp"))
    prec = _zero_div(F.col("tp"), F.col("pred"))
    rec = _zero_div(F.col("tp"), F.col("support"))
    f1 = _zero_div(2 * prec * rec, prec + rec)
    per = per.select("cls", prec.alias("precision"), rec.alias("recall"), f1.alias("f1"),
                     F.col("support").cast("long").alias("support"), "tp")
    tot = per.agg(F.sum("support").alias("n"), F.sum("tp").alias("tp"), F.avg("precision").alias("mp"),
                  F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
                  F.sum(F.col("precision") * F.col("support")).alias("wp"),
                  F.sum(F.col("recall") * F.col("support")).alias("wr"),
                  F.sum(F.col("f1") * F.col("support")).alias("wf"))
    n = F.col("n")
    def row(name, p, r, f):
        return F.struct(F.lit(name).alias("cls"), p.cast("double").alias("precision"),
                        r.cast("double").alias("recall"), f.cast("double").alias("f1"), n.cast("long").alias("support"))
    none = F.lit(None).cast("double")
    summary = tot.select(F.explode(F.array(
        row("accuracy", none, none, _zero_div(F.col("tp"), n)),
        row("macro avg", F.col("mp"), F.col("mr"), F.col("mf")),
        row("weighted avg", _zero_div(F.col("wp"), n), _zero_div(F.col("wr"), n), _zero_div(F.col("wf"), n)),
    )).alias("r")).select("r.*")
    return per.drop("tp").unionByName(summary)


def score_counts(df: DataFrame, label: str = "label", score: str = "score", positive=1) -> DataFrame:
    """(score, pos, neg, unlabelled): rows per distinct score (combined map-side)."""
    is_pos = F.col(label) == F.lit(positive)
    s = F.col(score).cast("double")
    return df.filter(s.isNotNull() & ~F.isnan(s)).groupBy(s.alias("score")).agg(
        F.count_if(is_pos).alias("pos"), F.count_if(~is_pos).alias("neg"),
        F.count_if(F.col(label).isNull()).alias("unlabelled"))


def curve_points(df: DataFrame, label: str = "label", score: str = "score", positive=1) -> DataFrame:
    """Per distinct score s (as a threshold, predict positive when score >= s): tp, fp and the counts at s,
    plus the totals P, N. Scored rows without a label are refused: they are neither positive nor negative."""
    sc = score_counts(df, label, score, positive)
    tot = sc.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"), F.sum("unlabelled").alias("U")).first()
    if tot["U"]:
        raise ValueError(f"{tot['U']} scored rows have no label: drop or label them first")
    sc = sc.drop("unlabelled")
    P, N = F.lit(int(tot["P"] or 0)), F.lit(int(tot["N"] or 0))
    rt = running_totals(sc, [], "score", ["pos", "neg"])
    return rt.select("score", "pos", "neg", (P - F.col("cum_pos") + F.col("pos")).alias("tp"),
                     (N - F.col("cum_neg") + F.col("neg")).alias("fp"), P.alias("P"), N.alias("N"))


def roc_auc(df: DataFrame, label: str = "label", score: str = "score", positive=1) -> DataFrame:
    """E5: exact ROC AUC on scores, ties counted half."""
    cp = curve_points(df, label, score, positive)
    above = F.col("tp") - F.col("pos")  # positives scored strictly higher
    s = cp.agg(F.sum(F.col("neg") * (above + F.col("pos") / 2.0)).alias("_u"), F.first("P").alias("P"),
               F.first("N").alias("N"))
    return s.select(safe_div(F.col("_u"), F.col("P").cast("double") * F.col("N")).alias("roc_auc"))


def roc_curve(df: DataFrame, label: str = "label", score: str = "score", positive=1) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score."""
    cp = curve_points(df, label, score, positive)
    return cp.select(F.col("score").alias("threshold"), safe_div(F.col("fp").cast("double"), F.col("N")).alias("fpr"),
                     safe_div(F.col("tp").cast("double"), F.col("P")).alias("tpr"))


def pr_curve(df: DataFrame, label: str = "label", score: str = "score", positive=1) -> DataFrame:
    """(threshold, precision, recall) at every distinct score."""
    cp = curve_points(df, label, score, positive)
    return cp.select(F.col("score").alias("threshold"),
                     (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
                     safe_div(F.col("tp").cast("double"), F.col("P")).alias("recall"))


def pr_auc(df: DataFrame, label: str = "label", score: str = "score", positive=1) -> DataFrame:
    """Trapezoid area under the precision-recall curve, starting at (recall 0, precision 1). The previous
    point of each threshold comes from its own counts (tp - pos, fp - neg), so no lag is needed."""
    cp = curve_points(df, label, score, positive)
    tp, fp = F.col("tp"), F.col("fp")
    tp0, fp0 = tp - F.col("pos"), fp - F.col("neg")
    prec = tp / (tp + fp)
    prec0 = F.when(tp0 + fp0 > 0, tp0 / (tp0 + fp0)).otherwise(1.0)
    area = safe_div((tp - tp0).cast("double"), F.col("P")) * (prec + prec0) / 2
    return cp.agg(F.sum(area).alias("pr_auc"))


def threshold_metrics(df: DataFrame, thresholds: list[float], label: str = "label", score: str = "score",
                      positive=1) -> DataFrame:
    """Accuracy, precision, recall, F1 of class 1 at each threshold (prediction = score >= t).
    One aggregate over the per-score counts computes every threshold; no join with a threshold list."""
    sc = score_counts(df, label, score, positive)
    aggs = [F.sum("pos").alias("P"), F.sum("neg").alias("N")]
    for i, t in enumerate(thresholds):
        hit = F.col("score") >= F.lit(float(t))
        aggs += [F.sum(F.when(hit, F.col("pos")).otherwise(0)).alias(f"tp{i}"),
                 F.sum(F.when(hit, F.col("neg")).otherwise(0)).alias(f"fp{i}")]
    g = sc.agg(*aggs)
    rows = []
    for i, t in enumerate(thresholds):
        tp, fp = F.col(f"tp{i}"), F.col(f"fp{i}")
        fn, tn = F.col("P") - tp, F.col("N") - fp
        prec = _zero_div(tp, tp + fp)
        rec = _zero_div(tp, F.col("P"))
        rows.append(F.struct(F.lit(float(t)).alias("threshold"),
                             _zero_div(tp + tn, F.col("P") + F.col("N")).alias("accuracy"),
                             prec.alias("precision"), rec.alias("recall"),
                             _zero_div(2 * tp, 2 * tp + fp + fn).alias("f1")))
    return g.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def eval_threshold(df: DataFrame, threshold: float, label: str = "label", score: str = "score",
                   positive=1) -> DataFrame:
    """E3 + E4 + E5 at one threshold: accuracy, precision, recall, F1 of class 1 and ROC AUC on scores."""
    m = threshold_metrics(df, [threshold], label, score, positive)
    auc = roc_auc(df, label, score, positive).scalar()
    return m.withColumn("roc_auc", auc)
