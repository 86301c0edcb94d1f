"""Plans for models and scoring (M1-M8): quality label of documents from length, language and source.

MLlib's random streams differ from any SQL engine, so no probability can be compared with an oracle's value. The
plans return what must hold of them for every row, next to the row's key and label: probabilities within 0 and 1,
the predicted class by the larger one, the score equations of an unpenalised logistic regression, equal scores
after saving and loading, fold sizes. ``operators.models`` returns the probabilities themselves.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tablesmith.operators import evaluate as EV
from tablesmith.operators import models as M
from tablesmith.operators import pipeline as PL
from tablesmith.operators import prep as P
from tablesmith.operators import split as SP
from tablesmith.plans import sqlparts as Q
from tablesmith.plans import tables as TB
from tablesmith.plans.catalog import register
from tablesmith.sources import io

NUM = ["n_chars"]
CAT = ["lang", "source"]
THRESHOLD = 0.65

S = Q.with_(Q.SCORED, Q.split_cte(src="scored", key="doc_id", target="label"))


def features(spark, sf_dir):
    s = TB.documents_split(spark, sf_dir)
    pre = P.fit_preprocessor(TB.train_part(s), NUM, CAT)
    data = pre.assemble(s, keep=["doc_id", "label", "split"])
    return pre, data


def scored(spark, sf_dir, kind, part=None):
    """M5 of a model fitted on the train part: doc_id, label, split, prediction, probability_1."""
    _pre, data = features(spark, sf_dir)
    m = M.fit(kind, TB.train_part(data))
    keep = ["doc_id", "label", "split"]
    return M.score_probability(m, data.filter(F.col("split") == part) if part else data, keep)


def checked(df):
    p = F.col("probability_1")
    return df.select("doc_id", "label", "split", ((p >= 0) & (p <= 1)).alias("in_range"),
                     (F.col("prediction") == (p > 0.5).cast("int")).alias("consistent"))


CHECKED_SQL = "SELECT doc_id, label, split, true AS in_range, true AS consistent FROM split"


def _model_plan(kind):
    def plan(spark, sf_dir):
        return checked(scored(spark, sf_dir, kind, "val"))
    return plan


for _name, _kind in [("model_logistic", "logistic"), ("model_tree", "tree"), ("model_forest", "forest"),
                     ("model_gbt", "gbt")]:
    register(_name, S + CHECKED_SQL + " WHERE split = 'val'")(_model_plan(_kind))


@register("score_probability", S + CHECKED_SQL)
def score_probability(spark, sf_dir):
    return checked(scored(spark, sf_dir, "forest"))


FEATURE_SQL = S[:-1] + """,
tr AS (SELECT * FROM split WHERE split = 'train'),
names AS (SELECT 'num__n_chars' AS feature
          UNION ALL SELECT DISTINCT 'cat__lang_' || lang FROM tr WHERE lang IS NOT NULL
          UNION ALL SELECT DISTINCT 'cat__source_' || source FROM tr WHERE source IS NOT NULL)
"""


@register("logistic_score_equations", FEATURE_SQL + """
SELECT feature, true AS balanced FROM names UNION ALL SELECT '(intercept)', true""")
def logistic_score_equations(spark, sf_dir):
    pre, data = features(spark, sf_dir)
    train = TB.train_part(data)
    m = M.fit("logistic", train, maxIter=500, tol=1e-12, regParam=0.0)
    eq = M.score_equations(m, train, pre.feature_names())
    return eq.select("feature", (F.abs("equation") < 1e-4).alias("balanced"))


@register("feature_importance", FEATURE_SQL + """
SELECT feature, true AS in_range, 1.0 AS total FROM names""")
def feature_importance(spark, sf_dir):
    """All features; their importances sum to 1."""
    pre, data = features(spark, sf_dir)
    imp = M.feature_importance(spark, M.fit("forest", TB.train_part(data)), pre.feature_names())
    return imp.select("feature", F.col("importance").between(0, 1).alias("in_range"),
                      F.round(imp.agg(F.sum("importance")).scalar(), 6).alias("total"))


def evaluation(spark, sf_dir, kind="forest", threshold=THRESHOLD):
    """Fit on train, score the validation part, cut at the threshold, compute and log the metrics."""
    val = scored(spark, sf_dir, kind, "val").checkpoint(eager=True)
    found = EV.eval_threshold(val, threshold, score="probability_1").first().asDict()
    found.pop("threshold")
    path = TB.scratch(spark, "evaluation")
    metrics = {k: v for k, v in found.items() if v is not None}
    for _ in range(2):
        io.log_metrics(spark, path, metrics, {"threshold": threshold})
    return val, metrics, io.read_metrics(spark, path)


@register("evaluate_model", """
SELECT run, kind, metric, true AS in_range, true AS timed
FROM (VALUES (1), (2)) r(run), (VALUES ('metric', 'accuracy'), ('metric', 'precision'), ('metric', 'recall'),
     ('metric', 'f1'), ('metric', 'roc_auc'), ('setting', 'threshold')) m(kind, metric)""")
def evaluate_model(spark, sf_dir):
    """Validation-set evaluation end to end: the run numbers, metrics and settings in the log."""
    _val, _metrics, log = evaluation(spark, sf_dir)
    return log.select("run", "kind", "metric", F.col("value").between(0, 1).alias("in_range"),
                      F.col("logged_at").cast("timestamp").isNotNull().alias("timed"))


@register("evaluate_model_counts", S + """
SELECT count(*) AS n_rows, true AS accuracy_agrees FROM split WHERE split = 'val'""")
def evaluate_model_counts(spark, sf_dir):
    """The logged accuracy against a count over the scored validation rows."""
    val, metrics, _log = evaluation(spark, sf_dir)
    right = (F.col("probability_1") >= THRESHOLD).cast("int") == F.col("label")
    return val.agg(F.count(F.lit(1)).alias("n_rows"),
                   (F.abs(F.avg(right.cast("int")) - F.lit(metrics["accuracy"])) < 1e-12).alias("accuracy_agrees"))


def _folds(spark, sf_dir):
    d = TB.scored_documents(spark, sf_dir)
    return SP.stratified_folds(d, "doc_id", "label", k=10, seed=TB.SEED).checkpoint(eager=True)


def _prepare(train):
    pre = P.fit_preprocessor(train, NUM, CAT)
    return lambda df: pre.assemble(df, keep=["doc_id", "label"])


FOLDS_SQL = Q.with_(Q.SCORED, """folds AS (
  SELECT (row_number() OVER (PARTITION BY label ORDER BY md5(CAST(doc_id AS VARCHAR) || ':42')) - 1) % 10 AS fold
  FROM scored)""")


def _cv_plan(kind, with_train, **params):
    def plan(spark, sf_dir):
        cv = M.cross_validate(kind, _folds(spark, sf_dir), 10, _prepare, with_train=with_train, **params)
        ok = F.col("f1_val").between(0, 1)
        if with_train:
            ok = ok & F.col("f1_train").between(0, 1) & (F.abs(F.col("gap") - F.col("f1_train") + F.col("f1_val")) < 1e-12)
        return cv.select("fold", "n_val", ok.alias("in_range"))
    return plan


CV_SQL = FOLDS_SQL + "SELECT CAST(fold AS INTEGER) AS fold, count(*) AS n_val, true AS in_range FROM folds GROUP BY 1"
register("cross_validate", CV_SQL)(_cv_plan("logistic", False))
register("overfit_gap", CV_SQL)(_cv_plan("logistic", True))
register("cross_validate_gbt", CV_SQL)(_cv_plan("gbt", True, maxIter=5))


@register("model_roundtrip", S + "SELECT count(*) AS n_rows, 0.0 AS largest_difference, true AS newest FROM split")
def model_roundtrip(spark, sf_dir):
    """Scores before saving and after loading the newest of two saved models, joined by key."""
    from pyspark.ml.classification import RandomForestClassificationModel
    s = TB.documents_split(spark, sf_dir)
    pre = P.fit_preprocessor(TB.train_part(s), NUM, CAT)
    ppath, base = TB.scratch(spark, "preprocessor"), TB.scratch(spark, "models")
    pre.save(spark, ppath)
    data = P.PreprocessorModel.load(spark, ppath).assemble(s, keep=["doc_id", "label", "split"])
    train = TB.train_part(data)
    M.fit("forest", train, numTrees=3).write().save(M.model_path(base, "forest"))
    model = M.fit("forest", train)
    model.write().save(M.model_path(base, "forest"))
    again = RandomForestClassificationModel.load(M.newest_model(spark, base, "forest"))
    before = M.score_probability(model, data, ["doc_id"], "p").select("doc_id", "p")
    after = M.score_probability(again, data, ["doc_id"], "q").select("doc_id", "q")
    return before.join(after, "doc_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.max(F.abs(F.col("p") - F.col("q"))).alias("largest_difference"),
        F.lit(len(again.trees) == 150).alias("newest"))


@register("pipeline_model_roundtrip", S + "SELECT count(*) AS n_rows, 0.0 AS from_loaded, 0.0 AS from_parts FROM split")
def pipeline_model_roundtrip(spark, sf_dir):
    """One saved model scores unprepared rows: the largest differences of its probabilities to those before saving,
    and to those of preprocessing and classifier fitted one by one."""
    from pyspark.ml import PipelineModel
    s = TB.documents_split(spark, sf_dir)
    train = TB.train_part(s)
    model = PL.fit_pipeline("forest", train, NUM, CAT)
    path = M.model_path(TB.scratch(spark, "pipelines"), "forest")
    model.write().save(path)
    again = PipelineModel.load(path)
    pre = P.fit_preprocessor(train, NUM, CAT)
    parts = M.fit("forest", pre.assemble(train, keep=["doc_id", "label"]))
    score = lambda m, df, p: M.score_probability(m, df, ["doc_id"], p).select("doc_id", p)
    all_three = (score(model, s, "p").join(score(again, s, "q"), "doc_id")
                 .join(score(parts, pre.assemble(s, keep=["doc_id"]), "r"), "doc_id"))
    far = lambda c: F.round(F.max(F.abs(F.col("p") - F.col(c))), 9)
    return all_three.agg(F.count(F.lit(1)).alias("n_rows"), far("q").alias("from_loaded"), far("r").alias("from_parts"))
