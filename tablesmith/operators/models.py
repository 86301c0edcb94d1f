"""Models and scoring (M1-M8) with MLlib; features come from a ``PreprocessorModel`` fitted on train."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesmith.operators.evaluate import classification_report

# The forest of the reference configuration.
FOREST_PARAMS = {"numTrees": 150, "maxDepth": 5, "impurity": "gini", "featureSubsetStrategy": "sqrt", "seed": 42,
                 "minInstancesPerNode": 1}


def estimator(kind: str, features: str = "features", label: str = "label", **params):
    """M1-M4: 'logistic', 'tree', 'forest' (150 trees, gini, sqrt, depth 5, seed 42) or 'gbt'."""
    common = {"featuresCol": features, "labelCol": label}
    if kind == "logistic":
        return LogisticRegression(**common, **{"maxIter": 100, **params})
    if kind == "tree":
        return DecisionTreeClassifier(**common, **{"seed": 42, **params})
    if kind == "forest":
        return RandomForestClassifier(**common, **{**FOREST_PARAMS, **params})
    if kind == "gbt":
        return GBTClassifier(**common, **{"maxIter": 50, "maxDepth": 4, "seed": 42, **params})
    raise ValueError(f"unknown model kind {kind!r}")


def fit(kind: str, train: DataFrame, features: str = "features", label: str = "label", **params):
    return estimator(kind, features, label, **params).fit(train.withColumn(label, F.col(label).cast("double")))


def score_probability(model, df: DataFrame, keep: list[str], out: str = "probability_1") -> DataFrame:
    """M5: probability of class 1, plus the predicted class."""
    pred = model.transform(df)
    return pred.select(*keep, F.col("prediction").cast("int").alias("prediction"),
                       vector_to_array("probability")[1].alias(out))


def feature_importance(spark, model, names: list[str], offset: int = 0) -> DataFrame:
    """M6: importances zipped with feature names, descending; ``offset`` skips the head (the reference shows
    the tail from the 21st on). The importance vector has one entry per feature (schema-bounded)."""
    imp = model.featureImportances.toArray().tolist()
    df = spark.createDataFrame(list(zip(names, [float(x) for x in imp])), "feature string, importance double")
    return df.orderBy(F.col("importance").desc(), F.col("feature")).offset(offset)


def weighted_f1(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    rep = classification_report(pred, label, prediction)
    return rep.filter(F.col("cls") == "weighted avg").select(F.col("f1").alias("f1_weighted"))


def cross_validate(kind: str, data: DataFrame, k: int, prepare, fold_col: str = "fold", label: str = "label",
                   with_train: bool = False, **params) -> DataFrame:
    """M7 / M8: per fold, fit preprocessing and model on the other folds and score the held-out one: (fold, n_val,
    f1_val), with ``with_train`` also the training folds' F1 and the gap train - validation.

    ``prepare(train)`` fits on the training folds and returns a function from a DataFrame to one with ``features``:
    nothing of the held-out fold reaches the preprocessing. Folds run one after another, each fit distributed;
    the driver keeps a row per fold."""
    rows = []
    for f in range(k):
        tr = data.filter(F.col(fold_col) != f)
        va = data.filter(F.col(fold_col) == f)
        features = prepare(tr)
        train = features(tr).persist()
        m = fit(kind, train, label=label, **params)
        scored = lambda df: m.transform(df).withColumn("prediction", F.col("prediction").cast("int"))
        vf = float(weighted_f1(scored(features(va)), label).first()[0])
        row = [f, va.count(), vf]
        if with_train:
            tf = float(weighted_f1(scored(train), label).first()[0])
            row += [tf, tf - vf]
        train.unpersist()
        rows.append(tuple(row))
    schema = "fold int, n_val bigint, f1_val double" + (", f1_train double, gap double" if with_train else "")
    return data.sparkSession.createDataFrame(rows, schema)


def score_equations(model, df: DataFrame, names: list[str], features: str = "features",
                    label: str = "label") -> DataFrame:
    """(feature, equation): sum over rows of (probability of 1 - label) * x_j for each feature, and for the
    intercept, by the mean's size; about 0 at the optimum of a logistic regression without penalty."""
    p = vector_to_array("probability")[1]
    x = vector_to_array(features)
    rest = model.transform(df).select((p - F.col(label)).alias("r"), x.alias("x"))
    sums = rest.agg(F.count(F.lit(1)).alias("n"), F.sum("r").alias("s_0"),
                    *[F.sum(F.col("r") * F.col("x")[j]).alias(f"s_{j + 1}") for j in range(len(names))])
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), (F.col(f"s_{j}") / F.col("n")).alias("equation"))
                     for j, c in enumerate(["(intercept)", *names])])
    return sums.select(F.inline(rows))


def model_path(base: str, name: str) -> str:
    """A place for a saved model with the time in its name, as UTC to the microsecond: names sort by age."""
    stamp = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    return f"{base.rstrip('/')}/{name}-{stamp}"


def newest_model(spark, base: str, name: str) -> str:
    """The path of the youngest model of that name below ``base``."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(base)
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    paths = [f.getPath().toString() for f in found if f.getPath().getName().startswith(f"{name}-")]
    if not paths:
        raise FileNotFoundError(f"no model {name!r} below {base}")
    return max(paths)
