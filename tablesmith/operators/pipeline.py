"""Preprocessing as pipeline stages, so that one saved ``PipelineModel`` holds it together with the classifier."""

from __future__ import annotations

from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.pipeline import Pipeline
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame

from tablesmith.operators.models import estimator
from tablesmith.operators.prep import PreprocessorModel, fit_preprocessor


class TablePreprocessor(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Fits ``prep.fit_preprocessor`` on the given rows; its model adds the feature vector ``featuresCol``."""

    numericCols = Param(Params._dummy(), "numericCols", "columns to impute and scale", TypeConverters.toListString)
    categoricalCols = Param(Params._dummy(), "categoricalCols", "columns to impute and one-hot", TypeConverters.toListString)
    featuresCol = Param(Params._dummy(), "featuresCol", "the vector column to add", TypeConverters.toString)

    def __init__(self, numeric: list[str] = (), categorical: list[str] = (), features: str = "features"):
        super().__init__()
        self._set(numericCols=list(numeric), categoricalCols=list(categorical), featuresCol=features)

    def _fit(self, dataset: DataFrame) -> TablePreprocessorModel:
        of = self.getOrDefault
        fitted = fit_preprocessor(dataset, of(self.numericCols), of(self.categoricalCols))
        return TablePreprocessorModel(fitted.to_json(), of(self.featuresCol))


class TablePreprocessorModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the feature vector to a table and keeps all its columns; one of the vector's name is replaced. A missing
    feature (a column without any training value) is NaN."""

    fitted = Param(Params._dummy(), "fitted", "the fitted values as JSON", TypeConverters.toString)
    featuresCol = Param(Params._dummy(), "featuresCol", "the vector column to add", TypeConverters.toString)

    def __init__(self, fitted: str = "{}", features: str = "features"):
        super().__init__()
        self._set(fitted=fitted, featuresCol=features)

    def preprocessor(self) -> PreprocessorModel:
        return PreprocessorModel.from_json(self.getOrDefault(self.fitted))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.preprocessor().with_vector(dataset, self.getOrDefault(self.featuresCol))


def fit_pipeline(kind: str, train: DataFrame, numeric: list[str], categorical: list[str], label: str = "label",
                 **params) -> PipelineModel:
    """Preprocessing and a classifier of ``models`` fitted on ``train`` as one ``PipelineModel``: it scores unprepared
    rows, and ``write().save`` and ``PipelineModel.load`` keep all of it under one path."""
    return Pipeline(stages=[TablePreprocessor(numeric, categorical), estimator(kind, label=label, **params)]).fit(train)
