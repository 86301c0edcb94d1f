"""One saved model with its preprocessing scores unprepared rows, as before saving."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel

from tablesmith.operators import models as M
from tablesmith.operators import pipeline as PL
from tablesmith.operators import prep as P


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(1)
    data = [(k, None if k % 7 == 0 else float(rng.normal(k % 2, 0.4)), [None, "a b", "c.d", "e"][k % 4], k % 2)
            for k in range(400)]
    return spark.createDataFrame(data, "id int, `x y` double, kind string, label int")


def test_saved_and_loaded(spark, rows, tmp_path):
    model = PL.fit_pipeline("logistic", rows, ["x y"], ["kind"])
    path = str(tmp_path / "model")
    model.write().save(path)
    again = PipelineModel.load(path)
    assert isinstance(again.stages[0], PL.TablePreprocessorModel)
    assert again.stages[0].preprocessor() == model.stages[0].preprocessor()
    odd = spark.createDataFrame([(900, None, None, 0), (901, 50.0, "never seen", 1)], rows.schema)
    both = rows.unionByName(odd)
    score = lambda m: sorted(map(tuple, M.score_probability(m, both, ["id"]).collect()))
    assert score(again) == score(model) and len(score(again)) == 402
    assert np.mean([p == i % 2 for i, p, _ in score(again) if i < 400]) > 0.8


def test_features_equal_the_assembled_ones(rows):
    stage = PL.TablePreprocessor(["x y"], ["kind"], "v").fit(rows)
    pre = P.fit_preprocessor(rows, ["x y"], ["kind"])
    got = {r["id"]: list(r["v"].toArray()) for r in stage.transform(rows).collect()}
    want = {r["id"]: list(r["features"].toArray()) for r in pre.assemble(rows, keep=["id"]).collect()}
    assert got == want and stage.transform(rows).columns == ["id", "x y", "kind", "label", "v"]


def test_an_estimator_keeps_its_columns_when_saved(tmp_path):
    path = str(tmp_path / "stage")
    PL.TablePreprocessor(["a"], ["b", "c"], "out").write().save(path)
    again = PL.TablePreprocessor.load(path)
    assert [again.getOrDefault(p) for p in ("numericCols", "categoricalCols", "featuresCol")] == [["a"], ["b", "c"], "out"]
