"""What the model, log and audit operators return, beyond what the plans' oracles compare."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tablesmith.operators import evaluate as EV
from tablesmith.operators import models as M
from tablesmith.plans import catalog, q_models
from tests.conftest import SF_ORACLE, SF_SMALL


def test_every_plan_has_an_oracle():
    assert set(catalog.queries()) == set(catalog.oracle_sql())


@pytest.mark.parametrize("kind", ["logistic", "forest", "gbt", "tree"])
def test_model_probabilities(spark, kind):
    df = q_models.scored(spark, SF_ORACLE, kind, "val")
    row = df.agg(F.min("probability_1"), F.max("probability_1"), F.count("*")).first()
    assert 0.0 <= row[0] <= row[1] <= 1.0 and row[2] > 0


def test_forest_beats_chance(spark):
    df = q_models.scored(spark, SF_ORACLE, "forest")
    assert EV.roc_auc(df, "label", "probability_1").first()[0] > 0.5


def test_held_out_fold_does_not_reach_the_preprocessor(spark):
    rows = [(k, k % 2, float(k), "rare" if k == 7 else "common", k % 3) for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, label int, x double, c string, fold int")
    seen = []

    def prepare(train):
        from tablesmith.operators import prep as P
        pre = P.fit_preprocessor(train, ["x"], ["c"])
        seen.append((train.count(), pre.categories["c"]))
        return lambda d: pre.assemble(d, keep=["doc_id", "label"])

    out = M.cross_validate("tree", df, 3, prepare, with_train=True).collect()
    assert [r["fold"] for r in out] == [0, 1, 2] and [r["n_val"] for r in out] == [20] * 3
    assert [n for n, _ in seen] == [40] * 3
    assert [c for _, c in seen] == [["common", "rare"], ["common"], ["common", "rare"]]
    assert all(abs(r["gap"] - (r["f1_train"] - r["f1_val"])) < 1e-12 for r in out)


def test_importances_are_complete(spark):
    names = [r["feature"] for r in E.queries()["feature_importance"](spark, SF_SMALL).collect()]
    assert len(names) > 20 and "num__n_chars" in names


def test_metrics_log_raises_storage_faults(spark, tmp_path):
    from tablesmith.sources import io
    path = str(tmp_path / "log")
    assert {r["run"] for r in io.log_metrics(spark, path, {"a": 1.0}, {"t": 0.5}).collect()} == {1}
    assert {r["run"] for r in io.log_metrics(spark, path, {"a": 1.0}).collect()} == {1, 2}
    for f in (tmp_path / "log").rglob("*.parquet"):
        f.write_bytes(b"broken")
    with pytest.raises(Exception):
        io.log_metrics(spark, path, {"a": 1.0})


def test_newest_model_wins(spark, tmp_path):
    base = str(tmp_path)
    paths = [M.model_path(base, "forest") for _ in range(2)]
    for p in paths:
        spark.range(1).write.parquet(p)
    assert M.newest_model(spark, base, "forest").endswith(paths[1].rsplit("/", 1)[-1])
    with pytest.raises(FileNotFoundError):
        M.newest_model(spark, base, "other")


def test_check_target(spark):
    from tablesmith.operators import validate as V
    df = spark.range(3).selectExpr("id", "cast(id as int) i", "cast(id as smallint) s", "cast(id as double) d")
    valid = lambda t: V.check_target(df, t).first()["valid"]
    assert valid("id") and valid(["i"]) and not valid("s") and not valid("d") and not valid(["id", "i"]) and not valid("x")
