"""Grids from fewer passes equal separate fits; out-of-fold choice; dictionary-based predictions equal MLlib's on the vectors."""

import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from pricelens.operators import models, tuning
from pricelens.operators.dictionary import INDEXED, prepare_features
from pricelens.operators.features import SCALED, prepare, with_fold
from pricelens.operators.models import Tuned, cross_validate, estimator, features_for, tuned_or_base
from pricelens.plans.common import clean, materialized
from pricelens.plans.score import predict
from pricelens.schema import ID, LABEL

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def narrow(spark):
    p = prepare(materialized(spark, SF_SMALL), "narrow")
    return with_fold(p.train, 3).cache(), p.test


@pytest.fixture(scope="module")
def full(spark):
    p = prepare_features(clean(spark, SF_SMALL), folds=3, partitions=4)
    return p, p.train.cache()


def test_linear_grid_equals_separate_fits(narrow):
    train, _ = narrow
    points = [{"regParam": r, "elasticNetParam": e} for r in (0.5, 2_000.0, 40_000.0) for e in (0.0, 0.5, 1.0)]
    got = tuning.linear_grid(train, points, SCALED)
    ev = RegressionEvaluator(labelCol=LABEL, metricName="rmse")
    for p, rmse in zip(points, got):
        for k in range(3):
            m = estimator("Linear Regression", **p, tol=1e-10, maxIter=500).fit(train.where(F.col("fold") != k))
            assert rmse[k] == pytest.approx(ev.evaluate(m.transform(train.where(F.col("fold") == k))), rel=2e-4)


def test_constant_and_dependent_features_do_no_harm():
    x = np.random.default_rng(1).normal(size=(50, 3))
    x[:, 1], y = 7.0, None
    x = np.column_stack([x, x[:, 0] * 2])
    y = 3 * x[:, 0] - x[:, 2] + 5
    z = np.column_stack([x, np.ones(50), y])
    for en in (0.0, 0.5):
        v = tuning.solve_linear(z.T @ z, 1e-9, en)
        assert v[1] == 0.0 and v @ (z.T @ z) @ v < 1e-3
    flat = np.column_stack([x, np.ones(50), np.full(50, 4.0)])
    assert tuning.solve_linear(flat.T @ flat)[-2] == pytest.approx(4.0)


def test_wide_grids_are_fitted_point_by_point(narrow, monkeypatch):
    train, _ = narrow
    grid = {"regParam": [10.0, 5_000.0]}
    one_scan = [r.avg_rmse for r in cross_validate("Linear Regression", train, grid=grid).cv_metrics.collect()]
    monkeypatch.setattr(models, "MAX_GRAM", 3)
    fitted = [r.avg_rmse for r in cross_validate("Linear Regression", train, grid=grid).cv_metrics.collect()]
    assert one_scan == pytest.approx(fitted, rel=2e-4)


def test_staged_boosting_equals_separate_fits(narrow):
    train, test = narrow
    grid = {"maxDepth": [2, 3], "maxIter": [2, 4]}
    tuned = cross_validate("Gradient Boosting", train, test, grid)
    separate = models._fitted_grid(estimator("Gradient Boosting"), train, grid, 3, LABEL, 4)
    got = {r.params: r.avg_rmse for r in tuned.cv_metrics.collect()}
    assert list(got) == ["maxDepth=2, maxIter=2", "maxDepth=2, maxIter=4", "maxDepth=3, maxIter=2", "maxDepth=3, maxIter=4"]
    assert list(got.values()) == pytest.approx([sum(s) / 3 for s in separate], rel=1e-9)
    assert tuned.best["maxIter"] == 4 and tuned.test_metrics["rmse"] > 0


def test_out_of_fold_rows_are_predicted_by_the_other_folds(narrow):
    train, _ = narrow
    table = models.out_of_fold_table("Linear Regression", train, 3)
    assert table.count() == train.count() and table.where("prediction is null").count() == 0
    held = estimator("Linear Regression").fit(train.where("fold != 1")).transform(train.where("fold = 1"))
    want = {r[ID]: r.prediction for r in held.collect()}
    got = {r[ID]: r.prediction for r in table.where("fold = 1").collect()}
    assert set(got) == set(want) and all(got[k] == pytest.approx(want[k], rel=1e-9) for k in got)


def test_choice_is_made_out_of_fold():
    tuned = Tuned(None, None, {"rmse": 9.0}, {}, {"rmse": 1.0})
    assert tuned_or_base({"rmse": 5.0, "out_of_fold": {"rmse": 2.0}}, tuned) == "tuned"
    assert tuned_or_base({"rmse": 5.0, "out_of_fold": {"rmse": 1.0}}, tuned) == "base"
    assert tuned_or_base({"rmse": 5.0}, tuned) == "base" and tuned_or_base({"rmse": 5.0}, None) == "base"


def test_trees_take_nominal_indexes_and_lines_every_slot(full):
    prep, train = full
    assert features_for("Linear Regression", train) == (SCALED, {})
    col, needed = features_for("Gradient Boosting", train)
    assert col == INDEXED and needed["maxBins"] == max([32, *prep.features.arities])


@pytest.mark.parametrize("name", ["Linear Regression", "Gradient Boosting"])
def test_predictions_by_the_dictionary_equal_those_on_the_vectors(full, name):
    prep, train = full
    col, needed = features_for(name, train)
    model = estimator(name, col, **needed).fit(train)
    rows = materialized(train.sparkSession, SF_SMALL).withColumn("k", F.xxhash64("*")).withColumn("Owner", F.when(F.col("Year") > 1995, F.col("Owner")))
    want = {r.k: r.prediction for r in model.transform(prep.features.transform(rows)).select("k", "prediction").collect()}
    out = predict(rows, prep.features, model, name, keep=("k",))
    got = {r.k: r.prediction for r in out.collect()}
    assert set(got) == set(want) and all(got[k] == pytest.approx(want[k], rel=1e-8) for k in want)


def test_a_request_without_a_number_has_no_prediction(full):
    prep, train = full
    rows = train.sparkSession.createDataFrame([("a", "Brand#13", None)], f"{ID} string, Brand string, Year int")
    for c in prep.features.categoricals + prep.features.numerics:
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit(None).cast("string" if c in prep.features.categoricals else "double"))
    for name in ("Linear Regression", "Random Forest"):
        col, needed = features_for(name, train)
        model = estimator(name, col, **{**needed, **({"numTrees": 2} if name == "Random Forest" else {})}).fit(train)
        assert [r.prediction for r in predict(rows, prep.features, model, name).collect()] == [None]
