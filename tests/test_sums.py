"""Linear fits over wide sparse vectors: solved from one scan's sums, equal to MLlib's passes and to the dense solution."""

import numpy as np
import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from pricelens.operators import models, sums, tuning
from pricelens.operators.dictionary import prepare_features
from pricelens.operators.features import SCALED
from pricelens.operators.models import cross_validate, estimator, fitted, out_of_fold_metrics, sums_for, tune_and_choose
from pricelens.schema import ID, LABEL


@pytest.fixture(scope="module")
def train(spark):
    rng = np.random.default_rng(3)
    data = [(f"id-{i}", f"b{rng.integers(9)}", f"m{rng.integers(60)}" if i % 11 else None, 2000 + int(rng.integers(20)), float(rng.integers(50) * 1000)) for i in range(900)]
    data = [(*r, 1000.0 * (r[3] - 1990) + 300.0 * int(r[1][1:]) + 40.0 * int((r[2] or "m0")[1:]) - r[4] / 20 + float(rng.normal() * 500)) for r in data]
    rows = spark.createDataFrame(data, f"{ID} string, Brand string, model string, Year int, kmDriven double, {LABEL} double")
    return prepare_features(rows, folds=3, partitions=3).train.cache()


def test_sums_equal_the_dense_ones(train, monkeypatch):
    monkeypatch.setattr(sums, "PAIRS_AT_ONCE", 50)
    w = tuning.width_of(train, SCALED)
    want, got = tuning.sums_per_fold(train, SCALED), sums.linear_sums(train, SCALED, w, fold="fold")
    assert got.folds == sorted(want)
    x = np.arange(w + 2.0)
    for k, values in zip(got.folds, got.of_fold):
        assert got.times(got.spread(values), x) == pytest.approx(want[k] @ x, rel=1e-9)
        for reg, en in ((0.0, 0.0), (50.0, 0.0), (50.0, 0.5), (200.0, 1.0)):
            a, b = got.solve(got.total - values, reg, en), tuning.solve_linear(sum(want.values()) - want[k], reg, en)
            assert got.rmse(values, a) == pytest.approx(got.rmse(values, b), rel=1e-5)


def test_wide_linear_fits_take_no_passes(train, monkeypatch):
    plain = [r.avg_rmse for r in cross_validate("Linear Regression", train).cv_metrics.collect()]
    oof = out_of_fold_metrics("Linear Regression", train)
    est = estimator("Linear Regression")
    want = est.fit(train)
    monkeypatch.setattr(models, "MAX_NORMAL", 10)
    monkeypatch.setattr(models, "MAX_GRAM", 10)
    monkeypatch.setattr(models.sums_for, "__defaults__", (None, 10))
    passes = []
    monkeypatch.setattr(LinearRegression, "_fit", lambda *_: passes.append(1))
    model = fitted(est, train)
    assert model.transform(train).agg(F.max(F.abs(F.col("prediction") - want.transform(train).first().prediction))).first()[0] > 0
    got = {r[ID]: r.prediction for r in model.transform(train).collect()}
    assert {r[ID]: r.prediction for r in want.transform(train).collect()} == pytest.approx(got, rel=1e-5)
    assert model.getFeaturesCol() == SCALED and model.getRegParam() == est.getRegParam()
    assert [r.avg_rmse for r in cross_validate("Linear Regression", train).cv_metrics.collect()] == pytest.approx(plain, rel=2e-4)
    base = {"rmse": 1.0}
    tuned, _ = tune_and_choose("Linear Regression", base, train, train)
    assert base["out_of_fold"]["rmse"] == pytest.approx(oof["rmse"], rel=1e-5) and tuned.out_of_fold["n"] == oof["n"] and not passes


def test_what_sums_do_not_solve_is_left_to_mllib(train, monkeypatch):
    assert sums_for(estimator("Linear Regression", maxIter=5), train, None, 1) is None
    assert sums_for(estimator("Linear Regression", fitIntercept=False), train, None, 1) is None
    assert sums_for(estimator("Random Forest"), train, None, 1) is None
    monkeypatch.setattr(sums, "MAX_SUMS", 100)
    assert sums_for(estimator("Linear Regression"), train, None, 1) is None
    assert fitted(estimator("Linear Regression"), train).numFeatures == tuning.width_of(train, SCALED)
