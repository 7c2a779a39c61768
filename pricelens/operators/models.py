"""Regressors, model comparison, best-model choice, cross-validated tuning.

The estimators are MLlib's own (distributed fits); this module only wires
them: one metrics table per comparison instead of a driver dict, RMSE
compared with RMSE, seeds fixed, CV folds from the row hash, and the grid
fits of a cross-validation run in parallel.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import (GBTRegressionModel, GBTRegressor, LinearRegression, LinearRegressionModel,
                                   RandomForestRegressionModel, RandomForestRegressor)
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import CV_FOLDS, GBT_ROUNDS, ID, LABEL, MODEL_FAMILIES, PARAM_GRIDS, RF_TREES, SEED
from .dictionary import INDEXED
from .features import SCALED
from .metrics import collect_metrics
from .sums import MAX_NORMAL, LinearSums, linear_sums, solved_from_sums
from .tuning import MAX_GRAM, fits_at_once, fold_sides, in_parallel, linear_grid, out_of_fold, staged_boosting, width_of

ESTIMATORS = {
    "Linear Regression": LinearRegression,
    "Random Forest": RandomForestRegressor,
    "Gradient Boosting": GBTRegressor,
}
MODEL_CLASSES = {
    "Linear Regression": LinearRegressionModel,
    "Random Forest": RandomForestRegressionModel,
    "Gradient Boosting": GBTRegressionModel,
}

# How tree learners execute (not what they learn): rows walk down the trees
# again in every pass, as a table of their node ids (a number for each row and
# tree, written anew for every level) costs more time and fills the disks; one
# pass over the data splits more nodes at once.
TREE_EXECUTION = dict(cacheNodeIds=False, maxMemoryInMB=1024, checkpointInterval=10)

# One-hot blocks sum to one, so with an intercept least squares has no single
# solution; this penalty (about 1e-8 of a standardised coefficient's weight)
# picks one and keeps the solver from giving up.
LINEAR_RIDGE = 1e-3

METRICS_TABLE_SCHEMA = T.StructType([
    T.StructField("model", T.StringType()),
    T.StructField("model_order", T.IntegerType()),
    T.StructField("rmse", T.DoubleType()),
    T.StructField("mse", T.DoubleType()),
    T.StructField("mae", T.DoubleType()),
    T.StructField("r2", T.DoubleType()),
    T.StructField("n", T.LongType()),
    T.StructField("fit_seconds", T.DoubleType()),
    T.StructField("val_rmse", T.DoubleType()),
])

IMPORTANCE_SCHEMA = "idx int, feature_name string, importance double"


def family_of(name: str):
    if name not in ESTIMATORS:
        raise ValueError(f"unknown model family {name!r}; choose one of {list(ESTIMATORS)}")
    return ESTIMATORS[name]


def estimator(name: str, features_col: str = SCALED, label: str = LABEL, seed: int = SEED, **params):
    """A family's estimator with the job's defaults (50 trees, 10 boosting rounds, fixed seed)."""
    cls = family_of(name)
    kw = dict(featuresCol=features_col, labelCol=label)
    if name == "Linear Regression" and features_col == SCALED:
        kw.update(regParam=LINEAR_RIDGE)
    if name == "Random Forest":
        kw.update(numTrees=RF_TREES, seed=seed, **TREE_EXECUTION)
    elif name == "Gradient Boosting":
        kw.update(maxIter=GBT_ROUNDS, seed=seed, **TREE_EXECUTION)
    kw.update(params)
    return cls(**kw)


def features_for(name: str, df: DataFrame, features_col: str = SCALED) -> tuple[str, dict]:
    """The vectors a family is fitted on, and the parameters they need.

    Trees take the nominal indexes where a table has them: a one-hot slot for
    every label would be a bin number in every row.  A tree then has
    to have as many bins as the largest column has labels.
    """
    if name == "Linear Regression" or features_col != SCALED or INDEXED not in df.columns:
        return features_col, {}
    nominal = df.schema[INDEXED].metadata.get("ml_attr", {}).get("attrs", {}).get("nominal", [])
    return INDEXED, {"maxBins": max([32, *[a["num_vals"] for a in nominal]])}


def param_grid(name: str, est, grid: dict | None = None):
    """Grid of a family (``PARAM_GRIDS`` unless a grid is passed)."""
    grid = PARAM_GRIDS[name] if grid is None else grid
    b = ParamGridBuilder()
    for pname, values in grid.items():
        b = b.addGrid(est.getParam(pname), list(values))
    return b.build()


def sums_for(est, train: DataFrame, fold: str | None = None, beyond: int = MAX_NORMAL) -> LinearSums | None:
    """The sums that a linear estimator's fits are solved from, where its vectors are wider than ``beyond``; else None."""
    if not solved_from_sums(est):
        return None
    width = width_of(train, est.getFeaturesCol())
    return linear_sums(train, est.getFeaturesCol(), width, est.getLabelCol(), fold) if width > beyond else None


def fitted(est, train: DataFrame):
    """The estimator's model: a wide linear one solved from one scan, any other by MLlib's own passes."""
    sums = sums_for(est, train)
    return est.fit(train) if sums is None else sums.model(est)


def fit_timed(est, train: DataFrame, by_sums: bool = False):
    t0 = time.time()
    model = fitted(est, train) if by_sums else est.fit(train)
    return model, time.time() - t0


@dataclass
class Comparison:
    metrics: DataFrame                      # METRICS_TABLE_SCHEMA
    models: dict = field(default_factory=dict)
    best_name: str | None = None


def validation_mask(df: DataFrame, slices: int = 8):
    """1 in ``slices`` training rows, chosen by the row hash (no shuffle)."""
    from .features import with_split_key
    return with_split_key(df), (F.floor(F.col("split_key") / 10) % slices) == 0


def _read_by_fits(df: DataFrame, names, *params: dict) -> list[str]:
    """The columns of ``df`` that have these names or are named by a parameter."""
    named = {*names, *(v for p in params for v in p.values() if isinstance(v, str))}
    return [c for c in df.columns if c in named]


def compare_models(train: DataFrame, test: DataFrame, families=None, features_col: str = SCALED,
                   label: str = LABEL, persist: bool = True, select_on: str = "test",
                   by_sums: bool = False, **overrides) -> Comparison:
    """Fit every family, score ``test``, one metrics row per family.

    ``select_on="test"`` fits on all training rows and picks the lowest test
    RMSE (the original flow, with a true RMSE).  ``select_on="validation"``
    fits on the training rows outside a hash-chosen validation slice, picks
    on the validation RMSE (``val_rmse``) and only reports the test metrics.
    ``overrides`` maps a family name to extra estimator params.  With ``persist``
    what the fits read of the table is kept (memory, spilling to disk); a table
    that is written with its vectors needs no second copy.  ``by_sums`` solves a wide
    linear model from one scan (``fitted``) instead of MLlib's passes, which stop
    nearer to or farther from the least error: predictions differ in the fifth digit.
    """
    families = list(families or MODEL_FAMILIES)
    spark = train.sparkSession
    val = None
    if select_on == "validation":
        keyed, mask = validation_mask(train)
        train, val = keyed.filter(~mask), keyed.filter(mask)
    elif select_on != "test":
        raise ValueError(f"select_on must be 'test' or 'validation', not {select_on!r}")
    train = train.select(*_read_by_fits(train, [features_col, INDEXED, label], *overrides.values()))
    if persist:
        train = train.persist(StorageLevel.MEMORY_AND_DISK)
        train.count()  # fill the cache now, so fit_seconds times the fits alone
    rows, models = [], {}
    try:
        for order, name in enumerate(families):
            own, needed = features_for(name, train, features_col)
            est = estimator(name, own, label, **{**needed, **overrides.get(name, {})})
            model, secs = fit_timed(est, train, by_sums)
            m = collect_metrics(model.transform(test), label)
            v = collect_metrics(model.transform(val), label)["rmse"] if val is not None else None
            rows.append((name, order, m["rmse"], m["mse"], m["mae"], m["r2"], m["n"], secs, v))
            models[name] = model
    finally:
        if persist:
            train.unpersist()
    metrics = spark.createDataFrame(rows, METRICS_TABLE_SCHEMA)
    best = choose_best(rows, by=8 if val is not None else 2)
    return Comparison(metrics, models, best)


def choose_best(rows, by: int = 2) -> str:
    """Smallest RMSE (column ``by`` of a metrics row), earlier family on ties; NaN never wins."""
    ok = [r for r in rows if r[by] is not None and r[by] == r[by]]
    if not ok:
        raise ValueError("no model produced a finite RMSE; nothing to choose")
    return min(ok, key=lambda r: (r[by], r[1]))[0]


def best_model_row(metrics: DataFrame, by: str = "rmse") -> DataFrame:
    """The best row of a metrics table (``by`` = ``rmse`` or ``val_rmse``), as a top-1 plan."""
    return (metrics.filter(F.col(by).isNotNull() & ~F.isnan(by))
                   .orderBy(by, "model_order").limit(1))


@dataclass
class Tuned:
    model: object
    cv_metrics: DataFrame        # (params, avg_rmse, std_rmse)
    test_metrics: dict
    best: dict = field(default_factory=dict)
    out_of_fold: dict = field(default_factory=dict)


def _points(grid: dict) -> list[dict]:
    """Every combination of a grid's values, the last parameter changing fastest."""
    points = [{}]
    for name, values in grid.items():
        points = [{**p, name: v} for p in points for v in values]
    return points


def _described(p: dict) -> str:
    return ", ".join(f"{k}={p[k]}" for k in sorted(p))


def cross_validate(name: str, train: DataFrame, test: DataFrame | None = None, grid: dict | None = None,
                   folds: int = CV_FOLDS, features_col: str = SCALED, label: str = LABEL,
                   parallelism: int = 8, sums: LinearSums | None = None, **params) -> Tuned:
    """K-fold CV over a family's grid, RMSE, folds from the ``fold`` column if present.

    A linear grid over penalties is solved from one scan (``sums`` is that scan's
    result, where it is known already), a boosting grid over rounds from one fit for each fold and depth;
    any other grid is fitted point by point, ``parallelism`` at a time or, where
    their tables would not fit side by side, fewer.
    The best point is refitted on the whole training table.
    """
    features_col, needed = features_for(name, train, features_col)
    params = {**needed, **params}
    grid = PARAM_GRIDS[name] if grid is None else grid
    points = _points(grid)
    make = lambda **p: estimator(name, features_col, label, **{**params, **p})
    if "fold" in train.columns:
        train = train.select(*_read_by_fits(train, [features_col, label, "fold"], params))
    folded = "fold" in train.columns
    penalties = name == "Linear Regression" and set(grid) <= {"regParam", "elasticNetParam"} and not set(params) - {"solver"}
    if folded and penalties and sums is None:
        sums = sums_for(make(), train, "fold", MAX_GRAM)
    own = sums if folded and penalties else None
    by_passes = own is None or own.width <= MAX_NORMAL  # a table that is read once more needs no copy
    if by_passes:
        train = train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if own is None:
            parallelism = fits_at_once(train.count(), parallelism)
        if own is not None:
            scores = own.grid(points, lambda tasks: in_parallel(train.sparkSession, tasks, parallelism))
        elif folded and penalties and width_of(train, features_col) <= MAX_GRAM:
            scores = linear_grid(train, points, features_col, label)
        elif folded and name == "Gradient Boosting" and "maxIter" in grid:
            scores = staged_boosting(make, train, points, folds, parallelism)
        else:
            scores = _fitted_grid(make(), train, grid, folds, label, parallelism)
        means = [sum(s) / len(s) for s in scores]
        best = points[min(range(len(points)), key=lambda i: means[i])]
        model = make(**best).fit(train) if by_passes else own.model(make(**best))
    finally:
        if by_passes:
            train.unpersist()
    spread = [(sum((x - m) ** 2 for x in s) / max(len(s) - 1, 1)) ** 0.5 for s, m in zip(scores, means)]
    cv_table = train.sparkSession.createDataFrame([(_described(p), float(m), float(d)) for p, m, d in zip(points, means, spread)],
                                                  "params string, avg_rmse double, std_rmse double")
    test_m = collect_metrics(model.transform(test), label) if test is not None else {}
    return Tuned(model, cv_table, test_m, {**params, **best})


def _fitted_grid(est, train: DataFrame, grid: dict, folds: int, label: str, parallelism: int) -> list[list[float]]:
    """RMSE of each point on each fold, one fit each."""
    ev = RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="rmse")
    maps = [{est.getParam(k): v for k, v in p.items()} for p in _points(grid)]
    if "fold" in train.columns:
        sides = fold_sides(train, folds)
    else:
        parts = train.randomSplit([1.0] * folds, seed=SEED)
        sides = [(_union([p for j, p in enumerate(parts) if j != i]), parts[i]) for i in range(folds)]
    tasks = [lambda m=m, s=s: ev.evaluate(est.copy(m).fit(s[0]).transform(s[1])) for m in maps for s in sides]
    flat = in_parallel(train.sparkSession, tasks, parallelism)
    return [flat[i * folds:(i + 1) * folds] for i in range(len(maps))]


def _union(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def out_of_fold_metrics(name: str, train: DataFrame, folds: int = CV_FOLDS, features_col: str = SCALED, label: str = LABEL,
                        sums: LinearSums | None = None, **params) -> dict:
    """Metrics over all training rows, each predicted by a model that did not see its fold."""
    return collect_metrics(out_of_fold_table(name, train, folds, features_col, label, sums, **params), label)


def out_of_fold_table(name: str, train: DataFrame, folds: int = CV_FOLDS, features_col: str = SCALED, label: str = LABEL,
                      sums: LinearSums | None = None, **params) -> DataFrame:
    """id, label, fold and prediction of every training row, by the model of a family that did not see its fold."""
    own, needed = features_for(name, train, features_col)
    keep = [c for c in (ID, label) if c in train.columns]
    make = lambda: estimator(name, own, label, **{**needed, **params})
    if "fold" not in train.columns or not solved_from_sums(make()):
        sums = None
    elif sums is None:
        sums = sums_for(make(), train, "fold")
    return out_of_fold(make, train, folds, keep, sums=sums if sums is not None and sums.width > MAX_NORMAL else None)


def tuned_or_base(base_metrics: dict, tuned: Tuned | None) -> str:
    """``"tuned"`` when its RMSE is strictly lower than the base model's: out of fold where both have one, else on the test rows."""
    if tuned is None or not (tuned.test_metrics or tuned.out_of_fold):
        return "base"
    base_oof = base_metrics.get("out_of_fold")
    if base_oof and tuned.out_of_fold:
        return "tuned" if tuned.out_of_fold["rmse"] < base_oof["rmse"] else "base"
    return "tuned" if tuned.test_metrics["rmse"] < base_metrics["rmse"] else "base"


def tune_and_choose(name: str, base_metrics: dict, train: DataFrame, test: DataFrame | None = None, grid: dict | None = None,
                    folds: int = CV_FOLDS, features_col: str = SCALED, label: str = LABEL, parallelism: int = 8, base_params: dict | None = None,
                    **params) -> tuple[Tuned, str]:
    """Tune a family, and say whether the tuned or the base model predicts unseen training rows better.

    Both are compared on out-of-fold predictions of the training table; the
    test table is only reported on.  ``base_metrics`` gets the base's under ``out_of_fold``.
    """
    own, needed = features_for(name, train, features_col)
    sums = sums_for(estimator(name, own, label, **needed), train, "fold") if "fold" in train.columns else None  # one scan for all of them
    tuned = cross_validate(name, train, test, grid, folds, features_col, label, parallelism, sums, **params)
    base_metrics["out_of_fold"] = out_of_fold_metrics(name, train, folds, features_col, label, sums, **(base_params or {}))
    tuned.out_of_fold = out_of_fold_metrics(name, train, folds, features_col, label, sums, **tuned.best)
    return tuned, tuned_or_base(base_metrics, tuned)


def feature_importance(spark: SparkSession, model, names: list[str]) -> DataFrame | None:
    """``(idx, feature_name, importance)`` for tree models, None for others."""
    if not hasattr(model, "featureImportances"):
        return None
    imp = model.featureImportances.toArray().tolist()
    rows = [(i, names[i] if i < len(names) else str(i), float(v)) for i, v in enumerate(imp)]
    return spark.createDataFrame(rows, IMPORTANCE_SCHEMA)
