"""Registered queries: regressors, metrics, comparison, tuning, jobs (M1-M13, A2-A5, J2-J8).

Models whose output SQL can reproduce are checked against it:

* ordinary least squares on two features = closed form from covariances;
* one unbagged tree (or one boosting round) on a low-cardinality feature,
  deep enough to give every value its own leaf = the per-value label mean;
* cross-validation of that tree over the hash folds = mean per-fold RMSE.

The full families (50-tree forest, 10-round boosting, grids) are checked
by row count only.
"""

from __future__ import annotations

import uuid

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import functions as F

from ..operators.dictionary import INDEXED, prepare_features
from ..operators.features import SCALED, split, with_fold
from ..operators.metrics import regression_metrics
from ..operators.models import best_model_row, compare_models, cross_validate, estimator, feature_importance, features_for, tune_and_choose
from ..oracles import with_listings
from ..registry import register
from ..schema import ID, LABEL, MARKET_FACTOR, SEED
from ..session import release
from ..sources.artifacts import METRICS_DIR, artifact_dir, load_artifacts, run_dir
from ..sources.store import current_path, manifests
from .common import clean, materialized
from .q_serve import requests
from .score import all_requests, predict, score_all
from .train import train as train_job

YEAR_COLS = [ID, "Year", "kmDriven", LABEL]

# Depth that gives each of up to 2**10 distinct values of one feature its own leaf.
DEEP = 10


def _mantissa(c, digits: int = 7):
    """(mantissa, exponent) of a double: scale-free rounding for the hash compare."""
    x = F.col(c) if isinstance(c, str) else c
    e = F.floor(F.log10(F.abs(x))).cast("int")
    return F.round(x / F.pow(F.lit(10.0), e), digits), e


def _mantissa_sql(x: str, digits: int = 7) -> str:
    e = f"CAST(floor(log10(abs({x}))) AS INTEGER)"
    return f"round({x} / pow(10.0, {e}), {digits}) AS mantissa, {e} AS exponent"


def _one_feature(df, col):
    return VectorAssembler(inputCols=[col], outputCol="f").transform(df)


# --- flagship --------------------------------------------------------------

def flagship_scores(spark, sf_dir, family: str = "Linear Regression"):
    """Clean listings, fit the feature dictionary over all ten features and a regressor on the training
    split, and price every clean listing (prediction and market-adjusted)."""
    # The clean table feeds several passes (index, scale, fit, score): write it
    # once to the checkpoint folder instead of re-running scan and joins.
    df = materialized(spark, sf_dir)
    prep = prepare_features(df)
    features_col, needed = features_for(family, prep.train)
    model = estimator(family, features_col, **needed).fit(prep.train)
    return predict(df, prep.features, model, family, MARKET_FACTOR, keep=(ID,))


@register("score_batch")
def q_score_batch(spark, sf_dir):
    """Every clean listing priced by the flagship model (J5 on a whole table)."""
    return flagship_scores(spark, sf_dir)


# --- SQL-checked models ----------------------------------------------------

_GROUP_MEAN_SQL = """
WITH means AS (SELECT Year, avg(AskPrice) AS prediction FROM train GROUP BY Year)"""


@register("regression_metrics", with_listings(_GROUP_MEAN_SQL + """
, scored AS (SELECT t.AskPrice, m.prediction FROM test t JOIN means m USING (Year))
SELECT 'group_mean_tree' AS model,
 round(sqrt(avg((AskPrice - prediction)^2)), 6) AS rmse,
 round(avg((AskPrice - prediction)^2), 2) AS mse,
 round(avg(abs(AskPrice - prediction)), 6) AS mae,
 round(1 - sum((AskPrice - prediction)^2) / (var_pop(AskPrice) * count(*)), 10) AS r2,
 CAST(count(*) AS BIGINT) AS n
FROM scored"""))
def q_regression_metrics(spark, sf_dir):
    """RMSE, MSE, MAE, R² in one pass, for a one-tree per-Year model on the test split."""
    train, test = split(materialized(spark, sf_dir, YEAR_COLS))
    rf = RandomForestRegressor(featuresCol="f", labelCol=LABEL, numTrees=1, bootstrap=False,
                               maxDepth=DEEP, featureSubsetStrategy="all", seed=SEED)
    model = rf.fit(_one_feature(train, "Year"))
    m = regression_metrics(model.transform(_one_feature(test, "Year")))
    return m.select(F.lit("group_mean_tree").alias("model"), F.round("rmse", 6).alias("rmse"),
                    F.round("mse", 2).alias("mse"), F.round("mae", 6).alias("mae"),
                    F.round("r2", 10).alias("r2"), "n")


@register("json_meta_roundtrip", with_listings(_GROUP_MEAN_SQL + """
, scored AS (SELECT t.AskPrice, m.prediction FROM test t JOIN means m USING (Year))
SELECT 'group_mean_tree' AS model_name,
 round(sqrt(avg((AskPrice - prediction)^2)), 6) AS RMSE,
 round(1 - sum((AskPrice - prediction)^2) / (var_pop(AskPrice) * count(*)), 10) AS R2,
 round(avg(abs(AskPrice - prediction)), 6) AS MAE
FROM scored"""))
def q_json_meta_roundtrip(spark, sf_dir):
    """Run metadata (model name, metrics struct, creation time) written as JSON and read back."""
    from ..operators.metrics import collect_metrics
    from ..sources.artifacts import load_metadata, metadata_frame, save_metadata
    train, test = split(materialized(spark, sf_dir, YEAR_COLS))
    rf = RandomForestRegressor(featuresCol="f", labelCol=LABEL, numTrees=1, bootstrap=False,
                               maxDepth=DEEP, featureSubsetStrategy="all", seed=SEED)
    model = rf.fit(_one_feature(train, "Year"))
    m = collect_metrics(model.transform(_one_feature(test, "Year")))
    out = run_dir(spark, "json_meta_roundtrip")
    save_metadata(metadata_frame(spark, "group_mean_tree", m), out)
    meta = load_metadata(spark, out)
    return meta.select("model_name", F.round("metrics.RMSE", 6).alias("RMSE"),
                       F.round("metrics.R2", 10).alias("R2"), F.round("metrics.MAE", 6).alias("MAE"))


@register("linear_two_feature", with_listings("""
WITH s AS (SELECT var_samp(Year) AS v1, var_samp(kmDriven) AS v2, covar_samp(Year, kmDriven) AS c12,
  covar_samp(Year, AskPrice) AS c1y, covar_samp(kmDriven, AskPrice) AS c2y,
  avg(Year) AS m1, avg(kmDriven) AS m2, avg(AskPrice) AS my FROM train),
b AS (SELECT (v2*c1y - c12*c2y) / (v1*v2 - c12*c12) AS b1, (v1*c2y - c12*c1y) / (v1*v2 - c12*c12) AS b2, m1, m2, my FROM s),
coef AS (SELECT 'Year' AS term, b1 AS value FROM b UNION ALL SELECT 'kmDriven', b2 FROM b
 UNION ALL SELECT 'intercept', my - b1*m1 - b2*m2 FROM b)
SELECT term, """ + _mantissa_sql("value") + " FROM coef"))
def q_linear_two_feature(spark, sf_dir):
    """Least squares of price on Year and kmDriven (normal equations) on the training split."""
    train, _ = split(materialized(spark, sf_dir, YEAR_COLS))
    asm = VectorAssembler(inputCols=["Year", "kmDriven"], outputCol="f")
    lr = LinearRegression(featuresCol="f", labelCol=LABEL, regParam=0.0, solver="normal")
    m = lr.fit(asm.transform(train))
    rows = [("Year", float(m.coefficients[0])), ("kmDriven", float(m.coefficients[1])),
            ("intercept", float(m.intercept))]
    coef = spark.createDataFrame(rows, "term string, value double")
    mant, exp = _mantissa("value")
    return coef.select("term", mant.alias("mantissa"), exp.alias("exponent"))


def _group_mean_model(spark, sf_dir, family):
    train, test = split(materialized(spark, sf_dir, YEAR_COLS))
    if family == "rf":
        est = RandomForestRegressor(featuresCol="f", labelCol=LABEL, numTrees=1, bootstrap=False,
                                    maxDepth=DEEP, featureSubsetStrategy="all", seed=SEED)
    else:
        est = GBTRegressor(featuresCol="f", labelCol=LABEL, maxIter=1, maxDepth=DEEP, seed=SEED)
    model = est.fit(_one_feature(train, "Year"))
    pred = model.transform(_one_feature(test, "Year"))
    return pred.select("Year", F.round("prediction", 4).alias("prediction")).distinct()


_GROUP_MEAN_PRED = with_listings(_GROUP_MEAN_SQL + """
SELECT DISTINCT t.Year, round(m.prediction, 4) AS prediction FROM test t JOIN means m USING (Year)""")


@register("rf_group_mean", _GROUP_MEAN_PRED)
def q_rf_group_mean(spark, sf_dir):
    """A one-tree forest without bagging on Year predicts the training mean per Year."""
    return _group_mean_model(spark, sf_dir, "rf")


@register("gbt_group_mean", _GROUP_MEAN_PRED)
def q_gbt_group_mean(spark, sf_dir):
    """One boosting round on Year predicts the training mean per Year."""
    return _group_mean_model(spark, sf_dir, "gbt")


@register("cv_group_mean", with_listings("""
WITH tf AS (SELECT Year, AskPrice, CAST(split_key % 3 AS INTEGER) AS fold FROM train),
folds AS (SELECT DISTINCT fold FROM tf),
means AS (SELECT f.fold, t.Year, avg(t.AskPrice) AS prediction FROM folds f JOIN tf t ON t.fold <> f.fold
          GROUP BY f.fold, t.Year),
per_fold AS (SELECT v.fold, sqrt(avg((v.AskPrice - m.prediction)^2)) AS rmse
             FROM tf v JOIN means m ON m.fold = v.fold AND m.Year = v.Year GROUP BY v.fold)
SELECT 'maxDepth=10' AS params, round(avg(rmse), 6) AS avg_rmse FROM per_fold"""))
def q_cv_group_mean(spark, sf_dir):
    """3-fold CV (folds from the row hash) of the per-Year tree: mean validation RMSE."""
    train, _ = split(materialized(spark, sf_dir, YEAR_COLS))
    t = _one_feature(with_fold(train, 3), "Year")
    tuned = cross_validate("Random Forest", t, None, grid={"maxDepth": [DEEP]}, folds=3, features_col="f",
                           parallelism=1, numTrees=1, bootstrap=False, featureSubsetStrategy="all")
    return tuned.cv_metrics.select("params", F.round("avg_rmse", 6).alias("avg_rmse"))


# --- full families (rows-only) ----------------------------------------------

def _prepared(spark, sf_dir, folds: int | None = None, **own):
    rows = materialized(spark, sf_dir)
    prep = prepare_features(rows, folds=folds, **own)
    release(rows)  # the dictionary and the vectors are tables of their own
    return prep, prep.train, prep.test


@register("model_comparison")
def q_model_comparison(spark, sf_dir):
    """Linear, 50-tree forest, 10-round boosting: test metrics per family (fit time left out)."""
    _, train, test = _prepared(spark, sf_dir)
    comp = compare_models(train, test, persist=False)
    return comp.metrics.drop("fit_seconds")


@register("best_model")
def q_best_model(spark, sf_dir):
    """The family with the lowest test RMSE (earlier family on ties)."""
    _, train, test = _prepared(spark, sf_dir)
    return best_model_row(compare_models(train, test, persist=False).metrics).drop("fit_seconds")


@register("feature_importance")
def q_feature_importance(spark, sf_dir):
    """Named importances of the boosted model's features, every label of a text column a value of its own."""
    prep, train, test = _prepared(spark, sf_dir, forms=(INDEXED,), tree_labels=None)
    comp = compare_models(train, test, ["Gradient Boosting"], persist=False)
    return feature_importance(spark, comp.models["Gradient Boosting"], prep.features.categoricals + prep.features.numerics)


def _cv(spark, sf_dir, family, grid=None):
    form = SCALED if family == "Linear Regression" else INDEXED
    _, train, test = _prepared(spark, sf_dir, folds=3, forms=(form,))
    return cross_validate(family, train, test, grid=grid)


@register("cv_lr")
def q_cv_lr(spark, sf_dir):
    """3-fold CV of the linear model over regParam × elasticNetParam (9 points)."""
    return _cv(spark, sf_dir, "Linear Regression").cv_metrics


@register("cv_rf")
def q_cv_rf(spark, sf_dir):
    """3-fold CV of the forest over numTrees × maxDepth (9 points)."""
    return _cv(spark, sf_dir, "Random Forest").cv_metrics


@register("cv_gbt")
def q_cv_gbt(spark, sf_dir):
    """3-fold CV of boosting over maxDepth × maxIter (9 points)."""
    return _cv(spark, sf_dir, "Gradient Boosting").cv_metrics


@register("tuned_vs_base")
def q_tuned_vs_base(spark, sf_dir):
    """Tuned linear model vs the untuned one, compared out of fold; RMSE on the test split beside it."""
    _, train, test = _prepared(spark, sf_dir, folds=3, forms=(SCALED,))
    comp = compare_models(train, test, ["Linear Regression"], persist=False, by_sums=True)
    base = comp.metrics.first().asDict()
    tuned, choice = tune_and_choose("Linear Regression", base, train, test)
    return spark.createDataFrame(
        [("Linear Regression", choice, float(base["out_of_fold"]["rmse"]), float(tuned.out_of_fold["rmse"]), float(base["rmse"]),
          float(tuned.test_metrics["rmse"]))],
        "model string, choice string, base_oof_rmse double, tuned_oof_rmse double, base_rmse double, tuned_rmse double")


@register("train_job")
def q_train_job(spark, sf_dir):
    """The whole training job (compare, tune the best, save artefacts as a run); its metrics table, read back."""
    out = f"{artifact_dir(spark, 'train_job')}/{uuid.uuid4().hex}"
    train_job(clean(spark, sf_dir), out, versioned=True, by_sums=True)
    return stored_run(spark, out)


def stored_run(spark, out):
    """The metrics table of a store's newest run, with the model that its manifest names."""
    names = manifests(spark, out).orderBy(F.desc("version")).limit(1).select("model_name", F.col("choice").alias("final"),
                                                                                    F.col("creation_date").rlike(r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d$").alias("dated"))
    metrics = spark.read.parquet(f"{current_path(spark, out)}/{METRICS_DIR}").drop("fit_seconds")
    return metrics.join(F.broadcast(names), F.lit(True)).withColumn("chosen", F.col("model") == F.col("model_name")).drop("model_name")


@register("score_from_saved")
def q_score_from_saved(spark, sf_dir):
    """Train without tuning, save, load the artefacts back and score the raw listings as requests."""
    out = f"{artifact_dir(spark, 'score_from_saved')}/{uuid.uuid4().hex}"
    train_job(clean(spark, sf_dir), out, tune=False, save_clean=False, by_sums=True)
    art = load_artifacts(spark, out)
    return score_all(requests(spark, sf_dir), art)


@register("score_stream")
def q_score_stream(spark, sf_dir):
    """Requests written as files, scored by the streaming job (available-now trigger)."""
    from ..streaming.score_stream import REQUEST_FILE_SCHEMA, read_sink, score_stream
    base = artifact_dir(spark, f"score_stream/{uuid.uuid4().hex}")
    train_job(clean(spark, sf_dir), f"{base}/model", tune=False, save_clean=False)
    req = requests(spark, sf_dir)
    req.select(*[F.col(f.name).cast("string") if f.name in req.columns else F.lit(None).cast("string").alias(f.name)
                 for f in REQUEST_FILE_SCHEMA.fields]).write.mode("overwrite").parquet(f"{base}/requests")
    for h in score_stream(spark, f"{base}/model", f"{base}/requests", f"{base}/out", checkpoint_dir=f"{base}/ckpt"):
        h.awaitTermination()
    bad = read_sink(spark, f"{base}/out", "quarantine").withColumn("errors", F.split("errors", "; "))
    return all_requests(read_sink(spark, f"{base}/out", "scored"), bad)
