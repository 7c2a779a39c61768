"""Registered queries: the model and scoring jobs on models that SQL can reproduce.

The operators are those of the full families (``compare_models``,
``cross_validate``, ``predict``, the artefact store, the streaming scorer);
only the estimators are reduced: least squares on Year is
``regr_slope``/``regr_intercept``, and one unbagged tree (or one boosting
round) on Year, deep enough for a leaf a value, is the mean per Year.
"""

from __future__ import annotations

import uuid

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from ..operators.features import split, with_fold
from ..operators.models import best_model_row, compare_models, cross_validate, estimator, feature_importance, tune_and_choose
from ..oracles import with_listings
from ..registry import register
from ..schema import ID, LABEL, MARKET_FACTOR, PRICE_DECIMALS
from ..sources.artifacts import artifact_dir, load_artifacts, metadata_frame, save_metadata, save_model, save_pipeline
from .common import clean, materialized
from .q_models import DEEP, stored_run
from .q_serve import CONFORMED_SQL, requests
from .score import all_requests, predict, score_all
from .train import train as train_job

ONE_TREE = dict(numTrees=1, bootstrap=False, maxDepth=DEEP, featureSubsetStrategy="all")
REDUCED = {
    "Linear Regression": dict(solver="normal"),
    "Random Forest": ONE_TREE,
    "Gradient Boosting": dict(maxIter=1, maxDepth=DEEP),
}
_MEANS = "means AS (SELECT Year, avg(AskPrice) AS prediction FROM train GROUP BY Year)"
_LINE = "line AS (SELECT regr_slope(AskPrice, Year) AS b, regr_intercept(AskPrice, Year) AS a FROM train)"
_METRICS = """CAST({order} AS INTEGER) AS model_order, round(sqrt(avg((AskPrice - prediction)^2)), 4) AS rmse,
 round(avg(abs(AskPrice - prediction)), 4) AS mae, round(1 - sum((AskPrice - prediction)^2) / (var_pop(AskPrice) * count(*)), 8) AS r2,
 CAST(count(*) AS BIGINT) AS n"""
_COMPARED = f"""
WITH {_MEANS}, {_LINE},
by_mean AS (SELECT t.AskPrice, m.prediction FROM test t JOIN means m USING (Year)),
by_line AS (SELECT AskPrice, a + b * Year AS prediction FROM test, line),
compared AS (SELECT 'Linear Regression' AS model, {_METRICS.format(order=0)} FROM by_line
 UNION ALL SELECT 'Random Forest', {_METRICS.format(order=1)} FROM by_mean
 UNION ALL SELECT 'Gradient Boosting', {_METRICS.format(order=2)} FROM by_mean)"""
_SCORED = (f"{CONFORMED_SQL}, {_MEANS}\n" + f"""
SELECT c.listing_id, c.errors, c.errors = '' AS is_valid,
 CASE WHEN c.errors = '' THEN round(m.prediction * {MARKET_FACTOR}, {PRICE_DECIMALS}) END AS price
FROM checked c LEFT JOIN means m USING (Year)""")


def _year_features(df):
    return VectorAssembler(inputCols=["Year"], outputCol="f").transform(df)


def _compared(spark, sf_dir, families=None):
    train, test = split(materialized(spark, sf_dir, [ID, "Year", LABEL]))
    return compare_models(_year_features(train), _year_features(test), families, features_col="f", **REDUCED).metrics


def _rounded(metrics):
    return metrics.select("model", "model_order", F.round("rmse", 4).alias("rmse"), F.round("mae", 4).alias("mae"),
                          F.round("r2", 8).alias("r2"), "n")


@register("model_comparison_by_year", with_listings(_COMPARED + "\nSELECT * FROM compared"))
def q_model_comparison_by_year(spark, sf_dir):
    """The three families compared on the test split, on Year alone."""
    return _rounded(_compared(spark, sf_dir))


@register("best_model_by_year", with_listings(
    _COMPARED + "\nSELECT * FROM compared WHERE model_order < 2 ORDER BY rmse, model_order LIMIT 1"))
def q_best_model_by_year(spark, sf_dir):
    """The better of least squares and the one-tree forest, by test RMSE."""
    return _rounded(best_model_row(_compared(spark, sf_dir, ["Linear Regression", "Random Forest"])))


@register("cv_line", with_listings("""
WITH tf AS (SELECT Year, AskPrice, CAST(split_key % 3 AS INTEGER) AS fold FROM train),
folds AS (SELECT DISTINCT fold FROM tf),
lines AS (SELECT f.fold, regr_slope(t.AskPrice, t.Year) AS b, regr_intercept(t.AskPrice, t.Year) AS a
 FROM folds f JOIN tf t ON t.fold <> f.fold GROUP BY f.fold),
per_fold AS (SELECT v.fold, sqrt(avg((v.AskPrice - a - b * v.Year)^2)) AS rmse FROM tf v JOIN lines USING (fold) GROUP BY v.fold)
SELECT 'regParam=0.0' AS params, round(avg(rmse), 4) AS avg_rmse FROM per_fold"""))
def q_cv_line(spark, sf_dir):
    """3-fold CV of least squares on Year: mean validation RMSE over the hash folds."""
    train, _ = split(materialized(spark, sf_dir, [ID, "Year", LABEL]))
    tuned = cross_validate("Linear Regression", _year_features(with_fold(train, 3)), grid={"regParam": [0.0]}, folds=3,
                           features_col="f", parallelism=1, solver="normal")
    return tuned.cv_metrics.select("params", F.round("avg_rmse", 4).alias("avg_rmse"))


_FOLDS = """
WITH tf AS (SELECT Year, kmDriven, AskPrice, CAST(split_key % 3 AS INTEGER) AS fold FROM train), folds AS (SELECT DISTINCT fold FROM tf)"""
RIDGE = [0.01, 0.1, 0.5, 50000.0]
ELASTIC = {"regParam": [0.1, 20000.0], "elasticNetParam": [0.0, 0.5, 1.0]}


@register("cv_ridge", with_listings(_FOLDS + f"""
, sides AS (SELECT f.fold, avg(Year) AS m1, avg(kmDriven) AS m2, avg(AskPrice) AS my, stddev_pop(Year) AS s1, stddev_pop(kmDriven) AS s2, stddev_pop(AskPrice) AS sy,
  corr(Year, kmDriven) AS r12, corr(Year, AskPrice) AS r1, corr(kmDriven, AskPrice) AS r2 FROM folds f JOIN tf t ON t.fold <> f.fold GROUP BY f.fold),
grid AS (SELECT CAST(unnest([{", ".join(map(str, RIDGE))}]) AS DOUBLE) AS reg),
solved AS (SELECT *, 1 + reg / sy AS d FROM sides, grid),
lines AS (SELECT fold, reg, m1, m2, my, (d * r1 - r12 * r2) / (d * d - r12 * r12) * sy / s1 AS b1, (d * r2 - r12 * r1) / (d * d - r12 * r12) * sy / s2 AS b2 FROM solved),
per_fold AS (SELECT reg, fold, sqrt(avg((AskPrice - my - b1 * (Year - m1) - b2 * (kmDriven - m2))^2)) AS rmse FROM tf JOIN lines USING (fold) GROUP BY reg, fold)
SELECT concat('elasticNetParam=0.0, regParam=', reg) AS params, round(avg(rmse), 4) AS avg_rmse FROM per_fold GROUP BY reg"""))
def q_cv_ridge(spark, sf_dir):
    """Ridge grid on Year and kmDriven from one scan: mean validation RMSE of each penalty over the hash folds."""
    train, _ = split(materialized(spark, sf_dir, [ID, "Year", "kmDriven", LABEL]))
    vectors = VectorAssembler(inputCols=["Year", "kmDriven"], outputCol="f").transform(with_fold(train, 3))
    tuned = cross_validate("Linear Regression", vectors, grid={"regParam": RIDGE, "elasticNetParam": [0.0]}, folds=3, features_col="f", solver="normal")
    return tuned.cv_metrics.select("params", F.round("avg_rmse", 4).alias("avg_rmse"))


@register("cv_elastic_net", with_listings(_FOLDS + f"""
, sides AS (SELECT f.fold, avg(Year) AS m, avg(AskPrice) AS my, stddev_pop(Year) AS s, stddev_pop(AskPrice) AS sy, corr(Year, AskPrice) AS r
 FROM folds f JOIN tf t ON t.fold <> f.fold GROUP BY f.fold),
grid AS (SELECT reg, en FROM (SELECT CAST(unnest({ELASTIC["regParam"]}) AS DOUBLE) AS reg), (SELECT CAST(unnest({ELASTIC["elasticNetParam"]}) AS DOUBLE) AS en)),
lines AS (SELECT fold, reg, en, m, my, sign(r) * greatest(abs(r) - en * reg / sy, 0) / (1 + (1 - en) * reg / sy) * sy / s AS b FROM sides, grid),
per_fold AS (SELECT reg, en, fold, sqrt(avg((AskPrice - my - b * (Year - m))^2)) AS rmse FROM tf JOIN lines USING (fold) GROUP BY reg, en, fold)
SELECT concat('elasticNetParam=', en, ', regParam=', reg) AS params, round(avg(rmse), 4) AS avg_rmse FROM per_fold GROUP BY reg, en"""))
def q_cv_elastic_net(spark, sf_dir):
    """Penalty × L1 share on Year from the same sums: soft thresholding in closed form."""
    train, _ = split(materialized(spark, sf_dir, [ID, "Year", LABEL]))
    tuned = cross_validate("Linear Regression", _year_features(with_fold(train, 3)), grid=ELASTIC, folds=3, features_col="f", solver="normal")
    return tuned.cv_metrics.select("params", F.round("avg_rmse", 4).alias("avg_rmse"))


@register("cv_boosting_stages", with_listings(_FOLDS + f"""
, means AS (SELECT f.fold, t.Year, avg(t.AskPrice) AS prediction FROM folds f JOIN tf t ON t.fold <> f.fold GROUP BY f.fold, t.Year),
per_fold AS (SELECT v.fold, sqrt(avg((v.AskPrice - m.prediction)^2)) AS rmse FROM tf v JOIN means m ON m.fold = v.fold AND m.Year = v.Year GROUP BY v.fold)
SELECT concat('maxDepth={DEEP}, maxIter=', k) AS params, round(avg(rmse), 4) AS avg_rmse FROM per_fold, (SELECT unnest([1, 2, 4]) AS k) GROUP BY k"""))
def q_cv_boosting_stages(spark, sf_dir):
    """Rounds grid of boosting on Year from one fit a fold: the first tree is the mean per Year, and no later one can better it."""
    train, _ = split(materialized(spark, sf_dir, [ID, "Year", LABEL]))
    tuned = cross_validate("Gradient Boosting", _year_features(with_fold(train, 3)), grid={"maxDepth": [DEEP], "maxIter": [1, 2, 4]}, folds=3, features_col="f")
    return tuned.cv_metrics.select("params", F.round("avg_rmse", 4).alias("avg_rmse"))


_SHRUNK = 50000.0


@register("tuned_vs_base_by_year", with_listings(_FOLDS + f"""
, sides AS (SELECT f.fold, avg(Year) AS m, avg(AskPrice) AS my, regr_slope(AskPrice, Year) AS b, stddev_pop(AskPrice) AS sy
 FROM folds f JOIN tf t ON t.fold <> f.fold GROUP BY f.fold),
whole AS (SELECT avg(Year) AS m, avg(AskPrice) AS my, regr_slope(AskPrice, Year) AS b, stddev_pop(AskPrice) AS sy FROM tf),
oof AS (SELECT sqrt(avg((AskPrice - my - b * (Year - m))^2)) AS plain, sqrt(avg((AskPrice - my - b / (1 + {_SHRUNK} / sy) * (Year - m))^2)) AS shrunk
 FROM tf JOIN sides USING (fold)),
tested AS (SELECT sqrt(avg((AskPrice - my - b * (Year - m))^2)) AS plain, sqrt(avg((AskPrice - my - b / (1 + {_SHRUNK} / sy) * (Year - m))^2)) AS shrunk
 FROM test, whole)
SELECT 'plain' AS base, CASE WHEN o.shrunk < o.plain THEN 'tuned' ELSE 'base' END AS choice, round(o.plain, 4) AS base_oof_rmse,
 round(o.shrunk, 4) AS tuned_oof_rmse, round(t.shrunk, 4) AS tuned_test_rmse FROM oof o, tested t
UNION ALL SELECT 'shrunk', CASE WHEN o.plain < o.shrunk THEN 'tuned' ELSE 'base' END, round(o.shrunk, 4), round(o.plain, 4), round(t.plain, 4) FROM oof o, tested t"""))
def q_tuned_vs_base_by_year(spark, sf_dir):
    """Least squares on Year against a shrunk line, either as the base: chosen by out-of-fold error, the test error only reported."""
    train, test = split(materialized(spark, sf_dir, [ID, "Year", LABEL]))
    train, test, rows = _year_features(with_fold(train, 3)), _year_features(test), []
    for name, base, other in (("plain", 0.0, _SHRUNK), ("shrunk", _SHRUNK, 0.0)):
        metrics = {}
        tuned, choice = tune_and_choose("Linear Regression", metrics, train, test, {"regParam": [other]}, 3, "f",
                                        base_params={"regParam": base, "solver": "normal"}, solver="normal")
        rows.append((name, choice, metrics["out_of_fold"]["rmse"], tuned.out_of_fold["rmse"], tuned.test_metrics["rmse"]))
    out = spark.createDataFrame(rows, "base string, choice string, base_oof_rmse double, tuned_oof_rmse double, tuned_test_rmse double")
    return out.withColumns({c: F.round(c, 4) for c in out.columns[2:]})


@register("out_of_fold_by_year", with_listings(_FOLDS.replace("SELECT Year, kmDriven", "SELECT listing_id, Year, kmDriven") + """
, means AS (SELECT f.fold, t.Year, avg(t.AskPrice) AS prediction FROM folds f JOIN tf t ON t.fold <> f.fold GROUP BY f.fold, t.Year)
SELECT v.listing_id, v.fold, round(m.prediction, 4) AS prediction FROM tf v JOIN means m ON m.fold = v.fold AND m.Year = v.Year"""))
def q_out_of_fold_by_year(spark, sf_dir):
    """Every training row predicted by the mean per Year of the other folds."""
    from ..operators.models import out_of_fold_table
    train, _ = split(materialized(spark, sf_dir, [ID, "Year", LABEL]))
    table = out_of_fold_table("Random Forest", _year_features(with_fold(train, 3)), 3, "f", **ONE_TREE)
    return table.select(ID, "fold", F.round("prediction", 4).alias("prediction"))


@register("importance_of_stump", with_listings("""
WITH x AS (SELECT AskPrice AS y, CASE WHEN Transmission = 'Automatic' THEN 1 ELSE 0 END AS f0,
 CASE WHEN FuelType = 'Diesel' THEN 1 ELSE 0 END AS f1 FROM train),
inside AS (SELECT 0 AS idx, sum(v * c) AS sse FROM (SELECT var_pop(y) AS v, count(*) AS c FROM x GROUP BY f0)
 UNION ALL SELECT 1, sum(v * c) FROM (SELECT var_pop(y) AS v, count(*) AS c FROM x GROUP BY f1))
SELECT CAST(idx AS INTEGER) AS idx, CASE idx WHEN 0 THEN 'automatic' ELSE 'diesel' END AS feature_name,
 CASE WHEN sse = (SELECT min(sse) FROM inside) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS importance FROM inside"""))
def q_importance_of_stump(spark, sf_dir):
    """Importances of a tree with one split over two 0/1 features: all of it on the one that lowers the variance more."""
    train, _ = split(materialized(spark, sf_dir, [ID, "Transmission", "FuelType", LABEL]))
    flags = train.select(LABEL, (F.col("Transmission") == "Automatic").cast("double").alias("automatic"),
                         (F.col("FuelType") == "Diesel").cast("double").alias("diesel"))
    names = ["automatic", "diesel"]
    model = estimator("Random Forest", "f", **{**ONE_TREE, "maxDepth": 1}).fit(
        VectorAssembler(inputCols=names, outputCol="f").transform(flags))
    return feature_importance(spark, model, names)


@register("train_job_by_year", with_listings(_COMPARED + """
, best AS (SELECT model FROM compared WHERE model_order < 2 ORDER BY rmse, model_order LIMIT 1)
SELECT compared.*, 'base' AS final, true AS dated, model = (SELECT model FROM best) AS chosen FROM compared WHERE model_order < 2"""))
def q_train_job_by_year(spark, sf_dir):
    """The training job on Year alone, stored as a run and read back through its manifest."""
    out = f"{artifact_dir(spark, 'train_job_by_year')}/{uuid.uuid4().hex}"
    own = {"Linear Regression": dict(solver="normal", regParam=0.0), "Random Forest": ONE_TREE}
    train_job(clean(spark, sf_dir).select(ID, "Year", LABEL), out, families=list(own), tune=False, versioned=True, save_clean=False, **own)
    run = stored_run(spark, out)
    return _rounded(run).join(run.select("model", "final", "dated", "chosen"), "model")


def _mean_per_year(spark, sf_dir):
    """(pipeline, one-tree forest) fitted on the training split."""
    train, _ = split(materialized(spark, sf_dir, [ID, "Year", LABEL]))
    pipe = Pipeline(stages=[VectorAssembler(inputCols=["Year"], outputCol="f")]).fit(train)
    return pipe, estimator("Random Forest", "f", **ONE_TREE).fit(pipe.transform(train))


@register("score_batch_by_year", with_listings(f"""
WITH {_MEANS}
SELECT k.listing_id, round(m.prediction, {PRICE_DECIMALS}) AS prediction, round(m.prediction * {MARKET_FACTOR}, {PRICE_DECIMALS}) AS adjusted_prediction,
 'Random Forest' AS model_name FROM keyed k JOIN means m USING (Year)"""))
def q_score_batch_by_year(spark, sf_dir):
    """Every clean listing priced by the mean per Year, and market-adjusted."""
    pipe, model = _mean_per_year(spark, sf_dir)
    out = predict(clean(spark, sf_dir).select(ID, "Year"), pipe, model, "Random Forest", keep=(ID,))
    return out.withColumns({c: F.round(c, PRICE_DECIMALS) for c in ("prediction", "adjusted_prediction")})


def _saved(spark, sf_dir):
    """A folder with pipeline, model and metadata of the mean-per-Year model."""
    out = f"{artifact_dir(spark, 'mean_per_year')}/{uuid.uuid4().hex}"
    pipe, model = _mean_per_year(spark, sf_dir)
    save_pipeline(pipe, out)
    save_model(model, out)
    save_metadata(metadata_frame(spark, "Random Forest", {"rmse": 0.0, "r2": 0.0, "mae": 0.0}), out)
    return out


def _priced(df):
    return df.select(ID, "errors", "is_valid", F.round("adjusted_prediction", PRICE_DECIMALS).alias("price"))


@register("score_from_saved_by_year", with_listings(_SCORED))
def q_score_from_saved_by_year(spark, sf_dir):
    """Every raw listing as a request, priced by stored artefacts or returned with the rules it breaks."""
    art = load_artifacts(spark, _saved(spark, sf_dir))
    return _priced(score_all(requests(spark, sf_dir), art))


@register("score_stream_by_year", with_listings(_SCORED))
def q_score_stream_by_year(spark, sf_dir):
    """The same requests as files, through the streaming job."""
    from ..streaming.score_stream import REQUEST_FILE_SCHEMA, read_sink, score_stream
    base, model = f"{artifact_dir(spark, 'stream_by_year')}/{uuid.uuid4().hex}", _saved(spark, sf_dir)
    req = requests(spark, sf_dir)
    req.select(*[F.col(f.name) if f.name in req.columns else F.lit(None).cast("string").alias(f.name)
                 for f in REQUEST_FILE_SCHEMA.fields]).write.parquet(f"{base}/requests")
    for handle in score_stream(spark, model, f"{base}/requests", f"{base}/out", checkpoint_dir=f"{base}/ckpt"):
        handle.awaitTermination()
    bad = read_sink(spark, f"{base}/out", "quarantine").withColumn("errors", F.split("errors", "; "))
    return _priced(all_requests(read_sink(spark, f"{base}/out", "scored"), bad))
