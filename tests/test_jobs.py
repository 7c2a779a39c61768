"""End-to-end jobs on the smallest tables: train, save, load, score (rows and sanity bounds)."""

import os
import uuid

import pandas as pd
import pytest
from pyspark.sql import functions as F

from pricelens.operators.features import prepare, split
from pricelens.operators.models import compare_models
from pricelens.plans.common import clean
from pricelens.plans.q_serve import requests
from pricelens.plans.score import requests_from_records, score_requests
from pricelens.plans.train import train
from pricelens.schema import MODEL_FAMILIES
from pricelens.session import ensure_checkpoint_dir
from pricelens.sources.artifacts import load_artifacts, metadata_or_default

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def trained(spark):
    out = os.path.join(ensure_checkpoint_dir(spark), "test-artifacts", uuid.uuid4().hex)
    res = train(clean(spark, SF_SMALL), out, "narrow", grid={"regParam": [0.01, 0.1], "elasticNetParam": [0.0]},
                save_clean=True)
    return res, out


def test_comparison_has_every_family_and_positive_r2(trained):
    res, _ = trained
    rows = {r.model: r for r in res.comparison.metrics.collect()}
    assert set(rows) == set(MODEL_FAMILIES)
    for r in rows.values():
        assert r.r2 > 0 and r.rmse >= r.mae > 0 and abs(r.mse - r.rmse ** 2) < 1e-6 * r.mse
    assert res.best_name == min(rows.values(), key=lambda r: (r.rmse, r.model_order)).model
    assert res.choice in ("base", "tuned")


def test_second_run_overwrites_artifacts(spark, trained):
    res, out = trained
    again = train(clean(spark, SF_SMALL), out, "narrow", families=["Linear Regression"], tune=False, save_clean=False)
    assert again.best_name == "Linear Regression"
    assert load_artifacts(spark, out).model_name == "Linear Regression"


def test_score_from_saved_keeps_every_valid_row(spark, trained):
    _, out = trained
    art = load_artifacts(spark, out)
    req = requests(spark, SF_SMALL)
    scored, bad = score_requests(req, art)
    assert scored.count() + bad.count() == req.count()
    assert scored.filter(F.abs(F.col("adjusted_prediction") - 0.85 * F.col("prediction")) > 1e-6).count() == 0


def test_metadata_default_when_missing(spark):
    meta = metadata_or_default(spark, "/nonexistent/pricelens").first()
    assert meta.model_name == "Unknown" and meta.metrics.RMSE == 0.0


def test_missing_artifacts_raise(spark):
    with pytest.raises(FileNotFoundError):
        load_artifacts(spark, "/nonexistent/pricelens")


def test_records_and_pandas_requests(spark, trained):
    _, out = trained
    art = load_artifacts(spark, out)
    recs = [{"Brand": "Brand#13", "model": "x", "Year": 1996, "kmDriven": 23000, "Transmission": "Manual",
             "Owner": "first", "FuelType": "Petrol"},
            {"Brand": "Brand#13", "model": "x", "Year": "abc", "kmDriven": 1, "Transmission": "Manual",
             "Owner": "first", "FuelType": "Petrol"}]
    for src in (recs, pd.DataFrame(recs)):
        scored, bad = score_requests(requests_from_records(spark, src), art)
        assert scored.count() == 1 and bad.count() == 1


def test_forest_predictions_stay_in_label_range(spark):
    prep = prepare(clean(spark, SF_SMALL), "narrow")
    comp = compare_models(prep.train, prep.test, ["Random Forest"])
    lo, hi = prep.train.agg(F.min("AskPrice"), F.max("AskPrice")).first()
    p = comp.models["Random Forest"].transform(prep.test).agg(F.min("prediction"), F.max("prediction")).first()
    assert lo <= p[0] and p[1] <= hi


def test_split_is_disjoint_and_complete(spark):
    df = clean(spark, SF_SMALL)
    tr, te = split(df)
    assert tr.count() + te.count() == df.count()
    assert tr.select("listing_id").intersect(te.select("listing_id")).count() == 0


def test_wide_profile_matches_the_original_feature_layout(spark):
    """Every text column one-hot (unknown slot dropped) + Year, Age, kmDriven."""
    from pricelens.operators.features import feature_names
    from pricelens.schema import WIDE_CATEGORICALS
    df = clean(spark, SF_SMALL)
    prep = prepare(df, "wide")
    tr, _ = split(df)
    labels = sum(tr.select(c).distinct().count() for c in WIDE_CATEGORICALS)
    names = feature_names(prep.pipeline_model.transform(df.limit(0)), "features")
    assert len(names) == labels + 3
    assert names[-3:] == ["Year", "Age", "kmDriven"]
    row = prep.train.select("scaled_features").first()[0]
    assert row.size == labels + 3


def test_missing_input_file_is_reported(spark):
    from pricelens.sources.listings import read_raw_csv
    with pytest.raises(FileNotFoundError, match="not found"):
        read_raw_csv(spark, "/nonexistent/listings.csv")


def test_train_then_score(spark):
    from pricelens.plans.train import train_then_score
    out = os.path.join(ensure_checkpoint_dir(spark), "test-artifacts", uuid.uuid4().hex)
    res, scored, bad = train_then_score(clean(spark, SF_SMALL), requests(spark, SF_SMALL), out,
                                        families=["Linear Regression"], tune=False, save_clean=False)
    assert res.best_name == "Linear Regression"
    assert scored.count() + bad.count() == requests(spark, SF_SMALL).count()


def test_selection_on_a_validation_slice(spark):
    prep = prepare(clean(spark, SF_SMALL), "narrow")
    comp = compare_models(prep.train, prep.test, ["Linear Regression", "Gradient Boosting"], select_on="validation")
    rows = {r.model: r for r in comp.metrics.collect()}
    assert all(r.val_rmse is not None and r.val_rmse > 0 for r in rows.values())
    assert comp.best_name == min(rows.values(), key=lambda r: (r.val_rmse, r.model_order)).model


def test_a_linear_run_leaves_no_older_importances(spark):
    out = os.path.join(ensure_checkpoint_dir(spark), "test-artifacts", uuid.uuid4().hex)
    rows = clean(spark, SF_SMALL)
    train(rows, out, families=["Gradient Boosting"], tune=False, save_clean=False)
    assert spark.read.parquet(f"{out}/feature_importance").count() > 0
    train(rows, out, families=["Linear Regression"], tune=False, save_clean=False)
    assert spark.read.parquet(f"{out}/feature_importance").count() == 0


def test_a_base_model_chosen_on_a_slice_is_fitted_again_on_all_training_rows(spark):
    rows = clean(spark, SF_SMALL)
    by_slice = train(rows, None, families=["Linear Regression"], tune=False, select_on="validation")
    whole = train(rows, None, families=["Linear Regression"], tune=False)
    assert by_slice.final_metrics["rmse"] == pytest.approx(whole.final_metrics["rmse"], rel=1e-9)


def test_streaming_scorer_matches_batch_scoring(spark, trained):
    """Requests dropped as files are scored by the stream exactly like the batch job."""
    from pricelens.streaming.score_stream import REQUEST_FILE_SCHEMA, score_stream
    _, out = trained
    base = os.path.join(ensure_checkpoint_dir(spark), "test-stream", uuid.uuid4().hex)
    req = requests(spark, SF_SMALL)
    req.select(*[F.col(f.name).cast("string") if f.name in req.columns else F.lit(None).cast("string").alias(f.name)
                 for f in REQUEST_FILE_SCHEMA.fields]).write.parquet(f"{base}/requests")
    for h in score_stream(spark, out, f"{base}/requests", f"{base}/out", checkpoint_dir=f"{base}/ckpt"):
        h.awaitTermination()
    streamed = spark.read.parquet(f"{base}/out/scored")
    batch, _ = score_requests(req, load_artifacts(spark, out))
    key = ["listing_id", "prediction"]
    assert sorted(streamed.select(*key).collect()) == sorted(batch.select(*key).collect())
    assert spark.read.parquet(f"{base}/out/quarantine").count() + streamed.count() == req.count()


def request_files(spark, base, parts):
    from pricelens.streaming.score_stream import REQUEST_FILE_SCHEMA
    req = requests(spark, SF_SMALL).select(*[F.col(f.name).cast("string") if f.name in requests(spark, SF_SMALL).columns else F.lit(None).cast("string").alias(f.name)
                                             for f in REQUEST_FILE_SCHEMA.fields])
    for k in range(parts):
        req.where(F.pmod(F.xxhash64("*"), F.lit(parts)) == k).coalesce(1).write.mode("append").parquet(f"{base}/requests")
    return req


def test_a_failed_batch_is_repeated_and_nothing_is_lost_or_doubled(spark, trained, monkeypatch):
    from pricelens.streaming import score_stream as stream
    _, out = trained
    base = os.path.join(ensure_checkpoint_dir(spark), "test-stream", uuid.uuid4().hex)
    req = request_files(spark, base, 3)
    whole = stream.score_batch

    def dies_after_writing(df, k, *a):
        whole(df, k, *a)
        if k == 1:
            raise RuntimeError("executor and driver lost")

    monkeypatch.setattr(stream, "score_batch", dies_after_writing)
    run = lambda: [h.awaitTermination() for h in stream.score_stream(
        spark, out, f"{base}/requests", f"{base}/out", checkpoint_dir=f"{base}/ckpt", max_files_per_trigger=1)]
    with pytest.raises(Exception, match="lost"):
        run()
    monkeypatch.setattr(stream, "score_batch", whole)
    run()
    run()
    scored, bad = score_requests(req, load_artifacts(spark, out))
    key = ["listing_id", "prediction"]
    assert sorted(stream.read_sink(spark, f"{base}/out", "scored").select(*key).collect()) == sorted(scored.select(*key).collect())
    assert stream.read_sink(spark, f"{base}/out", "quarantine").count() == bad.count()


def test_stream_reads_csv_requests_like_the_batch_reader(spark, trained):
    from pricelens.streaming import score_stream as stream
    from pricelens.sources.listings import write_clean
    _, out = trained
    base = os.path.join(ensure_checkpoint_dir(spark), "test-stream", uuid.uuid4().hex)
    names = [f.name for f in stream.REQUEST_FILE_SCHEMA.fields]
    odd = spark.createDataFrame([["a", "Brand#13", ' two\nlines, "q" ', "1996", None, "1000", "Manual", "first", "Petrol", "Jan-96", "x"]],
                                ", ".join(f"`{n}` string" for n in ["listing_id", "Brand", "model", "Year", "Age", "kmDriven", "Transmission", "Owner", "FuelType", "PostedDate", "AdditionInfo"]))
    write_clean(odd.select(*names).coalesce(1), f"{base}/requests", fmt="csv")
    for h in stream.score_stream(spark, out, f"{base}/requests", f"{base}/out", fmt="csv", checkpoint_dir=f"{base}/ckpt"):
        h.awaitTermination()
    assert [r.model for r in stream.read_sink(spark, f"{base}/out", "scored").collect()] == [' two\nlines, "q" ']


def test_train_on_all_ten_features_save_and_score(spark):
    from pricelens.operators.dictionary import FeatureModel
    out = os.path.join(ensure_checkpoint_dir(spark), "test-artifacts", uuid.uuid4().hex)
    res = train(clean(spark, SF_SMALL), out, families=["Linear Regression"], grid={"regParam": [0.01, 100.0]}, save_clean=False)
    art = load_artifacts(spark, out)
    assert isinstance(art.pipeline_model, FeatureModel) and len(art.pipeline_model.categoricals + art.pipeline_model.numerics) == 10
    assert res.tuned.out_of_fold["rmse"] > 0 and res.choice in ("base", "tuned")
    req = requests(spark, SF_SMALL)
    scored, bad = score_requests(req, art)
    assert scored.count() + bad.count() == req.count() and scored.where("prediction is null").count() == 0


def test_profile_builds_every_summary(spark):
    from pricelens.operators.profile import profile
    from pricelens.plans.common import materialized
    df = materialized(spark, SF_SMALL)
    out = profile(df)
    n = df.count()
    assert out["shape"].first().n_rows == n
    assert out["histogram"].agg(F.sum("n")).first()[0] == n
    assert out["kde"].count() == 200
    assert out["price_by_year"].agg(F.sum("n")).first()[0] == n
    for c in ["Brand", "FuelType", "Transmission", "Owner"]:
        box = out[f"box_by_{c}"].collect()
        assert 0 < len(box) <= 10
        assert all(r.whisker_low <= r.median <= r.whisker_high for r in box)


def test_release_deletes_only_checkpoint_tables(spark):
    from pricelens.session import cut_lineage, release
    t = cut_lineage(spark.range(10))
    files = t.inputFiles()
    assert release(t)
    assert not release(spark.read.parquet(f"{SF_SMALL}/region.parquet"))
    import os as _os
    assert not any(_os.path.exists(f.replace("file:", "")) for f in files)
