"""Work that has to stay in proportion: views derived once, files by rows, text cleaned once, fits side by side by their size."""

import os

from pyspark.sql import functions as F

from pricelens.operators import dictionary
from pricelens.operators.clean import clean_listings
from pricelens.operators.dictionary import INDEXED, prepare_features
from pricelens.operators.models import estimator, features_for
from pricelens.operators.tuning import ROWS_AT_ONCE, fits_at_once
from pricelens.plans import q_models, q_profile, q_wide
from pricelens.plans.score import score_all
from pricelens.schema import ID, LABEL
from pricelens.session import SHUFFLE_CLEANUP, cut_lineage
from pricelens.sources.artifacts import Artifacts
from pricelens.sources.listings import raw_listings
from pricelens.streaming import score_stream

from .conftest import SF_SMALL


def listings(spark, n=200):
    data = [(f"id-{i}", f"b{i % 7}", "Petrol", 2000 + i % 20, float(i % 50 * 1000), float(1000 + i % 20 * 500 + i % 7)) for i in range(n)]
    return spark.createDataFrame(data, f"{ID} string, Brand string, FuelType string, Year int, kmDriven double, {LABEL} double")


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_documents_are_written_by_all_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(q_wide, "run_dir", lambda *_: f"{tmp_path}/csv")
    texts = {i: f"line {i}\n\"quoted\", {i}" for i in range(40)}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    got = q_wide.q_documents_csv_roundtrip(spark, str(tmp_path)).collect()
    assert len([f for f in os.listdir(f"{tmp_path}/csv") if f.startswith("part-")]) > 1
    assert {r.doc_id: r.n_chars for r in got} == {i: len(t) for i, t in texts.items()} and len(got) == 40


def test_tables_with_vectors_have_files_by_rows(spark, monkeypatch):
    monkeypatch.setattr(dictionary, "ROWS_A_FILE", 10)
    prep = prepare_features(listings(spark), partitions=2)
    assert len(prep.train.inputFiles()) > 8
    assert prep.train.count() + prep.test.count() == 200


def test_text_is_cleaned_once(spark):
    raw = spark.createDataFrame([("1", "b", "m", "2001", "5 km", "₹ 1,000.5"), ("2", "b", "m", "2001", "n/a", "₹ 9"), ("3", "b", "m", "2001", "7", None)],
                                f"{ID} string, Brand string, model string, Year string, kmDriven string, {LABEL} string")
    out = clean_listings(raw)
    assert plan_of(out.select(ID, "kmDriven", LABEL)).count("regexp_replace") == 2
    assert out.select(ID, "kmDriven", LABEL).collect() == [("1", 5.0, 1000.5)]
    assert clean_listings(raw.withColumn("_row", F.lit("kept"))).select("_row").collect() == [("kept",)]


def test_stages_of_the_listing_view_are_compiled(spark):
    own = spark.newSession()
    own.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
    raw_listings(own, SF_SMALL)
    assert own.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


def test_top_lists_read_a_view_derived_once(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(q_profile, "top_categories_per_column", lambda df, *_: seen.append(df) or df)
    q_profile.q_top10_categories(spark, SF_SMALL)
    q_profile.q_top10_free_texts(spark, SF_SMALL)
    assert all("/tables/" in f for df in seen for f in df.inputFiles()) and len(seen) == 2


def test_trees_predict_all_rows_in_one_pass(spark):
    rows = listings(spark)
    prep = prepare_features(rows, partitions=2)
    col, needed = features_for("Random Forest", prep.train)
    model = estimator("Random Forest", col, **{**needed, "numTrees": 3}).fit(prep.train)
    spoiled = rows.withColumn("Year", F.when(F.col("Brand") != "b3", F.col("Year")))
    out = prep.features.predict(spoiled, model)
    assert col == INDEXED and "Union" not in plan_of(out)
    want = {r[ID]: r.prediction for r in model.transform(prep.features.transform(rows)).collect()}
    for r in out.collect():
        assert r.prediction == (None if r.Brand == "b3" else want[r[ID]])


def test_requests_are_derived_once(spark):
    rows = listings(spark)
    prep = prepare_features(rows, partitions=2)
    col, needed = features_for("Linear Regression", prep.train)
    model = estimator("Linear Regression", col, **needed).fit(prep.train)
    requests = rows.drop(LABEL).withColumn("Year", F.when(F.col("Brand") != "b3", F.col("Year")).cast("string"))
    out = score_all(requests, Artifacts(model, prep.features, "Linear Regression", {}))
    assert plan_of(out).count("LogicalRDD") == 0
    got = {r[ID]: (r.is_valid, r.prediction is None) for r in out.collect()}
    assert got == {f"id-{i}": (i % 7 != 3, i % 7 == 3) for i in range(200)}


def test_large_fits_run_one_at_a_time():
    assert [fits_at_once(n, 8) for n in (0, 1_000, ROWS_AT_ONCE // 3, ROWS_AT_ONCE, 10 * ROWS_AT_ONCE)] == [8, 8, 3, 1, 1]


def test_importances_see_every_label(spark, monkeypatch):
    # 32 common labels and 20 rare ones, which alone tell the price; the fuel tells most of it.
    label = lambda i: i % 32 if i < 576 else 32 + i % 20
    high = lambda i: label(i) >= 32 and label(i) % 2 == 1
    data = [(f"id-{i}", f"m{label(i):02d}", "Diesel" if high(i) != (i % 9 == 0) else "Petrol", 2000 + i % 7, 1000.0 + i % 3, 10_000.0 if high(i) else 1_000.0)
            for i in range(800)]
    rows = spark.createDataFrame(data, f"{ID} string, model string, FuelType string, Year int, kmDriven double, {LABEL} double")
    monkeypatch.setattr(q_models, "materialized", lambda *_: rows)
    got = {r.feature_name: r.importance for r in q_models.q_feature_importance(spark, SF_SMALL).collect()}
    assert got["model"] > 0.99 and set(got) == {"model", "FuelType", "Year", "kmDriven"}


def test_labels_of_single_rows_keep_their_index(spark):
    rows = listings(spark, 60).withColumn("Brand", F.col(ID))
    prep = prepare_features(rows, partitions=2, tree_labels=None)
    col, needed = features_for("Gradient Boosting", prep.train)
    assert prep.features.arities[prep.features.categoricals.index("Brand")] == prep.features.n_rows
    assert len(set(r[0][0] for r in prep.train.select(INDEXED).collect())) == prep.features.n_rows
    estimator("Gradient Boosting", col, **needed, maxIter=2).fit(prep.train)


def test_requests_are_scored_in_batches_of_a_bounded_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(score_stream, "BATCH_BYTES", 1)
    spark.range(40).repartition(4).selectExpr(f"cast(id as string) {ID}").write.parquet(f"{tmp_path}/in")
    batches = []
    stream = score_stream.request_stream(spark, f"{tmp_path}/in").select(ID)
    query = stream.writeStream.foreachBatch(lambda df, k: batches.append(df.count())).option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    query.awaitTermination()
    assert len(batches) == 4 and sum(batches) == 40


def test_a_written_table_leaves_no_shuffle_files(spark):
    def seen():
        return spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size()

    before, setting = seen(), spark.conf.get(SHUFFLE_CLEANUP, None)
    table = cut_lineage(spark.range(1_000).repartition(7).groupBy((F.col("id") % 50).alias("k")).count())
    assert seen() <= before and spark.conf.get(SHUFFLE_CLEANUP, None) == setting
    assert table.count() == 50
