"""Feature dictionaries against MLlib's own indexer, encoder, assembler and scaler, and their odd cases."""

import os
import uuid

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from pricelens.operators import dictionary
from pricelens.operators.dictionary import INDEXED, FeatureModel, fit_features, prepare_features
from pricelens.operators.features import SCALED, feature_pipeline, index_labels
from pricelens.plans.common import clean, materialized
from pricelens.schema import ID, WIDE_CATEGORICALS, WIDE_NUMERICS
from pricelens.session import ensure_checkpoint_dir

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def rows(spark):
    return materialized(spark, SF_SMALL)


@pytest.fixture(scope="module")
def model(rows):
    return fit_features(rows)


@pytest.fixture(scope="module")
def mllib(rows):
    return feature_pipeline(WIDE_CATEGORICALS, WIDE_NUMERICS).fit(rows)


def test_columns_come_from_the_schema(rows, model):
    assert set(model.categoricals) == set(WIDE_CATEGORICALS) and set(model.numerics) == set(WIDE_NUMERICS)
    extra = fit_features(rows.withColumn("Color", F.lit("red")).withColumn("Doors", F.lit(4)))
    assert extra.categoricals[-1] == "Color" and extra.numerics[-1] == "Doors" and extra.width == model.width + 2


def test_labels_are_those_of_the_indexer(rows, mllib):
    model = fit_features(rows, WIDE_CATEGORICALS, WIDE_NUMERICS)
    got = {}
    for r in model.labels.orderBy("slot").collect():
        got.setdefault(r.column_name, []).append(r.label)
        assert r.idx == len(got[r.column_name]) - 1
    assert got == index_labels(mllib)
    assert [r.slot for r in model.labels.select("slot").orderBy("slot").collect()] == list(range(sum(model.sizes)))


@pytest.mark.parametrize("limits", [(100_000, 1_000), (0, 1_000), (0, 4), (0, 10**9)])
def test_vectors_are_those_of_the_pipeline(rows, mllib, limits, monkeypatch):
    """Both ways of joining, with and without hot labels, give MLlib's scaled vectors; unseen labels and nulls give none."""
    monkeypatch.setattr(dictionary, "BROADCAST_LABELS", limits[0])
    monkeypatch.setattr(dictionary, "HOT_SHARE", limits[1])
    model = fit_features(rows, WIDE_CATEGORICALS, WIDE_NUMERICS)
    asked = rows.limit(300).withColumn("Brand", F.when(F.col("Year") % 3 == 0, F.lit("unseen")).when(F.col("Year") % 3 == 1, F.col("Brand")))
    asked = asked.withColumn("k", F.xxhash64(*rows.columns))
    key = [ID, "k"]
    want = {(r[ID], r.k): r.v for r in mllib.transform(asked).select(*key, vector_to_array(SCALED).alias("v")).collect()}
    got = {(r[ID], r.k): r.v for r in model.transform(asked, key).select(*key, vector_to_array(SCALED).alias("v")).collect()}
    assert set(got) == set(want)
    for k, v in want.items():
        assert got[k] == pytest.approx(v, rel=1e-9)


def test_indexes_carry_their_arity_and_unknown_is_last(spark, rows, model):
    table = model.transform(rows.limit(5).withColumn("Owner", F.lit("unseen")))
    nominal = table.schema[INDEXED].metadata["ml_attr"]["attrs"]["nominal"]
    at = {a["name"]: a for a in nominal}
    assert at["Brand"]["num_vals"] == model.arities[model.categoricals.index("Brand")]
    i = model.categoricals.index("Owner")
    assert {r.v[i] for r in table.select(vector_to_array(INDEXED).alias("v")).collect()} == {at["Owner"]["num_vals"] - 1.0}
    cut = FeatureModel(model.labels, model.categoricals, model.numerics, model.sizes, model.label_bytes, model.numeric_std, 80)
    top = vector_to_array(INDEXED)[model.categoricals.index("AdditionInfo")]
    assert cut.transform(rows).agg(F.max(top)).first()[0] == 10.0


def test_a_row_without_a_number_has_no_vector_and_constants_are_scaled_by_zero(spark):
    df = spark.createDataFrame([("a", "x", 1.0, 7, 5.0), ("b", None, None, 7, 5.0), ("c", "y", 3.0, 7, 5.0)], f"{ID} string, t string, n double, m int, AskPrice double")
    model = fit_features(df)
    got = {r[ID]: r.v for r in model.transform(df).select(ID, F.col(SCALED).alias("v")).collect()}
    assert got["b"] is None and got["a"].size == 4 and got["a"].toArray()[3] == 0.0
    assert {r.label: r.n for r in model.labels.collect()} == {"x": 1, "y": 1}


def test_empty_and_text_free_tables(spark, rows):
    empty = fit_features(rows.limit(0))
    assert empty.n_rows == 0 and empty.labels.count() == 0 and empty.transform(rows.limit(0)).count() == 0
    numbers = fit_features(rows.select(ID, "Year", "kmDriven", "AskPrice"))
    assert numbers.width == 2 and numbers.transform(rows.limit(3)).first()[SCALED].size == 2


def test_save_and_load(spark, rows, model):
    path = os.path.join(ensure_checkpoint_dir(spark), "test-features", uuid.uuid4().hex)
    model.save(path)
    again = FeatureModel.load(spark, path)
    assert again.width == model.width and again.arities == model.arities
    key = lambda m: sorted(m.triples(rows.limit(20)).collect())
    assert key(again) == key(model)


def test_prepared_tables_are_dealt_over_their_files(spark):
    p = prepare_features(clean(spark, SF_SMALL), folds=3, partitions=6)
    assert len(p.train.inputFiles()) == 6
    per = [r["count"] for r in p.train.groupBy(F.input_file_name()).count().collect()]
    assert len(per) == 6 and max(per) < 2 * min(per)
    assert p.train.select("fold").distinct().count() == 3 and p.test.where(F.col(SCALED).isNull()).count() == 0
