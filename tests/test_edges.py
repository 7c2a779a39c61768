"""Unusual input: missing values, constant columns, free text with line breaks, files without ids."""

import pytest
from pyspark.sql import Row

from pricelens.operators.clean import column_kinds
from pricelens.operators.features import split
from pricelens.operators.metrics import regression_metrics
from pricelens.operators.profile import box_stats, kde
from pricelens.operators.serve import conform, validate
from pricelens.plans.score import requests_from_records
from pricelens.sources.listings import read_raw_csv, write_clean


def test_records_keep_their_own_values(spark):
    df = conform(requests_from_records(spark, [{"Year": 2018}, {"Year": 2019}, {"Brand": "b"}]))
    assert [r.Year for r in df.collect()] == [2018, 2019, None]
    assert requests_from_records(spark, []).count() == 0
    with pytest.raises(ValueError):
        requests_from_records(spark, 5)


def test_missing_text_is_scored_and_bad_numbers_are_not(spark):
    rows = conform(requests_from_records(spark, [{"Year": 2018, "kmDriven": 1000}, {"Year": 2018, "kmDriven": "NaN"},
                                                 {"Year": 2018, "kmDriven": "Infinity"}, {"Year": 2018, "kmDriven": 1, "FuelType": "Steam"}]))
    assert [r.is_valid for r in validate(rows).collect()] == [True, False, False, False]


def test_metrics_of_a_constant_label(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, None), (1.0, 1.0)], "AskPrice double, prediction double")
    r = regression_metrics(df).first()
    assert (r.n, r.mse, r.r2) == (2, 0.5, None)
    assert regression_metrics(df.limit(0)).first().rmse is None


def test_profile_of_constant_and_empty_columns(spark):
    one = spark.createDataFrame([(3.0,), (3.0,)], "AskPrice double")
    assert kde(one).count() == 0 and kde(one.limit(0)).count() == 0
    assert box_stats(one).first().median == 3.0
    empty = box_stats(one.limit(0)).first()
    assert (empty.n, empty.median) == (0, None)


def test_csv_keeps_text_and_reads_globs(spark, tmp_path):
    text = ["  padded  ", 'line\nbreak, "quoted"', "", "plain"]
    write_clean(spark.createDataFrame([Row(Brand=str(i), AdditionInfo=t) for i, t in enumerate(text)]).coalesce(1), f"{tmp_path}/a", fmt="csv")
    got = {r.Brand: r.AdditionInfo for r in read_raw_csv(spark, f"{tmp_path}/*").collect()}
    assert [got[str(i)] or "" for i in range(4)] == text
    with pytest.raises(FileNotFoundError):
        read_raw_csv(spark, f"{tmp_path}/none")


def test_split_without_id(spark):
    df = spark.createDataFrame([(str(i), i) for i in range(200)], "Brand string, Year int")
    train, test = split(df)
    assert train.count() + test.count() == 200 and 0 < test.count() < 100


def test_every_numeric_type_is_a_feature(spark):
    df = spark.sql("select 'a' as t, 1L as b, cast(1 as decimal(5,2)) as d, cast(1 as float) as f, true as o")
    assert column_kinds(df) == (["t"], ["b", "d", "f", "o"])
