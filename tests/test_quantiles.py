"""The range-partitioned exact quantiles equal Spark's one-pass percentile."""

import pytest
from pyspark.sql import functions as F

import pricelens.operators.quantiles as Q
from pricelens.operators.quantiles import exact_quantiles

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]


def _as_dict(df):
    return {tuple(r[:-1]): r[-1] for r in df.collect()}


@pytest.fixture
def skewed(spark):
    # One group holds a third of all rows and one value holds most of that group.
    rows = [("hot", 7.0)] * 2000 + [("hot", float(i % 97)) for i in range(1000)]
    rows += [(f"g{i % 20}", float((i * 37) % 1009) / 3.0) for i in range(6000)]
    rows += [(None, 1.5), (None, 2.5), ("g1", None)]
    return spark.createDataFrame(rows, "k string, x double")


@pytest.mark.parametrize("by", [None, ["k"]])
def test_ranked_equals_percentile(spark, skewed, monkeypatch, by):
    monkeypatch.setattr(Q, "ROWS_PER_RANGE", 50)   # many small ranges
    a = _as_dict(exact_quantiles(skewed, "x", PROBS, by=by, method="aggregate"))
    b = _as_dict(exact_quantiles(skewed, "x", PROBS, by=by, method="ranked"))
    assert a.keys() == b.keys()
    for k in a:
        assert a[k] == pytest.approx(b[k], rel=1e-12, abs=1e-12), k


def test_auto_picks_aggregate_for_small_vocabularies(spark, skewed):
    got = _as_dict(exact_quantiles(skewed, "x", [0.5], by=["k"]))
    assert got[("hot", 0.5)] == 7.0


@pytest.mark.parametrize("by", [None, ["k"]])
@pytest.mark.parametrize("accuracy", [10_000, 100])
def test_bracketed_equals_percentile(spark, skewed, monkeypatch, by, accuracy):
    monkeypatch.setattr(Q, "ROWS_PER_RANGE", 50)
    monkeypatch.setattr(Q, "ACCURACY", accuracy)
    monkeypatch.setattr(Q, "WIDTHS", [3.0 / accuracy, 0.1, 0.3, 1.0])
    a = _as_dict(exact_quantiles(skewed, "x", PROBS, by=by, method="aggregate"))
    b = _as_dict(exact_quantiles(skewed, "x", PROBS, by=by))
    assert a.keys() == b.keys()
    for k in a:
        assert a[k] == pytest.approx(b[k], rel=1e-12, abs=1e-12), k


@pytest.mark.parametrize("n", [1, 2, 3, 5, 21, 400])
def test_bracketed_on_few_values(spark, n):
    df = spark.range(n).select((F.col("id") * 7 % 11).cast("double").alias("x"))
    a = _as_dict(exact_quantiles(df, "x", PROBS, method="aggregate"))
    assert _as_dict(exact_quantiles(df, "x", PROBS)) == pytest.approx(a)
    assert exact_quantiles(df.limit(0), "x", PROBS).count() == 0


def test_only_brackets_are_sorted(spark, monkeypatch):
    sizes = []
    picked = Q._picked
    monkeypatch.setattr(Q, "_picked", lambda counted, *a: sizes.append(counted.count()) or picked(counted, *a))
    df = spark.range(200_000).select(F.xxhash64("id").cast("double").alias("x"))
    got = _as_dict(exact_quantiles(df, "x", [0.25, 0.5]))
    assert sizes[0] < 2_000
    want = _as_dict(exact_quantiles(df, "x", [0.25, 0.5], method="aggregate"))
    assert got == pytest.approx(want)
